"""SentencePiece models on the tokenizers library."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import text_slices

SPACE = "▁"

# Kinds of pieces and of models in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2

# Words whose ids a task remembers; then it starts afresh.
WORDS_HELD = 200_000

# Words that a BPE model encodes in one call.
RUN = 32

# Threads that a task encodes a batch with.
THREADS = 2


@dataclass
class Model:
    """What a model file says about encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    single_spaces: bool = True
    escape_spaces: bool = True
    space_last: bool = False


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield number, data[at : at + size]
            at += size
        else:
            raise ValueError("not a model file")


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for part, x in _fields(value):
                if part == 1:
                    piece = x.decode()
                elif part == 2:
                    score = struct.unpack("<f", x)[0]
                elif part == 3:
                    kind = x
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for part, x in _fields(value):
                if part == 3:
                    model.kind = x
                elif part == 24:
                    model.space_last = bool(x)
                elif part == 35:
                    model.byte_fallback = bool(x)
                elif part == 40:
                    model.unknown = x
        elif number == 3:
            for part, x in _fields(value):
                if part == 2:
                    model.charsmap = x
                elif part == 3:
                    model.dummy_prefix = bool(x)
                elif part == 4:
                    model.single_spaces = bool(x)
                elif part == 5:
                    model.escape_spaces = bool(x)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if model.space_last or not model.escape_spaces:
        raise ValueError("spaces must be marked ahead of words")
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces whose join is a piece, best score of the join first."""
    ids = {piece: n for n, (piece, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = [
        (-score, ids[piece[:cut]], ids[piece[cut:]], piece[:cut], piece[cut:])
        for piece, score, kind in model.pieces
        if kind == NORMAL
        for cut in range(1, len(piece))
        if piece[:cut] in ids and piece[cut:] in ids
    ]
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model, marked: bool = False):
    """The model as a tokenizer.  ``marked``: texts come normalised, with each
    space already replaced by its marker."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        made = models.Unigram(
            [(piece, score) for piece, score, _ in model.pieces], model.unknown, model.byte_fallback
        )
    else:
        made = models.BPE(
            {piece: n for n, (piece, _, _) in enumerate(model.pieces)},
            _merges(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(made)
    users = [piece for piece, _, kind in model.pieces if kind == USER]
    if users:
        tokenizer.add_tokens([AddedToken(piece, normalized=True, special=False) for piece in users])
    if not marked:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.single_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(SPACE))
        steps.append(normalizers.Replace(" ", SPACE))
        tokenizer.normalizer = normalizers.Sequence(steps)
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


@dataclass
class Coded:
    """Ids of some texts in a row, how many each has, and whether they are equal to
    the reference library's and decode to the text."""

    ids: np.ndarray
    sizes: np.ndarray
    parity: np.ndarray
    back: np.ndarray

    @classmethod
    def none(cls) -> Coded:
        return cls(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool))

    def then(self, other: Coded) -> Coded:
        return Coded(*[np.concatenate([getattr(self, f.name), getattr(other, f.name)]) for f in fields(self)])


def _sizes(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32)


def _same_lists(flat: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    same = sizes == other_sizes
    left, right = np.repeat(same, sizes), np.repeat(same, other_sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)[left]
    same[rows[flat[left] != other[right]]] = False
    return same


class Encoder:
    """Encodes texts, and compares what it encodes with the reference library.

    Where no piece holds a space marker past its start, pieces never cross a
    space, so a text is encoded word by word and each distinct word once.  Other
    models, and texts with unusual spaces, are encoded whole."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        self.model = parse_model(data)
        self.whole = build_tokenizer(self.model)
        self.marked = build_tokenizer(self.model, marked=True)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.by_word = (
            not self.model.charsmap
            and self.model.dummy_prefix
            and not any(kind == USER for _, _, kind in self.model.pieces)
            and not any(SPACE in piece.lstrip(SPACE) for piece, _, _ in self.model.pieces)
        )
        # Then words in a row, one marker ahead of each, give the ids of each, and a
        # piece that starts with the marker is the first of a word.
        self.by_run = self.model.kind == BPE and any(piece == SPACE and kind == NORMAL for piece, _, kind in self.model.pieces)
        self.opens = np.array([piece.startswith(SPACE) for piece, _, _ in self.model.pieces])
        # What pieces are shown as; null for those that are not their own text.
        own = [piece.replace(SPACE, " ") if kind == NORMAL and not piece.startswith("<0x") else None for piece, _, kind in self.model.pieces]
        self.shown = pa.array(own, pa.large_string())
        self.places: dict[str, int] = {}
        self.held = Coded.none()

    def _ids(self, texts: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if tokenizer is self.marked:
            if self.by_run:
                runs = [SPACE + SPACE.join(texts[i : i + RUN]) for i in range(0, len(texts), RUN)]
                flat = _flat([x.ids for x in tokenizer.encode_batch_fast(runs, add_special_tokens=False)])
                starts = np.flatnonzero(self.opens[flat])
                return flat, np.diff(np.append(starts, len(flat)))
            texts = [SPACE + x for x in texts]
        lists = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return _flat(lists), _sizes(lists)

    def _back(self, flat: np.ndarray, sizes: np.ndarray, texts: list[str], tokenizer) -> np.ndarray:
        """Whether the ids decode to the texts.

        Ids of plain pieces decode to the pieces in a row; what differs from the
        text by that, or has other ids, is decoded by the tokenizer."""
        ends = np.append(0, np.cumsum(sizes))
        shown = pa.LargeListArray.from_arrays(pa.array(ends), self.shown.take(pa.array(flat)))
        lead, none = (pa.scalar(x, pa.large_string()) for x in (" " if self.model.dummy_prefix else "", ""))
        plain = pc.binary_join_element_wise(lead, pa.array(texts, pa.large_string()), none)
        same = pc.fill_null(pc.equal(pc.binary_join(shown, none), plain), False).to_numpy(zero_copy_only=False).copy()
        rest = np.flatnonzero(~same)
        if len(rest):
            back = tokenizer.decode_batch([flat[ends[i] : ends[i + 1]].tolist() for i in rest], skip_special_tokens=False)
            same[rest] = [b == texts[i] for i, b in zip(rest, back)]
        return same

    def _checked(self, texts: list[str], tokenizer) -> Coded:
        flat, sizes = self._ids(texts, tokenizer)
        others = self.other.encode(texts, num_threads=1)
        parity = _same_lists(flat, sizes, _flat(others), _sizes(others))
        if tokenizer is self.whole and self.model.single_spaces:
            texts = [" ".join(filter(None, x.split(" "))) for x in texts]
        return Coded(flat, sizes, parity, self._back(flat, sizes, texts, tokenizer))

    def encode(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
        """(ids, equal to the other library's, decodes to the text) of each text."""
        n = len(texts)
        odd = np.ones(n, bool)
        if self.by_word:
            unusual = pc.match_substring_regex(texts, f"^ |  | $|{SPACE}")
            odd = pc.or_(unusual, pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd)
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        coded = pc.list_flatten(lists).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [word for word in distinct if word not in self.places]
        if len(self.places) + len(new) > WORDS_HELD:
            self.places, self.held, new = {}, Coded.none(), distinct
        if new:
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.held = self.held.then(self._checked(new, self.marked))
        found = self.held
        places = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        index = places[coded.indices.to_numpy(zero_copy_only=False)]
        rows = np.repeat(plain, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        if odd.any():
            at = np.flatnonzero(odd)
            index = np.append(index, len(found.sizes) + np.arange(len(at)))
            found = found.then(self._checked(texts.take(pa.array(at)).to_pylist(), self.whole))
            order = np.argsort(np.append(rows, at), kind="stable")
            index, rows = index[order], np.append(rows, at)[order]
        before = np.append(0, np.cumsum(found.sizes[index]))
        ends = np.append(0, before[np.searchsorted(rows, np.arange(n), side="right")])
        flat = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(found.sizes)), found.ids).take(pa.array(index)).flatten()
        parity, back = np.ones(n, bool), np.ones(n, bool)
        parity[rows[~found.parity[index]]] = False
        back[rows[~found.back[index]]] = False
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), parity, back


@lru_cache(maxsize=1)
def _encoder(path: str, threads: int) -> Encoder:
    """Kept by a Python worker from task to task; it only saves work."""
    return Encoder(path, threads)


def _encoded(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, threads)
        for batch, texts in text_slices(batches, "text"):
            ids, parity, back = encoder.encode(texts)
            yield pa.record_batch(
                [batch.column("doc_id"), ids.value_lengths().cast(pa.int64()), ids, pa.array(parity), pa.array(back)],
                names=["doc_id", "n_tokens", "ids", "parity", "round_trip"],
            )

    return run


def encode_pieces(docs: DataFrame, model_path: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, n_tokens, ids, parity, round_trip) per row of ``docs`` (doc_id, text).

    ``model_path`` names a SentencePiece model on every executor.  ``parity`` is
    whether the reference library gives the same ids, ``round_trip`` whether they
    decode to the text (its runs of spaces cut to one, where the model does that).
    Null and empty texts have no ids.  Rows that repeat are returned as often, a
    null doc_id as such.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _encoded(model_path, threads),
        "doc_id long, n_tokens long, ids array<int>, parity boolean, round_trip boolean",
    )


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as file:
            tokenizer = build_tokenizer(parse_model(file.read()))
        for batch in batches:
            ids = batch.column("ids")
            texts = tokenizer.decode_batch([x or [] for x in ids.to_pylist()], skip_special_tokens=False)
            texts = pa.array(texts, pa.string(), mask=np.asarray(ids.is_null()))
            yield pa.record_batch([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return run


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give a null text."""
    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(_decoded(model_path), "doc_id long, text string")
