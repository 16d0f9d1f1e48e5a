"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import Words, byte_hashes, same_bytes, text_slices

# Window lengths, longest first, all powers of two; a window of any tier is full.
TIERS = (4096, 2048, 1024, 512)

END = 2

# Tokens of training steps: so many windows of a tier make one step.
STEP_TOKENS = 16 * 4096

# Tokens a task gathers before it packs them.
BUFFER_TOKENS = 1 << 20

# Words whose ids a task remembers, at some 50 bytes each; then it starts afresh.
WORDS_HELD = 2_000_000

_LOWER = np.arange(256)
_LOWER[65:91] += 32

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_id long"
)


class WordIds:
    """Token ids of texts by a tokenizer that splits at white space and between
    letters and marks, and takes A-Z as a-z.

    A text is cut into words, and a comma or full stop off a letter.  Each distinct
    one is encoded once; its ids are held in plain arrays under its 64-bit hash,
    along with its letters, which every word is compared with."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.slots = np.zeros(0, np.int64)
        self.flat, self.place = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.letters, self.spelled = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def _ids(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        """(ids of all words, number of each word), from one call, which is faster
        than many."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        begins = np.cumsum([0] + [len(word) + 1 for word in words])
        place = np.array([start for start, _ in found.offsets], np.int64)
        return found.ids, np.diff(np.searchsorted(place, begins))

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        ids, counts = self._ids([word.decode() for word in words])
        self.letters = np.append(self.letters, np.frombuffer(b"".join(words), np.uint8))
        self.spelled = np.append(self.spelled, self.spelled[-1] + np.cumsum([len(word) for word in words]))
        slots = len(self.place) - 1 + np.arange(len(keys))
        self.flat = np.append(self.flat, np.array(ids, np.uint32))
        self.place = np.append(self.place, self.place[-1] + np.cumsum(counts))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def _slots(self, lower: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Place of each word among those held.  Words that differ from the one held
        under their hash are hashed anew until none does."""
        seed = 0
        while True:
            distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.keys) + len(distinct) > WORDS_HELD:
                self._forget()
            at = np.searchsorted(self.keys, distinct)
            known = at < len(self.keys)
            known[known] = self.keys[at[known]] == distinct[known]
            if not known.all():
                new = first[~known]
                buffer = lower.tobytes()
                self._learn(distinct[~known], [buffer[a:b] for a, b in zip(begin[new].tolist(), end[new].tolist())])
                at = np.searchsorted(self.keys, distinct)
            slot = self.slots[at][index] if len(index) else index
            unlike = np.flatnonzero(
                ~same_bytes(lower, begin, end, self.letters, self.spelled[slot], self.spelled[slot + 1])
            )
            if not len(unlike):
                return slot
            seed += 1
            for i in unlike:
                hashes[i] = xxhash.xxh64_intdigest(lower[begin[i] : end[i]].tobytes(), seed)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end``; first id of each text and the end)."""
        words = Words(texts)
        data = words.data
        if len(words.begin):
            last, before = data[words.end - 1], data[np.maximum(words.end - 2, 0)] | 32
            tail = ((last == 44) | (last == 46)) & (before >= 97) & (before <= 122)
            tail &= words.end - words.begin > 1
            cut = words.end[tail]
            words.begin = np.sort(np.append(words.begin, cut - 1))
            words.end = np.sort(np.append(words.end - tail, cut))
        starts = np.searchsorted(words.begin, words.offsets)
        lower = _LOWER.astype(np.uint8)[data]
        slot = self._slots(lower, words.begin, words.end, byte_hashes(lower, words.begin, words.end))
        place = self.place[slot]
        counts = self.place[slot + 1] - place
        before = np.append(0, np.cumsum(counts))
        source = np.repeat(place - before[:-1], counts) + np.arange(before[-1])
        ends = before[starts[1:]] + np.arange(len(texts))  # one closing id per text before
        ids = np.full(before[-1] + len(texts), end, np.uint32)
        stays = np.ones(len(ids), bool)
        stays[ends] = False
        ids[stays] = self.flat[source]
        return ids, np.append(0, ends + 1)


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """Kept by a Python worker from task to task; it only saves work."""
    return WordIds(path)


class Packer:
    """Packs the documents of one task; a piece is [length, document, start]."""

    def __init__(self, lane: int, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.next_window = self.next_step = lane << 32
        self.pending: list[list] = []
        self.tokens = 0
        self.done: list[tuple[int, list[list]]] = []

    def add(self, document: object, length: int) -> None:
        """Whole windows of the longest tier are cut off first."""
        whole = length - length % self.tiers[0]
        self.done += [(self.tiers[0], [[self.tiers[0], document, at]]) for at in range(0, whole, self.tiers[0])]
        if whole < length:
            self.pending.append([length - whole, document, whole])
        self.tokens += length

    def pack(self, last: bool = False) -> Iterator[tuple]:
        """Rows (piece, window, offset, tier, step) of all windows filled so far.

        Pieces go to the shortest tier that holds them.  From the longest tier
        down, a window takes the longest piece of its tier, then, while one fits,
        the longest piece of its own or a shorter tier; what gap is left is filled
        by cutting a piece.  So every window is full; pieces too few for another
        window wait for more.  The ``last`` of them fill falling powers of two.
        """
        shelves: dict[int, list] = {tier: [] for tier in self.tiers}
        count = 0

        def put(piece: list) -> None:
            nonlocal count
            count += 1  # equal lengths stay apart: documents have no order
            insort(shelves[min(t for t in self.tiers if t >= piece[0])], (piece[0], count, piece))

        for piece in self.pending:
            put(piece)
        self.pending, self.tokens = [], 0
        for tier in self.tiers:
            below = [shelves[t] for t in self.tiers if t <= tier]
            while shelves[tier]:
                window = [shelves[tier].pop()[2]]
                gap = tier - window[0][0]
                while gap and any(below):
                    fits = [(shelf[at - 1][0], n) for n, shelf in enumerate(below) if (at := bisect_right(shelf, (gap, float("inf"))))]
                    if fits:
                        shelf = below[max(fits)[1]]
                        window.append(shelf.pop(bisect_right(shelf, (gap, float("inf"))) - 1)[2])
                    else:
                        length, document, start = next(filter(None, below)).pop()[2]
                        window.append([gap, document, start])
                        put([length - gap, document, start + gap])
                    gap -= window[-1][0]
                if gap:
                    self.pending += window
                else:
                    self.done.append((tier, window))
        if last:
            self._close()
        yield from self._steps()

    def _close(self) -> None:
        rest, self.pending = self.pending, []
        while rest:
            size = 1 << (sum(x[0] for x in rest).bit_length() - 1)
            size, window = min(size, self.tiers[0]), []
            gap = size
            while gap:
                length, document, start = rest.pop()
                part = min(gap, length)
                window.append([part, document, start])
                if part < length:
                    rest.append([length - part, document, start + part])
                gap -= part
            self.done.append((size, window))

    def _steps(self) -> Iterator[tuple]:
        """Windows of a tier are dealt to its steps there and back in order of
        attention cost, the sum of squared piece lengths, so steps cost alike."""
        for tier in sorted({tier for tier, _ in self.done}, reverse=True):
            windows = [window for t, window in self.done if t == tier]
            windows.sort(key=lambda w: -sum(x[0] ** 2 for x in w))
            steps = -(-len(windows) * tier // self.step_tokens)
            for n, window in enumerate(windows):
                turn, place = divmod(n, steps)
                step = self.next_step + (steps - 1 - place if turn % 2 else place)
                offset = 0
                for piece in window:
                    yield piece, self.next_window, offset, tier, step
                    offset += piece[0]
                self.next_window += 1
            self.next_step += steps
        self.done = []


def _packed(path: str, end: int, tiers: tuple[int, ...], step_tokens: int, buffer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(path)
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens)

        def rows(last: bool) -> pa.RecordBatch:
            made = []
            for (length, (doc_id, ids), start), window, offset, tier, step in packer.pack(last):
                crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                made.append((doc_id, start, length, crc, len(ids), window, offset, tier, step))
            columns = list(zip(*made)) or [[]] * 9
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch, texts in text_slices(batches, "text"):
            ids, starts = encoder.encode(texts, end)
            for n, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                packer.add((doc_id, ids[starts[n] : starts[n + 1]].copy()), int(starts[n + 1] - starts[n]))
            if packer.tokens >= buffer:
                yield rows(False)
        yield rows(True)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end: int = END,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in windows of tokens: see ``SCHEMA``.

    Each task encodes its documents and packs them as it goes, so no token is
    shuffled and memory is bounded by ``buffer_tokens`` and the longest document.
    Windows are full in every tier; the last documents of a task close with
    windows of falling powers of two, below the shortest tier if need be.  Nothing
    is padded, and each token lies in exactly one piece.

    ``sequence_id`` and ``step_id`` are unique, but not dense, over tasks.  The
    tokenizer must treat white space as a boundary, as one that splits words does.
    Null texts are empty: one closing id.  Rows that repeat are packed as often;
    a null doc_id is returned as such.  Other columns are ignored.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be falling powers of two")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_packed(tokenizer_path, end, tuple(tiers), step_tokens, buffer_tokens), SCHEMA)
