"""SentencePiece encoding and hierarchical packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from flowlake.llm import pieces  # noqa: E402
from flowlake.llm.packing import pack_documents  # noqa: E402

ODD = [
    "", " ", "  ", "a  b", " a", "a ", "tab\tand\nline", "▁ marked", "a▁b", "emoji 😀😀 x", "<s> and </s> <unk>",
    "İstanbul Σίσυφος ΣΑΣ", "é and ́ alone", "a b　c", "don't we'll I'm", "12345 6.7",
    "<|endoftext|>x<|startoftext|> <|endoftext|>", "x\x1cy", "\x00\x01", "漢字かな交じり", "A" * 5000, "'s 's",
]


@pytest.fixture
def docs(spark, prose):
    dice = random.Random(2)
    rows = list(enumerate(ODD)) + [(100 + i, prose(dice.choice([1, 40, 400, 3000]))) for i in range(40)]
    rows += [(None, "no id"), (900, None), (901, prose(20_000)), (100, "again"), (100, "again")]
    return rows, spark.createDataFrame([(a, b, "x", 7) for a, b in rows], "doc_id long, text string, ids string, start int")


def test_pieces_match_the_other_library(spark, docs):
    import sentencepiece

    rows, table = docs
    path = public_tokenizers.path("piece_bpe_32k.model")
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.encode_pieces(table, path)
    found = sorted(((r.doc_id, r.ids, r.n_tokens, r.parity, r.round_trip) for r in got.collect()), key=str)
    want = sorted(((a, i := other.encode(b or ""), len(i), True, True) for a, b in rows), key=str)
    # A literal marker is a space to the model, so it does not come back.
    assert [x[:4] for x in found] == [x[:4] for x in want]
    marked = {i for i, text in enumerate(ODD) if "▁" in text}
    assert {x[0] for x in found if not x[4]} == marked
    back = pieces.decode_pieces(got.select("doc_id", "ids"), path).collect()
    expected = sorted(((a, (b or "").replace("▁", " ")) for a, b in rows), key=str)
    assert sorted(map(tuple, back), key=str) == expected
    assert pieces.encode_pieces(table.limit(0), path).collect() == []


class Counted:
    """A tokenizer that counts the texts given to it."""

    def __init__(self, inner):
        self.inner, self.encoded, self.decoded = inner, 0, 0

    def encode_batch_fast(self, texts, **options):
        self.encoded += len(texts)
        return self.inner.encode_batch_fast(texts, **options)

    def decode_batch(self, ids, **options):
        self.decoded += len(ids)
        return self.inner.decode_batch(ids, **options)


@pytest.mark.parametrize("held", [50, 200_000])
def test_words_are_encoded_in_runs(prose, monkeypatch, held):
    """The time of a word went to calls for it alone, to encode and to decode it."""
    monkeypatch.setattr(pieces, "WORDS_HELD", held)
    encoder = pieces.Encoder(public_tokenizers.path("piece_bpe_32k.model"), 1)
    counted = encoder.marked = Counted(encoder.marked)
    strange = ["<0x41>", "漢字", "😀x", "\x00", "a\u00a0b", "<s>", "<unk>"]
    slices = [prose(3000).split() + strange for _ in range(4)]
    distinct = sum(len(set(words)) for words in slices)
    for words in slices:
        texts = [" ".join(words), words[0], "", " odd", *strange]
        ids, parity, back = encoder.encode(pa.array(texts, pa.large_string()))
        assert ids.to_pylist() == [encoder.other.encode(x) for x in texts]
        assert parity.all() and back.all()
    assert counted.encoded < distinct / 20 and counted.decoded < distinct / 20


def _message(*parts):
    out = b""
    for number, value in parts:
        def varint(n):
            made = b""
            while True:
                n, low = n >> 7, n & 127
                made += bytes([low | (128 if n else 0)])
                if not n:
                    return made

        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_model_with_byte_fallback(tmp_path):
    """A model file of our own: scores decide, unknown characters become bytes."""
    words = {"▁": -3.0, "a": -2.5, "b": -2.6, "ab": -2.0, "▁ab": -1.5, "ba": -4.0, "▁a": -4.5, "c": -3.5, "bc": -2.2}
    parts = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)]
    parts += [(f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256)] + [(w, s, pieces.NORMAL) for w, s in words.items()]
    data = b"".join(
        _message((1, _message((1, p.encode()), (2, s), (3, k)))) for p, s, k in parts
    ) + _message((2, _message((3, pieces.UNIGRAM), (4, len(parts)), (35, 1), (40, 0), (41, 1), (42, 2)))) + _message(
        (3, _message((1, b"identity"), (3, 1), (4, 1), (5, 1)))
    )
    path = tmp_path / "own.model"
    path.write_bytes(data)
    encoder = pieces.Encoder(str(path))
    texts = ["ab abc", "aab  b ", " cab", "é ab", "a b c abab", "", "zz z"]
    ids, parity, back = encoder.encode(pa.array(texts, pa.large_string()))
    assert ids.to_pylist() == encoder.other.encode(texts)
    assert parity.all() and back.all()


@pytest.mark.parametrize("buffer", [1 << 20, 3000])
def test_packing(spark, docs, buffer):
    from tokenizers import Tokenizer

    rows, table = docs
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want = {}
    for a, b in rows:
        ids = plain.encode(b or "", add_special_tokens=False).ids + [2]
        want.setdefault(a, []).append(ids)
    got = pack_documents(table.repartition(3), path, buffer_tokens=buffer).collect()
    spent, windows = {}, {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
        choices = [x for x in want[r.doc_id] if len(x) == r.doc_tokens]
        crcs = {zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) for x in choices}
        assert r.ids_crc32 in crcs
        spent.setdefault(r.doc_id, []).append(r.length)
    assert {d: sum(x) for d, x in spent.items()} == {d: sum(map(len, x)) for d, x in want.items()}
    for r in {r.doc_id: r for r in got if len(want[r.doc_id]) == 1}.values():
        parts = sorted((x.start, x.length) for x in got if x.doc_id == r.doc_id)
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    steps = {}
    for window in windows.values():
        window.sort(key=lambda r: r.offset)
        assert window[0].offset == 0
        assert all(a.offset + a.length == b.offset for a, b in zip(window, window[1:]))
        total = sum(r.length for r in window)
        assert total == window[0].tier and total & (total - 1) == 0 and total <= 4096
        assert len({(r.tier, r.step_id) for r in window}) == 1
        steps[window[0].step_id] = steps.get(window[0].step_id, 0) + total
    assert max(steps.values()) <= 16 * 4096
    assert pack_documents(table.limit(0), path).collect() == []


def test_tiers_must_fall(spark, docs):
    with pytest.raises(ValueError):
        pack_documents(docs[1], "x", tiers=(512, 4096))
