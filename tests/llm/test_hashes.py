"""Words that hashes of a weak construction would take for equal."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from flowlake.llm import blocks
from flowlake.llm.lines import dedup_lines
from flowlake.llm.substrings import remove_repeats


def thue_morse(length: int) -> tuple[str, str]:
    """Two words of "a" and "b" with one hash under any polynomial modulo 2**64."""
    word = "a"
    while len(word) < length:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [8, 64, 1024, 4096])
def test_hashes_tell_them_apart(length):
    first, second = thue_morse(length)
    words = blocks.Words(pa.array([first, second, f"{second} {first}"], pa.large_string()))
    hashes = words.hashes()
    assert hashes[0] == hashes[3] != hashes[1] == hashes[2]
    spans = blocks.Spans(np.frombuffer((first + second + first).encode(), np.uint8).astype(np.uint64))
    at = np.arange(3) * length
    found = spans.of(at, at + length)
    assert found[0] == found[2] != found[1]


def test_spelling_is_compared():
    data = np.frombuffer(b"alphabet alphabeT alphabet alpha  alphabetical", np.uint8)
    begin, end = np.array([0, 9, 18, 27, 33, 34]), np.array([8, 17, 26, 32, 33, 46])
    got = blocks.same_bytes(data, begin, end, data, np.repeat(0, 6), np.repeat(8, 6))
    assert got.tolist() == [True, False, True, False, False, False]
    assert blocks.same_bytes(data, begin[4:5], end[4:5], data, begin[4:5], end[4:5]).all()


def test_windows_of_different_words_stay(spark):
    first, second = thue_morse(1024)
    twelve = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{twelve} {first}"), (2, f"{twelve} {second}")], "doc_id long, text string")
    assert [r.n_removed for r in remove_repeats(docs).collect()] == [0, 0]


def test_lines_of_different_words_stay(spark):
    first, second = thue_morse(1024)
    docs = spark.createDataFrame([(1, f"p q {first}"), (2, f"p q {second}")], "doc_id long, text string")
    assert [r.n_removed for r in dedup_lines(docs).collect()] == [0, 0]


def test_ids_of_different_words(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from flowlake.llm import packing
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = [*thue_morse(4096), "one two, three", "three one one", ""]

    def check():
        ids, starts = packing.WordIds(path).encode(pa.array(texts, pa.large_string()), 2)
        for text, a, b in zip(texts, starts, starts[1:]):
            want = [*plain.encode(text, add_special_tokens=False).ids, 2]
            assert zlib.crc32(ids[a:b].tobytes()) == zlib.crc32(np.array(want, np.uint32).tobytes())

    check()
    # Even where all words share one hash.
    monkeypatch.setattr(packing, "byte_hashes", lambda data, begin, end: np.zeros(len(begin), np.uint64))
    check()
