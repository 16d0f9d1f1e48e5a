"""Phrase mining against counting in Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from flowlake.llm import phrases
from flowlake.llm.phrases import mine_phrases

SCHEMA = "text string, lang string, phrase string, rank int, n string"


def table(spark, rows):
    return spark.createDataFrame([(t, g, "x", 1, "y") for t, g in rows], SCHEMA)


def by_hand(rows, least, longest=5, first=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            counts.update(
                (lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1)
            )
    found = {}
    candidates = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    for (lang, words), a in candidates.items():
        inside = any(
            f >= a and len(other) > len(words) and language == lang
            and any(other[i : i + len(words)] == words for i in range(len(other)))
            for (language, other), f in candidates.items()
        )
        if inside:
            continue
        cuts = []
        for cut in range(1, len(words)):
            l, r = counts[lang, words[:cut]], counts[lang, words[cut:]]
            cuts.append((1000 * a * total[lang] // (l * r), cut, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, words, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, words.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def mined(spark, rows, **options):
    got = mine_phrases(table(spark, rows), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in got.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, got.collect()))


@pytest.fixture
def rows(prose):
    dice = random.Random(8)
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ".\n", ": ", "! ", "\r\n", " \x0c "]
    words = "New York new Äpfel äpfel city of of the a b — x's café".split()
    out = []
    for _ in range(60):
        text = "".join(dice.choice(words) + dice.choice(marks) for _ in range(dice.choice([0, 3, 40, 300])))
        out.append((text, dice.choice(["en", "de", None, "und", ""])))
    passage = "the quick brown fox jumps over the lazy dog"
    out += [(passage, "en")] * 25 + [(f"so {passage} again", "de")] * 9  # a hot passage
    return out + [(None, "en"), ("", "en"), ("...", None), ("a " * 3000, "fr"), (prose(4000), "en")]


def test_like_counting_in_python(spark, rows):
    for least in (5, 12):
        want = by_hand(rows, least)
        assert mined(spark, rows, least=least) == want
        assert len(want) > 20


def test_caps_and_lengths(spark, rows):
    assert mined(spark, rows, least=5, first=3) == by_hand(rows, 5, first=3)
    assert mined(spark, rows, least=5, longest=2) == by_hand(rows, 5, longest=2)


def test_fingerprints_that_collide(spark, rows, monkeypatch):
    """Four fingerprints for all sequences, and few words with a hash of their own."""
    plain = phrases.Sequences

    class Weak(plain):
        def __init__(self, *args):
            super().__init__(*args)
            self.hashes = self.hashes % np.uint64(3)

        def prints(self, at, k):
            return super().prints(at, k) & np.uint64(3 << 62)

    assert Weak.prints is not plain.prints
    import pyarrow as pa

    texts = pa.array([t or "" for t, _ in rows], pa.large_string())
    langs = pa.array(["und" if g is None else g for _, g in rows])
    whole = [phrases.Marks(16, np.full(1 << 10, 2**64 - 1, np.uint64))] * 5
    results = []
    for kind in (plain, Weak):
        monkeypatch.setattr(phrases, "Sequences", kind)
        batch = pa.record_batch([langs, texts], names=["lang", "text"])
        total = Counter()
        for out in phrases._spelled(whole)(iter([batch])):
            for r in out.to_pylist():
                total[r["lang"], r["k"], r["phrase"]] += r["n"]
        results.append(total)
    assert results[0] == results[1]


def test_marks_of_a_full_table(spark, rows, monkeypatch):
    """Where every bit is set, counts alone decide."""
    monkeypatch.setattr(phrases, "MARK_BITS", (6, 6))
    assert mined(spark, rows, least=12) == by_hand(rows, 12)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("one two", "en")]) == []
