"""Phrase collocations: frequent word sequences that occur together beyond chance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.blocks import Marks, Spans, byte_hashes, marks_of, mixed, same_bytes, stored, text_slices

LONGEST = 5  # words of a phrase, 2 at least
LEAST = 100  # occurrences of a phrase
FIRST = 2000  # phrases of each language

# Bytes of text a Python worker holds as words and sequences at a time; one longer
# text is still handled whole.
SLICE_BYTES = 8 << 20

# Tables of marks have from 2 to the 16th to 2 to the 27th bits.  Where these do not
# suffice more rare sequences pass, to be dropped by their counts.
MARK_BITS = (16, 27)

# Rows of a language ranked apart before the last merge, and copies of the lookup
# table, so that no first word of many phrases meets them in one task.
LANES = 64
SALTS = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(10, 14)]] = True
_GAPS = _BREAKS.copy()
_GAPS[[32, 9]] = True


def _places(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the sorted ``bounds`` are at or before each of the sorted ``at``."""
    return np.searchsorted(bounds, at, side="right").astype(np.int32)


class Sequences:
    """Words of a slice of texts and the fingerprint of every sequence of them that
    lies within one piece of a text."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        raw = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = _LOWER[raw]
        solid = ~_GAPS[raw]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        first[inner] = solid[inner]
        last[:-1] &= ~solid[1:]
        last[inner - 1] = solid[inner - 1]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        del solid, first, last
        doc = _places(offsets, self.begin) - 1
        # Both grow along the words, so their sum changes where either does.
        self.piece = _places(np.flatnonzero(_BREAKS[raw]), self.begin) + doc
        self.names = langs.dictionary_encode()
        self.lang = self.names.indices.to_numpy()[doc]
        letters = self.names.dictionary.cast(pa.large_binary()).to_pylist()
        ends = np.cumsum([0] + [len(x) for x in letters])
        self.seeds = byte_hashes(np.frombuffer(b"".join(letters), np.uint8), ends[:-1], ends[1:])
        self.hashes = byte_hashes(self.data, self.begin, self.end)
        self.spans = Spans(self.hashes)

    def starts(self, k: int) -> np.ndarray:
        """First words of the sequences of ``k`` words."""
        n = len(self.begin) - k + 1
        return np.flatnonzero(self.piece[: max(n, 0)] == self.piece[k - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def prints(self, at: np.ndarray, k: int) -> np.ndarray:
        """Fingerprints of the sequences of ``k`` words from ``at``, of their language."""
        return mixed(self.spans.of(at, at + k) + mixed(self.seeds ^ np.uint64(k))[self.lang[at]])

    def words(self) -> np.ndarray:
        """A number for each word, the same for equal spellings only."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        held = first[number]
        odd = np.flatnonzero(
            ~same_bytes(self.data, self.begin, self.end, self.data, self.begin[held], self.end[held])
        )
        others: dict[bytes, int] = {}
        for i in odd:  # spelled unlike the first word of their hash
            spelled = self.data[self.begin[i] : self.end[i]].tobytes()
            number[i] = others.setdefault(spelled, len(first) + len(others))
        return number

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        """Text of the sequences of ``k`` words from ``at``."""
        place = (at[:, None] + np.arange(k)).reshape(-1)
        lengths = self.end[place] - self.begin[place] + 1
        stops = np.cumsum(lengths)
        source = np.repeat(self.begin[place] - (stops - lengths), lengths) + np.arange(lengths.sum())
        out = np.append(self.data, np.uint8(32))[source]
        out[stops - 1] = 32
        # The space after a last word is left out.
        stays = np.ones(len(out), bool)
        stays[stops[k - 1 :: k] - 1] = False
        ends = stops[k - 1 :: k] - np.arange(1, len(at) + 1)
        offsets = np.append(0, ends).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[stays].tobytes())]
        return pa.LargeStringArray.from_buffers(len(at), buffers[1], buffers[2]).cast(pa.string())


def _per_slice(count: Callable[[Sequences], Iterator[pa.RecordBatch]]):
    """``count`` over slices of batches; one slice is gone before the next is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text", SLICE_BYTES):
            yield from count(Sequences(texts, batch.column("lang")))

    return run


def _likely(x: Sequences, k: int, shorter: list[Marks]) -> np.ndarray:
    """Starts of the sequences of ``k`` words all of whose parts of as many words as
    the last of ``shorter`` marks are marked."""
    at = x.starts(k)
    if not shorter:
        return at
    part = len(shorter)
    ok = np.zeros(len(x.begin), bool)
    parts = x.starts(part)
    ok[parts[shorter[-1].has(x.prints(parts, part))]] = True
    good = np.ones(len(at), bool)
    for step in range(k - part + 1):
        good &= ok[at + step]
    return at[good]


def _fingerprints(sizes: tuple[int, ...], shorter: list[Marks]):
    """Fingerprints of the likely sequences of ``sizes`` words and how often they occur."""

    def count(x: Sequences) -> Iterator[pa.RecordBatch]:
        for k in sizes:
            prints, n = np.unique(x.prints(_likely(x, k, shorter), k), return_counts=True)
            yield pa.record_batch(
                [pa.array(np.full(len(n), k, np.int8)), pa.array(prints.view(np.int64)), pa.array(n, pa.int32())],
                names=["k", "print", "n"],
            )

    return _per_slice(count)


def _frequent(docs: DataFrame, sizes: tuple[int, ...], shorter: list[Marks], least: int) -> list[Marks]:
    """Marks of the frequent fingerprints of each of ``sizes``."""
    rows = docs.mapInArrow(_fingerprints(sizes, shorter), "k byte, print long, n int")
    found = rows.groupBy("k", "print").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = stored(found.select("k", "print"), "frequent")
    return [marks_of(found.where(F.col("k") == k), "print", MARK_BITS) for k in sizes]


def _spelled(marks: list[Marks]):
    """Text and number of the sequences whose fingerprint is marked, and the number
    of all words of a language (k = 0).

    Within a slice a fingerprint keeps the place of its first occurrence.  Every
    other is compared with that one word by word; those that differ count apart."""

    def count(x: Sequences) -> Iterator[pa.RecordBatch]:
        number = x.words()
        names = x.names.dictionary
        langs, total = np.unique(x.lang, return_counts=True)
        yield _counted(names.take(pa.array(langs)), 0, pa.array([""] * len(langs), pa.string()), total)
        for k, marked in enumerate(marks, 1):
            at = x.starts(k)
            prints = x.prints(at, k)
            keep = marked.has(prints)
            at = at[keep]
            _, first, group = np.unique(prints[keep], return_index=True, return_inverse=True)
            held = at[first][group]
            same = x.lang[at] == x.lang[held]
            for step in range(k):
                same &= number[at + step] == number[held + step]
            counts = np.bincount(group[same], minlength=len(first))
            if not same.all():
                odd = at[~same]
                spelled = np.stack([x.lang[odd], *[number[odd + step] for step in range(k)]])
                _, other, n = np.unique(spelled, axis=1, return_index=True, return_counts=True)
                at, first, counts = np.append(at, odd), np.append(first, len(at) + other), np.append(counts, n)
            place = at[first]
            yield _counted(names.take(pa.array(x.lang[place])), k, x.phrases(place, k), counts)

    return _per_slice(count)


def _counted(langs: pa.Array, k: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    columns = [langs.cast(pa.string()), pa.array(np.full(len(n), k, np.int8)), phrases, pa.array(n, pa.int64())]
    return pa.record_batch(columns, names=["lang", "k", "phrase", "n"])


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, k, phrase, n): phrases of up to ``longest`` words with ``least``
    occurrences, and, with k = 0, the words of each language.

    Three passes count fingerprints of words, of pairs of frequent words, and of
    sequences of frequent pairs.  A last one spells out and counts only what these
    mark, so neither a fingerprint that two phrases share nor a mark too many
    changes a result: what counts in the end is the text.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    marks: list[Marks] = []
    for sizes in ((1,), (2,), tuple(range(3, longest + 1))):
        sizes = tuple(k for k in sizes if k <= longest)
        if sizes:
            marks += _frequent(rows, sizes, marks, least)
    counted = rows.mapInArrow(_spelled(marks), "lang string, k byte, phrase string, n long")
    counted = counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return stored(counted.where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _looked_up(rows: DataFrame, counted: DataFrame, part: str, name: str) -> DataFrame:
    """Add the count of the phrase in column ``part``.

    A word may start a large share of all phrases: rows are salted, and the lookup
    side, a row per frequent phrase, is repeated."""
    salt = F.pmod(F.xxhash64("phrase", "cut"), F.lit(SALTS)).cast("int")
    table = counted.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(table, ["lang", part, "salt"]).drop("salt")


def mine_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each
    language of ``docs`` (text, lang).

    Texts have A-Z lower-cased and are split at ``.,;:!?`` and line ends into pieces,
    these at spaces and tabs into words.  A phrase has 2 to ``longest`` words of one
    piece and ``a`` >= ``least`` occurrences, overlaps included.  Cut after any of
    its words it gives two parts that occur l and r times, and the score 1000 a n /
    (l r), rounded down, n being all words of the language; the lowest score holds,
    of equal ones the earliest cut.  Phrases that lie in a longer one that occurs as
    often are left out.  Order: score, a, both descending, phrase by its bytes.

    Null texts are empty, the null language is ``und``.  Repeated rows count as often
    as they come; rows need no id.  An empty table gives no rows; other columns are
    ignored.  All counts are exact, and products have 38 digits.
    """
    counted = count_phrases(docs, least, longest)
    totals = counted.where("k = 0").select("lang", F.col("n").alias("total"))
    counted = counted.where("k > 0")
    candidates = counted.where("k > 1").withColumnRenamed("n", "a")
    # A longer phrase that occurs as often has one of just one more word between.
    longer = candidates.where("k > 2").select("lang", "phrase", "k", F.col("a").alias("f"))
    inside = longer.select(
        "lang",
        "f",
        F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1))).alias("phrase"),
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where("f IS NULL OR f < a").drop("f")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)))
    cuts = cuts.withColumns(
        {"head": _part(F.lit(1), F.col("cut")), "tail": _part(F.col("cut") + 1, F.col("k").cast("int") - F.col("cut"))}
    )
    cuts = _looked_up(_looked_up(cuts, counted, "head", "l"), counted, "tail", "r").join(totals, "lang")
    wide = {name: F.col(name).cast("decimal(38,0)") for name in ("a", "l", "r", "total")}
    cuts = cuts.select("lang", "phrase", "cut", *[c.alias(f"w_{n}") for n, c in wide.items()], "a", "l", "r", "total")
    scored = cuts.withColumn("score", F.expr("(w_a * w_total * 1000BD) div (w_l * w_r)"))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"), F.first("total").alias("n")
    )
    ranked = best.select("lang", "phrase", "a", "n", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = ranked.withColumn("lane", F.pmod(F.xxhash64("phrase"), F.lit(LANES)))
    for by in (["lang", "lane"], ["lang"]):
        window = Window.partitionBy(*by).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
