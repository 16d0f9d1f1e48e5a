"""Helpers for work on Arrow batches and on groups of any size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.session import scratch_path

# Bytes of text a Python worker holds as words at a time; one longer text is
# still handled whole.
TEXT_BYTES = 2 << 20

# A prime of 31 bits, so products and long sums of residues fit 64 bits, and two
# bases drawn at random below it.
PRIME = (1 << 31) - 1
BASES = (1_327_217_885, 905_342_647)

# Words of more bytes are hashed one by one.
LONG_WORD = 1024


# Lets Spark delete the shuffle files of a write once it is complete.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage there.

    A lost executor then costs only the work after this table, and the shuffle
    files of the work before it are freed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = TEXT_BYTES):
    """Re-cut batches so that a slice holds about ``limit`` bytes of text; null
    texts count as empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False

_powers = np.ones((4, 1), np.uint32)


def _folded(x: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Small numbers equal to ``x`` modulo PRIME: below 2**34 after one round, and
    below PRIME + 9 after two."""
    prime, bits = np.uint64(PRIME), np.uint64(31)
    for _ in range(rounds):
        high = x >> bits
        x = x & prime
        x += high
    return x


def _residues(x: np.ndarray) -> np.ndarray:
    x = _folded(x)
    x[x == PRIME] = 0
    return x


def _powers_up_to(n: int) -> np.ndarray:
    """Powers of each base and of its inverse, kept by the process."""
    global _powers
    if _powers.shape[1] <= n:
        made = np.ones((4, 1), np.uint64)
        factors = np.array([f for base in BASES for f in (base, pow(base, -1, PRIME))], np.uint64)[:, None]
        while made.shape[1] <= n:
            made = np.concatenate([made, _residues(made * factors)], axis=1)
            factors = _residues(factors * factors)
        _powers = made.astype(np.uint32)
    return _powers


class Spans:
    """Polynomial hashes of any span of a sequence, modulo a prime to two bases.

    A power of two as modulus would give some sequences of two values the same
    hash whatever the base."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = _powers_up_to(n)
        self.undo = powers[1], powers[3]
        self.sums = np.zeros((2, n + 1), np.uint64)
        for sums, power, residues in zip(self.sums, powers[::2], (values, mixed(values)), strict=True):
            np.add.accumulate(_folded(_folded(residues, 2) * power[:n], 1), out=sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        high, low = (
            _residues(_folded(sums[stop] - sums[start], 2) * undo[start])
            for sums, undo in zip(self.sums, self.undo, strict=True)
        )
        return mixed(high << np.uint64(31) | low)


class Words:
    """Words of a slice of texts, by their place in the bytes of all of them.

    ``begin`` and ``end`` are a word's bytes in ``data``; ``starts`` has the first
    word of each text, and the end."""

    def __init__(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        self.data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        solid = _SOLID[self.data]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(solid))]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        first[inner] = solid[inner]
        last[:-1] &= ~solid[1:]
        last[inner - 1] = solid[inner - 1]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.starts = np.searchsorted(self.begin, self.offsets)

    def hashes(self, change: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word, bytes replaced by the table ``change`` first."""
        data = self.data if change is None else change.astype(np.uint8)[self.data]
        return byte_hashes(data, self.begin, self.end)


def byte_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, meant for words.

    Eight bytes a step, each step one to one: spans of the same length up to eight
    bytes never share a hash."""
    eights = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    lengths = end - begin
    found = mixed(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    open_, done = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0)), 0
    while len(open_):
        unused = np.uint64(64) - np.minimum(lengths[open_] - done, 8).astype(np.uint64) * np.uint64(8)
        value = eights[begin[open_] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> unused)
        found[open_] = mixed(mixed(found[open_] ^ value) + np.uint64(done))
        done += 8
        open_ = open_[lengths[open_] > done]
    for i in np.flatnonzero(lengths > LONG_WORD):
        found[i] = xxhash.xxh64_intdigest(data[begin[i] : end[i]].tobytes())
    return found


def same_bytes(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, other: np.ndarray, from_: np.ndarray, to: np.ndarray
) -> np.ndarray:
    """Whether each span of ``data`` equals the span of ``other`` at its side."""
    left, right = (
        np.ndarray(len(x) + 1, "<u8", np.append(x, np.zeros(8, np.uint8)), strides=(1,)) for x in (data, other)
    )
    lengths = end - begin
    equal = lengths == to - from_
    open_, done = np.flatnonzero(equal & (lengths > 0)), 0
    while len(open_):
        unused = np.uint64(64) - np.minimum(lengths[open_] - done, 8).astype(np.uint64) * np.uint64(8)
        unlike = (left[begin[open_] + done] ^ right[from_[open_] + done]) << unused != 0
        equal[open_[unlike]] = False
        done += 8
        open_ = open_[~unlike & (lengths[open_] > done)]
    return equal


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Marks:
    """A table of bits, set for every one of some hashes and a few others."""

    bits: int
    table: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def marks_of(hashes: DataFrame, name: str, limits: tuple[int, int] = (16, 27)) -> Marks:
    """Marks for the hashes (longs) in column ``name`` of a stored table.

    32 bits for each, within powers of two: up to 16 MB, whatever their number.
    Spark puts the table together; the driver sees its words."""
    low, high = limits
    bits = min(high, max(low, math.ceil(math.log2(32 * max(1, hashes.count())))))
    at = F.shiftrightunsigned(name, 64 - bits)
    table = np.zeros(1 << (bits - 6), np.uint64)
    words = (
        hashes.select(F.shiftright(at, 6).cast("int").alias("word"), F.expr("1L").alias("one"), (at % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("bit"))).alias("bits"))
        .toArrow()
    )
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Marks(bits, table)


def in_lanes(
    rows: DataFrame, keys: list[str], by: list[str], limit: int, small: Column | None = None
) -> DataFrame:
    """Prepare the comparison of all rows that share ``keys``, in bounded blocks.

    A group of more than ``limit`` rows is dealt over lanes by the hash of
    ``by``, and each row goes to every block (low, high) that its lane is part
    of, so any two rows of a group meet in at least one block of two lanes.
    Only groups beyond the limit are repeated.  Adds ``lane``, ``low``, ``high``.
    The list of large groups is a stored table, so Spark knows its size and picks
    the join by it.  ``small`` is true for rows whose group is known to be small.
    """
    large = stored(
        (rows if small is None else rows.where(~small))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > limit)
        .select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_lanes")),
        "large",
    )
    lanes = F.coalesce("_lanes", F.lit(1))
    dealt = (
        (rows if small is None else rows.where(~small))
        .join(large, keys, "left")
        .withColumn("lane", F.pmod(F.xxhash64(*by, F.lit(7)), lanes).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), lanes - 1)))
        .withColumn("low", F.least("lane", "_other"))
        .withColumn("high", F.greatest("lane", "_other"))
        .drop("_lanes", "_other")
    )
    if small is None:
        return dealt
    one = {name: F.lit(0) for name in ("lane", "low", "high")}
    return rows.where(small).withColumns(one).unionByName(dealt)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys``: tables of some ``rows`` rows that end
    where a group ends, each with the first row of every group and the end."""
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(last: bool):
        nonlocal held, count
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        end = table.num_rows if last else int(starts[-1])
        rest = table.slice(end)
        held, count = (rest.to_batches() if rest.num_rows else []), rest.num_rows
        starts = starts[starts < end]
        if end:
            yield table.slice(0, end), np.append(starts, end)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                before = count
                yield from cut(False)
                rows = max(rows, 2 * count) if count == before else rows
    if held:
        yield from cut(True)


def forest(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes by the given links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[first], label[second])
        np.minimum.at(label, first, low)
        np.minimum.at(label, second, low)
        label = label[label]
        if np.array_equal(before, label):
            return label
