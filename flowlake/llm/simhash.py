"""SimHash near-dedup with bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import forest, in_lanes, stored, whole_groups
from flowlake.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42

# Fingerprints are cut into this many pieces.  At most RADIUS differing bits
# leave BLOCKS - RADIUS pieces untouched, whose values make up a bucket's key.
BLOCKS = 6

# Rows of a bucket compared in one block of lanes.
BLOCK_ROWS = 4096

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``size`` words, of all words if there are fewer."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(words) else ends
    if 0 < len(words) < size:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts[: max(0, len(words) - size + 1)].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def _fingerprints(size: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [
                fingerprint(shingle_hashes(text.as_py() or "", size, seed)) for text in batch.column(1)
            ]
            yield pa.record_batch(
                [batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "print"]
            )

    return run


def _full_add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bits in each lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _beyond(ones, twos, fours, over, radius: int):
    """Lanes whose count exceeds ``radius`` (at most 7)."""
    more, same = np.zeros_like(ones), np.full_like(ones, _FULL)
    for plane, bit in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & bit:
            same = same & plane
        else:
            more = more | (same & plane)
            same = same & ~plane
    return over | more


def close_pairs(prints: np.ndarray, starts: np.ndarray, radius: int = RADIUS):
    """Index pairs within the same group whose prints differ in at most ``radius`` bits.

    The prints of all groups, largest group first, are stored as 64 bit planes.
    For every shift s one pass compares each print with the one s places on, 64
    at a time: XOR of plane and shifted plane, summed by carry-save adders into
    three counter planes and an overflow plane.  After every 16 planes, words in
    which all 64 lanes are beyond the radius are abandoned.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 1]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = sizes[order]
    ends = np.cumsum(sizes)
    within = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    rows = np.repeat(starts[:-1][order], sizes) + within
    after = np.repeat(sizes, sizes) - within - 1  # rows of the group that follow
    values = prints[rows]
    width = -(-len(values) // 64)
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((64, width * 8 + 8 * (sizes[0] // 64 + 2)), np.uint8)
    planes[:, : -(-len(values) // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    planes = planes.view(np.uint64)
    left, right = [], []
    for shift in range(1, int(sizes[0])):
        q, r = divmod(shift, 64)
        reach = int(ends[np.searchsorted(-sizes, -shift, side="left") - 1])
        words = np.arange(-(-reach // 64))
        ones = twos = fours = over = np.zeros(len(words), np.uint64)
        for first in range(0, 64, 16):
            for plane in range(first, first + 16, 4):
                x = []
                for row in planes[plane : plane + 4]:
                    moved = row[words + q] >> np.uint64(r)
                    if r:
                        moved = moved | (row[words + q + 1] << np.uint64(64 - r))
                    x.append(row[words] ^ moved)
                ones, two_a = _full_add(ones, x[0], x[1])
                ones, two_b = _full_add(ones, x[2], x[3])
                twos, four = _full_add(twos, two_a, two_b)
                over = over | (fours & four)
                fours = fours ^ four
            beyond = _beyond(ones, twos, fours, over, radius)
            alive = beyond != _FULL
            if not alive.all():
                words, ones, twos, fours, over, beyond = (
                    v[alive] for v in (words, ones, twos, fours, over, beyond)
                )
            if not len(words):
                break
        if len(words):
            lanes = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(lanes)
            at = words[word] * 64 + lane
            at = at[at < len(values)]
            at = at[after[at] >= shift]
            left.append(rows[at])
            right.append(rows[at + shift])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["choice", "key", "low", "high"]):
            prints = table.column("print").to_numpy().astype(np.int64).view(np.uint64)
            nodes = table.column("node").to_numpy()
            i, j = close_pairs(prints, starts, radius)
            root = forest(i, j, len(nodes))
            member = np.flatnonzero(root != np.arange(len(nodes)))
            edges = np.unique(np.stack([nodes[member], nodes[root[member]]], axis=1), axis=0)
            edges = edges[edges[:, 0] != edges[:, 1]]
            yield pa.record_batch(
                [pa.array(edges[:, 0], pa.int64()), pa.array(edges[:, 1], pa.int64())], names=["a", "b"]
            )

    return run


def piece_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """One mask, as a signed long, per choice of ``blocks - radius`` of the pieces."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    pieces = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(pieces, blocks - radius)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def simhash_groups(
    docs: DataFrame,
    size: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
    blocks: int = BLOCKS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs`` (doc_id, text).

    Fingerprints link at ``radius`` or fewer differing bits (0 to 7, below
    ``blocks``); ``component_id`` is the smallest doc_id reachable.  All links
    are found: any two linked fingerprints agree in ``blocks - radius`` whole
    pieces, and all fingerprints that agree in a choice of pieces are compared.

    Equal fingerprints are one node, whatever their number.  A bucket hands on
    the links of a spanning forest, never its pairs; a bucket of more than
    ``block_rows`` prints is compared in blocks.

    Null or empty text: fingerprint zero, linked like any other.  Rows that
    repeat are returned as often.  A row without doc_id gets a fingerprint but
    takes no part in linking; its component is null.  Other columns are ignored.
    """
    if not 0 <= radius < min(8, blocks):
        raise ValueError("the radius must be below 8 and below the number of blocks")
    prints = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _fingerprints(size, seed), "doc_id long, print long"
        ),
        "prints",
    )
    nodes = prints.where("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("node"))
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(piece_masks(radius, blocks))
        ]
    )
    keyed = nodes.select("print", "node", F.inline(choices))
    bucket = ["choice", "key", "low", "high"]
    links = (
        in_lanes(keyed, ["choice", "key"], ["print"], block_rows)
        .repartition(*bucket)
        .sortWithinPartitions(*bucket)
        .mapInArrow(_links(radius), "a long, b long")
    )
    roots = connected_components(links)
    named = nodes.join(roots, "node", "left").select(
        "print", F.coalesce("root", "node").alias("component_id")
    )
    return prints.join(named, "print", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id.

    Rows without doc_id stay, as they belong to no group; of rows that repeat a
    kept doc_id, all stay.  Columns are those of ``docs``.
    """
    groups = simhash_groups(docs.select("doc_id", "text"), **options)
    others = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti")
