"""Line dedup by an exact set-similarity join."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import Marks, Words, in_lanes, marks_of, mixed, stored, text_slices, whole_groups
from flowlake.llm.substrings import KEY, keyed

SIMILARITY = Fraction(4, 5)

# Token frequencies are counted in this many buckets (two to the 20th), whatever
# the vocabulary; the table of counts, 8 MB, is all that the driver sees.  A token
# that makes up more than a bucket's share of all words has about its own count.
BUCKET_BITS = 20

# Neighbouring buckets whose counts a task passes on as one row.
STRETCH = 256

# Lines that share a token compared in one block of lanes.
BLOCK_ROWS = 20_000

# Candidates a block gives a line at most; if it has more and none of them is
# similar, the line asks again for all.
FIRST = 4

# Lines of so many tokens carry more parity bits, four or more for a token, up to
# 4096; shorter ones have 128.
LONG_LINE = 128
MOST_BITS = 4096

_LINE = [*KEY, "line"]

# The same in two longs, in the same order: sig and line make up the place.
_AT = ["doc_id", "place"]
_EARLIER = ["o_doc_id", "o_place"]
_PARITY = ["parity", "parity2"]


def _place() -> Column:
    return F.shiftleft(F.col("sig").cast("long"), 32).bitwiseOR(F.col("line").cast("long"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for _, texts in text_slices(batches, "text"):
        buckets = Words(texts).hashes() >> np.uint64(64 - BUCKET_BITS)
        total += np.bincount(buckets.astype(np.int64), minlength=len(total))
    # In stretches of buckets, as a row for each of them would cost more than its words.
    stretches = total.reshape(-1, STRETCH)
    used = np.flatnonzero(stretches.any(axis=1))
    ends = pa.array(np.arange(len(used) + 1) * STRETCH, pa.int32())
    yield pa.record_batch(
        [pa.array(used), pa.ListArray.from_arrays(ends, pa.array(stretches[used].ravel()))], names=["stretch", "counts"]
    )


def _summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64).reshape(-1, STRETCH)
    for batch in batches:
        counts = batch.column("counts").flatten().to_numpy().reshape(-1, STRETCH)
        np.add.at(total, batch.column("stretch").to_numpy(), counts)
    total = total.ravel()
    used = np.flatnonzero(total)
    yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Words per hash bucket over all documents."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    rows = docs.select("text").mapInArrow(_counts, "stretch long, counts array<long>")
    counts = rows.repartition("stretch").mapInArrow(_summed_counts, "bucket long, n long").toArrow()
    total[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    return total


def _by_line(owner: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Order by owner, which ascends, and token.

    One sort of numbers made up of the line's and the top bits of the token; only
    if two unlike tokens of a line share these are both sorted in full."""
    line = np.cumsum(np.append(False, owner[1:] != owner[:-1])[: len(owner)], dtype=np.uint64)
    bits = int(line[-1]).bit_length() if len(line) else 0
    if not bits:
        return np.argsort(tokens, kind="stable")
    key = line << np.uint64(64 - bits) | tokens >> np.uint64(bits)
    order = np.argsort(key)
    key, by_key = key[order], tokens[order]
    if ((key[1:] == key[:-1]) & (by_key[1:] != by_key[:-1])).any():
        return np.lexsort((tokens, owner))
    return order


class _Lines:
    """Token sets of the lines of a slice of documents.

    A token is its hash with the bucket, in the top bits, replaced by the rank of
    the bucket's frequency, so tokens in ascending order are in order of rarity.
    Lines without words are left out."""

    def __init__(self, texts: pa.Array, rank: np.ndarray):
        words = Words(texts)
        feeds = np.flatnonzero(words.data == 10)
        doc = np.repeat(np.arange(len(texts)), np.diff(words.starts))
        before = np.searchsorted(feeds, words.offsets[:-1])
        owner = (doc << 32) | (np.searchsorted(feeds, words.begin) - before[doc])
        hashes = words.hashes()
        low = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
        tokens = (rank[hashes >> np.uint64(64 - BUCKET_BITS)] << np.uint64(64 - BUCKET_BITS)) | (
            hashes & low
        )
        order = _by_line(owner, tokens)
        tokens = tokens[order]
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1]))[: len(tokens)]
        self.tokens, owner = tokens[new], owner[new]
        begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
        self.starts = np.append(begins, len(owner))
        self.doc, self.line = owner[begins] >> 32, owner[begins] & 0xFFFFFFFF
        self.sizes = np.diff(self.starts)

    def summed(self, values: np.ndarray, by: np.ufunc) -> np.ndarray:
        return by.reduceat(values, self.starts[:-1]) if len(self.sizes) else values


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _wide_bits(n: np.ndarray) -> np.ndarray:
    """Parity bits of long lines of ``n`` tokens, a power of two."""
    return np.minimum(4 << np.floor(np.log2(n)).astype(np.int64), MOST_BITS)


def _wide_parity(x: _Lines, spread: np.ndarray) -> pa.Array:
    """More parity bits of long lines, null for others."""
    long = x.sizes >= LONG_LINE
    words = np.where(long, _wide_bits(np.maximum(x.sizes, 1)) >> 6, 0)
    starts = np.append(0, np.cumsum(words))
    flat = np.zeros(starts[-1], np.uint64)
    line = np.repeat(np.arange(len(x.sizes)), x.sizes)
    mine = long[line]
    line, index = line[mine], spread[mine] & (words[line[mine]].astype(np.uint64) * np.uint64(64) - np.uint64(1))
    np.bitwise_xor.at(flat, starts[line] + (index >> np.uint64(6)).astype(np.int64), np.uint64(1) << (index & np.uint64(63)))
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), _signed(flat), mask=pa.array(~long))


def _firsts(d1: np.ndarray, d2: np.ndarray, n: np.ndarray, *line: np.ndarray) -> np.ndarray:
    """Places of the first line of each set, by the first digest."""
    order = np.lexsort((*line[::-1], n, d2, d1))
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (d1, d2, n)])
    return order[~same]


def _sets(rank: np.ndarray, similarity: Fraction):
    """Per line: digest and size of its token set, parity bits, prefix.

    Each token flips one of 128 parity bits, held in two words, so two sets differ
    in at least as many tokens as bits.  Long lines have more in ``wide``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            x = _Lines(texts, rank)
            spread = mixed(x.tokens)
            bit = np.uint64(1) << (spread & np.uint64(63))
            n = x.sizes
            least = -(-similarity.numerator * n // similarity.denominator)
            prefix = n - least + 1
            within = np.arange(len(x.tokens)) - np.repeat(x.starts[:-1], n)
            kept = within < np.repeat(prefix, n)
            rows = pa.array(x.doc)
            digests = x.summed(spread, np.add), x.summed(mixed(spread ^ np.uint64(0x5BD1E995)), np.add)
            made = pa.record_batch(
                [
                    *[_signed(digest) for digest in digests],
                    batch.column("doc_id").take(rows),
                    batch.column("sig").take(rows),
                    pa.array(x.line, pa.int32()),
                    pa.array(n, pa.int32()),
                    *[
                        _signed(x.summed(np.where(spread >> np.uint64(6) & np.uint64(1) == half, bit, 0), np.bitwise_xor))
                        for half in (0, 1)
                    ],
                    _wide_parity(x, spread),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(prefix)), pa.int32()), _signed(x.tokens[kept])
                    ),
                ],
                names=["d1", "d2", *_LINE, "n", *_PARITY, "wide", "prefix"],
            )
            yield made.take(pa.array(_firsts(*digests, n, *[made.column(name).to_numpy() for name in _LINE])))

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each set, of rows sorted by ``d1``.  Those of a batch's
    last digest wait for the next."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([held, batch]) if held else batch
        rows = rows.take(pa.array(_firsts(*[rows.column(name).to_numpy() for name in ("d1", "d2", "n", *_LINE)])))
        d1 = rows.column("d1").to_numpy()
        cut = int(np.searchsorted(d1, d1[-1]))
        yield rows.slice(0, cut).drop_columns(["d1", "d2"])
        held = rows.slice(cut)
    if held:
        yield held.drop_columns(["d1", "d2"])


def _line_hash(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(mixed(doc.view(np.uint64)) + place.view(np.uint64))


def _tokens_of(rank: np.ndarray, docs: Marks, lines: Marks):
    """Token sets of the marked lines of the marked documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            batch = batch.filter(pa.array(docs.has(_line_hash(ids, np.zeros(len(ids), np.int64)))))
            for part, texts in text_slices([batch], "text"):
                x = _Lines(texts, rank)
                ids = part.column("doc_id").to_numpy()[x.doc]
                place = part.column("sig").to_numpy()[x.doc].astype(np.int64) << 32 | x.line
                mine = lines.has(_line_hash(ids, place))
                sizes = x.sizes[mine]
                yield pa.record_batch(
                    [
                        pa.array(ids[mine]),
                        pa.array(place[mine]),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), _signed(x.tokens[np.repeat(mine, x.sizes)])
                        ),
                    ],
                    names=["doc_id", "place", "tokens"],
                )

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, place = (batch.column(name).to_numpy() for name in _AT)
        columns = [_line_hash(ids, np.zeros(len(ids), np.int64)), _line_hash(ids, place)]
        yield pa.record_batch([_signed(c) for c in columns], names=["doc", "line"])


def _unlike(wide: np.ndarray, starts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing parity bits of rows ``i`` and ``j``; the longer is folded to the shorter."""
    found = np.zeros(len(i), np.int64)
    words = np.diff(starts)
    for a, b in {(int(a), int(b)) for a, b in zip(words[i], words[j])}:
        mine = np.flatnonzero((words[i] == a) & (words[j] == b))
        left, right = (wide[starts[rows[mine]][:, None] + np.arange(n)] for rows, n in ((i, a), (j, b)))
        width = min(a, b)
        left, right = (np.bitwise_xor.reduce(x.reshape(len(mine), -1, width), axis=1) for x in (left, right))
        found[mine] = np.bitwise_count(left ^ right).sum(axis=1)
    return found


def _candidates(similarity: Fraction, most: int | None):
    """Pairs of lines (later, earlier) that share a prefix token and pass the
    length, positional and parity filters; only the ``most`` earliest of each later
    line and bucket, with ``more`` if there may be others.  Rows come sorted by
    bucket; ``size`` is a line's size, a bit if it asks, and the token's place."""
    a, b = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["bucket"]):
            sizes = np.diff(starts)
            group = np.repeat(np.arange(len(sizes)), sizes)
            shared = np.flatnonzero(np.repeat(sizes > 1, sizes))
            if not len(shared):
                continue
            at = [table.column(name).to_numpy()[shared] for name in _AT]
            table = table.take(pa.array(shared[np.lexsort((*at[::-1], group[shared]))])).combine_chunks()
            starts = np.append(0, np.cumsum(sizes[sizes > 1]))
            size = table.column("size").to_numpy()
            n, left = size >> 33, (size >> 33) - 1 - (size & 0xFFFFFFFF)
            parity = [table.column(name).to_numpy().view(np.uint64) for name in _PARITY]
            lists = table.column("wide").combine_chunks()
            wide = lists.flatten().to_numpy().view(np.uint64)
            wide_at = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()))
            begin = np.repeat(starts[:-1], np.diff(starts))
            open_ = np.flatnonzero(size >> 32 & 1)
            open_ = open_[open_ > begin[open_]]
            found, more = np.zeros(len(n), np.int32), np.zeros(len(n), bool)
            later, earlier = [], []
            step = 0
            while len(open_):
                first = begin[open_] + step
                total = n[open_] + n[first]
                shared = -(-a * total // (a + b))  # tokens two such lines must share
                unlike = sum(np.bitwise_count(word[open_] ^ word[first]) for word in parity)
                good = (
                    (np.minimum(n[open_], n[first]) * b >= a * np.maximum(n[open_], n[first]))
                    & (1 + np.minimum(left[open_], left[first]) >= shared)
                    & (unlike <= total - 2 * shared)
                )
                long = np.flatnonzero(good & (np.minimum(n[open_], n[first]) >= LONG_LINE))
                if len(long):
                    bits = _unlike(wide, wide_at, open_[long], first[long])
                    good[long] = bits <= (total - 2 * shared)[long]
                later.append(open_[good])
                earlier.append(first[good])
                step += 1
                stay = begin[open_] + step < open_
                if most is not None:
                    found[open_[good]] += 1
                    full = good & (found[open_] >= most)
                    more[open_[full & stay]] = True
                    stay &= ~full
                open_ = open_[stay]
            if later:
                i, j = np.concatenate(later), np.concatenate(earlier)
                ids, places = table.column("doc_id").to_numpy(), table.column("place").to_numpy()
                columns = [ids[i], places[i], ids[j], places[j], more[i]]
                yield pa.record_batch([pa.array(c) for c in columns], names=[*_AT, *_EARLIER, "more"])

    return run


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        rows, counts, removed = [], [], []
        for doc, text, kept in zip(batch.column("doc_id"), texts, batch.column("lines")):
            lines = text.as_py().split("\n")
            if doc.is_valid:
                stay = set(kept.as_py() or ())
                left = [x for i, x in enumerate(lines) if i in stay or not x.encode().split()]
            else:
                left = lines
            rows.append("\n".join(left))
            counts.append(len(lines))
            removed.append(len(lines) - len(left))
        yield pa.record_batch(
            [
                batch.column("row"),
                pa.array(rows, pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
            ],
            names=["row", "text", "n_lines", "n_removed"],
        )


def _similar(docs: DataFrame, pairs: DataFrame, rank: np.ndarray, similarity: Fraction) -> DataFrame:
    """Pairs with ``same``: whether the token sets really reach the similarity.

    The lines are marked, so that documents are scanned once more but not shuffled;
    lines marked by chance drop out at the join."""
    other = pairs.select(*[F.col(o).alias(name) for o, name in zip(_EARLIER, _AT)])
    wanted = pairs.select(*_AT).union(other).distinct().mapInArrow(_hashes, "doc long, line long")
    wanted = stored(wanted, "wanted")
    marks = marks_of(wanted, "doc"), marks_of(wanted, "line")
    sets = docs.mapInArrow(_tokens_of(rank, *marks), "doc_id long, place long, tokens array<long>")
    sets = stored(sets.dropDuplicates(_AT), "sets")
    others = sets.select(*[F.col(name).alias(o) for name, o in zip(_AT, _EARLIER)], F.col("tokens").alias("o_tokens"))
    shared = F.size(F.array_intersect("tokens", "o_tokens"))
    union = F.size("tokens") + F.size("o_tokens") - shared
    return pairs.join(sets, _AT).join(others, _EARLIER).select(
        *_AT, (shared * similarity.denominator >= union * similarity.numerator).alias("same")
    )


def kept_lines(
    docs: DataFrame, similarity: Fraction = SIMILARITY, block_rows: int = BLOCK_ROWS, first: int = FIRST
) -> DataFrame:
    """(doc_id, sig, line) of each line with words, of ``docs`` (doc_id, text,
    sig), that no earlier line resembles, by (doc_id, sig, line)."""
    similarity = Fraction(similarity)
    docs = docs.where("doc_id IS NOT NULL")
    totals = bucket_counts(docs)
    order = np.argsort(totals, kind="stable")
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    lines = docs.mapInArrow(
        _sets(rank, similarity),
        "d1 long, d2 long, doc_id long, sig int, line int, n int, parity long, parity2 long, wide array<long>, "
        "prefix array<long>",
    )
    # Equal sets are one class, known by its first line; later ones go.
    classes = stored(
        lines.repartition("d1", "d2", "n")
        .sortWithinPartitions("d1")
        .mapInArrow(_classes, lines.drop("d1", "d2").schema),
        "lines",
    )
    # Only tokens of buckets this frequent can exceed a block.
    frequent = int(np.searchsorted(totals[order], block_rows, side="right"))

    placed = classes.withColumn("place", _place())

    def candidates(rows: DataFrame, most: int | None) -> DataFrame:
        # Lines whose last token is rare have no other; they are not unfolded to see.
        rare = (F.shiftrightunsigned("last", 64 - BUCKET_BITS) < frequent) | (
            F.shiftrightunsigned("token", 64 - BUCKET_BITS) < frequent
        )
        dealt = in_lanes(rows, ["token"], _AT, block_rows, rare).select(
            # Two buckets of one hash are compared as one, which costs a glance.
            F.xxhash64("token", "low", "high").alias("bucket"),
            *_AT,
            F.shiftleft(F.col("n").cast("long"), 33)
            .bitwiseOR(F.shiftleft(F.col("asks").cast("long"), 32))
            .bitwiseOR(F.col("pos").cast("long"))
            .alias("size"),
            *_PARITY,
            "wide",
        )
        return (
            dealt.repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_candidates(similarity, most), "doc_id long, place long, o_doc_id long, o_place long, more boolean")
        )

    last = F.element_at("prefix", -1).alias("last")
    tokens = placed.select(*_AT, "n", *_PARITY, "wide", last, F.posexplode("prefix").alias("pos", "token"))
    # At most FIRST per prefix token and lane of a line, and then of the line.
    asked = (
        candidates(tokens.withColumn("asks", F.lit(True)), first)
        .groupBy(*_AT)
        .agg(F.array_sort(F.collect_set(F.struct(*_EARLIER))).alias("all"), F.bool_or("more").alias("more"))
        .select(*_AT, F.slice("all", 1, first).alias("some"), (F.col("more") | (F.size("all") > first)).alias("more"))
    )
    asked = stored(asked, "asked")
    pairs = asked.select(*_AT, F.inline("some"))
    checked = _similar(docs, pairs, rank, similarity)
    matched = stored(checked.where("same").select(*_AT).distinct(), "matched")
    # A line with more candidates than it was given, none of them similar, asks again.
    failed = stored(
        placed.join(asked.where("more").join(matched, _AT, "left_anti"), _AT, "left_semi").select(*_AT, "n", "prefix"),
        "failed",
    )
    if not failed.isEmpty():
        # Of each token only lines of a length that one of them could resemble.
        held = failed.select("n", F.explode("prefix").alias("token")).groupBy("token")
        shared = stored(held.agg(F.min("n").alias("least"), F.max("n").alias("most")), "shared")
        asking = failed.select(*_AT, F.lit(True).alias("asks"))
        a, b = similarity.numerator, similarity.denominator
        near = tokens.join(shared, "token").where((F.col("n") * b >= F.col("least") * a) & (F.col("n") * a <= F.col("most") * b))
        again = near.drop("least", "most").join(asking, _AT, "left")
        again = again.withColumn("asks", F.coalesce("asks", F.lit(False)))
        every = candidates(again, None).select(*_AT, *_EARLIER).distinct()
        more = _similar(docs, stored(every, "pairs"), rank, similarity)
        matched = matched.union(more.where("same").select(*_AT))
    return placed.select(*_LINE, "place").join(matched.distinct(), _AT, "left_anti").select(*_LINE)


def dedup_lines(
    docs: DataFrame, similarity: Fraction = SIMILARITY, keep_columns: bool = False, **options
) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) per row of ``docs`` (doc_id, text): the
    text without lines that resemble an earlier line.

    A line is the set of its words (runs of anything but ASCII white space).  It
    goes if any line before it, in order of doc_id and line, has a Jaccard
    similarity of ``similarity`` or more with it; this is judged on the input, so
    a removed line still removes others.  The join is exact: two such lines share
    a token among the rarest of each (prefix filter), and each filter drops only
    pairs that cannot reach the similarity; what passes is verified.

    ``keep_columns``: the columns of ``docs`` instead, with a new ``text`` and, if
    there, ``n_chars``.  Other columns are ignored.

    Lines without words stay.  Null texts are empty.  Rows with equal doc_id are
    told apart by their text; rows equal in both are one document and lose the
    same lines.  Rows without doc_id are left as they are and remove nothing.
    """
    rows = keyed(docs)
    lists = kept_lines(rows, similarity, **options).groupBy(*KEY).agg(F.collect_list("line").alias("lines"))
    lists = stored(lists, "kept")
    columns = docs.columns if keep_columns else ["doc_id", "text"]
    own = F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"]).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.hash(text).alias("sig"))
    done = whole.join(lists, KEY, "left").select("row", "doc_id", "text", "lines")
    kind = dict(done.dtypes)["row"]
    done = done.mapInArrow(_rest, f"row {kind}, text string, n_lines long, n_removed long")
    if not keep_columns:
        return done.select("row.doc_id", "text", "n_lines", "n_removed").withColumn("doc_id", F.col("doc_id").cast("long"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in columns])
