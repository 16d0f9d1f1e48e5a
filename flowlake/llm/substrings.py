"""Substring dedup: seeds on winnowed anchors, extended both ways."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import Spans, Words, mixed, stored, text_slices

# Shortest repeat, in words.
WINDOW = 13

# Words of an anchor.  Every window picks the anchor of the smallest hash among
# the WINDOW - ANCHOR + 1 it holds, so equal windows pick equal anchors; about
# one word in five starts a picked anchor.
ANCHOR = 5

# A row of documents: its doc_id and 32 bits of its text, as doc_id may repeat.
KEY = ["doc_id", "sig"]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sig); null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn(
        "sig", F.hash("text")
    )


class _Picked:
    """Anchors picked in a slice of documents, in order of place.

    ``place`` is an anchor's first word, ``first`` to ``last`` the windows that
    picked it, as places in the slice; ``doc`` the row of the slice."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        words = Words(texts)
        self.starts, values = words.starts, words.hashes()
        self.spans = Spans(values)
        n, width = len(values), window - anchor + 1
        starts = np.arange(max(0, n - window + 1))
        doc = np.searchsorted(self.starts, starts, side="right") - 1
        starts = starts[starts + window <= self.starts[doc + 1]]
        grams = np.arange(max(0, n - anchor + 1))
        hashes = self.spans.of(grams, grams + anchor)
        best, place = hashes[starts], starts.copy()
        for step in range(1, width):
            other = hashes[starts + step]
            nearer = other <= best
            best = np.where(nearer, other, best)
            place = np.where(nearer, starts + step, place)
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else starts
        self.place = place[new]
        self.first = starts[new]
        self.last = starts[np.append(new[1:], len(place)) - 1] if len(place) else starts
        self.doc = np.searchsorted(self.starts, self.first, side="right") - 1
        self.anchor = hashes[self.place].view(np.int64)
        self.window = window

    def context(self) -> np.ndarray:
        """Hash of an anchor's windows, as one span, and of its place in them."""
        span = self.spans.of(self.first, self.last + self.window)
        return mixed(span + (self.place - self.first).astype(np.uint64)).view(np.int64)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64())


def _seeds(window: int, anchor: int):
    """Per slice: anchor, smallest and largest doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            found = _Picked(texts, window, anchor)
            if len(found.anchor):
                docs = batch.column("doc_id").to_numpy(zero_copy_only=False)[found.doc]
                order = np.argsort(found.anchor, kind="stable")
                hashes, docs = found.anchor[order], docs[order]
                new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
                low, high = np.minimum.reduceat(docs, new), np.maximum.reduceat(docs, new)
                yield pa.record_batch(
                    [_long(hashes[new]), _long(low), _long(high)], names=["anchor", "low", "high"]
                )

    return run


def _occurrences(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            found = _Picked(texts, window, anchor)
            at = found.place - found.starts[found.doc]
            rows = pa.array(found.doc)
            yield pa.record_batch(
                [
                    _long(found.anchor),
                    _long(found.context()),
                    batch.column("doc_id").take(rows),
                    batch.column("sig").take(rows),
                    pa.array(at, pa.int32()),
                    pa.array(found.place - found.first, pa.int16()),
                    pa.array(found.last - found.place, pa.int16()),
                ],
                names=["anchor", "context", "doc_id", "sig", "at", "before", "after"],
            )

    return run


def _windows(window: int, anchor: int):
    """Windows that picked one of the anchors in ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            found = _Picked(texts, window, anchor)
            places = batch.column("places")
            owner = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            wanted = found.starts[owner] + places.flatten().to_numpy()
            chosen = np.flatnonzero(np.isin(found.place, wanted))
            counts = (found.last - found.first + 1)[chosen]
            which = np.repeat(chosen, counts)
            step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = found.first[which] + step
            rows = pa.array(found.doc[which])
            yield pa.record_batch(
                [
                    _long(found.anchor[which]),
                    _long(found.spans.of(start, start + window).view(np.int64)),
                    batch.column("doc_id").take(rows),
                    batch.column("sig").take(rows),
                    pa.array(start - found.starts[found.doc[which]], pa.int32()),
                ],
                names=["anchor", "window", "doc_id", "sig", "start"],
            )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, sig, start, stop): spans of words, of at least ``window``, that
    also occur in a document with a smaller doc_id.  Spans may overlap; their
    union is every word of every such repeat.

    1. Seed: anchors found in one document only cannot be part of a repeat.
    2. Extend: the windows that picked an anchor reach up to ``window - anchor``
       words to either side of it.  Occurrences whose whole reach is equal form
       a class; all but those of its smallest doc_id are repeats from end to end.
    3. Where an anchor has several classes, their first documents are compared
       window by window, so an extension ends exactly where the texts part.

    Adjoining spans chain up to the maximal repeat.  Copies meet only as minima
    per anchor, class or window, never as pairs.  Equality is that of two 64-bit
    hashes, of the anchor and of the span around it.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor must fit into a window")
    docs = docs.where("doc_id IS NOT NULL")
    shared = (
        docs.mapInArrow(_seeds(window, anchor), "anchor long, low long, high long")
        .groupBy("anchor")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    hits = stored(
        docs.mapInArrow(
            _occurrences(window, anchor),
            "anchor long, context long, doc_id long, sig int, at int, before short, after short",
        ).join(stored(shared, "anchors"), "anchor", "left_semi"),
        "hits",
    )
    classes = stored(
        hits.groupBy("anchor", "context").agg(F.min("doc_id").alias("earliest")), "classes"
    )
    parted = (
        classes.groupBy("anchor")
        .agg(F.min("context").alias("low"), F.max("context").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    known = hits.join(classes, ["anchor", "context"])
    whole = known.where("earliest < doc_id").select(
        *KEY,
        (F.col("at") - F.col("before")).alias("start"),
        (F.col("at") + F.col("after") + window).alias("stop"),
    )
    places = (
        known.where("earliest = doc_id")
        .join(parted, "anchor", "left_semi")
        .groupBy(*KEY)
        .agg(F.collect_list("at").alias("places"))
    )
    windows = stored(
        docs.dropDuplicates(KEY)
        .join(stored(places, "places"), KEY)
        .mapInArrow(
            _windows(window, anchor), "anchor long, window long, doc_id long, sig int, start int"
        ),
        "windows",
    )
    earliest = (
        windows.groupBy("anchor", "window")
        .agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
        .where("earliest < latest")
    )
    parts = (
        windows.join(earliest, ["anchor", "window"])
        .where("earliest < doc_id")
        .select(*KEY, "start", (F.col("start") + window).alias("stop"))
    )
    return whole.union(parts)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        kept, total, removed = [], [], []
        for text, starts, stops in zip(texts, batch.column("starts"), batch.column("stops")):
            words = text.as_py().encode().split()
            change = np.zeros(len(words) + 1, np.int64)
            if starts.is_valid:
                np.add.at(change, starts.values.to_numpy(), 1)
                np.add.at(change, stops.values.to_numpy(), -1)
                stays = np.cumsum(change)[:-1] == 0
                left = [w for w, stay in zip(words, stays.tolist()) if stay]
            else:
                left = words
            kept.append(b" ".join(left).decode())
            total.append(len(words))
            removed.append(len(words) - len(left))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(kept, pa.string()), _long(total), _long(removed)],
            names=["doc_id", "text", "n_words", "n_removed"],
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text, n_words, n_removed) per row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space.  Each word of a run of
    ``window`` words whose sequence also starts in a document with a smaller
    doc_id goes; ``text`` holds the others, joined by one space.  Repeats are
    judged on the input, not on what is left.

    Null texts are empty; texts below ``window`` words stay as they are.  Rows
    with equal doc_id are not compared with each other.  Rows without doc_id
    neither lose words nor count as an earlier place.  Other columns are ignored.
    """
    rows = keyed(docs)
    spans = (
        repeated_spans(rows, window, anchor)
        .groupBy(*KEY)
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    )
    return (
        rows.join(stored(spans, "spans"), KEY, "left")
        .select("doc_id", "text", "starts", "stops")
        .mapInArrow(_without, "doc_id long, text string, n_words long, n_removed long")
    )
