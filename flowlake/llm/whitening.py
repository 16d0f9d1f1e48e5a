"""Embedding whitening from exact squared sums."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored

# Entries become floor(64 * c) + 1000000.
SCALE = 64
SHIFT = 1_000_000

COMPONENTS = 16

# Sums travel as this many limbs of so many bits, each a long of its own; the last
# holds the sign.  Added up over any number of tasks below 2**30 they stay exact.
LIMBS = 8
LIMB_BITS = 32

# Centred entries are squared as two halves of so many bits, in 64 bits, and added in
# blocks of so many rows; larger entries as Python integers.
HALF_BITS = 25
BLOCK_ROWS = 4096

_LIMB_COLUMNS = [f"limb{i}" for i in range(LIMBS)]
_SUMS = "dims int, i int, j int, " + ", ".join(f"{c} long" for c in _LIMB_COLUMNS)

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def _digits(vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows that remain, their entries as longs).  Beyond a long, entries are cut
    to its ends."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values
    entries = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    good = np.append(0, np.cumsum(~np.isfinite(entries)))
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(valid & (good[offsets[1:]] == good[offsets[:-1]]))
    with np.errstate(over="ignore"):
        x = np.floor(np.nan_to_num(entries, posinf=0.0, neginf=0.0) * SCALE)
    inside = np.abs(x) < 2.0**62
    whole = np.where(inside, x, 0).astype(np.int64) + SHIFT
    whole[~inside & (x > 0)], whole[~inside & (x < 0)] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    return rows, [whole[offsets[r] : offsets[r + 1]] for r in rows]


def _packed(x: np.ndarray) -> bytes:
    """The entries less SHIFT in the fewest bytes that hold them all: equal vectors
    give equal bytes."""
    small = x - SHIFT if len(x) and x.min() > np.iinfo(np.int64).min + SHIFT else x
    moved = small is not x
    for code, width in enumerate(_WIDTHS):
        info = np.iinfo(width)
        if not len(small) or (small.min() >= info.min and small.max() <= info.max):
            break
    return bytes([code + 4 * moved]) + small.astype(width).tobytes()


def _unpacked(keys: pa.Array) -> dict[int, np.ndarray]:
    """Vectors of a batch by their length, one row each."""
    found: dict[int, list[np.ndarray]] = {}
    for key in keys.to_pylist():
        moved, code = divmod(key[0], 4)
        x = np.frombuffer(key, _WIDTHS[code], offset=1).astype(np.int64) + (SHIFT if moved else 0)
        found.setdefault(len(x), []).append(x)
    return {dims: np.stack(rows) for dims, rows in found.items()}


def _to_limbs(total: int) -> list[int]:
    limbs = [(total >> (LIMB_BITS * i)) & ((1 << LIMB_BITS) - 1) for i in range(LIMBS - 1)]
    return [*limbs, total >> (LIMB_BITS * (LIMBS - 1))]


def _sums_batch(totals: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    keys = np.array(list(totals), np.int32).reshape(-1, 3)
    limbs = np.array([_to_limbs(v) for v in totals.values()], np.int64).reshape(-1, LIMBS)
    return pa.record_batch(
        [pa.array(keys[:, c]) for c in range(3)] + [pa.array(limbs[:, c]) for c in range(LIMBS)],
        names=["dims", "i", "j", *_LIMB_COLUMNS],
    )


def _collected(sums: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Totals by vector length, and by pair of dimensions: as many rows as pairs,
    whatever the number of vectors."""
    added = sums.groupBy("dims", "i", "j").agg(*[F.sum(c).alias(c) for c in _LIMB_COLUMNS])
    found: dict[int, dict[tuple[int, int], int]] = {}
    for batch in added.toArrow().to_batches():
        columns = [column.to_pylist() for column in batch.columns]
        for dims, i, j, *limbs in zip(*columns):
            found.setdefault(dims, {})[i, j] = sum(limb << (LIMB_BITS * n) for n, limb in enumerate(limbs))
    return found


def _entry_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of vectors (i = -1) and sum of each dimension."""
    totals: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for dims, x in _unpacked(batch.column("x")).items():
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            totals[dims, -1, -1] = totals.get((dims, -1, -1), 0) + len(x)
            for i in range(dims):
                totals[dims, i, i] = totals.get((dims, i, i), 0) + (int(high[i]) << 32) + int(low[i])
    yield _sums_batch(totals)


@dataclass
class Centre:
    """Number ``n`` of distinct vectors and the sum of each dimension, exact."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.floors = [total // self.n for total in self.sums]
        self.rest = [total - self.n * low for total, low in zip(self.sums, self.floors)]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S; as Python integers where longs might not hold them."""
        floors = np.array(self.floors, object)
        near = max(abs(int(x.max()) - min(self.floors)), abs(int(x.min()) - max(self.floors))) if x.size else 0
        if (near + 1) * self.n < 1 << (2 * HALF_BITS - 1) and near < 1 << 62:
            return (x - floors.astype(np.int64)) * self.n - np.array(self.rest, np.int64)
        return (x.astype(object) - floors) * self.n - np.array(self.rest, object)


def _square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each column, of up to BLOCK_ROWS rows."""
    if y.dtype == object:
        return [sum(int(v) ** 2 for v in column) for column in y.T]
    high, low = y >> HALF_BITS, y & ((1 << HALF_BITS) - 1)
    parts = [np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(a << (2 * HALF_BITS)) + (b << (HALF_BITS + 1)) + c for a, b, c in zip(*parts)]


def _lengths_squared(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    parts = [_square_sums(y.T[at : at + BLOCK_ROWS]) for at in range(0, y.shape[1], BLOCK_ROWS)]
    return [sum(row) for row in zip(*parts)]


def _variance_sums(centres: dict[int, Centre]):
    """Squared centred values of every dimension (i = j) and of every sum of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for dims, x in _unpacked(batch.column("x")).items():
                for begin in range(0, len(x), BLOCK_ROWS):
                    y = centres[dims].deviations(x[begin : begin + BLOCK_ROWS])
                    for i in range(dims):
                        sums = y[:, i + 1 :] + y[:, i : i + 1]
                        for j, value in enumerate(_square_sums(y[:, i : i + 1]) + _square_sums(sums), i):
                            totals[dims, i, j] = totals.get((dims, i, j), 0) + value
        yield _sums_batch(totals)

    return run


@dataclass
class Whitening:
    """Mean, components and eigenvalues of one length of vectors."""

    centre: Centre
    vectors: np.ndarray  # one column per component
    values: np.ndarray
    trace: float

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of the deviations ``y``."""
        return (y.astype(np.float64) / self.centre.n) @ self.vectors / np.sqrt(self.values)


def _solved(centre: Centre, sums: dict[tuple[int, int], int], components: int) -> Whitening:
    """Covariances as differences of variances: half of var(i + j) - var(i) - var(j)."""
    dims = len(centre.sums)
    scale = centre.n**3  # deviations are n times too large, and n of them are added
    cov = np.zeros((dims, dims))
    for (i, j), total in sums.items():
        if i == j:
            cov[i, i] = total / scale
        else:
            cov[i, j] = cov[j, i] = (total - sums[i, i] - sums[j, j]) / (2 * scale)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = values > (values[0] * dims * np.finfo(float).eps if dims else 0.0)
    count = min(components, int(some.sum()))
    values, vectors = values[:count].copy(), vectors[:, :count].copy()
    if count:
        largest = np.abs(vectors).argmax(axis=0)
        vectors *= np.where(vectors[largest, np.arange(count)] < 0, -1.0, 1.0)
    trace = sum(sums[i, i] for i in range(dims)) / scale
    return Whitening(centre, vectors, values, trace)


def _moments(models: dict[int, Whitening]):
    """Sums of whitened values and of their products, of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, x in _unpacked(batch.column("x")).items():
                w = models[dims].project(models[dims].centre.deviations(x))
                w = np.hstack([w, np.ones((len(w), 1))])
                totals[dims] = totals.get(dims, 0) + w.T @ w
        for dims, total in totals.items():
            at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            columns = [np.full(total.size, dims, np.int32), at[0], at[1], total.reshape(-1)]
            yield pa.record_batch([pa.array(c) for c in columns], names=["dims", "i", "j", "total"])

    return run


def _identity_errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    sums = fit.mapInArrow(_moments(models), "dims int, i int, j int, total double")
    found: dict[int, float] = {}
    tables: dict[int, dict] = {}
    for row in sums.groupBy("dims", "i", "j").agg(F.sum("total").alias("total")).collect():
        tables.setdefault(row.dims, {})[row.i, row.j] = row.total
    for dims, table in tables.items():
        k, n = len(models[dims].values), models[dims].centre.n
        total = np.array([[table[i, j] for j in range(k + 1)] for i in range(k + 1)])
        mean = total[:k, k] / n
        error = total[:k, :k] / n - np.outer(mean, mean) - np.eye(k)
        found[dims] = float(np.abs(error).max()) if k else 0.0
    return found


def fit_whitening(
    vectors: DataFrame, components: int = COMPONENTS
) -> tuple[dict[int, Whitening], dict[int, float]]:
    """Whitening of each length of vectors of ``vectors`` (embedding), and the
    largest error of the whitened covariance, measured on the vectors themselves.

    Each distinct vector counts once.  What reaches the driver are sums per pair
    of dimensions, exact integers of any size.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = _digits(batch.column(0))
            yield pa.record_batch([pa.array([_packed(x) for x in found], pa.binary())], names=["x"])

    rows = vectors.select(F.col("embedding").cast("array<double>").alias("embedding"))
    fit = stored(rows.mapInArrow(keys, "x binary").distinct(), "distinct")
    entries = _collected(fit.mapInArrow(_entry_sums, _SUMS))
    centres = {
        dims: Centre(sums[-1, -1], [sums[i, i] for i in range(dims)]) for dims, sums in entries.items()
    }
    pairs = _collected(fit.mapInArrow(_variance_sums(centres), _SUMS))
    models = {dims: _solved(centre, pairs.get(dims, {}), components) for dims, centre in centres.items()}
    return models, _identity_errors(fit, models)


def whiten_vectors(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    wide_deviation) per remaining row of ``vectors`` (vec_id, embedding) and component.

    Rows whose vector is null or holds null or non-finite entries drop out.  Entries
    become longs x = floor(64 c) + 1000000, cut to the ends of a long where they pass
    it.  Sums run over distinct vectors: n of them, S per dimension.  The covariance
    comes from polarisation: the squares of n x - S of every dimension and of every
    sum of two dimensions are added up exactly, and their differences give all
    covariances.  ``deviation`` is the sum of (n x - S)^2 over the dimensions, null
    where it passes a long; ``wide_deviation`` holds it as text, always.

    Components are numbered by falling eigenvalue, the largest entry of each is
    positive; those without variance are left out, so a table of equal vectors, or
    of one, gives no rows, and vectors of no entries give none.  Vectors of each
    length are whitened among their own.  Repeated rows and null ids are returned as
    often as they come; other columns are ignored.
    """
    models, errors = fit_whitening(vectors, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = _digits(batch.column("embedding"))
            lengths = np.array([len(x) for x in found])
            for dims in np.unique(lengths):
                model = models[int(dims)]
                k = len(model.values)
                if not k:
                    continue
                at = np.flatnonzero(lengths == dims)
                y = model.centre.deviations(np.stack([found[i] for i in at]))
                wide = _lengths_squared(y)
                fits = [v if v < 1 << 63 else None for v in wide]
                each = pa.array(np.repeat(np.arange(len(at)), k))
                m = len(at) * k
                yield pa.record_batch(
                    [
                        batch.column("vec_id").take(pa.array(rows[at])).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(m, model.centre.n, np.int64)),
                        pa.array(fits, pa.int64()).take(each),
                        pa.array(model.project(y).reshape(-1)),
                        pa.array(np.tile(model.values / model.trace, len(at))),
                        pa.array(np.full(m, errors[int(dims)])),
                        pa.array([str(v) for v in wide], pa.string()).take(each),
                    ],
                    names=[
                        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                        "wide_deviation",
                    ],
                )

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(
        run,
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, wide_deviation string",
    )
