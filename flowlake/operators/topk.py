"""Top rows of an order, for any cap and any number of tasks.

``orderBy().limit(k)`` keeps k rows per task and merges them all in one task: k
times the number of tasks, which grows with the cluster.  ``top_rows`` merges in
rounds instead, and ``latest_rows`` first narrows the input by time.  Both are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.functions.times import partition_key

# Groups per merge round.  A first-round group receives k rows from 1/4096 of
# the tasks, a second-round group from 128 groups, the final merge from 32.
ROUNDS = (4096, 32)

# Stands in for the cut when there are fewer rows than asked for.
_BEGINNING = "0001-01-01 00:00:00"


def top_rows(
    df: DataFrame, order: list[Column], k: int, rounds: tuple[int, ...] = ROUNDS
) -> DataFrame:
    """First ``k`` rows of ``df`` in ``order``.

    Rows are grouped by the task that holds them, never by value, so equal or
    hot keys cannot pile up in a group.  Spark applies the ranked filter before
    each shuffle too (see ``session.configure``).
    """
    lane, rank = "_lane", "_rank"
    ranked = df.withColumn(lane, F.spark_partition_id())
    for groups in rounds:
        window = Window.partitionBy(lane).orderBy(*order)
        ranked = (
            ranked.withColumn(lane, F.col(lane) % groups)
            .withColumn(rank, F.row_number().over(window))
            .where(F.col(rank) <= k)
        )
    return ranked.drop(lane, rank).orderBy(*order).limit(k)


def _cut(moments: DataFrame, name: str, k: int) -> Column:
    """Latest value of ``name`` with at least ``k`` rows at or after it.

    A scalar subquery over a histogram.  Its window runs in one task, over one
    row per distinct value: hours of the retained span, or seconds of few hours.
    """
    newest_first = Window.orderBy(F.col(name).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        moments.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(name, F.sum("n").over(newest_first).alias("seen"))
        .where(F.col("seen") >= k)
        .agg(F.coalesce(F.max(name), F.lit(_BEGINNING).cast("timestamp")).alias(name))
        .scalar()
    )


def _since(df: DataFrame, name: str, cut: Column) -> DataFrame:
    # Null times sort last but still count as rows, so they remain candidates.
    return df.where((F.col(name) >= cut) | F.col(name).isNull())


def latest_rows(flows: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` staged flows in ``order``, which must start with
    ``received_at`` descending, nulls last.

    The hour histogram reads a single, highly compressible column and fixes the
    hour in which the k-th latest row lies; a second histogram, over those hours
    only, fixes the second.  What is left is about k rows, whatever the size of
    the table; should one second hold a large share of it, ``top_rows`` still
    merges that in rounds.
    """
    hour = _cut(flows, "received_hour", k)
    in_hours = _since(flows, "received_hour", hour)
    if "day" in flows.columns:
        in_hours = _since(in_hours, "day", partition_key(hour))
    seconds = in_hours.select(F.date_trunc("second", "received_at").alias("second"))
    return top_rows(_since(in_hours, "received_at", _cut(seconds, "second", k)), order, k)


def top_sums(
    parts: list[DataFrame], keys: list[str], value: str, order: list[Column], k: int
) -> DataFrame:
    """First ``k`` keys in ``order`` by the sum of ``value`` over ``parts``, each of
    which has a key once; other columns are summed up as well.

    A threshold algorithm, so that parts are not added up as a whole.  The k largest
    of each part give k keys a sum known in part; the least of these sums, over the
    number of parts, is a value that each of the k largest keys reaches in some part.
    Only rows that reach it are fetched: parts should be written with large values
    first, as row groups are then skipped by their statistics.  Keys whose sum could
    still be large enough are then looked up in all parts.

    ``order`` must rank by ``value``, descending.  Values must not be negative; null
    ones count as nothing.  Where there are fewer than ``k`` keys, all are added up.
    """
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    others = [name for name in every.columns if name not in keys]

    def kth(rows: DataFrame, name: str) -> Column:
        """Value of the k-th row, 0 where there are fewer."""
        first = rows.orderBy(F.desc(name)).limit(k)
        return first.agg(F.when(F.count(name) >= k, F.min(name)).otherwise(0).alias(name)).scalar()

    largest = parts[0].select(*keys, value).orderBy(F.desc(value)).limit(k)
    for part in parts[1:]:
        largest = largest.unionByName(part.select(*keys, value).orderBy(F.desc(value)).limit(k))
    known = largest.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    cut = known.agg(F.lit(1)).select(kth(known, "_sum").alias("_cut")).first()[0]
    if not cut:
        return top_rows(every.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in others]), order, k)
    # Rounded down, so that no key is lost to the division.
    least = int(cut) // len(parts)
    fetched = (
        every.where(F.col(value) >= least)
        .groupBy(*keys)
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_parts"))
    )
    # A part in which a key was not fetched adds less than the least fetched value.
    possible = fetched.where(F.col("_sum") + (len(parts) - F.col("_parts")) * least >= int(cut))
    match = [F.col(f"c.{key}").eqNullSafe(F.col(f"e.{key}")) for key in keys]
    found = every.alias("e").join(possible.select(*keys).alias("c"), match, "left_semi")
    return top_rows(found.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in others]), order, k)
