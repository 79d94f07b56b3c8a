"""Sorting, ranking and picking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwise.session import landed


def global_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Rank of each row by ``value``, highest first, equal values alike (1, 2, 2, 4); NULL where the value is.

    No task sees more than its share: rows are counted by value, values are dealt to ranges, and a value's
    rank is what the ranges before its own hold plus what lies above it in its own. A value lies in one
    range, so ties never meet a border. Only the ranges' totals, a row each, are summed in one task.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    ranges = landed(counts.repartitionByRange(n, F.desc("_value")).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_range").agg(F.sum("_n").alias("_total"))
    before = F.coalesce(F.sum("_total").over(Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = F.coalesce(F.sum("_n").over(Window.partitionBy("_range").orderBy(F.desc("_value")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("_range", before.alias("_before"))
    ranks = ranges.withColumn("_above", above).join(offsets, "_range").select("_value", (F.col("_before") + F.col("_above") + 1).cast("int").alias(out))
    return df.join(ranks, df[value] == ranks["_value"], "left").drop("_value")


def latest_ranking(df: DataFrame, period: str, value: str, entity: str) -> DataFrame:
    """Rows of the latest period, ranked by value, highest first; any number of entities.

    ``df`` is written once, for the latest period and its rows.
    """
    rows = landed(df, "ranking")
    latest = rows.filter(F.col(period) == rows.select(F.max(period)).scalar()).dropna(subset=[value])
    return global_rank(latest, value).orderBy("rank", entity)


def top_k(df: DataFrame, by: Column, k: int, *ties: str) -> DataFrame:
    """The first k rows; each task keeps k rows at most, ``ties`` settle equal ones."""
    return df.orderBy(by, *ties).limit(k)


def page(df: DataFrame, order: Sequence[str], size: int, after: Mapping[str, object] | None = None) -> DataFrame:
    """The next ``size`` rows after the key ``after``, in ``order``, whose columns together name a row.

    Each task keeps ``size`` rows, whichever page it is: nothing before the key is sorted or moved, and the
    key's first column prunes the scan. NULLs come first.
    """
    if after is None:
        return df.orderBy(*order).limit(size)

    def beyond(column: str) -> Column:
        return F.col(column).isNotNull() if after[column] is None else F.col(column) > F.lit(after[column])

    later = beyond(order[-1])
    for column in reversed(order[:-1]):
        later = beyond(column) | (F.col(column).eqNullSafe(F.lit(after[column])) & later)
    first = after[order[0]]
    rows = df if first is None else df.filter(F.col(order[0]) >= F.lit(first))
    return rows.filter(later).orderBy(*order).limit(size)


def last_key(rows: DataFrame, order: Sequence[str]) -> dict[str, object] | None:
    """The key of a page's last row, from which the next page starts; None for an empty page."""
    row = rows.select(*order).orderBy(*[F.desc_nulls_last(c) for c in order]).first()
    return None if row is None else row.asDict()


def leaderboard(metrics: DataFrame, error: str = "mae", name: str = "model") -> DataFrame:
    return metrics.orderBy(F.col(error).asc_nulls_last(), name)


def best_by(
    metrics: DataFrame, name: str = "model", errors: Sequence[str] = (), scores: Sequence[str] = ()
) -> DataFrame:
    """One row: the best model by each error (lowest) and score (highest); ties by name."""
    low = [
        F.min(F.when(F.col(e).isNotNull(), F.struct(F.col(e).alias("v"), F.col(name).alias("n"))))
        ["n"].alias(f"best_by_{e}")
        for e in errors
    ]
    high = [
        F.min(F.when(F.col(s).isNotNull(), F.struct((-F.col(s)).alias("v"), F.col(name).alias("n"))))
        ["n"].alias(f"best_by_{s}")
        for s in scores
    ]
    return metrics.agg(*low, *high)
