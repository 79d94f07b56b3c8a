"""Windows over panels.

A window partition is one entity's periods. Callers pass panels, one row per (keys, order), so
its length is the length of the calendar and never the number of readings: a hot entity has
no more rows than any other. ``order`` holds one or more columns. Lags count rows; where
periods can be absent, ``complete_calendar`` puts them back first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelwise.operators.join import attach
from panelwise.session import landed


def by_time(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def trailing(keys: Sequence[str], order: Sequence[str], n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return by_time(keys, order).rowsBetween(1 - n, 0)


def with_lags(
    df: DataFrame,
    lags: Mapping[str, Iterable[int]],
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "{column}_lag{n}",
) -> DataFrame:
    """Earlier values; all lags share one sort."""
    w = by_time(keys, order)
    return df.withColumns(
        {name.format(column=c, n=n): F.lag(c, n).over(w) for c, ns in lags.items() for n in ns}
    )


def with_guarded_lags(
    df: DataFrame,
    lags: Mapping[str, Iterable[int]],
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "{column}_lag{n}",
) -> DataFrame:
    """As ``with_lags``, and NULL where the current value is missing."""
    w = by_time(keys, order)
    return df.withColumns(
        {
            name.format(column=c, n=n): F.when(F.col(c).isNotNull(), F.lag(c, n).over(w))
            for c, ns in lags.items()
            for n in ns
        }
    )


def with_change(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str], out: str = "change"
) -> DataFrame:
    return df.withColumn(out, F.col(column) - F.lag(column).over(by_time(keys, order)))


def with_pct_change(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "change_pct",
    fill_gaps: bool = False,
) -> DataFrame:
    """Percent change to the row before.

    With ``fill_gaps`` a missing value takes the last known one first. Otherwise the result is
    NULL when either side is. A base of 0 gives NULL.
    """
    w = by_time(keys, order)
    if not fill_gaps:
        before = F.lag(column).over(w)
        return df.withColumn(out, F.try_divide(F.col(column) - before, before) * 100)
    known = F.last(column, ignorenulls=True)
    now = known.over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = known.over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.try_divide(now - before, before) * 100)


def rolling_mean(column: str, n: int, keys: Sequence[str], order: Sequence[str]) -> Column:
    return F.avg(column).over(trailing(keys, order, n))


def rolling_std(column: str, n: int, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Sample deviation; NULL for a single value."""
    return F.stddev_samp(column).over(trailing(keys, order, n))


def rolling_mean_full(column: str, n: int, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Trailing mean, NULL unless all n values are there."""
    w = trailing(keys, order, n)
    return F.when(F.count(column).over(w) == n, F.avg(column).over(w))


def with_rolling(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    means: Sequence[int] = (),
    deviations: Sequence[int] = (),
) -> DataFrame:
    return df.withColumns(
        {f"{c}_roll{n}": rolling_mean(c, n, keys, order) for c in columns for n in means}
        | {f"{c}_std{n}": rolling_std(c, n, keys, order) for c in columns for n in deviations}
    )


def with_trailing_anomaly(
    df: DataFrame, column: str, n: int, keys: Sequence[str], order: Sequence[str], out: str
) -> DataFrame:
    return df.withColumn(out, F.col(column) - rolling_mean(column, n, keys, order))


def with_anomaly_pct(
    df: DataFrame, column: str, n: int, keys: Sequence[str], order: Sequence[str], out: str
) -> DataFrame:
    """Percent deviation from the trailing mean, whose size counts as at least 1."""
    base = rolling_mean(column, n, keys, order)
    at_least_one = F.when(base.isNotNull(), F.greatest(base, F.lit(1.0)))
    return df.withColumn(out, (F.col(column) / at_least_one - 1) * 100)


def with_global_anomaly(
    df: DataFrame, column: str, out: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Value minus the mean of all periods.

    The mean is aggregated first and brought back (one value, or a join per key): unlike a
    window over the whole group this never gathers the group in one task. Without keys ``df`` is
    written once, for its mean and its rows.
    """
    if not keys:
        df = landed(df, "anomaly")
        return df.withColumn(out, F.col(column) - df.select(F.avg(column)).scalar())
    means = df.groupBy(*keys).agg(F.avg(column).alias("_mean"))
    return attach(df, means, keys).withColumn(out, F.col(column) - F.col("_mean")).drop("_mean")


def with_pct_from_first(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str], out: str = "change_pct"
) -> DataFrame:
    """Percent change from the group's earliest known value."""
    first = df.dropna(subset=[column]).groupBy(*keys).agg(
        F.min_by(column, F.struct(*order)).alias("_first")
    )
    return (
        attach(df, first, keys)
        .withColumn(out, F.try_divide(F.col(column) - F.col("_first"), F.col("_first")) * 100)
        .drop("_first")
    )


def complete_calendar(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and month from the key's first to its last month."""
    index = F.col("year") * 12 + F.col("month") - 1
    span = df.groupBy(*keys).agg(F.min(index).alias("a"), F.max(index).alias("b"))
    months = span.select(*keys, F.explode(F.sequence("a", "b")).alias("i")).select(
        *keys,
        F.expr("CAST(i DIV 12 AS INT)").alias("year"),
        (F.col("i") % 12 + 1).cast("int").alias("month"),
    )
    return months.join(df, [*keys, "year", "month"], "left")
