"""Grouped summaries of daily readings and long tables.

All of them combine on the map side, so what crosses the network is one row per group and
input task whatever the number of readings behind it; a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwise.operators.clean import numeric_columns

# Rain above this many millimetres makes a wet day.
WET_DAY = 0.1


def count_above(column: str, threshold: float) -> Column:
    return F.count_if(F.col(column) > threshold)


def monthly(df: DataFrame, keys: Sequence[str] = ("city",), wet_day: float = WET_DAY) -> DataFrame:
    """Readings with (year, month) to one row per keys and month."""
    lo, hi = F.min("temp"), F.max("temp")
    return df.groupBy(*keys, "year", "month").agg(
        F.avg("temp").alias("temp_mean"),
        lo.alias("temp_min"),
        hi.alias("temp_max"),
        (hi - lo).alias("temp_range"),
        F.sum("precip").alias("precip_total"),
        count_above("precip", wet_day).alias("precip_days"),
        F.max("precip").alias("precip_max_day"),
        F.avg("humidity").alias("humidity_mean"),
        F.avg("wind").alias("wind_mean"),
        F.avg("solar").alias("solar_mean"),
        F.count(F.lit(1)).alias("n_obs"),
    )


def annual_pooled(
    df: DataFrame, keys: Sequence[str] = (), entity: str = "city", wet_day: float = WET_DAY
) -> DataFrame:
    """Yearly means; rainfall and wet days are summed over all entities."""
    return df.groupBy(*keys, "year").agg(
        F.avg("temp").alias("temp_mean"),
        F.max("temp").alias("temp_max"),
        F.sum("precip").alias("precip_total"),
        count_above("precip", wet_day).alias("precip_days"),
        F.avg("humidity").alias("humidity_mean"),
        F.avg("wind").alias("wind_mean"),
        F.avg("solar").alias("solar_mean"),
        F.count_distinct(entity).alias("n_cities"),
    )


def annual_per_entity(
    df: DataFrame, keys: Sequence[str] = (), entity: str = "city", wet_day: float = WET_DAY
) -> DataFrame:
    """As ``annual_pooled`` with rainfall and wet days divided by the number of entities."""
    pooled = annual_pooled(df, keys, entity, wet_day)
    return pooled.withColumns(
        {c: F.col(c) / F.col("n_cities") for c in ("precip_total", "precip_days")}
    )


def mean_of_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Means of all number columns; the keys alone where there are none."""
    means = [F.avg(c).alias(c) for c in numeric_columns(df, keys)]
    return df.groupBy(*keys).agg(*means) if means else df.select(*keys).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, the number of distinct values per column.

    Each column is counted in its own two-step aggregation and the tagged values share one
    pass, so no task has to hold a column's values.
    """
    cells = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    tagged = df.select(F.inline(F.array(*cells)))
    per_value = tagged.dropna().groupBy("name", "value").agg(F.lit(1).alias("one"))
    return per_value.agg(*[F.count_if(F.col("name") == c).alias(f"n_{c}") for c in columns])


def climatology(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("city",)) -> DataFrame:
    """Mean per calendar month over all years."""
    return df.groupBy(*keys, "month").agg(*[F.avg(m).alias(m) for m in measures])


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def period_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"first_{column}"), F.max(column).alias(f"last_{column}"))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) for columns with missing values, worst first."""
    chosen = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in chosen])
    return (
        counts.unpivot([], chosen, "column", "n_missing")
        .filter("n_missing > 0")
        .orderBy(F.desc("n_missing"), "column")
    )


def extremes(df: DataFrame, value: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Highest and lowest value with their labels; the smallest label wins a tie."""
    tie = F.struct(F.col(value).alias("v"), (-F.col(label)).alias("k"))
    low = F.struct(F.col(value).alias("v"), F.col(label).alias("k"))
    present = F.col(value).isNotNull()
    best, worst = F.max(F.when(present, tie)), F.min(F.when(present, low))
    return df.groupBy(*keys).agg(
        best["v"].alias("peak"),
        (-best["k"]).alias(f"peak_{label}"),
        worst["v"].alias("low"),
        worst["k"].alias(f"low_{label}"),
    )


def first_last_change(df: DataFrame, value: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Percent change from the first to the last known value."""
    when = F.when(F.col(value).isNotNull(), F.col(order))
    first, last = F.min_by(value, when), F.max_by(value, when)
    return df.groupBy(*keys).agg(first.alias("first_value"), last.alias("last_value")).withColumn(
        "change_pct",
        F.try_divide(F.col("last_value") - F.col("first_value"), F.col("first_value")) * 100,
    )


def latest_known(
    df: DataFrame, measures: Sequence[str], order: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Per measure the value of the latest period that has one."""
    return df.groupBy(*keys).agg(
        *[F.max_by(m, F.when(F.col(m).isNotNull(), F.col(order))).alias(m) for m in measures]
    )


def last_row(df: DataFrame, measures: Sequence[str], order: str, keys: Sequence[str] = ()) -> DataFrame:
    """The measures of the latest period, missing or not."""
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*measures), order).alias("r"))
        .select(*keys, "r.*")
    )
