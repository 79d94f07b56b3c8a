"""From the three landed feeds, whose text is parsed once, to the processed tables and the monthly panel."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwise.operators import aggregate, clean, join, shape, window
from panelwise.plans.features import annual_features, spread_features
from panelwise.session import landed
from panelwise.sources import sinks, text


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Columns of the feeds.
INDICATOR_FEED = _strings("country", "iso3", "year", "indicator", "value")
ESTIMATE_FEED = _strings(
    "country", "iso3", "year", "indicator", "value", "low_ci", "high_ci", "value_type"
)
CLIMATE_FEED = _strings(
    "city",
    "latitude",
    "longitude",
    "date",
    "temperature_c",
    "precipitation_mm",
    "humidity_pct",
    "wind_speed_ms",
    "solar_radiation_mj",
)

# Measures of the climate feed by their short names.
MEASURES = {
    "temperature_c": "temp",
    "precipitation_mm": "precip",
    "humidity_pct": "humidity",
    "wind_speed_ms": "wind",
    "solar_radiation_mj": "solar",
}

# Names the processed tables are published under.
PUBLISHED = {
    "temp_mean": "temp_mean_c",
    "temp_min": "temp_min_c",
    "temp_max": "temp_max_c",
    "temp_range": "temp_range_c",
    "precip_total": "precip_total_mm",
    "precip_max_day": "precip_max_day",
    "wind_mean": "wind_mean_ms",
    "solar_mean": "solar_mean_mj",
    "precip_total_lag1": "precip_lag1",
    "precip_total_lag2": "precip_lag2",
    "temp_mean_lag1": "temp_lag1",
    "temp_mean_lag2": "temp_lag2",
}


@dataclass(frozen=True)
class Options:
    """Choices where common practice differs; the defaults are the recommended ones.

    focal: code of the country the merged table is about; target: the indicator to predict.
    sentinels: "null" empties the cell, "drop" removes the reading.
    rainfall: "per_entity" divides by the number of cities, "pooled" adds them all up.
    merge: "full" keeps every year of any table, "left" those of the indicators.
    anomaly: "trailing" compares with the last five years, "global" with all.
    duplicates: "first" or "last" line of a cell wins.
    """

    focal: str
    target: str
    wet_day: float = aggregate.WET_DAY
    sentinels: str = "null"
    rainfall: str = "per_entity"
    merge: str = "full"
    anomaly: str = "trailing"
    duplicates: str = "first"
    keep_focal_in_region: bool = True


def load_indicators(spark: SparkSession, path: str, schema: StructType = INDICATOR_FEED) -> DataFrame:
    """Typed, validated rows of an indicator or estimate feed with their ordinal."""
    rows = text.scan_lines(spark, path, schema).filter(~F.col("is_long"))
    valid, _ = clean.split_valid(rows.select(*schema.names, text.ORDINAL), "year", "iso3")
    numbers = [c for c in ("value", "low_ci", "high_ci") if c in schema.names]
    typed = clean.coerce(valid, numbers).withColumn("year", F.col("year").cast("int"))
    return clean.drop_missing(typed, ["value"])


def load_climate(spark: SparkSession, path: str, sentinels: str = "null") -> DataFrame:
    """Daily readings with (year, month) and short measure names."""
    rows = text.scan_strings(spark, path, CLIMATE_FEED.names).withColumnsRenamed(MEASURES)
    measures = list(MEASURES.values())
    typed = clean.coerce(clean.with_day(rows, "date"), [*measures, "latitude", "longitude"])
    if sentinels == "drop":
        return clean.drop_sentinel_rows(typed, "temp", "precip")
    return clean.null_sentinels(typed, measures)


def indicator_names(long: DataFrame) -> list[str]:
    """The distinct indicators, a short list by nature."""
    return [r[0] for r in long.select("indicator").distinct().orderBy("indicator").collect()]


def wide_indicators(long: DataFrame, options: Options) -> DataFrame:
    rows = long.filter(F.col("iso3") == options.focal)
    pivot = shape.pivot_first if options.duplicates == "first" else shape.pivot_last
    return pivot(rows, ["year"], "indicator", indicator_names(rows), "value", text.ORDINAL)


def regional(long: DataFrame, options: Options) -> DataFrame:
    """The target indicator of all countries, one row per country and year."""
    rows = long.filter(F.col("indicator") == options.target)
    if not options.keep_focal_in_region:
        rows = rows.filter(F.col("iso3") != options.focal)
    pick = F.min_by if options.duplicates == "first" else F.max_by
    return rows.groupBy("country", "iso3", "year").agg(
        pick("value", text.ORDINAL).alias(options.target)
    )


def wide_estimates(long: DataFrame, options: Options) -> DataFrame:
    """The focal country's estimates with bounds, one row per year."""
    values = ["value", "low_ci", "high_ci"]
    rows = long.filter(F.col("iso3") == options.focal)
    last = options.duplicates != "first"
    wide = shape.pivot_bounds(rows, ["year"], "indicator", indicator_names(rows), values, text.ORDINAL, last)
    return clean.normalize_names(wide)


def features(merged_parts: Mapping[str, DataFrame], options: Options) -> DataFrame:
    """The merged annual table with lags, changes and anomalies."""
    target, climate = merged_parts["indicators"], merged_parts["climate"]
    if options.merge == "left":
        climate = join.keep_keys(climate, target, ["year"])
    estimates = merged_parts["estimates"]
    if options.merge == "left":
        estimates = join.keep_keys(estimates, target, ["year"])
    named = target.withColumnRenamed(
        clean.first_present(target, [options.target], parts=["incidence", "1000"]), "incidence"
    )
    out = annual_features(named, climate, [], "incidence", [estimates])
    if options.anomaly == "global":
        for column, name in (("precip_total", "precip_anomaly"), ("temp_mean", "temp_anomaly")):
            out = window.with_global_anomaly(out, column, name)
    return out.withColumnRenamed("incidence", options.target)


@dataclass(frozen=True)
class Typed:
    """The feeds as typed rows, written once: every table and the lists of indicators read these."""

    indicators: DataFrame
    estimates: DataFrame
    climate: DataFrame


def typed(spark: SparkSession, raw: Mapping[str, str], options: Options) -> Typed:
    """``raw`` maps indicators, estimates and climate to paths."""
    return Typed(
        landed(load_indicators(spark, raw["indicators"]), "indicators"),
        landed(load_indicators(spark, raw["estimates"], ESTIMATE_FEED), "estimates"),
        landed(load_climate(spark, raw["climate"], options.sentinels), "climate"),
    )


def process(spark: SparkSession, raw: Mapping[str, str] | Typed, options: Options) -> dict[str, DataFrame]:
    """The processed tables by name, from paths or typed feeds."""
    rows = raw if isinstance(raw, Typed) else typed(spark, raw, options)
    yearly = aggregate.annual_per_entity if options.rainfall == "per_entity" else aggregate.annual_pooled
    parts = {
        "indicators": wide_indicators(rows.indicators, options),
        "estimates": wide_estimates(rows.estimates, options),
        "climate": yearly(rows.climate, wet_day=options.wet_day),
    }
    tables = {
        "indicators_annual": parts["indicators"],
        "regional": regional(rows.indicators, options),
        "estimates_annual": parts["estimates"],
        "climate_monthly": climate_by_month(rows, options),
        "climate_annual": parts["climate"],
        "features": features(parts, options),
    }
    return {name: clean.rename_present(df, PUBLISHED) for name, df in tables.items()}


def climate_by_month(rows: Typed, options: Options) -> DataFrame:
    return aggregate.monthly(rows.climate, ["city", "latitude", "longitude"], options.wet_day)


def monthly_panel(spark: SparkSession, raw: Mapping[str, str] | Typed, options: Options) -> DataFrame:
    """The monthly table that models are tuned on: one row for each city and month of the target's years.

    The target comes from the estimates where they have it, else from the indicators.
    """
    rows = raw if isinstance(raw, Typed) else typed(spark, raw, options)
    wide, estimates = wide_indicators(rows.indicators, options), wide_estimates(rows.estimates, options)
    source, name = estimates, f"{options.target}_value"
    if name not in estimates.columns:
        source, name = wide, clean.first_present(wide, [options.target], parts=["incidence", "1000"])
    target = source.select("year", F.col(name).alias("incidence"))
    # What the target was spread from is its own month's answer.
    others = [wide.drop(options.target, name), estimates.drop(*[f"{options.target}_{x}" for x in ("value", "low_ci", "high_ci")])]
    return spread_features(target, climate_by_month(rows, options), ["city"], annual_tables=others)


def write_tables(tables: Mapping[str, DataFrame], out: str, as_csv: bool = False) -> None:
    for name, df in tables.items():
        if as_csv:
            sinks.write_csv(df, f"{out}/{name}")
        else:
            sinks.write_table(df, f"{out}/{name}")
