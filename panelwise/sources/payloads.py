"""Nested JSON payloads to long rows, one generator per payload shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Payload schemas of the three feeds.
PAGE_ITEMS = (
    "array<struct<country:struct<value:string>,countryiso3code:string,date:string,value:double>>"
)
ESTIMATES = (
    "struct<value:array<struct<TimeDim:int,NumericValue:double,Low:double,High:double,Value:string>>>"
)
SERIES = "struct<properties:struct<parameter:map<string,map<string,double>>>>"

# Parameter names of the daily feed and the columns they land in.
DAILY_PARAMETERS = {
    "T2M": "temp",
    "PRECTOTCORR": "precip",
    "RH2M": "humidity",
    "WS2M": "wind",
    "ALLSKY_SFC_SW_DWN": "solar",
}

# Fixed value: date key of the daily feed that marks a missing day.
MISSING_DAY = "-999.0"


def indicator_pages(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``[meta, [item, ...]]`` pages to (country, code, year, value) rows."""
    parts = F.from_json(F.col(text), "array<string>")
    items = F.from_json(F.get(parts, F.lit(1)), PAGE_ITEMS)
    return df.select(*keep, F.explode(items).alias("_item")).select(
        *keep,
        F.col("_item.country.value").alias("country"),
        F.col("_item.countryiso3code").alias("code"),
        F.col("_item.date").alias("year"),
        F.col("_item.value").alias("value"),
    )


def estimate_array(
    df: DataFrame, text: str, keep: Sequence[str], drop_missing: bool = False
) -> DataFrame:
    """``{"value": [...]}`` to one row per estimate with its bounds."""
    item = F.explode(F.from_json(F.col(text), ESTIMATES)["value"]).alias("_item")
    rows = df.select(*keep, item).select(
        *keep,
        F.col("_item.TimeDim").alias("year"),
        F.col("_item.NumericValue").alias("value"),
        F.col("_item.Low").alias("low_ci"),
        F.col("_item.High").alias("high_ci"),
        F.col("_item.Value").alias("value_type"),
    )
    return rows.dropna(subset=["value"]) if drop_missing else rows


def map_series(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    parameters: Mapping[str, str] = DAILY_PARAMETERS,
    axis: Sequence[str] = ("T2M", "PRECTOTCORR"),
) -> DataFrame:
    """One map per measure to one row per day of the ``axis`` measures' combined days.

    The entries of all maps are spread once and met again by document and day: work grows with the entries,
    not with days times measures, and a document's days are dealt to many tasks. Of keys that repeat in one
    map the largest value counts.
    """
    parsed = F.from_json(F.col(text), SERIES)["properties"]["parameter"]
    maps = df.select(*keep, F.monotonically_increasing_id().alias("_doc"), parsed.alias("_maps"))
    names = list(parameters) + [a for a in axis if a not in parameters]

    def entries(name: str) -> Column:
        days = F.map_entries(F.try_element_at(F.col("_maps"), F.lit(name)))
        cell = F.transform(days, lambda e: F.struct(F.lit(names.index(name)).alias("m"), e["key"].alias("day"), e["value"].alias("v")))
        return F.coalesce(cell, F.array().cast("array<struct<m:int,day:string,v:double>>"))

    cells = maps.select(*keep, "_doc", F.inline(F.concat(*[entries(n) for n in names]))).filter(F.col("day") != MISSING_DAY)
    on_axis = F.max(F.col("m").isin([names.index(a) for a in axis])).alias("_on_axis")
    values = [F.max(F.when(F.col("m") == names.index(n), F.col("v"))).alias(c) for n, c in parameters.items()]
    return cells.groupBy("_doc", *keep, "day").agg(on_axis, *values).filter("_on_axis").select(*keep, "day", *parameters.values())


def scan_report(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A report document; without a schema Spark derives one from the documents."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def report_section(report: DataFrame, section: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of an array-of-struct section, fields as columns."""
    return report.select(*keep, F.inline(section))
