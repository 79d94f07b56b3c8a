"""The given tables seen as the feeds the operators work on, as frames and as SQL.

Measures are whole numbers held as doubles, so sums are exact in any order of addition and a
result does not depend on how the input is partitioned.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.sql.types import StructType

from panelwise.operators import aggregate, window
from panelwise.operators.shape import unpivot

INDICATORS = ("ind_1_urgent", "ind_2_high", "ind_3_medium", "ind_4_not_specified", "ind_5_low")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TIME = ("year", "month")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from a footer once per path."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Daily readings per city: the line items, placed by their supplier's nation.

    Dimensions join one after the other, each straight from its scan, so that Catalyst knows
    their sizes: small ones are broadcast, a supplier table beyond the threshold is shuffled.
    """
    day = F.to_date("l_shipdate")
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            day.alias("obs_date"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.col("l_quantity").alias("temp"),
            F.floor(F.col("l_extendedprice") / 100).cast("double").alias("precip"),
            whole_percent("l_discount").alias("humidity"),
            whole_percent("l_tax").alias("wind"),
            F.col("l_linenumber").cast("double").alias("solar"),
        )
    )


def whole_percent(column: str) -> Column:
    # floor(x + 0.5): Spark's round goes through a decimal per row.
    return F.floor(F.col(column) * 100 + 0.5).cast("double")


def names_in(df: DataFrame, column: str) -> list:
    """The distinct values of a column that becomes a table's header, in order."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.monthly(readings(spark, sf))


def annual(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly climate per city."""
    return aggregate.annual_per_entity(readings(spark, sf), keys=("city",))


def indicator_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Long indicators as they arrive: several rows per (country, year, indicator)."""
    key = F.col("n_nationkey")
    name = F.lower(F.translate("o_orderpriority", "- ", "__"))
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country"),
            F.concat(F.lit("N"), F.char(F.floor(key / 26) + 65), F.char(key % 26 + 65)).alias("code"),
            F.year("o_orderdate").alias("year"),
            F.concat(F.lit("ind_"), name).alias("indicator"),
            F.floor("o_totalprice").cast("double").alias("value"),
            F.col("o_orderkey").alias("ordinal"),
        )
    )


def indicators(spark: SparkSession, sf: str) -> DataFrame:
    """One estimate with bounds per (country, year, indicator)."""
    return (
        indicator_rows(spark, sf)
        .groupBy("country", "code", "year", "indicator")
        .agg(F.sum("value").alias("value"), F.min("value").alias("low_ci"), F.max("value").alias("high_ci"))
    )


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows as text with planted null tokens, sentinels, bad dates and shifted fields."""
    k = F.col("o_orderkey")
    number = F.floor("o_totalprice").cast("bigint").cast("string")
    year = F.year("o_orderdate").cast("string")
    return table(spark, sf, "orders").select(
        k.alias("order_key"),
        F.when(k % 29 == 0, "2004")
        .otherwise(F.concat(F.lit(" N"), F.char(o_mod(26) + 65), F.char(o_mod(7) + 97)))
        .alias("code_text"),
        F.when(k % 23 == 0, "KEN").otherwise(F.concat(year, F.lit(" "))).alias("year_text"),
        F.when(k % 7 == 0, "NA")
        .when(k % 11 == 0, "")
        .when(k % 13 == 0, "None")
        .when(k % 5 == 0, "nan")
        .when(k % 3 == 0, F.concat(number, F.lit(".5")))
        .otherwise(number)
        .alias("value_text"),
        F.when(k % 17 == 0, "-999.0")
        .when(k % 19 == 0, "20101301")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
        .alias("date_text"),
        F.when(k % 31 == 0, F.lit(None)).when(k % 37 == 0, -999.0).otherwise((k % 40).cast("double")).alias("temp"),
        F.when(k % 41 == 0, -999.0).otherwise(F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("precip"),
    )


def o_mod(n: int) -> Column:
    return F.col("o_custkey") % n


def predictions(spark: SparkSession, sf: str, panel: DataFrame | None = None) -> DataFrame:
    """Three naive predictors of a month's rainfall, long by model; ``panel`` is the monthly one if it is at hand."""
    w = window.by_time(["city"], TIME)
    wide = (monthly(spark, sf) if panel is None else panel).select(
        "city",
        *TIME,
        F.col("precip_total").alias("actual"),
        F.lag("precip_total", 1).over(w).alias("lag1"),
        F.avg("precip_total").over(w.rowsBetween(-3, -1)).alias("roll3"),
        F.lag("precip_total", 12).over(w).alias("lag12"),
    )
    known = wide.dropna(subset=["lag12"])
    return unpivot(known, ["city", *TIME, "actual"], ["lag1", "roll3", "lag12"], "model", "predicted")


def scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as rows of knobs."""
    k = F.col("c_custkey")

    def knob(c: Column) -> Column:
        return c.cast("double")

    return table(spark, sf, "customer").select(
        k.alias("scenario_id"),
        knob(k % 250 + 20).alias("lag1"),
        knob(k % 240 + 25).alias("lag2"),
        knob(k % 30 - 15).alias("change"),
        knob(k * 7 % 2500).alias("precip"),
        knob(k % 16 + 15).alias("temp"),
        knob(k % 60 + 40).alias("humidity"),
        knob(k % 80 + 10).alias("urban"),
        knob(k * 1000 + 1000000).alias("population"),
        knob(k % 9 + 1).alias("health"),
    )


# --- the same views as SQL --------------------------------------------------------------------

_VIEWS = {
    "readings": """
        SELECT n_name AS city, r_name AS region, CAST(l_shipdate AS DATE) AS obs_date,
               year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month,
               l_quantity AS temp, floor(l_extendedprice / 100) AS precip,
               floor(l_discount * 100 + 0.5) AS humidity, floor(l_tax * 100 + 0.5) AS wind,
               l_linenumber::DOUBLE AS solar
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "monthly": """
        SELECT city, year, month, avg(temp) AS temp_mean, min(temp) AS temp_min, max(temp) AS temp_max,
               max(temp) - min(temp) AS temp_range, sum(precip) AS precip_total,
               count(*) FILTER (WHERE precip > 0.1) AS precip_days, max(precip) AS precip_max_day,
               avg(humidity) AS humidity_mean, avg(wind) AS wind_mean, avg(solar) AS solar_mean,
               count(*) AS n_obs
        FROM readings GROUP BY city, year, month""",
    "annual": """
        SELECT city, year, avg(temp) AS temp_mean, max(temp) AS temp_max, sum(precip) AS precip_total,
               count(*) FILTER (WHERE precip > 0.1)::DOUBLE AS precip_days,
               avg(humidity) AS humidity_mean, avg(wind) AS wind_mean, avg(solar) AS solar_mean,
               count(DISTINCT city) AS n_cities
        FROM readings GROUP BY city, year""",
    "indicator_rows": """
        SELECT n_name AS country,
               'N' || chr((n_nationkey // 26 + 65)::INT) || chr((n_nationkey % 26 + 65)::INT) AS code,
               year(o_orderdate)::INT AS year,
               'ind_' || lower(translate(o_orderpriority, '- ', '__')) AS indicator,
               floor(o_totalprice) AS value, o_orderkey AS ordinal
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "indicators": """
        SELECT country, code, year, indicator, sum(value) AS value, min(value) AS low_ci, max(value) AS high_ci
        FROM indicator_rows GROUP BY country, code, year, indicator""",
    "dirty": """
        SELECT o_orderkey AS order_key,
               CASE WHEN o_orderkey % 29 = 0 THEN '2004'
                    ELSE ' N' || chr((o_custkey % 26 + 65)::INT) || chr((o_custkey % 7 + 97)::INT) END AS code_text,
               CASE WHEN o_orderkey % 23 = 0 THEN 'KEN'
                    ELSE year(o_orderdate)::INT::VARCHAR || ' ' END AS year_text,
               CASE WHEN o_orderkey % 7 = 0 THEN 'NA' WHEN o_orderkey % 11 = 0 THEN ''
                    WHEN o_orderkey % 13 = 0 THEN 'None' WHEN o_orderkey % 5 = 0 THEN 'nan'
                    WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice)::BIGINT::VARCHAR || '.5'
                    ELSE floor(o_totalprice)::BIGINT::VARCHAR END AS value_text,
               CASE WHEN o_orderkey % 17 = 0 THEN '-999.0' WHEN o_orderkey % 19 = 0 THEN '20101301'
                    ELSE strftime(o_orderdate, '%Y%m%d') END AS date_text,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN -999.0
                    ELSE o_orderkey % 40 END::DOUBLE AS temp,
               CASE WHEN o_orderkey % 41 = 0 THEN -999.0 ELSE floor(o_totalprice / 1000) END::DOUBLE AS precip
        FROM orders""",
    "numbers": """
        SELECT *, CASE WHEN trim(value_text) IN ('', 'NA', 'None', 'nan') THEN NULL
                       ELSE TRY_CAST(value_text AS DOUBLE) END AS value FROM dirty""",
    "predictions": """
        SELECT city, year, month, actual, model, predicted FROM (SELECT * FROM (
          SELECT city, year, month, precip_total AS actual,
                 lag(precip_total, 1) OVER w AS lag1,
                 avg(precip_total) OVER (PARTITION BY city ORDER BY year, month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll3,
                 lag(precip_total, 12) OVER w AS lag12
          FROM monthly WINDOW w AS (PARTITION BY city ORDER BY year, month)) WHERE lag12 IS NOT NULL)
        UNPIVOT (predicted FOR model IN (lag1, roll3, lag12))""",
    "scenarios": """
        SELECT c_custkey AS scenario_id, (c_custkey % 250 + 20)::DOUBLE AS lag1, (c_custkey % 240 + 25)::DOUBLE AS lag2,
               (c_custkey % 30 - 15)::DOUBLE AS change, (c_custkey * 7 % 2500)::DOUBLE AS precip,
               (c_custkey % 16 + 15)::DOUBLE AS temp, (c_custkey % 60 + 40)::DOUBLE AS humidity,
               (c_custkey % 80 + 10)::DOUBLE AS urban, (c_custkey * 1000 + 1000000)::DOUBLE AS population,
               (c_custkey % 9 + 1)::DOUBLE AS health
        FROM customer""",
    "metrics": """
        SELECT model, avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
               1 - sum((actual - predicted) * (actual - predicted)) / regr_syy(actual, predicted) AS r2,
               avg(abs(actual - predicted) / abs(actual)) AS mape, count(*) AS n
        FROM predictions GROUP BY model""",
}


def oracle(body: str) -> str:
    """``body`` with the views it names, and those they name, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _VIEWS:
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                visit(_VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    views = ", ".join(f"{name} AS ({_VIEWS[name]})" for name in needed)
    body = body.strip()
    if not views:
        return body
    # A body with its own expressions continues the list.
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {body[15:]}"
    return f"WITH {views}, {body[5:]}" if body.startswith("WITH ") else f"WITH {views} {body}"
