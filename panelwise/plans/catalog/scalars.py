"""Projections, filters and scalar functions, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions import cleaning, derive
from panelwise.operators import clean, stats, window
from panelwise.plans import bindings as b
from panelwise.plans.catalog.registry import query

SIN_DIGITS = 10


@query("coerce_numeric", "SELECT order_key, value FROM numbers")
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    renamed = b.dirty(spark, sf).select("order_key", F.col("value_text").alias("value"))
    return clean.coerce(renamed, ["value"])


@query(
    "null_tokens",
    """SELECT order_key, CASE WHEN trim(value_text) IN ('', 'NA', 'None', 'nan') THEN NULL ELSE value_text END AS value_text,
              value FROM numbers""",
)
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("value_text")
    return b.dirty(spark, sf).select(
        "order_key",
        cleaning.null_if_token(c).alias("value_text"),
        cleaning.to_number_or_null_token(c).alias("value"),
    )


_DAY = "try_strptime(date_text, '%Y%m%d')"


@query(
    "parse_yyyymmdd",
    f"SELECT order_key, strftime({_DAY}, '%Y-%m-%d') AS obs_date FROM dirty WHERE {_DAY} IS NOT NULL",
)
def parse_yyyymmdd(spark: SparkSession, sf: str) -> DataFrame:
    days = b.dirty(spark, sf).withColumn("obs_date", cleaning.parse_day(F.col("date_text")))
    return clean.drop_missing(days, ["obs_date"]).select("order_key", F.col("obs_date").cast("string"))


@query(
    "date_parts",
    f"SELECT order_key, year({_DAY})::INT AS year, month({_DAY})::INT AS month FROM dirty WHERE {_DAY} IS NOT NULL",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_day(b.dirty(spark, sf), "date_text").select("order_key", "year", "month")


@query(
    "drop_null_required",
    "SELECT order_key, value, temp FROM numbers WHERE value IS NOT NULL AND temp IS NOT NULL",
)
def drop_null_required(spark: SparkSession, sf: str) -> DataFrame:
    typed = clean.coerce(
        b.dirty(spark, sf).select("order_key", F.col("value_text").alias("value"), "temp"), ["value"]
    )
    return clean.drop_missing(typed, ["value", "temp"])


@query("sentinel_drop_rows", "SELECT order_key, temp, precip FROM dirty WHERE temp > -900 AND precip >= 0")
def sentinel_drop_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.dirty(spark, sf).select("order_key", "temp", "precip")
    return clean.drop_sentinel_rows(rows, "temp", "precip")


@query(
    "sentinel_to_null",
    """SELECT order_key, CASE WHEN temp >= -900 THEN temp END AS temp,
              CASE WHEN precip >= -900 THEN precip END AS precip FROM dirty""",
)
def sentinel_to_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.dirty(spark, sf).select("order_key", "temp", "precip")
    return clean.null_sentinels(rows, ["temp", "precip"])


@query(
    "validate_quarantine",
    """SELECT order_key, trim(year_text) AS year_text, trim(code_text) AS code_text,
              CASE WHEN regexp_full_match(trim(year_text), '[0-9]{4}')
                    AND regexp_full_match(trim(code_text), '[A-Za-z]{3}') THEN 'valid' ELSE 'rejected' END AS status
       FROM dirty""",
)
def validate_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.dirty(spark, sf).select("order_key", "year_text", "code_text")
    flagged = clean.with_validity(rows, "year_text", "code_text")
    status = F.when(F.col("is_valid"), "valid").otherwise("rejected")
    return flagged.withColumn("status", status).drop("is_valid")


@query(
    "filter_predicates",
    """SELECT country, year, indicator, value FROM indicators
       WHERE indicator IN ('ind_1_urgent', 'ind_5_low') AND country != 'NATION_3' AND year = 1997""",
)
def filter_predicates(spark: SparkSession, sf: str) -> DataFrame:
    # On the rows behind the estimates, so that the filters reach the scans.
    rows = b.indicator_rows(spark, sf).filter(
        F.col("indicator").isin("ind_1_urgent", "ind_5_low")
        & (F.col("country") != "NATION_3")
        & (F.col("year") == 1997)
    )
    return rows.groupBy("country", "year", "indicator").agg(F.sum("value").alias("value"))


@query(
    "filter_case_insensitive",
    "SELECT city, year, month, temp_mean FROM monthly WHERE lower(city) = 'nation_8'",
)
def filter_case_insensitive(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.monthly(spark, sf).filter(F.lower("city") == "Nation_8".lower())
    return rows.select("city", "year", "month", "temp_mean")


@query(
    "filter_text_contains",
    """WITH tagged AS (SELECT *, model || CASE WHEN year < 2000 THEN ' (train)' ELSE '' END AS tag FROM predictions)
       SELECT city, year, month, tag, actual, contains(tag, 'train') AS is_train FROM tagged""",
)
def filter_text_contains(spark: SparkSession, sf: str) -> DataFrame:
    suffix = F.when(F.col("year") < 2000, " (train)").otherwise("")
    tagged = b.predictions(spark, sf).withColumn("tag", F.concat("model", suffix))
    return tagged.select(
        "city", "year", "month", "tag", "actual", clean.contains_tag("tag", "train").alias("is_train")
    )


@query(
    "project_rename",
    "SELECT country, year, value AS incidence FROM indicators WHERE indicator = 'ind_1_urgent'",
)
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.indicators(spark, sf).filter(F.col("indicator") == "ind_1_urgent")
    return clean.rename_present(rows, {"value": "incidence", "not_there": "ignored"}).select(
        "country", "year", "incidence"
    )


_TITLES = {i: i.split("_", 2)[2].replace("_", " ").title() + " Cases (Total)" for i in b.INDICATORS}
_NORMAL = {i: t.lower().replace(" ", "_").replace("(", "").replace(")", "") for i, t in _TITLES.items()}


@query(
    "normalize_column_names",
    "SELECT country, year, "
    + ", ".join(f"sum(value) FILTER (WHERE indicator = '{i}') AS {n}" for i, n in _NORMAL.items())
    + " FROM indicators GROUP BY country, year",
)
def normalize_column_names(spark: SparkSession, sf: str) -> DataFrame:
    named = b.indicator_rows(spark, sf).withColumn("indicator", derive.recode(F.col("indicator"), _TITLES))
    names = b.names_in(named, "indicator")
    wide = named.groupBy("country", "year").pivot("indicator", names).agg(F.sum("value"))
    return clean.normalize_names(wide)


@query(
    "column_fallback",
    "SELECT city, year, month, precip_total AS incidence, temp_mean AS warmth FROM monthly",
)
def column_fallback(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf)
    target = clean.first_present(panel, ["incidence", "precip_total"])
    by_part = clean.first_present(panel, ["temperature"], parts=["temp", "mean"])
    return panel.select("city", "year", "month", F.col(target).alias("incidence"), F.col(by_part).alias("warmth"))


@query(
    "select_numeric_columns",
    """SELECT temp_mean, temp_min, temp_max, temp_range, precip_days, precip_max_day, humidity_mean, wind_mean,
              solar_mean, n_obs FROM monthly""",
)
def select_numeric_columns(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf)
    return panel.select(*clean.numeric_columns(panel, exclude=["year", "month", "precip_total"]))


@query(
    "round_across",
    """SELECT city, year, month, round(sqrt(temp_mean), 3) AS temp_mean, round(sqrt(humidity_mean), 3) AS humidity_mean,
              round(precip_total, -1) AS precip_total FROM monthly""",
)
def round_across(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf).select(
        "city",
        "year",
        "month",
        F.sqrt("temp_mean").alias("temp_mean"),
        F.sqrt("humidity_mean").alias("humidity_mean"),
        "precip_total",
    )
    rounded = clean.round_columns(panel, 3, ["temp_mean", "humidity_mean"])
    return clean.round_columns(rounded, -1, ["precip_total"])


@query(
    "interaction_terms",
    """SELECT city, year, month, precip_total * temp_mean AS precip_x_temp, humidity_mean * temp_mean AS humidity_x_temp
       FROM monthly""",
)
def interaction_terms(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf).select(
        "city",
        "year",
        "month",
        (F.col("precip_total") * F.col("temp_mean")).alias("precip_x_temp"),
        (F.col("humidity_mean") * F.col("temp_mean")).alias("humidity_x_temp"),
    )


@query(
    "cyclic_month",
    """SELECT city, year, month, round(sin(2 * pi() * month / 12), 10) + 0.0 AS month_sin,
              round(cos(2 * pi() * month / 12), 10) + 0.0 AS month_cos FROM monthly""",
)
def cyclic_month(spark: SparkSession, sf: str) -> DataFrame:
    sine, cosine = derive.month_angle(F.col("month"))
    # + 0.0 turns a negative zero into zero.
    return b.monthly(spark, sf).select(
        "city",
        "year",
        "month",
        (F.round(sine, SIN_DIGITS) + F.lit(0.0)).alias("month_sin"),
        (F.round(cosine, SIN_DIGITS) + F.lit(0.0)).alias("month_cos"),
    )


@query(
    "season_flag",
    "SELECT city, year, month, (month IN (3, 4, 5, 10, 11, 12))::INT AS is_wet_season FROM monthly",
)
def season_flag(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf).select(
        "city", "year", "month", derive.in_season(F.col("month")).alias("is_wet_season")
    )


@query(
    "min_max_normalize",
    """SELECT city, year, month, (year - (SELECT min(year) FROM monthly))::DOUBLE
              / ((SELECT max(year) FROM monthly) - (SELECT min(year) FROM monthly)) AS year_normalized FROM monthly""",
)
def min_max_normalize(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf).select("city", "year", "month")
    return stats.min_max(panel, "year", "year_normalized")


@query(
    "clip_bounds",
    """SELECT city, year, month, greatest(least(temp_mean, 27), 24) AS temp_clipped,
              greatest(precip_total, 1000) AS precip_floor FROM monthly""",
)
def clip_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf).select(
        "city",
        "year",
        "month",
        derive.clip(F.col("temp_mean"), 24.0, 27.0).alias("temp_clipped"),
        derive.clip(F.col("precip_total"), lower=1000.0).alias("precip_floor"),
    )


@query(
    "pair_band",
    """WITH p AS (SELECT city, year, month, model, actual, CASE WHEN month % 5 = 0 THEN NULL ELSE predicted END AS predicted
                  FROM predictions)
       SELECT city, year, month, model, CASE WHEN predicted IS NOT NULL THEN least(actual, predicted) END AS band_low,
              CASE WHEN predicted IS NOT NULL THEN greatest(actual, predicted) END AS band_high FROM p""",
)
def pair_band(spark: SparkSession, sf: str) -> DataFrame:
    predicted = F.when(F.col("month") % 5 != 0, F.col("predicted"))
    low, high = derive.band_between(F.col("actual"), predicted)
    return b.predictions(spark, sf).select(
        "city", "year", "month", "model", low.alias("band_low"), high.alias("band_high")
    )


_RISK = """CASE WHEN lag1 < 50 THEN 'LOW' WHEN lag1 < 80 THEN 'MODERATE' WHEN lag1 < 120 THEN 'HIGH' ELSE 'VERY HIGH' END"""


@query(
    "risk_band",
    f"""SELECT scenario_id, lag1, {_RISK} AS risk,
               CASE WHEN lag1 < 50 THEN '{derive.RISK_ADVICE["LOW"]}' WHEN lag1 < 80 THEN '{derive.RISK_ADVICE["MODERATE"]}'
                    WHEN lag1 < 120 THEN '{derive.RISK_ADVICE["HIGH"]}' ELSE 'Activate all resources.' END AS advice
        FROM scenarios""",
)
def risk_band(spark: SparkSession, sf: str) -> DataFrame:
    band = derive.risk_band(F.col("lag1"))
    return b.scenarios(spark, sf).select(
        "scenario_id",
        "lag1",
        band.alias("risk"),
        derive.risk_advice(band, "Activate all resources.").alias("advice"),
    )


@query(
    "residual_band",
    """SELECT city, year, month, model, CASE WHEN actual - predicted <= -2000 THEN 'over'
              WHEN actual - predicted <= 2000 THEN 'close' ELSE 'under' END AS band FROM predictions""",
)
def residual_band(spark: SparkSession, sf: str) -> DataFrame:
    residual = F.col("actual") - F.col("predicted")
    return b.predictions(spark, sf).select(
        "city", "year", "month", "model", derive.residual_band(residual, 2000.0).alias("band")
    )


@query(
    "anomaly_sign",
    """SELECT city, year, month, CASE WHEN precip_total - lag(precip_total) OVER w < 0 THEN 'negative'
              WHEN precip_total - lag(precip_total) OVER w >= 0 THEN 'non_negative' END AS sign
       FROM monthly WINDOW w AS (PARTITION BY city ORDER BY year, month)""",
)
def anomaly_sign(spark: SparkSession, sf: str) -> DataFrame:
    changes = window.with_change(b.monthly(spark, sf), "precip_total", ["city"], b.TIME)
    return changes.select("city", "year", "month", derive.anomaly_sign(F.col("change")).alias("sign"))


@query(
    "importance_band",
    """WITH shares AS (SELECT country, indicator, sum(value) / sum(sum(value)) OVER (PARTITION BY country) AS share
                       FROM indicators GROUP BY country, indicator)
       SELECT country, indicator, CASE WHEN share > 0.2 THEN 'strong' WHEN share > 0.02 THEN 'moderate' ELSE 'weak' END AS band
       FROM shares""",
)
def importance_band(spark: SparkSession, sf: str) -> DataFrame:
    totals = b.indicator_rows(spark, sf).groupBy("country", "indicator").agg(F.sum("value").alias("t"))
    whole = F.sum("t").over(window.by_time(["country"], ["indicator"]).rowsBetween(
        window.Window.unboundedPreceding, window.Window.unboundedFollowing))
    # Five indicators share a country's total evenly: halve the shares to meet all bands.
    return totals.withColumn("share", F.col("t") / whole / 2).select(
        "country", "indicator", derive.importance_band(F.col("share")).alias("band")
    )


@query(
    "label_recode",
    """SELECT DISTINCT indicator, CASE indicator WHEN 'ind_1_urgent' THEN 'Urgent cases' WHEN 'ind_2_high' THEN 'High burden'
              ELSE indicator END AS label FROM indicators""",
)
def label_recode(spark: SparkSession, sf: str) -> DataFrame:
    names = {"ind_1_urgent": "Urgent cases", "ind_2_high": "High burden"}
    seen = b.indicator_rows(spark, sf).select("indicator").distinct()
    return seen.select("indicator", derive.recode(F.col("indicator"), names).alias("label"))


@query(
    "month_name",
    """SELECT city, year, month, (['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'])[month] AS month_name
       FROM monthly""",
)
def month_name(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf).select(
        "city", "year", "month", derive.month_name(F.col("month")).alias("month_name")
    )


@query(
    "text_label",
    """SELECT city, year, month, 'City: ' || city || ', year: ' || year || ', rain: ' || precip_total::BIGINT || ' mm' AS label
       FROM monthly""",
)
def text_label(spark: SparkSession, sf: str) -> DataFrame:
    label = F.format_string(
        "City: %s, year: %d, rain: %d mm", "city", "year", F.col("precip_total").cast("bigint")
    )
    return b.monthly(spark, sf).select("city", "year", "month", label.alias("label"))


@query(
    "unit_scale",
    "SELECT country, year, indicator, value / 1000000 AS value_m, high_ci / 1000 AS high_k FROM indicators",
)
def unit_scale(spark: SparkSession, sf: str) -> DataFrame:
    return b.indicators(spark, sf).select(
        "country",
        "year",
        "indicator",
        (F.col("value") / 1_000_000).alias("value_m"),
        (F.col("high_ci") / 1000).alias("high_k"),
    )


@query(
    "focal_flag",
    """SELECT country, year, indicator, country = 'NATION_7' AS is_focal,
              CASE WHEN country = 'NATION_7' THEN 1.0 ELSE 0.5 END::DOUBLE AS weight FROM indicators""",
)
def focal_flag(spark: SparkSession, sf: str) -> DataFrame:
    return b.indicators(spark, sf).select(
        "country",
        "year",
        "indicator",
        (F.col("country") == "NATION_7").alias("is_focal"),
        derive.focal_weight(F.col("country"), "NATION_7").alias("weight"),
    )


@query("default_zero", "SELECT order_key, coalesce(value, 0) AS value FROM numbers")
def default_zero(spark: SparkSession, sf: str) -> DataFrame:
    value = cleaning.to_number(F.col("value_text"))
    return b.dirty(spark, sf).select("order_key", derive.or_zero(value).alias("value"))


@query(
    "split_tag",
    "SELECT city, year, month, CASE WHEN year < 2000 THEN 'train' ELSE 'test' END AS split FROM monthly",
)
def split_tag(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf).select(
        "city", "year", "month", derive.split_tag(F.col("year"), 2000).alias("split")
    )
