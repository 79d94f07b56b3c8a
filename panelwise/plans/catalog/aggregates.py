"""Aggregations, pivots, summaries and fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions import cleaning
from panelwise.operators import aggregate, clean, join, shape, stats
from panelwise.plans import bindings as b
from panelwise.plans.catalog.registry import query
from panelwise.session import landed

WET = 500.0


@query("agg_monthly", "SELECT * FROM monthly")
def agg_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return b.monthly(spark, sf)


@query(
    "agg_annual_sum",
    """SELECT year, avg(temp) AS temp_mean, max(temp) AS temp_max, sum(precip) AS precip_total,
              count(*) FILTER (WHERE precip > 500) AS precip_days, avg(humidity) AS humidity_mean,
              avg(wind) AS wind_mean, avg(solar) AS solar_mean, count(DISTINCT city) AS n_cities
       FROM readings GROUP BY year""",
)
def agg_annual_sum(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.annual_pooled(b.readings(spark, sf), wet_day=WET)


@query(
    "agg_annual_per_entity",
    """SELECT region, year, avg(temp) AS temp_mean, max(temp) AS temp_max, sum(precip) / count(DISTINCT city) AS precip_total,
              (count(*) FILTER (WHERE precip > 0.1)) / count(DISTINCT city) AS precip_days, avg(humidity) AS humidity_mean,
              avg(wind) AS wind_mean, avg(solar) AS solar_mean, count(DISTINCT city) AS n_cities
       FROM readings GROUP BY region, year""",
)
def agg_annual_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.annual_per_entity(b.readings(spark, sf), keys=["region"])


@query(
    "agg_conditional_count",
    """SELECT city, year, count(*) FILTER (WHERE precip > 0.1) AS wet_days, count(*) FILTER (WHERE precip > 500) AS very_wet_days
       FROM readings GROUP BY city, year""",
)
def agg_conditional_count(spark: SparkSession, sf: str) -> DataFrame:
    return b.readings(spark, sf).groupBy("city", "year").agg(
        aggregate.count_above("precip", aggregate.WET_DAY).alias("wet_days"),
        aggregate.count_above("precip", WET).alias("very_wet_days"),
    )


@query(
    "agg_count_distinct",
    """SELECT count(DISTINCT city) AS n_city, count(DISTINCT region) AS n_region, count(DISTINCT obs_date) AS n_obs_date
       FROM readings""",
)
def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.distinct_counts(b.readings(spark, sf), ["city", "region", "obs_date"])


@query(
    "agg_mean_all_numeric",
    "SELECT year, avg(value) AS value, avg(low_ci) AS low_ci, avg(high_ci) AS high_ci FROM indicators GROUP BY year",
)
def agg_mean_all_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.mean_of_numeric(b.indicators(spark, sf), ["year"])


@query(
    "distinct_sorted",
    """SELECT region, city, (SELECT min(year) FROM readings) AS first_year, (SELECT max(year) FROM readings) AS last_year
       FROM (SELECT DISTINCT region, city FROM readings) ORDER BY region, city""",
)
def distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    spans = b.readings(spark, sf).groupBy("region", "city").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    spans = landed(spans, "spans")  # a row for each place, for the places and for the ends of all
    ends = spans.select(F.min("first").alias("first_year"), F.max("last").alias("last_year"))
    places = aggregate.distinct_sorted(spans, ["region", "city"])
    return places.withColumns({c: ends.select(c).scalar() for c in ends.columns})


def gappy_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Raw indicator rows where every fourth value is missing."""
    value = F.when(F.col("ordinal") % 4 != 0, F.col("value"))
    return b.indicator_rows(spark, sf).withColumn("value", value)


_GAPPY = "(SELECT country, year, indicator, ordinal, CASE WHEN ordinal % 4 != 0 THEN value END AS value FROM indicator_rows)"


@query(
    "pivot_first",
    "SELECT country, year, "
    + ", ".join(
        f"arg_min(value, ordinal) FILTER (WHERE indicator = '{i}') AS {i}" for i in b.INDICATORS
    )
    + f" FROM {_GAPPY} WHERE value IS NOT NULL GROUP BY country, year",
)
def pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = gappy_rows(spark, sf)
    names = b.names_in(rows, "indicator")
    return shape.pivot_first(rows, ["country", "year"], "indicator", names, "value", "ordinal")


@query(
    "pivot_last",
    "SELECT country, year, "
    + ", ".join(
        f"(arg_max({{'v': value}}, ordinal) FILTER (WHERE indicator = '{i}')).v AS {i}" for i in b.INDICATORS
    )
    + f" FROM {_GAPPY} GROUP BY country, year",
)
def pivot_last(spark: SparkSession, sf: str) -> DataFrame:
    rows = gappy_rows(spark, sf)
    names = b.names_in(rows, "indicator")
    return shape.pivot_last(rows, ["country", "year"], "indicator", names, "value", "ordinal")


@query(
    "pivot_multi_value",
    "SELECT country, year, "
    + ", ".join(
        f"max({v}) FILTER (WHERE indicator = '{i}') AS {i}_{v}"
        for i in b.INDICATORS
        for v in ("value", "low_ci", "high_ci")
    )
    + " FROM indicators GROUP BY country, year",
)
def pivot_multi_value(spark: SparkSession, sf: str) -> DataFrame:
    names = b.names_in(b.indicator_rows(spark, sf), "indicator")
    values = ["value", "low_ci", "high_ci"]
    return shape.pivot_bounds(b.indicators(spark, sf), ["country", "year"], "indicator", names, values, "year")


#: The columns of the SQL twin; the query takes the years from its rows.
YEARS = range(1995, 2002)


@query(
    "pivot_mean_matrix",
    "SELECT month, "
    + ", ".join(f"avg(temp_mean) FILTER (WHERE year = {y}) AS y{y}" for y in YEARS)
    + " FROM monthly WHERE city = 'NATION_8' GROUP BY month",
)
def pivot_mean_matrix(spark: SparkSession, sf: str) -> DataFrame:
    one_city = b.monthly(spark, sf).filter("city = 'NATION_8'")
    years = b.names_in(b.readings(spark, sf).filter("city = 'NATION_8'"), "year")
    return shape.pivot_mean(one_city, ["month"], "year", years, "temp_mean", prefix="y")


_RSQ = """SELECT model, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
                 corr(predicted, actual) * corr(predicted, actual) AS rsq, avg(abs(actual - predicted)) AS mae,
                 sqrt(avg((actual - predicted) * (actual - predicted))) / avg(actual) * 100 AS mape
          FROM predictions GROUP BY model"""


@query(
    "pivot_metrics",
    f"SELECT model, round(rmse, 4) AS rmse, round(rsq, 6) AS rsq, round(mae, 4) AS mae FROM ({_RSQ})",
)
def pivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = stats.regression_metrics_rsq(b.predictions(spark, sf))
    long = shape.unpivot(metrics, ["model"], ["rmse", "rsq", "mae", "mape"], "metric", "estimate")
    wide = stats.model_comparison(long)
    return wide.select(
        "model", F.round("rmse", 4).alias("rmse"), F.round("rsq", 6).alias("rsq"), F.round("mae", 4).alias("mae")
    )


@query(
    "unpivot",
    """SELECT city, year, month, var, val FROM (SELECT city, year, month, temp_mean,
              CASE WHEN month != 4 THEN precip_total END AS precip_total, humidity_mean FROM monthly)
       UNPIVOT INCLUDE NULLS (val FOR var IN (temp_mean, precip_total, humidity_mean))""",
)
def unpivot(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf).withColumn(
        "precip_total", F.when(F.col("month") != 4, F.col("precip_total"))
    )
    return shape.unpivot(panel, ["city", "year", "month"], ["temp_mean", "precip_total", "humidity_mean"])


@query(
    "missing_report",
    """SELECT * FROM (SELECT 'value' AS "column", count(*) FILTER (WHERE value IS NULL) AS n_missing FROM numbers
       UNION ALL SELECT 'temp', count(*) FILTER (WHERE temp IS NULL OR temp < -900) FROM numbers
       UNION ALL SELECT 'precip', count(*) FILTER (WHERE precip < -900) FROM numbers) WHERE n_missing > 0""",
)
def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    typed = b.dirty(spark, sf).withColumn("value", cleaning.to_number(F.col("value_text")))
    cleaned = clean.null_sentinels(typed, ["temp", "precip"])
    return aggregate.missing_report(cleaned, ["order_key", "value", "temp", "precip"])


@query(
    "numeric_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_missing, avg({c}) AS mean, min({c}) AS min,
                   quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3, max({c}) AS max
            FROM {t}"""
        for c, t in (("temp", "readings"), ("precip", "readings"), ("humidity", "readings"), ("wind", "readings"))
    ),
)
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return stats.numeric_summary(b.readings(spark, sf), ["temp", "precip", "humidity", "wind"])


@query(
    "climatology",
    """SELECT city, month, round(avg(temp_mean), 8) AS temp_mean, round(avg(precip_total), 5) AS precip_total,
              round(avg(humidity_mean), 8) AS humidity_mean FROM monthly GROUP BY city, month""",
)
def climatology(spark: SparkSession, sf: str) -> DataFrame:
    measures = {"temp_mean": 8, "precip_total": 5, "humidity_mean": 8}
    means = aggregate.climatology(b.monthly(spark, sf), list(measures))
    return means.withColumns({m: F.round(m, d) for m, d in measures.items()})


@query(
    "corr_pair",
    """SELECT city, round(corr(precip, temp), 8) AS r, CAST(NULL AS DOUBLE) AS r_constant FROM readings GROUP BY city""",
)
def corr_pair(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.readings(spark, sf).withColumn("constant", F.lit(1.0))
    return rows.groupBy("city").agg(
        F.round(stats.correlation("temp", "precip"), 8).alias("r"),
        stats.correlation("constant", "precip").alias("r_constant"),
    )


MEASURES = (
    "temp_mean",
    "temp_min",
    "temp_max",
    "temp_range",
    "precip_total",
    "precip_days",
    "precip_max_day",
    "humidity_mean",
    "wind_mean",
    "solar_mean",
    "n_obs",
)


def _any_correlated(j: int) -> str:
    tests = [f"coalesce(abs(corr({a}, {MEASURES[j]})) > 0.95, false)" for a in MEASURES[:j]]
    return " OR ".join(tests) or "bool_or(false)"


@query(
    "corr_prune",
    " UNION ALL ".join(
        f"SELECT '{m}' AS feature, ({_any_correlated(j)}) AS dropped FROM monthly" for j, m in enumerate(MEASURES)
    ),
)
def corr_prune(spark: SparkSession, sf: str) -> DataFrame:
    dropped = stats.correlated_columns(b.monthly(spark, sf), MEASURES)
    return spark.createDataFrame([(m, m in dropped) for m in MEASURES], "feature string, dropped boolean")


@query(
    "nonnull_share_select",
    """SELECT feature, kept FROM (
         SELECT 'value' AS feature, count(value) >= count(*) * 0.5 AS kept FROM numbers
         UNION ALL SELECT 'temp', count(temp) >= count(*) * 0.5 FROM numbers
         UNION ALL SELECT 'rare', count(CASE WHEN order_key % 3 = 0 THEN temp END) >= count(*) * 0.5 FROM numbers)""",
)
def nonnull_share_select(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["value", "temp", "rare"]
    rows = b.dirty(spark, sf).select(
        cleaning.to_number(F.col("value_text")).alias("value"),
        "temp",
        F.when(F.col("order_key") % 3 == 0, F.col("temp")).alias("rare"),
    )
    kept = stats.filled_columns(rows, columns)
    return spark.createDataFrame([(c, c in kept) for c in columns], "feature string, kept boolean")


@query(
    "median_impute",
    """SELECT order_key, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM numbers)) AS value,
              coalesce(CASE WHEN temp >= -900 THEN temp END,
                       (SELECT quantile_cont(CASE WHEN temp >= -900 THEN temp END, 0.5) FROM numbers)) AS temp
       FROM numbers""",
)
def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.dirty(spark, sf).select(
        "order_key",
        cleaning.to_number(F.col("value_text")).alias("value"),
        cleaning.null_if_sentinel(F.col("temp")).alias("temp"),
    )
    return stats.fill_medians(rows, ["value", "temp"])


@query(
    "ols_line",
    """WITH fits AS (SELECT city, regr_slope(precip_total, temp_mean) AS slope, regr_intercept(precip_total, temp_mean) AS intercept
                     FROM monthly GROUP BY city)
       SELECT city, year, month, precip_total, round(intercept + slope * temp_mean, 4) AS fitted FROM monthly JOIN fits USING (city)""",
)
def ols_line(spark: SparkSession, sf: str) -> DataFrame:
    panel = b.monthly(spark, sf).select("city", "year", "month", "temp_mean", "precip_total")
    fitted = stats.with_fitted_line(panel, "temp_mean", "precip_total", ["city"])
    return fitted.select("city", "year", "month", "precip_total", F.round("fitted", 4).alias("fitted"))


@query(
    "ols_line_se",
    """WITH f AS (SELECT city, regr_slope(precip_total, temp_mean) AS slope, regr_intercept(precip_total, temp_mean) AS intercept,
                         regr_count(precip_total, temp_mean) AS n, regr_avgx(precip_total, temp_mean) AS xm,
                         regr_sxx(precip_total, temp_mean) AS sxx, regr_syy(precip_total, temp_mean) AS syy,
                         regr_sxy(precip_total, temp_mean) AS sxy FROM monthly GROUP BY city),
            g AS (SELECT *, intercept + slope * 25 AS fitted,
                         sqrt((syy - sxy * sxy / sxx) / (n - 2)) * sqrt(1.0 / n + (25 - xm) * (25 - xm) / sxx) AS se FROM f)
       SELECT city, round(fitted, 3) AS fitted, round(se, 4) AS se, round(fitted - 1.99 * se, 3) AS lower,
              round(fitted + 1.99 * se, 3) AS upper FROM g""",
)
def ols_line_se(spark: SparkSession, sf: str) -> DataFrame:
    fit = stats.line_fit(b.monthly(spark, sf), "temp_mean", "precip_total", ["city"])
    band = stats.line_band(fit, F.lit(25.0), 1.99)
    return band.select(
        "city",
        F.round("fitted", 3).alias("fitted"),
        F.round("se", 4).alias("se"),
        F.round("lower", 3).alias("lower"),
        F.round("upper", 3).alias("upper"),
    )


@query(
    "quadratic_trend",
    """WITH m AS (SELECT city, (year * 12 + month)::DOUBLE AS x, precip_total AS v FROM monthly),
            u AS (SELECT city, x - avg(x) OVER (PARTITION BY city) AS u, avg(x) OVER (PARTITION BY city) AS xm, v FROM m),
            s AS (SELECT city, any_value(xm) AS xm, count(*)::DOUBLE AS n, sum(u*u) AS s2, sum(u*u*u) AS s3, sum(u*u*u*u) AS s4,
                         sum(v) AS t0, sum(u*v) AS t1, sum(u*u*v) AS t2 FROM u GROUP BY city),
            a AS (SELECT *, (t2 - s3 * t1 / s2 - s2 * t0 / n) / (s4 - s3 * s3 / s2 - s2 * s2 / n) AS qa FROM s)
       SELECT city, round(xm, 6) AS x_mean, round(qa, 6) AS a, round((t1 - qa * s3) / s2, 5) AS b,
              round((t0 - qa * s2) / n, 4) AS c FROM a""",
)
def quadratic_trend(spark: SparkSession, sf: str) -> DataFrame:
    series = b.monthly(spark, sf).select(
        "city", (F.col("year") * 12 + F.col("month")).cast("double").alias("x"), "precip_total"
    )
    fit = stats.quadratic_fit(series, "x", "precip_total", ["city"])
    digits = {"x_mean": 6, "a": 6, "b": 5, "c": 4}
    return fit.select("city", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "trend_grid",
    """WITH f AS (SELECT city, regr_slope(precip_total, temp_mean) AS slope, regr_intercept(precip_total, temp_mean) AS intercept,
                         min(temp_mean) AS a, max(temp_mean) AS b FROM monthly GROUP BY city),
            g AS (SELECT city, slope, intercept, s.step::INT AS step, a + (b - a) * s.step / 99 AS x
                  FROM f, (SELECT unnest(range(100)) AS step) s)
       SELECT city, step, round(x, 8) AS x, round(intercept + slope * x, 3) AS fitted FROM g""",
)
def trend_grid(spark: SparkSession, sf: str) -> DataFrame:
    fit = stats.line_fit(b.monthly(spark, sf), "temp_mean", "precip_total", ["city"])
    grid = stats.trend_grid(fit, 100)
    return grid.select("city", "step", F.round("x", 8).alias("x"), F.round("fitted", 3).alias("fitted"))


@query(
    "arg_extremes",
    """WITH m AS (SELECT city, year * 100 + month AS period, precip_total FROM monthly)
       SELECT city, max(precip_total) AS peak, (array_agg(period ORDER BY precip_total DESC, period))[1] AS peak_period,
              min(precip_total) AS low, (array_agg(period ORDER BY precip_total, period))[1] AS low_period FROM m GROUP BY city""",
)
def arg_extremes(spark: SparkSession, sf: str) -> DataFrame:
    series = b.monthly(spark, sf).withColumn("period", F.col("year") * 100 + F.col("month"))
    return aggregate.extremes(series, "precip_total", "period", ["city"])


@query(
    "first_last_change",
    """WITH m AS (SELECT city, year * 100 + month AS period, precip_total AS v FROM monthly WHERE month NOT IN (1, 11)),
            e AS (SELECT city, arg_min(v, period) AS first_value, arg_max(v, period) AS last_value FROM m GROUP BY city)
       SELECT city, first_value, last_value, (last_value - first_value) / first_value * 100 AS change_pct FROM e""",
)
def first_last_change(spark: SparkSession, sf: str) -> DataFrame:
    series = b.monthly(spark, sf).select(
        "city",
        (F.col("year") * 100 + F.col("month")).alias("period"),
        F.when(~F.col("month").isin(1, 11), F.col("precip_total")).alias("precip_total"),
    )
    return aggregate.first_last_change(series, "precip_total", "period", ["city"])


@query(
    "latest_kpis",
    """WITH m AS (SELECT city, year * 100 + month AS period, temp_mean, CASE WHEN month < 6 THEN precip_total END AS precip_total
                  FROM monthly),
            k AS (SELECT city, arg_max(temp_mean, period) AS temp_mean, arg_max(precip_total, period) AS precip_total,
                         arg_max({'v': precip_total}, period).v AS precip_last_row, arg_max(temp_mean, period) AS temp_last_row FROM m GROUP BY city)
       SELECT * FROM k""",
)
def latest_kpis(spark: SparkSession, sf: str) -> DataFrame:
    series = b.monthly(spark, sf).select(
        "city",
        (F.col("year") * 100 + F.col("month")).alias("period"),
        "temp_mean",
        F.when(F.col("month") < 6, F.col("precip_total")).alias("precip_total"),
    )
    known = aggregate.latest_known(series, ["temp_mean", "precip_total"], "period", ["city"])
    last = aggregate.last_row(series, ["temp_mean", "precip_total"], "period", ["city"])
    renamed = last.withColumnsRenamed({"temp_mean": "temp_last_row", "precip_total": "precip_last_row"})
    return join.attach(known, renamed, ["city"])


@query(
    "regression_metrics",
    """SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 6) AS r2, round(mape, 8) AS mape, n FROM metrics""",
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    digits = {"mae": 4, "rmse": 4, "r2": 6, "mape": 8}
    metrics = stats.regression_metrics(b.predictions(spark, sf))
    return metrics.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "regression_metrics_rsq",
    f"""SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(rsq, 6) AS rsq, round(mape, 6) AS mape FROM ({_RSQ})""",
)
def regression_metrics_rsq(spark: SparkSession, sf: str) -> DataFrame:
    digits = {"mae": 4, "rmse": 4, "rsq": 6, "mape": 6}
    metrics = stats.regression_metrics_rsq(b.predictions(spark, sf))
    return metrics.withColumns({c: F.round(c, d) for c, d in digits.items()})
