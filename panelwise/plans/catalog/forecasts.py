"""Disaggregation, extrapolation, intervals, scenarios, scaling, ensembles and the feature chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions import derive
from panelwise.operators import ensemble, forecast, models, stats
from panelwise.plans import bindings as b, features
from panelwise.plans.catalog.joins import _SHARES, incidence
from panelwise.plans.catalog.registry import query
from panelwise.session import landed


@query(
    "seasonal_disaggregate",
    f"""SELECT country, year, t.month, value * t.share AS monthly, value AS annual
        FROM (SELECT country, year, CASE WHEN year % 2 = 0 THEN value ELSE -value END AS value FROM indicators WHERE indicator = 'ind_1_urgent'),
             (VALUES {_SHARES}) AS t(month, share) WHERE value > 0""",
)
def seasonal_disaggregate(spark: SparkSession, sf: str) -> DataFrame:
    # Odd years get a negative value: they are not spread.
    value = F.when(F.col("year") % 2 == 0, F.col("incidence")).otherwise(-F.col("incidence"))
    totals = incidence(spark, sf).select(F.col("city").alias("country"), "year", value.alias("value"))
    return forecast.seasonal_disaggregate(totals, "value", ["country", "year"])


def forecast_base(spark: SparkSession, sf: str) -> DataFrame:
    """Annual features with a city that has none and one that has two values."""
    temp = F.when(
        (F.col("city") != "NATION_1") & ((F.col("city") != "NATION_2") | (F.col("year") < 1997)), F.col("temp_mean")
    )
    return b.annual(spark, sf).select("city", "year", temp.alias("temp_mean"), "precip_total", "wind_mean")


@query(
    "forecast_trend",
    """WITH l AS (SELECT city, year, feature, y FROM (
             SELECT city, year, CASE WHEN city != 'NATION_1' AND (city != 'NATION_2' OR year < 1997) THEN temp_mean END AS temp_mean,
                    precip_total, wind_mean FROM annual)
           UNPIVOT INCLUDE NULLS (y FOR feature IN (temp_mean, precip_total, wind_mean))),
            k AS (SELECT *, (row_number() OVER (PARTITION BY city, feature ORDER BY year) - 1)::DOUBLE AS i FROM l WHERE y IS NOT NULL),
            f AS (SELECT city, feature, count(*) AS n, regr_slope(y, i) AS s, regr_intercept(y, i) AS a, arg_max(y, i) AS last
                  FROM k GROUP BY ALL),
            e AS (SELECT city, feature, max(year) AS last_year FROM l GROUP BY ALL)
       SELECT city, feature, (e.last_year + h.h)::INT AS year,
              round(CASE WHEN n >= 3 THEN a + s * (n + h.h) WHEN n >= 1 THEN last ELSE 0 END, 5) AS value
       FROM e LEFT JOIN f USING (city, feature), (SELECT unnest(range(1, 6)) AS h) h""",
)
def forecast_trend(spark: SparkSession, sf: str) -> DataFrame:
    out = forecast.forecast_trend(
        forecast_base(spark, sf), ["temp_mean", "precip_total", "wind_mean"], ["city"], ["year"]
    )
    return out.select("city", "feature", "year", F.round("value", 5).alias("value"))


@query(
    "forecast_interval",
    """WITH p AS (SELECT city, year, month, (precip_total - 12000) / 7 AS p FROM monthly)
       SELECT city, year, month, round(p, 2) AS predicted, round(greatest(p - abs(p) * 0.15::DOUBLE * 1.96::DOUBLE, 0), 2) AS lower_bound,
              round(p + abs(p) * 0.15::DOUBLE * 1.96::DOUBLE, 2) AS upper_bound, '95%' AS confidence FROM p""",
)
def forecast_interval(spark: SparkSession, sf: str) -> DataFrame:
    predicted = ((F.col("precip_total") - 12000) / 7).alias("predicted")
    return forecast.with_forecast_bounds(b.monthly(spark, sf).select("city", "year", "month", predicted))


@query(
    "prediction_interval",
    """WITH p AS (SELECT city, year, month, CASE WHEN month != 7 OR model = 'lag12' THEN predicted END AS predicted FROM predictions),
            s AS (SELECT city, year, month, avg(predicted) AS m, stddev_pop(predicted) AS d, count(predicted) AS n FROM p GROUP BY ALL),
            w AS (SELECT *, CASE WHEN n > 1 THEN d * 1.959964 ELSE abs(m) * 0.1::DOUBLE * 1.96::DOUBLE END AS width FROM s)
       SELECT city, year, month, round(m, 4) AS predicted, round(m - width, 4) AS lower, round(m + width, 4) AS upper,
              n AS n_estimators FROM w""",
)
def prediction_interval(spark: SparkSession, sf: str) -> DataFrame:
    some = F.when(F.expr("month != 7 OR model = 'lag12'"), F.col("predicted"))
    estimates = b.predictions(spark, sf).withColumn("predicted", some)
    out = forecast.prediction_interval(estimates, ["city", "year", "month"])
    return out.withColumns({c: F.round(c, 4) for c in ("predicted", "lower", "upper")})


@query(
    "scenario_features",
    """SELECT scenario_id, lag1, lag2, change, precip, temp, humidity, urban, population, health, precip / 10 AS precip_days,
              0.0::DOUBLE AS precip_anomaly, temp + 8 AS temp_max, 0.0::DOUBLE AS temp_anomaly, 3.0::DOUBLE AS wind_mean,
              18.0::DOUBLE AS solar_mean, precip * 0.95::DOUBLE AS precip_lag1, precip * 1.05::DOUBLE AS precip_lag2,
              temp - 0.2::DOUBLE AS temp_lag1, temp + 0.1::DOUBLE AS temp_lag2, precip * 0.6::DOUBLE AS farm_precip
       FROM scenarios""",
)
def scenario_features(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.scenario_features(b.scenarios(spark, sf))


@query(
    "scenario_score",
    """WITH s AS (SELECT scenario_id, least(greatest(lag1 * 0.45::DOUBLE + precip / 100 * 2.5::DOUBLE + (temp - 21) * 5
              + (humidity - 70) * 0.3::DOUBLE - urban / 10 * 0.5::DOUBLE, 10), 300) AS score FROM scenarios)
       SELECT scenario_id, round(score, 4) AS score, CASE WHEN score < 50 THEN 'LOW' WHEN score < 80 THEN 'MODERATE'
              WHEN score < 120 THEN 'HIGH' ELSE 'VERY HIGH' END AS risk FROM s""",
)
def scenario_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = forecast.scenario_score(b.scenarios(spark, sf), digits=4)
    return scored.select("scenario_id", "score", "risk")


@query(
    "time_split",
    """SELECT city, year, month, CASE WHEN year < (SELECT min(year) FROM (SELECT DISTINCT year FROM monthly ORDER BY year DESC LIMIT 2))
              THEN 'train' ELSE 'test' END AS split FROM monthly""",
)
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    panel = landed(b.monthly(spark, sf).select("city", "year", "month"), "panel")
    first_test = models.first_test_period(panel, "year", 2)
    return panel.withColumn("split", derive.split_tag(F.col("year"), first_test))


@query(
    "standard_scale",
    """SELECT city, year, month, round((temp_mean - avg(temp_mean) OVER ()) / stddev_pop(temp_mean) OVER (), 6) AS temp_mean_scaled,
              round((precip_total - avg(precip_total) OVER ()) / stddev_pop(precip_total) OVER (), 6) AS precip_total_scaled
       FROM monthly""",
)
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["temp_mean", "precip_total"]
    panel = b.monthly(spark, sf).select("city", "year", "month", *columns)
    panel = landed(panel, "panel")
    scaled = stats.scale(panel, stats.standard_parameters(panel, columns))
    return scaled.select("city", "year", "month", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in columns])


@query(
    "robust_scale",
    """WITH q AS (SELECT quantile_cont(temp, 0.25) AS t1, quantile_cont(temp, 0.5) AS t2, quantile_cont(temp, 0.75) AS t3,
                         quantile_cont(precip, 0.25) AS p1, quantile_cont(precip, 0.5) AS p2, quantile_cont(precip, 0.75) AS p3 FROM readings)
       SELECT city, year, month, (max(temp) - any_value(t2)) / (any_value(t3) - any_value(t1)) AS temp_scaled,
              (max(precip) - any_value(p2)) / (any_value(p3) - any_value(p1)) AS precip_scaled FROM readings, q GROUP BY city, year, month""",
)
def robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["temp", "precip"]
    rows = b.readings(spark, sf).select("city", "year", "month", *columns)
    scaled = stats.scale(rows, stats.robust_parameters(rows, columns))
    return scaled.groupBy("city", "year", "month").agg(*[F.max(f"{c}_scaled").alias(f"{c}_scaled") for c in columns])


@query(
    "ensemble_weighted",
    """WITH w AS (SELECT model, 1 / (mae + 1e-6) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM metrics)
       SELECT city, year, month, max(actual) AS actual, round(sum(weight * predicted), 4) AS predicted
       FROM predictions JOIN w USING (model) GROUP BY city, year, month""",
)
def ensemble_weighted(spark: SparkSession, sf: str) -> DataFrame:
    out = ensemble.weighted_ensemble(b.predictions(spark, sf), ["city", "year", "month"])
    return out.withColumn("predicted", F.round("predicted", 4))


_WY = "WINDOW w AS (PARTITION BY city ORDER BY year), w5 AS (PARTITION BY city ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


_OTHERS = ("incidence_low", "incidence_high", *b.INDICATORS[1:])
_PIVOT_SQL = f"""max(value) FILTER (indicator = '{b.INDICATORS[0]}') AS incidence, max(low_ci) FILTER (indicator = '{b.INDICATORS[0]}') AS incidence_low,
    max(high_ci) FILTER (indicator = '{b.INDICATORS[0]}') AS incidence_high, """ + ", ".join(f"max(value) FILTER (indicator = '{i}') AS {i}" for i in b.INDICATORS[1:])


def _wide_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """One row per city and year: all indicators, the first with its bounds."""
    name, value = F.col("indicator"), F.col("value")
    return b.indicator_rows(spark, sf).groupBy(F.col("country").alias("city"), "year").agg(
        F.sum(F.when(name == b.INDICATORS[0], value)).alias("incidence"),
        F.min(F.when(name == b.INDICATORS[0], value)).alias("incidence_low"),
        F.max(F.when(name == b.INDICATORS[0], value)).alias("incidence_high"),
        *[F.sum(F.when(name == i, value)).alias(i) for i in b.INDICATORS[1:]],
    )


@query(
    "flagship_features",
    f"""WITH t AS (SELECT country AS city, year, {_PIVOT_SQL} FROM indicators GROUP BY ALL),
             m AS (SELECT city, year, incidence, {', '.join(_OTHERS)}, temp_mean, temp_max, precip_total, precip_days, humidity_mean, wind_mean, solar_mean, n_cities
                   FROM t FULL OUTER JOIN annual USING (city, year)),
             f AS (SELECT *, last_value(incidence IGNORE NULLS) OVER w AS v FROM m {_WY})
        SELECT city, year, incidence, {', '.join(_OTHERS)}, temp_mean, temp_max, precip_total, precip_days, humidity_mean, wind_mean, solar_mean, n_cities,
               lag(incidence, 1) OVER w AS incidence_lag1, lag(incidence, 2) OVER w AS incidence_lag2,
               incidence - lag(incidence) OVER w AS incidence_change,
               round((v - lag(v) OVER w) / nullif(lag(v) OVER w, 0) * 100, 8) AS incidence_change_pct,
               lag(precip_total, 1) OVER w AS precip_total_lag1, lag(precip_total, 2) OVER w AS precip_total_lag2,
               lag(temp_mean, 1) OVER w AS temp_mean_lag1, lag(temp_mean, 2) OVER w AS temp_mean_lag2,
               lag(humidity_mean, 1) OVER w AS humidity_mean_lag1, lag(humidity_mean, 2) OVER w AS humidity_mean_lag2,
               precip_total - avg(precip_total) OVER w5 AS precip_anomaly,
               round(temp_mean - avg(temp_mean) OVER w5, 8) AS temp_anomaly FROM f {_WY}""",
)
def flagship_features(spark: SparkSession, sf: str) -> DataFrame:
    """All indicators by year, the first with its bounds, beside the climate, with lags, changes and anomalies."""
    wide = _wide_indicators(spark, sf)
    out = features.annual_features(wide, b.annual(spark, sf), ["city"])
    return out.withColumns({c: F.round(c, 8) for c in ("incidence_change_pct", "temp_anomaly")})


_MEASURES = ("precip_total", "temp_mean", "humidity_mean")
_WM = "WINDOW w AS (PARTITION BY city ORDER BY year, month), " + ", ".join(
    f"w{n} AS (PARTITION BY city ORDER BY year, month ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 6, 12)
)
# Sums of floats in a window's order are compared to four digits, copies and products as they are.
_EXACT = ("_lag", "_x_", "is_wet")
_SPREAD = {
    **{f"annual_lag{n}": f"lag(annual, {n}) OVER w" for n in (12, 24, 36)},
    **{f"monthly_lag{n}": f"lag(monthly, {n}) OVER w" for n in (1, 3, 6, 12, 24, 36)},
    **{f"{c}_lag{n}": f"lag({c}, {n}) OVER w" for c in _MEASURES for n in (1, 2, 3, 6, 12)},
    **{f"{c}_roll{n}": f"avg({c}) OVER w{n}" for c in _MEASURES for n in (3, 6, 12)},
    **{f"{c}_std{n}": f"stddev_samp({c}) OVER w{n}" for c in _MEASURES for n in (3, 6)},
    "precip_anomaly": "precip_total - avg(precip_total) OVER w12",
    "temp_anomaly": "temp_mean - avg(temp_mean) OVER w12",
    "precip_anomaly_pct": "(precip_total / greatest(avg(precip_total) OVER w12, 1) - 1) * 100",
    "month_sin": "sin(2 * pi() * month / 12)",
    "month_cos": "cos(2 * pi() * month / 12)",
    "is_wet_season": "CASE WHEN month IN (3, 4, 5, 10, 11, 12) THEN 1 ELSE 0 END",
    "precip_x_temp": "precip_total * temp_mean",
    "humidity_x_temp": "humidity_mean * temp_mean",
}


@query(
    "spread_features",
    f"""WITH t AS (SELECT country AS city, year, {_PIVOT_SQL} FROM indicators GROUP BY ALL),
             m AS (SELECT city, year, s.month, incidence * s.share AS monthly, incidence AS annual, precip_total, temp_mean, humidity_mean, n_obs,
                          incidence_low, incidence_high, {", ".join(b.INDICATORS[1:])}
                   FROM t CROSS JOIN (VALUES {_SHARES}) AS s(month, share)
                   LEFT JOIN (SELECT city, year, month, precip_total, temp_mean, humidity_mean, n_obs FROM monthly) c USING (city, year, month)
                   WHERE incidence > 0)
        SELECT city, year, month, annual, n_obs, incidence_low, incidence_high, {", ".join(b.INDICATORS[1:])},
               round(monthly, 4) AS monthly, (year - min(year) OVER ()) / (max(year) OVER () - min(year) OVER ())::DOUBLE AS year_normalized,
               {", ".join(f"{sql} AS {name}" if any(x in name for x in _EXACT) else f"round({sql}, 4) AS {name}" for name, sql in _SPREAD.items())} FROM m {_WM}""",
)
def spread_features(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly training table: the first indicator spread over months, climate, the others' years, all features."""
    wide = landed(_wide_indicators(spark, sf), "indicators")
    climate = b.monthly(spark, sf).select("city", "year", "month", *_MEASURES, "n_obs")
    out = features.spread_features(wide, climate, ["city"], ["city"], annual_tables=[wide.drop("incidence")])
    rounded = out.withColumns({c: F.round(c, 4) for c in ("monthly", *_SPREAD) if not any(x in c for x in _EXACT)})
    return rounded.drop(*_MEASURES)
