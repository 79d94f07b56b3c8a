"""Windows and rankings on the monthly panel, one window partition per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.operators import rank, stats, window
from panelwise.plans import bindings as b
from panelwise.plans.catalog.registry import query
from panelwise.session import landed

KEYS = ["city"]
TIME = b.TIME
ID = ["city", "year", "month"]

_W = "WINDOW w AS (PARTITION BY city ORDER BY year, month)"
_GAPPY = "(SELECT city, year, month, CASE WHEN (year * 12 + month) % 5 != 0 THEN precip_total END AS p FROM monthly)"


def panel(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return b.monthly(spark, sf).select(*ID, *columns)


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Rainfall with every fifth month missing, as ``p``."""
    known = (F.col("year") * 12 + F.col("month")) % 5 != 0
    return b.monthly(spark, sf).select(*ID, F.when(known, F.col("precip_total")).alias("p"))


@query(
    "lag_n",
    f"""SELECT city, year, month, lag(precip_total, 1) OVER w AS precip_total_lag1, lag(precip_total, 2) OVER w AS precip_total_lag2,
               lag(precip_total, 12) OVER w AS precip_total_lag12, lag(precip_total, 24) OVER w AS precip_total_lag24,
               lag(precip_total, 36) OVER w AS precip_total_lag36 FROM monthly {_W}""",
)
def lag_n(spark: SparkSession, sf: str) -> DataFrame:
    lagged = window.with_lags(panel(spark, sf, "precip_total"), {"precip_total": (1, 2, 12, 24, 36)}, KEYS, TIME)
    return lagged.drop("precip_total")


_LAGGED = ("precip_total", "temp_mean", "humidity_mean")


@query(
    "lag_multi",
    "SELECT city, year, month, "
    + ", ".join(f"lag({c}, {n}) OVER w AS {c}_lag{n}m" for c in _LAGGED for n in (1, 2, 3, 6, 12))
    + f" FROM monthly {_W}",
)
def lag_multi(spark: SparkSession, sf: str) -> DataFrame:
    lags = {c: (1, 2, 3, 6, 12) for c in _LAGGED}
    out = window.with_lags(panel(spark, sf, *_LAGGED), lags, KEYS, TIME, "{column}_lag{n}m")
    return out.drop(*_LAGGED)


@query(
    "lag_guarded",
    f"""SELECT city, year, month, CASE WHEN p IS NOT NULL THEN lag(p, 1) OVER w END AS p_lag1,
               lag(p, 2) OVER w AS p_lag2 FROM {_GAPPY} {_W}""",
)
def lag_guarded(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_guarded_lags(gappy(spark, sf), {"p": (1,)}, KEYS, TIME)
    return window.with_lags(out, {"p": (2,)}, KEYS, TIME).drop("p")


@query("diff_1", f"SELECT city, year, month, p - lag(p) OVER w AS change FROM {_GAPPY} {_W}")
def diff_1(spark: SparkSession, sf: str) -> DataFrame:
    return window.with_change(gappy(spark, sf), "p", KEYS, TIME).drop("p")


@query(
    "pct_change_ffill",
    f"""WITH f AS (SELECT city, year, month, last_value(p IGNORE NULLS) OVER w AS v FROM {_GAPPY} {_W})
        SELECT city, year, month, round((v - lag(v) OVER w) / nullif(lag(v) OVER w, 0) * 100, 8) AS change_pct FROM f {_W}""",
)
def pct_change_ffill(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_pct_change(gappy(spark, sf), "p", KEYS, TIME, fill_gaps=True)
    return out.select(*ID, F.round("change_pct", 8).alias("change_pct"))


@query(
    "pct_change_strict",
    f"""SELECT city, year, month, round((p - lag(p) OVER w) / nullif(lag(p) OVER w, 0) * 100, 8) AS change_pct FROM {_GAPPY} {_W}""",
)
def pct_change_strict(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_pct_change(gappy(spark, sf), "p", KEYS, TIME)
    return out.select(*ID, F.round("change_pct", 8).alias("change_pct"))


def _rows(n: int) -> str:
    return f"OVER (PARTITION BY city ORDER BY year, month ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query(
    "rolling_mean",
    "SELECT city, year, month, " + ", ".join(f"avg(p) {_rows(n)} AS p_roll{n}" for n in (3, 5, 6, 12)) + f" FROM {_GAPPY}",
)
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    return window.with_rolling(gappy(spark, sf), ["p"], KEYS, TIME, means=(3, 5, 6, 12)).drop("p")


@query(
    "rolling_std",
    "SELECT city, year, month, "
    + ", ".join(f"round(stddev_samp(p) {_rows(n)}, 5) AS p_std{n}" for n in (3, 6))
    + f" FROM {_GAPPY}",
)
def rolling_std(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_rolling(gappy(spark, sf), ["p"], KEYS, TIME, deviations=(3, 6))
    return out.select(*ID, *[F.round(c, 5).alias(c) for c in ("p_std3", "p_std6")])


@query(
    "rolling_mean_full",
    f"""SELECT city, year, month, CASE WHEN count(p) {_rows(3)} = 3 THEN avg(p) {_rows(3)} END AS p_roll3 FROM {_GAPPY}""",
)
def rolling_mean_full(spark: SparkSession, sf: str) -> DataFrame:
    return gappy(spark, sf).select(*ID, window.rolling_mean_full("p", 3, KEYS, TIME).alias("p_roll3"))


@query(
    "anomaly_trailing",
    f"""SELECT city, year, month, p - avg(p) {_rows(5)} AS anomaly5, p - avg(p) {_rows(12)} AS anomaly12 FROM {_GAPPY}""",
)
def anomaly_trailing(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_trailing_anomaly(gappy(spark, sf), "p", 5, KEYS, TIME, "anomaly5")
    return window.with_trailing_anomaly(out, "p", 12, KEYS, TIME, "anomaly12").drop("p")


@query(
    "anomaly_pct",
    f"""SELECT city, year, month, round((p / greatest(avg(p) {_rows(12)}, 1) - 1) * 100, 8) AS anomaly_pct
        FROM (SELECT city, year, month, CASE WHEN month = 3 THEN 0 ELSE p END AS p FROM {_GAPPY})""",
)
def anomaly_pct(spark: SparkSession, sf: str) -> DataFrame:
    dry_march = F.when(F.col("month") == 3, 0.0).otherwise(F.col("p"))
    series = gappy(spark, sf).withColumn("p", dry_march)
    out = window.with_anomaly_pct(series, "p", 12, KEYS, TIME, "anomaly_pct")
    return out.select(*ID, F.round("anomaly_pct", 8).alias("anomaly_pct"))


@query(
    "anomaly_global",
    f"""SELECT city, year, month, p - avg(p) OVER (PARTITION BY city) AS anomaly_city, p - (SELECT avg(p) FROM {_GAPPY}) AS anomaly_all
        FROM {_GAPPY}""",
)
def anomaly_global(spark: SparkSession, sf: str) -> DataFrame:
    out = window.with_global_anomaly(gappy(spark, sf), "p", "anomaly_all")
    return window.with_global_anomaly(out, "p", "anomaly_city", KEYS).select(*ID, "anomaly_city", "anomaly_all")


@query(
    "pct_from_first",
    f"""WITH g AS (SELECT * FROM {_GAPPY} WHERE p IS NOT NULL)
        SELECT city, year, month, (p - first_value(p) OVER w) / first_value(p) OVER w * 100 AS change_pct FROM g {_W}""",
)
def pct_from_first(spark: SparkSession, sf: str) -> DataFrame:
    known = gappy(spark, sf).dropna(subset=["p"])
    return window.with_pct_from_first(known, "p", KEYS, list(TIME)).drop("p")


# --- sorts, limits, top-k -----------------------------------------------------------------------


@query("sort_multi", "SELECT city, year, month, precip_total FROM monthly ORDER BY year, month, city")
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    return panel(spark, sf, "precip_total").orderBy("year", "month", "city")


@query(
    "latest_ranking",
    """WITH t AS (SELECT country, year, value FROM indicators WHERE indicator = 'ind_1_urgent')
       SELECT country, year, value, rank() OVER (ORDER BY value DESC) AS rank FROM t WHERE year = (SELECT max(year) FROM t)""",
)
def latest_ranking(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.indicator_rows(spark, sf).filter(F.col("indicator") == "ind_1_urgent")
    totals = rows.groupBy("country", "year").agg(F.sum("value").alias("value"))
    return rank.latest_ranking(totals, "year", "value", "country")


@query(
    "top_k",
    "SELECT city, year, month, precip_total FROM monthly ORDER BY precip_total DESC, city, year, month LIMIT 15",
)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    return rank.top_k(panel(spark, sf, "precip_total"), F.desc("precip_total"), 15, *ID)


@query(
    "limit_n",
    "SELECT city, year, month, temp_mean FROM monthly ORDER BY city, year, month LIMIT 10 OFFSET 20",
)
def limit_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed(panel(spark, sf, "temp_mean"), "pages")
    after = None
    for _ in range(2):
        after = rank.last_key(rank.page(rows, ID, 10, after), ID)
    return rank.page(rows, ID, 10, after)


@query(
    "best_model",
    """SELECT (SELECT model FROM metrics ORDER BY mae, model LIMIT 1) AS best_by_mae,
              (SELECT model FROM metrics ORDER BY rmse, model LIMIT 1) AS best_by_rmse,
              (SELECT model FROM metrics ORDER BY r2 DESC, model LIMIT 1) AS best_by_r2""",
)
def best_model(spark: SparkSession, sf: str) -> DataFrame:
    metrics = stats.regression_metrics(b.predictions(spark, sf))
    return rank.best_by(metrics, errors=["mae", "rmse"], scores=["r2"])


@query("leaderboard", "SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM metrics ORDER BY mae, model")
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    board = rank.leaderboard(stats.regression_metrics(b.predictions(spark, sf)))
    return board.select("model", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"))
