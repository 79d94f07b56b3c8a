"""Joins and set operations on annual and monthly panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.operators import forecast, join, shape, stats
from panelwise.plans import bindings as b
from panelwise.plans.catalog.registry import query
from panelwise.session import landed


def incidence(spark: SparkSession, sf: str, indicator: str = "ind_1_urgent", name: str = "incidence") -> DataFrame:
    """(city, year, name): one indicator's yearly total per country."""
    rows = b.indicator_rows(spark, sf).filter(F.col("indicator") == indicator)
    return rows.groupBy(F.col("country").alias("city"), "year").agg(F.sum("value").alias(name))


def moved(column: str, where: str):
    """Keys without a partner: some rows go a century ahead, none is left out."""
    return F.when(F.expr(where), F.col(column) + 100).otherwise(F.col(column))


def climate(spark: SparkSession, sf: str) -> DataFrame:
    return b.annual(spark, sf).select("city", "year", "precip_total", "temp_mean")


_INC = "(SELECT country AS city, year, value AS incidence FROM indicators WHERE indicator = 'ind_1_urgent')"


@query(
    "join_full_outer",
    f"""SELECT city, year, incidence, low_cases, precip_total, temp_mean
        FROM (SELECT city, CASE WHEN year < 1996 THEN year + 100 ELSE year END AS year, incidence FROM {_INC})
        FULL OUTER JOIN (SELECT country AS city, CASE WHEN year > 2000 THEN year + 100 ELSE year END AS year, value AS low_cases
                         FROM indicators WHERE indicator = 'ind_5_low') USING (city, year)
        FULL OUTER JOIN (SELECT city, CASE WHEN year = 1998 THEN year + 100 ELSE year END AS year, precip_total, temp_mean
                         FROM annual) USING (city, year)""",
)
def join_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    on, names = ["city", "year"], {"ind_1_urgent": "incidence", "ind_5_low": "low_cases"}
    rows = b.indicator_rows(spark, sf).filter(F.col("indicator").isin(list(names)))
    totals = rows.groupBy(F.col("country").alias("city"), "year", "indicator").agg(F.sum("value").alias("value"))
    shifted = F.when(F.col("indicator") == "ind_1_urgent", moved("year", "year < 1996")).otherwise(moved("year", "year > 2000"))
    both = join.merge_long(totals.withColumn("year", shifted), on, "indicator", "value", names)
    third = climate(spark, sf).withColumn("year", moved("year", "year = 1998"))
    return join.merge_full(both, third, on)


@query(
    "join_left",
    f"""SELECT city, year, incidence, precip_total, temp_mean FROM {_INC}
        LEFT JOIN (SELECT city, CASE WHEN year <= 1996 THEN year + 100 ELSE year END AS year, precip_total, temp_mean
                   FROM annual) USING (city, year)""",
)
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    right = climate(spark, sf).withColumn("year", moved("year", "year <= 1996"))
    return join.merge_left(incidence(spark, sf), right, ["city", "year"])


_SHARES = ", ".join(f"({m}, {s}::DOUBLE)" for m, s in enumerate(forecast.SEASON_SHARES, start=1))


@query(
    "join_left_composite",
    f"""SELECT year, month, estimate, city, temp_mean FROM
          (SELECT year, t.month, total * t.share AS estimate
           FROM (SELECT year, sum(value) AS total FROM indicators WHERE indicator = 'ind_1_urgent' GROUP BY year),
                (VALUES {_SHARES}) AS t(month, share))
        LEFT JOIN (SELECT city, year, CASE WHEN month = 2 THEN month + 100 ELSE month END AS month, temp_mean
                   FROM monthly) USING (year, month)""",
)
def join_left_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.indicator_rows(spark, sf).filter(F.col("indicator") == "ind_1_urgent")
    totals = rows.groupBy("year").agg(F.sum("value").alias("total"))
    estimates = forecast.seasonal_disaggregate(totals, "total", ["year"])
    panel = b.monthly(spark, sf).select("city", "year", moved("month", "month = 2").alias("month"), "temp_mean")
    return join.merge_left(estimates, panel, ["year", "month"]).select(
        "year", "month", F.col("monthly").alias("estimate"), "city", "temp_mean"
    )


@query(
    "join_suffix_collision",
    """SELECT l.city, l.year, l.value, l.low_ci, r.indicator, r.value AS value_who, r.low_ci AS low_ci_who
       FROM (SELECT country AS city, year, value, low_ci FROM indicators WHERE indicator = 'ind_1_urgent') l
       JOIN (SELECT country AS city, year, indicator, value, low_ci FROM indicators WHERE indicator <> 'ind_1_urgent') r
         ON l.city = r.city AND l.year = r.year""",
)
def join_suffix_collision(spark: SparkSession, sf: str) -> DataFrame:
    """The first indicator's estimates beside those of every other one."""
    estimates = b.indicator_rows(spark, sf).groupBy(F.col("country").alias("city"), "year", "indicator").agg(
        F.sum("value").alias("value"), F.min("value").alias("low_ci")
    )
    estimates = landed(estimates, "estimates")
    left = estimates.filter("indicator = 'ind_1_urgent'").drop("indicator")
    right = estimates.filter("indicator <> 'ind_1_urgent'")
    on = ["city", "year"]
    return left.join(join.suffix_collisions(left, right, on, "_who"), on)


@query(
    "join_semi",
    """SELECT city, year, month, precip_total FROM monthly m WHERE EXISTS (
         SELECT 1 FROM indicators i WHERE i.country = m.city AND i.year = m.year AND i.low_ci < 10000)""",
)
def join_semi(spark: SparkSession, sf: str) -> DataFrame:
    low = b.indicator_rows(spark, sf).filter("value < 10000")
    wanted = low.select(F.col("country").alias("city"), "year").distinct()
    panel = b.monthly(spark, sf).select("city", "year", "month", "precip_total")
    return join.keep_keys(panel, wanted, ["city", "year"])


@query(
    "join_trends",
    """SELECT city, year, month, precip_total, temp_mean, predicted FROM
         (SELECT city, CASE WHEN year >= 2001 THEN year + 100 ELSE year END AS year, month,
                 coalesce(CASE WHEN month != 6 THEN precip_total END, 0) AS precip_total, temp_mean FROM monthly)
       FULL OUTER JOIN (SELECT city, year, month, predicted FROM predictions WHERE model = 'lag12') USING (city, year, month)""",
)
def join_trends(spark: SparkSession, sf: str) -> DataFrame:
    monthly = landed(b.monthly(spark, sf), "panel")
    panel = monthly.withColumn("year", moved("year", "year >= 2001"))
    actuals = panel.withColumn("precip_total", F.when(F.col("month") != 6, F.col("precip_total")))
    tagged = b.predictions(spark, sf, monthly).withColumn(
        "model", F.when(F.col("model") == "lag12", "lag12").otherwise(F.concat("model", F.lit(" (train)")))
    )
    return join.trends(actuals, tagged, ["city", "year", "month"], ["precip_total", "temp_mean"])


@query(
    "join_focal_diff",
    f"""WITH inc AS (SELECT * FROM {_INC})
        SELECT city, year, incidence, incidence - (SELECT max(incidence) FROM inc f WHERE f.city = 'NATION_7' AND f.year = inc.year) AS diff
        FROM inc""",
)
def join_focal_diff(spark: SparkSession, sf: str) -> DataFrame:
    return join.focal_difference(incidence(spark, sf), "city", "NATION_7", "incidence", ["year"])


@query(
    "anti_keys",
    """SELECT country, year, indicator, value FROM indicators i WHERE NOT EXISTS (
         SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = i.country AND r_name = 'AFRICA')""",
)
def anti_keys(spark: SparkSession, sf: str) -> DataFrame:
    african = b.table(spark, sf, "region").filter("r_name = 'AFRICA'")
    nations = b.table(spark, sf, "nation").join(african, F.col("n_regionkey") == F.col("r_regionkey"))
    forbidden = nations.select(F.col("n_name").alias("country"))
    # Dropped before the sums: no forbidden row is aggregated.
    rows = join.drop_keys(b.indicator_rows(spark, sf), forbidden, ["country"])
    return rows.groupBy("country", "year", "indicator").agg(F.sum("value").alias("value"))


# --- set operations ---------------------------------------------------------------------------


@query(
    "union_all",
    """SELECT country, year, indicator, value FROM indicators
       UNION ALL SELECT city AS country, year, 'rainfall' AS indicator, precip_total AS value FROM annual""",
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    rain = climate(spark, sf).select(
        F.col("precip_total").alias("value"), F.lit("rainfall").alias("indicator"), "year", F.col("city").alias("country")
    )
    return shape.union_all([b.indicators(spark, sf).select("country", "year", "indicator", "value"), rain])


@query(
    "union_fill",
    """SELECT model, round(mae, 4) AS mae, CASE WHEN r2 > 0 THEN 'yes' ELSE 'no' END AS has_skill FROM metrics
       UNION ALL SELECT 'mean of all' AS model, round(avg(mae), 4) AS mae, NULL AS has_skill FROM metrics""",
)
def union_fill(spark: SparkSession, sf: str) -> DataFrame:
    metrics = stats.regression_metrics(b.predictions(spark, sf))
    single = metrics.select("model", "mae", F.when(F.col("r2") > 0, "yes").otherwise("no").alias("has_skill"))
    pooled = single.agg(F.lit("mean of all").alias("model"), F.avg("mae").alias("mae"))
    return shape.union_all([single, pooled], fill=True).withColumn("mae", F.round("mae", 4))


@query(
    "union_tagged",
    """SELECT city, year, incidence, 'historical' AS type FROM (SELECT country AS city, year, value AS incidence
         FROM indicators WHERE indicator = 'ind_1_urgent')
       UNION ALL SELECT country AS city, max(year) + 1 AS year, arg_max(value, year) * 1.5 AS incidence, 'simulated' AS type
         FROM indicators WHERE indicator = 'ind_1_urgent' GROUP BY country""",
)
def union_tagged(spark: SparkSession, sf: str) -> DataFrame:
    history = incidence(spark, sf)
    simulated = history.groupBy("city").agg(
        (F.max("year") + 1).alias("year"), (F.max_by("incidence", "year") * 1.5).alias("incidence")
    )
    return shape.union_tagged({"historical": history, "simulated": simulated})


@query(
    "key_union",
    """SELECT city, CASE WHEN year >= 1998 THEN year + 100 ELSE year END AS year FROM annual
       UNION SELECT country AS city, year FROM indicators""",
)
def key_union(spark: SparkSession, sf: str) -> DataFrame:
    climate_keys = b.readings(spark, sf).withColumn("year", moved("year", "year >= 1998"))
    indicator_keys = b.indicator_rows(spark, sf).withColumnRenamed("country", "city")
    return shape.key_union([climate_keys, indicator_keys], ["city", "year"])
