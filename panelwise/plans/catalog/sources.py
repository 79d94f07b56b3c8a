"""Scans, payloads, manifests and writers. Landed files go below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelwise.operators import shape, stats
from panelwise.plans import bindings as b
from panelwise.plans.catalog.registry import query
from panelwise.session import landed, new_folder
from panelwise.sources import entities, manifest, payloads, sinks, text

#: Items of one page of an indicator, about.
ITEMS_A_PAGE = 50

ESTIMATE_SCHEMA = (
    "country string, code string, year int, indicator string, value double, low_ci double, high_ci double"
)


@query("scan_csv_inferred", "SELECT country, code, year, indicator, value FROM indicators")
def scan_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "indicators")
    sinks.write_csv(
        b.indicators(spark, sf).select("country", "code", "year", "indicator", "value"), path
    )
    return text.scan_inferred(spark, path)


@query("scan_csv_typed", "SELECT * FROM indicators")
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "estimates")
    sinks.write_csv(b.indicators(spark, sf), path)
    return text.scan_typed(spark, path, ESTIMATE_SCHEMA)


@query(
    "scan_csv_strings",
    "SELECT order_key::VARCHAR AS order_key, code_text, year_text, nullif(value_text, '') AS value_text, date_text FROM dirty",
)
def scan_csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["order_key", "code_text", "year_text", "value_text", "date_text"]
    path = new_folder(spark, "dirty")
    # Leading and trailing blanks are part of the landed text.
    (
        b.dirty(spark, sf)
        .select(*columns)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return text.scan_strings(spark, path, columns)


@query(
    "csv_bad_lines",
    """SELECT order_key, CASE WHEN order_key % 29 = 0 THEN 'quarantined' ELSE 'kept' END AS status,
              CASE WHEN order_key % 29 = 0 OR order_key % 31 = 0 THEN NULL ELSE year_text END AS year_text,
              CASE WHEN order_key % 29 = 0 OR order_key % 31 = 0 THEN NULL ELSE value END AS value
       FROM numbers""",
)
def csv_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("order_key")
    label = F.when(k % 5 == 0, F.lit('"a,\n""b"""')).otherwise(F.lit('"a, b"'))  # a line break inside quotes
    fields = [k.cast("string"), label, F.col("year_text"), F.col("value_text")]
    line = (
        F.when(k % 29 == 0, F.concat_ws(",", *fields, F.lit("extra")))
        .when(k % 31 == 0, F.concat_ws(",", *fields[:2]))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = new_folder(spark, "lines")
    b.dirty(spark, sf).select(line.alias("value")).write.text(path)
    schema = StructType(
        [
            StructField("order_key", LongType()),
            StructField("label", StringType()),
            StructField("year_text", StringType()),
            StructField("value", DoubleType()),
        ]
    )
    rows = text.scan_lines(spark, path, schema, header=False)
    kept = ~F.col("is_long")
    return rows.select(
        "order_key",
        F.when(kept, "kept").otherwise("quarantined").alias("status"),
        F.when(kept, F.col("year_text")).alias("year_text"),
        F.when(kept & ~F.isnan("value"), F.col("value")).alias("value"),
    )


@query(
    "scan_or_empty",
    "SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY o_orderpriority",
)
def scan_or_empty(spark: SparkSession, sf: str) -> DataFrame:
    schema = b.table(spark, sf, "orders").schema
    here = text.scan_or_empty(spark, f"{sf}/orders.parquet", schema, "parquet")
    absent = text.scan_or_empty(spark, f"{sf}/no_such_table.parquet", schema, "parquet")
    return (
        here.unionByName(absent).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "input_manifest",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, true AS present, true AS has_bytes, count(*) AS n_rows FROM {t}"
        for t in b.TABLES
    ),
)
def input_manifest(spark: SparkSession, sf: str) -> DataFrame:
    files = manifest.file_manifest(spark, sf, b.TABLES)
    rows = manifest.row_counts({t: b.table(spark, sf, t) for t in b.TABLES})
    return files.join(rows, "name", "left").select(
        "name", "present", (F.col("bytes") > 0).alias("has_bytes"), "n_rows"
    )


def report_frame(spark: SparkSession, sf: str) -> DataFrame:
    """A one-row report: best model, results and forecasts, both short lists."""
    predictions = b.predictions(spark, sf)
    metrics = stats.regression_metrics(predictions).select("model", "mae", "rmse", "r2", "mape", "n")
    monthly_means = predictions.groupBy("month").agg(F.avg("actual").alias("mean_actual"))
    results = metrics.agg(
        F.min_by("model", F.struct("mae", "model")).alias("best_model"),
        F.collect_list(F.struct("*")).alias("results"),
    )
    forecasts = monthly_means.agg(F.array_sort(F.collect_list(F.struct("*"))).alias("f"))
    return results.withColumn("forecasts", forecasts.scalar())


REPORT_SCHEMA = (
    "best_model string, results array<struct<model:string,mae:double,rmse:double,r2:double,"
    "mape:double,n:bigint>>, forecasts array<struct<month:int,mean_actual:double>>"
)


@query(
    "scan_json_report",
    """SELECT (SELECT model FROM metrics ORDER BY mae, model LIMIT 1) AS best_model, model,
              round(mae, 4) AS mae, round(r2, 6) AS r2, n FROM metrics""",
)
def scan_json_report(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "report")
    sinks.write_report(report_frame(spark, sf), path)
    report = payloads.scan_report(spark, path, REPORT_SCHEMA)
    section = payloads.report_section(report, "results", keep=["best_model"])
    return section.select(
        "best_model", "model", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"), "n"
    )


@query(
    "sink_json_report",
    """SELECT (SELECT model FROM metrics ORDER BY mae, model LIMIT 1) AS best_model,
              (SELECT count(*) FROM metrics)::INT AS n_results, month,
              round(avg(actual), 4) AS mean_actual FROM predictions GROUP BY month""",
)
def sink_json_report(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "report")
    sinks.write_report(report_frame(spark, sf), path)
    report = payloads.scan_report(spark, path)
    return payloads.report_section(
        report.withColumn("n_results", F.size("results")), "forecasts", keep=["best_model", "n_results"]
    ).select("best_model", "n_results", F.col("month").cast("int"), F.round("mean_actual", 4).alias("mean_actual"))


@query(
    "json_indicator_pages",
    "SELECT indicator, country, code, year::VARCHAR AS year, value FROM indicators",
)
def json_indicator_pages(spark: SparkSession, sf: str) -> DataFrame:
    item = F.struct(
        F.struct(F.col("country").alias("value")).alias("country"),
        F.col("code").alias("countryiso3code"),
        F.col("year").cast("string").alias("date"),
        "value",
    )
    rows = landed(b.indicators(spark, sf), "indicators")
    sizes = rows.groupBy("indicator").agg(F.ceil(F.count("*") / ITEMS_A_PAGE).cast("int").alias("pages"))
    number = F.pmod(F.xxhash64("country", "code", "year"), F.col("pages")).cast("int") + 1
    paged = rows.join(sizes, "indicator").withColumn("number", number)
    # Numbered pages, as the feed has them: an indicator is as many documents as its rows fill.
    pages = paged.groupBy("indicator", "number").agg(F.max("pages").alias("pages"), F.to_json(F.collect_list(item)).alias("items"))
    meta = F.to_json(F.struct(F.col("number").alias("page"), "pages"))
    pages = pages.select("indicator", F.concat(F.lit("["), meta, F.lit(","), "items", F.lit("]")).alias("page"))
    return payloads.indicator_pages(pages, "page", keep=["indicator"])


@query(
    "json_value_array",
    """WITH known AS (SELECT country, indicator, year, CASE WHEN year % 3 = 0 THEN NULL ELSE value END AS value,
              low_ci, high_ci, code || ' estimate' AS value_type FROM indicators)
       SELECT 'all' AS variant, * FROM known
       UNION ALL SELECT 'known' AS variant, * FROM known WHERE value IS NOT NULL""",
)
def json_value_array(spark: SparkSession, sf: str) -> DataFrame:
    item = F.struct(
        F.col("year").alias("TimeDim"),
        F.when(F.col("year") % 3 != 0, F.col("value")).alias("NumericValue"),
        F.col("low_ci").alias("Low"),
        F.col("high_ci").alias("High"),
        F.concat("code", F.lit(" estimate")).alias("Value"),
    )
    documents = (
        b.indicators(spark, sf)
        .groupBy("country", "indicator")
        .agg(F.to_json(F.struct(F.collect_list(item).alias("value"))).alias("document"))
    )
    keep = ["country", "indicator"]
    return shape.union_tagged(
        {
            "all": payloads.estimate_array(documents, "document", keep),
            "known": payloads.estimate_array(documents, "document", keep, drop_missing=True),
        },
        "variant",
    )


@query(
    "json_map_series",
    """WITH days AS (
         SELECT user_id, strftime(ts, '%Y%m%d') AS day, count(*)::DOUBLE AS n,
                sum(floor(value)) AS v, sum((props->>'$.k')::INT)::DOUBLE AS k
         FROM events GROUP BY ALL)
       SELECT user_id, day, CASE WHEN n % 2 = 1 THEN n END AS temp, CASE WHEN k % 3 != 0 THEN k END AS precip,
              CASE WHEN v % 5 != 0 THEN v END AS humidity, n AS wind, k AS solar
       FROM days WHERE n % 2 = 1 OR k % 3 != 0""",
)
def json_map_series(spark: SparkSession, sf: str) -> DataFrame:
    # Reduced to one row per user and day first: a document is as long as the calendar.
    days = (
        b.table(spark, sf, "events")
        .groupBy("user_id", F.date_format("ts", "yyyyMMdd").alias("day"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(F.floor("value")).cast("double").alias("v"),
            F.sum(F.get_json_object("props", "$.k").cast("int")).cast("double").alias("k"),
        )
    )

    def series(value: str, known=None):
        entry = F.struct("day", value)
        kept = entry if known is None else F.when(known, entry)
        return F.map_from_entries(F.collect_list(kept))

    missing_day = F.create_map(F.lit(payloads.MISSING_DAY), F.lit(0.0))
    documents = days.groupBy("user_id").agg(
        F.map_concat(series("n", F.col("n") % 2 == 1), missing_day).alias("T2M"),
        series("k", F.col("k") % 3 != 0).alias("PRECTOTCORR"),
        series("v", F.col("v") % 5 != 0).alias("RH2M"),
        series("n").alias("WS2M"),
        series("k").alias("ALLSKY_SFC_SW_DWN"),
    )
    parameter = F.struct(*payloads.DAILY_PARAMETERS)
    document = F.to_json(F.struct(F.struct(parameter.alias("parameter")).alias("properties")))
    return payloads.map_series(documents.select("user_id", document.alias("doc")), "doc", ["user_id"])


@query("sink_csv", "SELECT city, year, month, temp_mean, temp_max, precip_total, precip_days, n_obs FROM monthly")
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "monthly")
    columns = ["city", "year", "month", "temp_mean", "temp_max", "precip_total", "precip_days", "n_obs"]
    panel = b.monthly(spark, sf).select(*columns)
    sinks.write_csv(panel, path)
    return text.scan_typed(spark, path, panel.schema)


@query(
    "dim_entities",
    f"""WITH places AS (SELECT * FROM (VALUES {", ".join(
        f"({i}, '{c}', {lat}::DOUBLE, {lon}::DOUBLE, '{z}')" for i, (c, lat, lon, z) in enumerate(entities.PLACES)
    )}) AS t(i, city, lat, lon, zone))
       SELECT city, lat, lon, zone, count(*) AS n_suppliers
       FROM supplier JOIN places ON s_nationkey % 8 = i GROUP BY ALL""",
)
def dim_entities(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(p[0]) for p in entities.PLACES])
    city = F.get(names, F.col("s_nationkey") % len(entities.PLACES))
    placed = b.table(spark, sf, "supplier").select(city.alias("city"))
    per_city = placed.groupBy("city").agg(F.count(F.lit(1)).alias("n_suppliers"))
    # Eight literal rows: always small enough to broadcast.
    return per_city.join(F.broadcast(entities.places(spark)), "city").select(
        "city", "lat", "lon", "zone", "n_suppliers"
    )
