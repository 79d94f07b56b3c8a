import json
import time

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from panelwise.session import landed, new_folder, shared_folder
from panelwise.sources import manifest, payloads, sinks, text

SCHEMA = StructType(
    [StructField("country", StringType()), StructField("year", IntegerType()), StructField("value", DoubleType())]
)


def land(spark, lines):
    path = new_folder(spark, "t")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_long_lines_are_set_apart(spark):
    path = land(spark, ["country,year,value", 'Kenya,2001,1.5', '"Korea, Rep",2001,2.5', "Bolivia, Rep,x,2001,3", "Chad,2002", "Mali,NA,4", "", "Peru,2003,5,"])
    kept, quarantined = text.scan_with_quarantine(spark, path, SCHEMA)
    want = {("Kenya", 2001, 1.5), ("Korea, Rep", 2001, 2.5), ("Chad", 2002, None), ("Mali", None, 4.0)}
    assert {tuple(r) for r in kept.collect()} == want
    assert {r[0] for r in quarantined.collect()} == {"Bolivia, Rep,x,2001,3", "Peru,2003,5,"}


def test_csv_round_trips(spark):
    df = spark.createDataFrame([("Kenya", 2001, 1.5), ("a, b", None, None)], SCHEMA)
    path = new_folder(spark, "t")
    sinks.write_csv(df, path)
    assert {tuple(r) for r in text.scan_typed(spark, path, SCHEMA).collect()} == {("Kenya", 2001, 1.5), ("a, b", None, None)}
    assert text.scan_inferred(spark, path).schema["year"].dataType == IntegerType()
    assert {r.year for r in text.scan_strings(spark, path, SCHEMA.names).collect()} == {"2001", None}
    assert text.scan_or_empty(spark, path, SCHEMA).count() == 2
    assert text.scan_or_empty(spark, path + "-absent", SCHEMA).count() == 0


def test_partitioned_tables_and_landing(spark):
    df = spark.createDataFrame([("a", 2001), ("b", 2002)], "city string, year int")
    path = new_folder(spark, "t")
    sinks.write_table(df, path, by=["year"])
    plan = spark.read.parquet(path).filter("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert landed(df, "t").count() == 2


def test_indicator_pages(spark):
    page = json.dumps([{"page": 1}, [
        {"country": {"value": "Kenya"}, "countryiso3code": "KEN", "date": "2001", "value": 1.5, "unit": ""},
        {"country": {"value": "Kenya"}, "countryiso3code": "KEN", "date": "2002", "value": None},
    ]])
    df = spark.createDataFrame([("i", page), ("none", '[{"page":0},null]'), ("bad", "oops")], "name string, doc string")
    got = {tuple(r) for r in payloads.indicator_pages(df, "doc", ["name"]).collect()}
    assert got == {("i", "Kenya", "KEN", "2001", 1.5), ("i", "Kenya", "KEN", "2002", None)}


def test_series_cover_the_axis_days_only(spark):
    doc = json.dumps({"properties": {"parameter": {
        "T2M": {"20200101": 20.0, "-999.0": 0.0}, "PRECTOTCORR": {"20200102": 1.0}, "RH2M": {"20200103": 70.0, "20200101": 60.0},
    }}})
    df = spark.createDataFrame([("x", doc)], "city string, doc string")
    got = [tuple(r) for r in payloads.map_series(df, "doc", ["city"]).collect()]
    assert got == [("x", "20200101", 20.0, None, 60.0, None, None), ("x", "20200102", None, 1.0, None, None, None)]


def test_report_sections(spark):
    path = new_folder(spark, "t")
    df = spark.sql("SELECT 'm' AS best, array(named_struct('year', 2025, 'p', 5.44), named_struct('year', 2026, 'p', 5.43)) AS forecasts")
    sinks.write_report(df, path)
    section = payloads.report_section(payloads.scan_report(spark, path), "forecasts", ["best"])
    assert {(r.best, r.year, r.p) for r in section.collect()} == {("m", 2025, 5.44), ("m", 2026, 5.43)}


def test_manifest_names_what_is_absent(spark, sf):
    got = {r.name: (r.present, r.bytes > 0) for r in manifest.file_manifest(spark, sf, ["nation", "no_such"]).collect()}
    assert got == {"nation": (True, True), "no_such": (False, False)}


class Session:
    """Just enough of a session to ask for its settings."""

    def __init__(self, master, **settings):
        self.sparkContext = type("C", (), {"master": master})()
        self.conf = type("F", (), {"get": staticmethod(lambda k, d=None: settings.get(k, d))})()


def test_scratch_needs_a_shared_folder():
    cluster = Session("spark://host:7077", **{"spark.checkpoint.dir": "/shared/scratch/"})
    assert shared_folder(cluster) == "/shared/scratch"
    assert new_folder(cluster, "x") != new_folder(cluster, "x")
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host:7077"))


def records_of(spark, path):
    rows = text.records(spark, path).collect()
    return sorted((r._ordinal.block.file_block_start, r._ordinal.line, r._record, r.is_broken) for r in rows)


def quoted_lines():
    """Records with everything that may stand inside quotes, and the file they make."""
    records = []
    for i in range(300):
        records.append(f'{i},"plain, {i}",{i * 0.5}')
        if i % 3 == 0:
            records.append(f'{i},"two\nlines with ""doubled"" quotes\n\nand, commas",1')
        if i % 7 == 0:
            records.append(f'{i},5" pipe,2')  # a quote inside an unquoted field opens nothing
        if i % 11 == 0:
            records.append(f'{i},"ends here ""\n"" or there",""')
        if i % 50 == 0:
            records.append(f'{i},"' + "\n".join(["a line, of many"] * 40) + '",3')
    return records


@pytest.mark.parametrize("split", ["100", "1000", "128m"])
def test_quoted_line_breaks_stay_in_one_record_wherever_files_split(spark, split):
    records = quoted_lines()
    path = new_folder(spark, "t")
    spark.createDataFrame([("\n".join(records),)], "value string").coalesce(1).write.text(path)
    spark.createDataFrame([("x,y,z\n1,\"a\nb\",2",)], "value string").coalesce(1).write.mode("append").text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = records_of(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > (5 if split != "128m" else 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r[2] for r in got) == sorted([*records, "x,y,z", '1,"a\nb",2']) and not any(r[3] for r in got)


def test_very_long_quoted_fields(spark):
    long = 'x ""y"" ' * 20_000
    rows = ["1,a", f'2,"{long}",z', f'3,"{long}\n{long}"']
    assert sorted(r[2] for r in records_of(spark, land(spark, rows))) == sorted(rows)


def test_a_lost_quote_gathers_no_file(spark):
    lines = ["1,a", '2,"never closed'] + [f"{i},b" for i in range(3, 60)]
    path = land(spark, lines)
    rows = text.records(spark, path, most_lines=20).collect()
    assert sorted((r._record, r.is_broken) for r in rows) == sorted((x, x != "1,a") for x in lines)


def test_records_with_line_breaks_are_parsed_and_long_ones_set_apart(spark):
    path = land(spark, ["country,year,value", '"Korea,\nRep ""S""",2001,2.5', '"two\nlines",2002,1.0,"and\nmore"', "Chad,2002"])
    kept, quarantined = text.scan_with_quarantine(spark, path, SCHEMA)
    assert {tuple(r) for r in kept.collect()} == {('Korea,\nRep "S"', 2001, 2.5), ("Chad", 2002, None)}
    assert [r[0] for r in quarantined.collect()] == ['"two\nlines",2002,1.0,"and\nmore"']


def test_series_of_many_days_take_time_in_proportion(spark):
    def document(n):
        days = {f"{20000000 + i}": float(i) for i in range(n)}
        return json.dumps({"properties": {"parameter": {"T2M": days, "PRECTOTCORR": days, "RH2M": days, "WS2M": days, "ALLSKY_SFC_SW_DWN": days}}})

    def seconds(n):
        df = landed(spark.createDataFrame([("x", document(n))], "city string, doc string"), "t")
        start = time.perf_counter()
        total = payloads.map_series(df, "doc", ["city"]).selectExpr("count(*)", "sum(temp + precip + humidity + wind + solar)").first()
        assert tuple(total) == (n, 5.0 * n * (n - 1) / 2)
        return time.perf_counter() - start

    seconds(100)
    few, many = min(seconds(1_000) for _ in range(2)), min(seconds(10_000) for _ in range(2))
    assert many < 10 * max(few, 0.3)


def test_equal_keys_of_different_documents_stay_apart(spark):
    doc = json.dumps({"properties": {"parameter": {"T2M": {"20200101": 1.0, "20200102": None}, "RH2M": {"20200101": 5.0}}}})
    df = spark.createDataFrame([("x", doc), ("x", doc), ("y", "{}"), ("z", None)], "city string, doc string")
    got = sorted((r.city, r.day, r.temp, r.humidity) for r in payloads.map_series(df, "doc", ["city"]).collect())
    assert got == sorted([("x", "20200101", 1.0, 5.0), ("x", "20200102", None, None)] * 2, key=str)
