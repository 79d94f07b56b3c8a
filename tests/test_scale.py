"""Plans and results under the conditions of large, skewed tables."""

import pytest
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.readwriter import DataFrameWriter

from panelwise.operators import aggregate
from panelwise.plans import bindings
from panelwise.plans.catalog import QUERIES, models
from tools.check_oracles import canonical

FACTS = ("lineitem", "orders", "events")
#: Two passes are the method: brackets, then counts (``quantiles``); parameters, then the rows they change.
TWO_PASSES = {"numeric_summary": 2, "median_impute": 2, "robust_scale": 2}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


class Plans:
    """The plans of all that a query does, eager steps and scalar subqueries included, without adaptive changes."""

    def __init__(self, spark, monkeypatch):
        self.texts = []
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for kind, names in ((DataFrameWriter, ("parquet", "csv", "json", "text")), (DataFrame, ("collect", "first", "count", "toArrow"))):
            for name in names:
                monkeypatch.setattr(kind, name, self.noted(getattr(kind, name)))

    def noted(self, action):
        def run(on, *args, **kwargs):
            self.note(on._df if hasattr(on, "_df") else on)
            return action(on, *args, **kwargs)

        return run

    def note(self, df):
        self.texts.append(df._jdf.queryExecution().executedPlan().toString())

    def scans(self, table):
        return sum(f"/{table}.parquet" in line and "FileScan" in line for text in self.texts for line in text.splitlines())


@pytest.fixture
def plans(spark, monkeypatch):
    yield Plans(spark, monkeypatch)
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_facts_are_scanned_once_without_cross_joins(name, spark, sf, plans):
    if name in ("ts_cv_grid", "ts_cv_errors", "ensemble_stacking", "ensemble_stacking_errors") or name.startswith("model_"):
        # Fitting only adds passes over what is written: the panel is the part that reads facts.
        df = models.feature_panel(spark, sf)
    else:
        df = QUERIES[name](spark, sf)
    plans.note(df)
    for table in FACTS:
        assert plans.scans(table) <= TWO_PASSES.get(name, 1), table
    for plan in plans.texts:
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan


def test_scan_reads_the_needed_columns_only(spark, sf):
    plan = QUERIES["season_flag"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "/lineitem.parquet" in line)
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in scan


def test_range_filter_reaches_the_scan(spark, sf):
    from panelwise.operators.quantiles import Interval, _inside

    line = bindings.table(spark, sf, "lineitem")
    plan = _inside(line, [Interval("l_tax", 0.01, 0.02, 0, 9)])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_tax,0.01)" in plan and "ReadSchema: struct<l_tax:double>" in plan


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", ["agg_monthly", "flagship_features", "anomaly_global", "join_focal_diff"])
def test_shuffled_dimensions_give_the_same_rows(name, spark, sf, request):
    want = canonical(QUERIES[name](spark, sf).toPandas())
    request.getfixturevalue("no_broadcast")
    shuffled = QUERIES[name](spark, sf)
    assert "SortMergeJoin" in final_plan(shuffled)
    assert canonical(shuffled.toPandas()).equals(want)


def test_hot_city_costs_one_row_per_task(spark):
    # A third of all readings belong to one city; what is shuffled does not grow with them.
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("city"),
        F.lit(2020).alias("year"),
        (F.col("id") % 2 + 1).cast("int").alias("month"),
        *[(F.col("id") % n).cast("double").alias(c) for n, c in ((7, "temp"), (5, "precip"), (3, "humidity"), (4, "wind"), (6, "solar"))],
    )
    out = aggregate.monthly(df)
    assert out.agg(F.sum("n_obs")).first()[0] == 30_000
    assert out.filter("city = 'hot'").agg(F.sum("n_obs")).first()[0] == 10_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg(temp" in plan and "Exchange hashpartitioning(city" in plan
