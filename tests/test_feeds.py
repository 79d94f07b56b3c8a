"""The whole way from landed feeds to saved models, against pandas on the same small files."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import models
from panelwise.operators.forecast import SEASON_SHARES
from panelwise.operators.models import Spec
from panelwise.plans import feeds, training
from panelwise.plans.features import monthly_features, spread_inputs
from panelwise.plans.feeds import Options
from panelwise.session import new_folder
from panelwise.sources import payloads

TARGET = "incidence_per_1000"
YEARS = range(2000, 2013)


def indicator_lines():
    for y in YEARS:
        yield f"Aland,AAA,{y},{TARGET},{300 - 9 * (y - 2000) + (y % 3)}"
        yield f"Aland,AAA,{y},population,{'None' if y == 2003 else 1000 + y}"
        yield f"Bland,BBB,{y},{TARGET},{100 + y % 5}"
    for y in YEARS:  # The focal country comes a second time.
        yield f"Aland,AAA,{y},{TARGET},{500 + y}"
    yield "Cland, Rep,CCC,2001,incidence_per_1000,5"
    yield "Dland,2001,DDD,incidence_per_1000,5"


def estimate_lines():
    for y in range(2000, 2011):
        yield f"Aland,AAA,{y},cases,{y * 10},{y * 9},{y * 11},text"


def climate_rows():
    rng = np.random.default_rng(4)
    for city, base in (("north", 18.0), ("south", 25.0)):
        for day in pd.date_range("2002-01-01", "2012-12-31", freq="5D"):
            temp = round(base + 4 * math.sin(day.month) + rng.normal(), 1)
            rain = round(max(0.0, rng.normal(3, 4)), 1)
            if rng.random() < 0.02:
                temp = -999.0
            if rng.random() < 0.02:
                rain = -999.0
            yield (city, 1.5, 30.0, day.strftime("%Y%m%d"), temp, rain, 70.0, 2.0, 20.0)
        yield (city, 1.5, 30.0, "20021399", 20.0, 1.0, 70.0, 2.0, 20.0)


@pytest.fixture(scope="module")
def raw(spark):
    def land(name, header, lines):
        path = new_folder(spark, name)
        content = "\n".join([",".join(header.names), *lines])
        spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(path)
        return path

    return {
        "indicators": land("ind", feeds.INDICATOR_FEED, indicator_lines()),
        "estimates": land("est", feeds.ESTIMATE_FEED, estimate_lines()),
        "climate": land("cli", feeds.CLIMATE_FEED, (",".join(map(str, r)) for r in climate_rows())),
    }


@pytest.fixture(scope="module")
def tables(spark, raw):
    return {k: v.cache() for k, v in feeds.process(spark, raw, Options("AAA", TARGET)).items()}


@pytest.fixture(scope="module")
def climate():
    df = pd.DataFrame(climate_rows(), columns=["city", "lat", "lon", "date", "temp", "rain", "h", "w", "s"])
    df = df[df.date != "20021399"].replace(-999.0, np.nan)
    return df.assign(year=df.date.str[:4].astype(int), month=df.date.str[4:6].astype(int))


def test_indicator_tables(tables):
    wide = tables["indicators_annual"].orderBy("year").toPandas()
    assert list(wide.year) == list(YEARS)
    assert list(wide[TARGET]) == [300 - 9 * (y - 2000) + (y % 3) for y in YEARS]
    assert wide.population.isna().sum() == 1
    assert tables["regional"].count() == 2 * len(YEARS)
    assert tables["estimates_annual"].filter("year = 2004").first().cases_low_ci == 2004 * 9


def test_climate_tables(tables, climate):
    want = climate.groupby(["city", "year", "month"]).agg(t=("temp", "mean"), r=("rain", "sum")).reset_index()
    got = tables["climate_monthly"].orderBy("city", "year", "month").toPandas()
    np.testing.assert_allclose(got.temp_mean_c, want.t)
    np.testing.assert_allclose(got.precip_total_mm, want.r, atol=1e-9)
    yearly = climate.groupby("year").agg(r=("rain", "sum"), d=("rain", lambda x: (x > 0.1).sum()))
    got = tables["climate_annual"].orderBy("year").toPandas()
    np.testing.assert_allclose(got.precip_total_mm, yearly.r / 2)
    np.testing.assert_allclose(got.precip_days, yearly.d / 2)


def test_features(tables, climate):
    got = tables["features"].orderBy("year").toPandas().set_index("year")
    y = pd.Series({y: 300 - 9 * (y - 2000) + (y % 3) for y in YEARS}, dtype=float)
    np.testing.assert_allclose(got.incidence_lag2, y.shift(2))
    np.testing.assert_allclose(got.incidence_change_pct, y.pct_change() * 100)
    rain = (climate.groupby("year").rain.sum() / 2).reindex(YEARS)
    np.testing.assert_allclose(got.precip_anomaly, rain - rain.rolling(5, min_periods=1).mean(), atol=1e-9)
    np.testing.assert_allclose(got.precip_lag1, rain.shift(1))


def test_other_choices(spark, raw, climate):
    options = Options("AAA", TARGET, sentinels="drop", rainfall="pooled", merge="left", anomaly="global", duplicates="last", keep_focal_in_region=False)
    out = feeds.process(spark, raw, options)
    kept = climate.dropna(subset=["temp", "rain"])
    got = out["features"].orderBy("year").toPandas().set_index("year")
    rain = kept.groupby("year").rain.sum()
    np.testing.assert_allclose(got.precip_anomaly.dropna(), rain - rain.mean(), atol=1e-9)
    assert list(got[TARGET]) == [500 + y for y in YEARS]
    assert {r.country for r in out["regional"].collect()} == {"Bland"}


def test_annual_training_and_scoring(spark, tables):
    specs = {"ridge": Spec("ridge", {"alpha": 1.0}), "forest": Spec("random_forest", {"trees": 5, "depth": 3})}
    names = ["incidence_lag1", "incidence_lag2", "temp_mean_c", "precip_total_mm", "absent"]
    run = training.train_annual(tables["features"], TARGET, names, ["incidence_lag1"], n_test=3, specs=specs)
    assert run.features == names[:4]
    assert {(r.model, r.split): r.n for r in run.metrics.collect()} == {(m, s): n for m in specs for s, n in (("train", 9), ("test", 3))}
    test_r2 = {r.model: r.r2 for r in run.metrics.filter("split = 'test'").collect()}
    assert run.best == max(test_r2, key=test_r2.get)
    assert run.predictions.filter(F.col("model").contains("train")).count() == 9
    folder = new_folder(spark, "run")
    training.save_run(run, folder)
    report = payloads.scan_report(spark, f"{folder}/report")
    assert report.first().best_model == run.best and payloads.report_section(report, "results").count() == 4
    scored = models.batch_score(tables["features"], training.load_model(folder), run.features)
    assert scored.filter("risk IS NULL OR predicted IS NULL").count() == 0


def test_tuned_training_with_ensembles_and_forecast(spark, tables):
    panel = tables["climate_monthly"].withColumnsRenamed({v: k for k, v in feeds.PUBLISHED.items()})
    rows = monthly_features(panel, "temp_mean", ["city"]).withColumn("period", F.col("year") * 12 + F.col("month"))
    names = ["temp_mean_lag1", "temp_mean_lag12", "precip_total", "month_sin", "month_cos"]
    grids = {"ridge": {"alpha": [1.0, 10.0]}, "random_forest": {"trees": [5], "depth": [4], "min_leaf": [3]}}
    run = training.train_tuned(rows, "temp_mean", names, ["city"], "period", 24, grids, stack_top=2, horizon=3)
    by_model = {r.model: r.mae for r in run.metrics.filter("split = 'test'").collect()}
    assert set(by_model) == {"ridge", "random_forest", "weighted", "stacking"}
    assert by_model["weighted"] <= max(by_model["ridge"], by_model["random_forest"]) + 1e-9
    forecasts = run.forecasts.orderBy("city", "period").collect()
    assert len(forecasts) == 6 and all(f.lower_bound <= f.predicted <= f.upper_bound for f in forecasts)
    assert run.best == run.report().first().best_model == min(run.cv_errors, key=run.cv_errors.get)
    folder = new_folder(spark, "tuned")
    training.save_run(run, folder)
    stacked = models.Stack.load(f"{folder}/stack")
    again = {(r.city, r.period): r.predicted for r in stacked.transform(rows.dropna(subset=["temp_mean"])).collect()}
    want = {(r.city, r.period): r.predicted for r in run.stacked.transform(rows.dropna(subset=["temp_mean"])).collect()}
    assert again == want
    assert set(run.cv_errors) == {*grids, "weighted", "stacking"}
    report = payloads.scan_report(spark, f"{folder}/report")
    assert report.first().samples.asDict() == {"train": 252, "test": 48} or report.first().samples.train > report.first().samples.test
    params = {r.model: {p["key"]: p["value"] for p in r.params} for r in payloads.report_section(report, "best_params").collect()}
    assert params["random_forest"] == {"trees": 5, "depth": 4, "min_leaf": 3} and params["ridge"]["alpha"] in (1.0, 10.0)
    assert {r.model: r.weight for r in payloads.report_section(report, "ensemble_weights").collect()} == pytest.approx(run.weights())
    weights = {r.model: r.weight for r in spark.read.parquet(f"{folder}/weights").collect()}
    assert set(weights) == set(grids) and sum(weights.values()) == pytest.approx(1)
    assert spark.read.parquet(f"{folder}/forecasts").count() == 6
    scored = models.batch_score(rows, training.load_model(folder), run.features)
    assert scored.count() == rows.count() and scored.filter("risk IS NULL OR predicted IS NULL").count() == 0


@pytest.mark.parametrize("winner", ["weighted", "stacking", "ridge"])
def test_whatever_wins_is_saved_loaded_and_served(spark, tables, monkeypatch, winner):
    panel = tables["climate_monthly"].withColumnsRenamed({v: k for k, v in feeds.PUBLISHED.items()})
    rows = monthly_features(panel, "temp_mean", ["city"]).withColumn("period", F.col("year") * 12 + F.col("month"))
    names, grids = ["temp_mean_lag1", "month_sin", "month_cos"], {"ridge": {"alpha": [1.0]}, "extra_trees": {"trees": [3], "depth": [4]}}
    found = {"weighted": 1e9, "stacking": 1e9} | ({winner: 0.0} if winner != "ridge" else {})
    monkeypatch.setattr(training.tuning, "ensemble_errors", lambda *a: found)
    monkeypatch.setitem(grids, "extra_trees", {"trees": [3], "depth": [0 if winner == "ridge" else 4]})
    run = training.train_tuned(rows, "temp_mean", names, ["city"], "period", 24, grids, stack_top=2, horizon=2)
    assert run.best == winner
    folder = new_folder(spark, "served")
    training.save_run(run, folder)
    loaded = training.load_model(folder)
    assert isinstance(loaded, models.Stack) == (winner != "ridge")
    a, b = ({(r.city, r.period): r.p for r in models.predict({"p": m}, rows).select("city", "period", "p").collect()} for m in (run.final, loaded))
    assert a == b and len(set(a.values())) > 10
    if winner == "weighted":
        parts = models.predict(dict(run.final.bases), rows).limit(5).collect()
        for r in parts:
            assert a[r.city, r.period] == pytest.approx(sum(r[f"base_{n}"] * w for n, w in run.weights().items()))


@pytest.mark.parametrize(("duplicates", "factor"), [("first", 10), ("last", 20)])
def test_estimates_are_the_focal_countrys(spark, raw, duplicates, factor):
    lines = [f"Bland,BBB,{y},cases,999,998,1000,text" for y in YEARS]
    lines += [f"Aland,AAA,{y},cases,{y * k},{y * k - 1},{y * k + 1},text" for k in (10, 20) for y in YEARS]
    path = new_folder(spark, "two-countries")
    content = "\n".join([",".join(feeds.ESTIMATE_FEED.names), *lines])
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(path)
    out = feeds.process(spark, {**raw, "estimates": path}, Options("AAA", TARGET, duplicates=duplicates))
    got = {r.year: r.cases_value for r in out["estimates_annual"].collect()}
    assert got == {y: y * factor for y in YEARS}


def test_monthly_panel_from_text_to_a_served_winner(spark, raw, climate):
    panel = feeds.monthly_panel(spark, feeds.typed(spark, raw, Options("AAA", TARGET)), Options("AAA", TARGET)).cache()
    y = {y: 300.0 - 9 * (y - 2000) + (y % 3) for y in YEARS}
    months = climate.groupby(["city", "year", "month"]).agg(t=("temp", "mean"), r=("rain", "sum")).reset_index()
    got = panel.filter("city IS NOT NULL").orderBy("city", "year", "month").toPandas()
    assert len(got) == len(months) == 2 * 11 * 12 and panel.filter("city IS NULL").count() == 24
    np.testing.assert_allclose(got.temp_mean, months.t)
    np.testing.assert_allclose(got.monthly, [y[a] * SEASON_SHARES[m - 1] for a, m in zip(got.year, got.month, strict=True)])
    np.testing.assert_allclose(got.annual_lag12, [y[a - 1] if a > 2002 else np.nan for a in got.year])
    np.testing.assert_allclose(got.monthly_lag3, got.groupby("city").monthly.shift(3))
    np.testing.assert_allclose(got.precip_total_roll6, months.groupby("city").r.transform(lambda r: r.rolling(6, min_periods=1).mean()), atol=1e-9)
    np.testing.assert_allclose(got.year_normalized, (got.year - 2000) / 12)
    np.testing.assert_allclose(got.population, [np.nan if a == 2003 else 1000 + a for a in got.year])
    np.testing.assert_allclose(got.cases_low_ci, [a * 9 if a <= 2010 else np.nan for a in got.year])
    names = spread_inputs(panel, ["latitude", "longitude"])
    assert not {"annual", "monthly", TARGET, "year", "month", "city"} & set(names) and {"population", "cases_value", "annual_lag36"} <= set(names)
    grids = {"ridge": {"alpha": [1.0]}, "random_forest": {"trees": [5], "depth": [4], "min_leaf": [3]}}
    rows = panel.dropna(subset=["annual_lag12"])
    run = training.train_tuned(rows, "monthly", names, ["city", "month"], "year", 2, grids, stack_top=2, horizon=1)
    test = {r.model: r.r2 for r in run.metrics.filter("split = 'test'").collect()}
    assert test[run.best] > 0.5 and run.samples["test"] == 2 * 2 * 12
    folder = new_folder(spark, "monthly-run")
    training.save_run(run, folder)
    scored = models.batch_score(rows, training.load_model(folder), run.features)
    assert scored.count() == rows.count() and scored.filter("risk IS NULL OR predicted IS NULL").count() == 0
    assert run.forecasts.count() == 3 * 12  # Two cities, and the months before their climate begins.


def test_monthly_panel_of_an_estimated_target(spark, raw):
    panel = feeds.monthly_panel(spark, raw, Options("AAA", "cases"))
    assert {r.year: round(r.s, 6) for r in panel.filter("city = 'north' OR city IS NULL").groupBy("year").agg(F.sum("monthly").alias("s")).collect()} == {y: 10.0 * y for y in range(2000, 2011)}
    assert not {"cases_value", "cases_low_ci", "cases_high_ci"} & set(panel.columns) and {TARGET, "population"} <= set(panel.columns)
