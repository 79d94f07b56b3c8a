import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import forecast


def test_season_shares_fill_the_year(rows):
    assert sum(forecast.SEASON_SHARES) == pytest.approx(1.0)
    df = rows([("a", 2020, 100.0), ("a", 2021, 0.0), ("a", 2022, None), ("a", 2023, -1.0)], "c string, year int, v double")
    out = forecast.seasonal_disaggregate(df, "v", ["c", "year"])
    assert out.count() == 12 and out.agg(F.sum("monthly")).first()[0] == pytest.approx(100.0)


def test_trend_rules(rows):
    data = [("a", y, 2.0 * i + (i % 2), None if i else 5.0, None) for i, y in enumerate(range(2015, 2021))]
    df = rows(data, "c string, year int, line double, once double, never double")
    out = forecast.forecast_trend(df, ["line", "once", "never"], ["c"], ["year"], horizon=2)
    got = {(r.feature, r.year): r.value for r in out.collect()}
    y = [d[2] for d in data]
    fit = np.polyfit(range(6), y, 1)
    assert got["line", 2021] == pytest.approx(np.polyval(fit, 7)) and got["line", 2022] == pytest.approx(np.polyval(fit, 8))
    assert got["once", 2022] == 5.0 and got["never", 2021] == 0.0


def test_trend_numbers_known_values_only(rows):
    known = [(2000, 1.0), (2001, None), (2002, 3.0), (2003, None), (2004, 4.0)]
    df = rows([("a", *k) for k in known], "c string, year int, v double")
    out = forecast.forecast_trend(df, ["v"], ["c"], ["year"], horizon=1).first()
    fit = np.polyfit([0, 1, 2], [1.0, 3.0, 4.0], 1)
    assert out.year == 2005 and out.value == pytest.approx(np.polyval(fit, 4))


def test_published_bounds(rows):
    out = forecast.with_forecast_bounds(rows([(5.44,), (-2.0,)], "predicted double")).collect()
    assert out[0].lower_bound == pytest.approx(3.84, abs=0.011) and out[0].upper_bound == pytest.approx(7.03, abs=0.011)
    assert out[1].lower_bound == 0.0 and out[1].confidence == "95%"


def test_interval_of_one_estimator_is_the_heuristic(rows):
    df = rows([("a", "m1", 10.0), ("a", "m2", 14.0), ("b", "m1", -10.0)], "k string, e string, predicted double")
    out = {r.k: r for r in forecast.prediction_interval(df, ["k"]).collect()}
    assert out["a"].lower == pytest.approx(12 - 1.959964 * 2) and out["b"].upper == pytest.approx(-10 + 1.96)


def test_scenario_score_limits_and_noise(rows):
    knobs = [(1, 74.0, 1500.0, 21.0, 70.0, 30.0), (2, 900.0, 2500.0, 40.0, 90.0, 0.0), (3, 0.0, 0.0, 0.0, 0.0, 90.0)]
    df = rows(knobs, "id int, lag1 double, precip double, temp double, humidity double, urban double")
    out = [(r.score, r.risk) for r in forecast.scenario_score(df).orderBy("id").collect()]
    assert out == [(69.3, "MODERATE"), (300.0, "VERY HIGH"), (10.0, "LOW")]
    noisy = forecast.scenario_score(df, noise_seed=1).orderBy("id").collect()
    assert abs(noisy[0].score - 69.3) < 10


def test_scenario_features_fill_twenty_inputs(rows):
    schema = "lag1 double, lag2 double, change double, precip double, temp double, humidity double, population double, urban double, health double"
    df = rows([(74.0, 73.0, 1.0, 1500.0, 22.0, 70.0, 1e6, 30.0, 4.0)], schema)
    r = forecast.scenario_features(df).first()
    assert len(r) == 20 and r.precip_days == 150.0 and r.temp_max == 30.0 and r.farm_precip == 900.0
    assert forecast.with_defaults(df, ["lag1", "absent"]).first().absent == 0.0
