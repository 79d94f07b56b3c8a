"""Windows against hand-made series, pandas, and the published feature table's numbers."""

import numpy as np
import pandas as pd
import pytest

from panelwise.operators import aggregate, rank, window

KEYS, TIME = ["city"], ["t"]
SERIES = [3.0, None, 5.0, 0.0, 4.0, 4.0, None, None, 10.0, 7.0, 1.0, 2.0, 8.0]


@pytest.fixture
def two_cities(rows):
    """The same series twice, the second doubled, rows out of order."""
    data = [("a", t, v) for t, v in enumerate(SERIES)]
    data += [("b", t, None if v is None else 2 * v) for t, v in enumerate(SERIES)]
    return rows(data[::-1], "city string, t int, v double")


def column(df, name, city="a"):
    got = df.filter(f"city = '{city}'").orderBy("t").select(name).toPandas()[name]
    return got.astype(float).to_numpy()


def same(got, want):
    np.testing.assert_allclose(got, np.asarray(want, dtype=float), rtol=1e-12, atol=1e-12)


def test_rolling_matches_pandas(two_cities):
    s = pd.Series(SERIES, dtype=float)
    out = window.with_rolling(two_cities, ["v"], KEYS, TIME, means=(3, 5), deviations=(3, 6))
    for n in (3, 5):
        same(column(out, f"v_roll{n}"), s.rolling(n, min_periods=1).mean())
        same(column(out, f"v_roll{n}", "b"), 2 * s.rolling(n, min_periods=1).mean())
    for n in (3, 6):
        same(column(out, f"v_std{n}"), s.rolling(n, min_periods=1).std())
    full = two_cities.withColumn("f", window.rolling_mean_full("v", 3, KEYS, TIME))
    same(column(full, "f"), s.rolling(3).mean())


def test_changes(two_cities):
    s = pd.Series(SERIES, dtype=float)
    same(column(window.with_change(two_cities, "v", KEYS, TIME), "change"), s.diff())
    filled = s.ffill()
    want = (filled / filled.shift(1) - 1).where(filled.shift(1) != 0) * 100
    same(column(window.with_pct_change(two_cities, "v", KEYS, TIME, fill_gaps=True), "change_pct"), want)
    strict = (s / s.shift(1) - 1).where(s.shift(1) != 0) * 100
    same(column(window.with_pct_change(two_cities, "v", KEYS, TIME), "change_pct"), strict)


def test_lags(two_cities):
    s = pd.Series(SERIES, dtype=float)
    out = window.with_lags(two_cities, {"v": (1, 2)}, KEYS, TIME)
    same(column(out, "v_lag2"), s.shift(2))
    guarded = window.with_guarded_lags(two_cities, {"v": (1,)}, KEYS, TIME)
    same(column(guarded, "v_lag1"), s.shift(1).where(s.notna()))


def test_global_anomaly_per_key_and_overall(two_cities):
    s = pd.Series(SERIES, dtype=float)
    same(column(window.with_global_anomaly(two_cities, "v", "x", KEYS), "x", "b"), 2 * (s - s.mean()))
    same(column(window.with_global_anomaly(two_cities, "v", "x"), "x"), s - 1.5 * s.mean())


def test_group_results_reach_null_keys(rows):
    df = rows([(None, 1, 2.0), (None, 2, 4.0), ("a", 1, 1.0)], "city string, t int, v double")
    out = window.with_global_anomaly(df, "v", "x", KEYS).orderBy("city", "t").collect()
    assert [r.x for r in out] == [-1.0, 1.0, 0.0]


def test_pct_from_first_uses_the_earliest_known_value(rows):
    df = rows([("a", 3, 6.0), ("a", 1, None), ("a", 2, 4.0), ("b", 1, 0.0), ("b", 2, 1.0)], "city string, t int, v double")
    out = window.with_pct_from_first(df, "v", KEYS, TIME).orderBy("city", "t").collect()
    assert [r.change_pct for r in out] == [None, 0.0, 50.0, None, None]


def test_complete_calendar(rows):
    df = rows([("a", 2020, 11, 1.0), ("a", 2021, 2, 2.0), ("b", 2020, 1, 3.0)], "city string, year int, month int, v double")
    out = [tuple(r) for r in window.complete_calendar(df, KEYS).orderBy("city", "year", "month").collect()]
    assert out == [("a", 2020, 11, 1.0), ("a", 2020, 12, None), ("a", 2021, 1, None), ("a", 2021, 2, 2.0), ("b", 2020, 1, 3.0)]


# Published series and the features published for them.
INCIDENCE = [(2000, 220.26), (2001, 243.23), (2002, 227.55)]
RAIN_AND_TEMP = [
    (2020, 15782.33, 20.735573770491804),
    (2021, 9203.75, 21.031390410958906),
    (2022, 9716.21, 21.05320205479452),
    (2023, 13909.65, 21.228383561643835),
    (2024, 14217.68, 21.35904713114754),
]


def test_published_changes(rows):
    df = rows([("x", y, v) for y, v in INCIDENCE], "city string, t int, v double")
    out = window.with_pct_change(window.with_change(df, "v", KEYS, TIME), "v", KEYS, TIME, fill_gaps=True)
    same(column(out, "change", "x")[1:], [22.97, -15.68])
    assert column(out, "change_pct", "x")[1] == pytest.approx(10.428584400254248, abs=1e-9)


def test_published_anomalies(rows):
    df = rows([("x", *r) for r in RAIN_AND_TEMP], "city string, t int, rain double, temp double")
    out = window.with_trailing_anomaly(df, "rain", 5, KEYS, TIME, "r")
    out = window.with_trailing_anomaly(out, "temp", 5, KEYS, TIME, "w")
    assert column(out, "r", "x")[-1] == pytest.approx(1651.756, abs=1e-6)
    assert column(out, "w", "x")[-1] == pytest.approx(0.27752774534, abs=1e-9)


def test_ranking_ties_and_missing(rows):
    df = rows([("a", 1, 9.0), ("a", 2, 5.0), ("b", 2, 7.0), ("c", 2, 7.0), ("d", 2, None)], "e string, y int, v double")
    out = rank.latest_ranking(df, "y", "v", "e").collect()
    assert [(r.e, r["rank"]) for r in out] == [("b", 1), ("c", 1), ("a", 3)]


def test_best_by_ignores_missing_and_settles_ties(rows):
    df = rows([("b", 1.0, None), ("a", 1.0, 0.2), ("c", None, 0.9)], "model string, mae double, r2 double")
    assert tuple(rank.best_by(df, errors=["mae"], scores=["r2"]).first()) == ("a", "c")


def test_extremes_and_latest(rows):
    df = rows([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("b", 1, None)], "city string, t int, v double")
    out = {r.city: r for r in aggregate.extremes(df, "v", "t", KEYS).collect()}
    assert (out["a"].peak_t, out["a"].low_t, out["b"].peak) == (1, 1, None)
    latest = {r.city: r.v for r in aggregate.latest_known(df, ["v"], "t", KEYS).collect()}
    last = {r.city: r.v for r in aggregate.last_row(df, ["v"], "t", KEYS).collect()}
    assert latest == {"a": 5.0, "b": None} and last == {"a": None, "b": None}


def test_global_rank_equals_a_window_over_everything(spark):
    rows = [(i, float(v)) for i, v in enumerate([3, 1, 3, 3, 2, 5, 5, -1, 0] * 40)] + [(1000 + i, i * 0.37 % 7) for i in range(500)] + [(5000, None)]
    df = spark.createDataFrame(rows, "id int, v double").repartition(4)
    got = {r.id: r["rank"] for r in rank.global_rank(df, "v").collect()}
    values = sorted((v for _, v in rows if v is not None), reverse=True)
    first = {}
    for place, v in enumerate(values, 1):
        first.setdefault(v, place)
    assert got == {i: None if v is None else first[v] for i, v in rows}


def test_pages_follow_one_another_from_the_last_key(spark):
    rows = [(a, b, 0) for a in (None, 1, 2, 3) for b in (None, 1, 2, 3, 4, 5, 6) if a or b]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(3)
    order, after, seen = ["a", "b"], None, []
    while True:
        page = rank.page(df, order, 4, after)
        after = rank.last_key(page, order)
        if after is None:
            break
        seen += [(r.a, r.b) for r in page.collect()]
    assert seen == [(r.a, r.b) for r in df.orderBy("a", "b").collect()] and len(seen) == len(rows)


def test_a_later_page_moves_a_page_only(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice")
    plan = rank.page(df, ["o_orderkey"], 10, {"o_orderkey": 1400})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and "GreaterThanOrEqual(o_orderkey,1400)" in plan
