import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import ensemble, quantiles, shape, stats
from panelwise.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def quantile_data():
    rng = np.random.default_rng(7)
    return {
        "uniform": rng.uniform(-5, 5, 999),
        # A third of all values is one and the same.
        "hot": np.where(np.arange(999) % 3 == 0, 4.25, rng.normal(4.25, 1e-6, 999)),
        "outliers": np.concatenate([rng.normal(1e6, 1e-3, 995), [-1e300, 1e300, 0.0, -0.5]]),
        "constant": np.full(999, 2.0),
        "integers": rng.integers(0, 6, 999).astype(float),
        "powers": 10.0 ** rng.integers(-300, 300, 999),
    }


@pytest.mark.parametrize("accuracy", [10_000, 100, 8])
def test_quantiles_against_sorting(spark, accuracy):
    data = quantile_data()
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data)).repartition(5)
    got = exact_quantiles(df, list(data), PROBABILITIES, accuracy)
    for name, values in data.items():
        np.testing.assert_allclose(got[name], np.quantile(values, PROBABILITIES), rtol=1e-12)


@pytest.mark.parametrize("accuracy", [10_000, 8])
def test_quantiles_with_infinities_and_nan(spark, accuracy):
    inf, nan = float("inf"), float("nan")
    values = [float(i) for i in range(150)] + [inf] * 30 + [-inf] * 20 + [nan] * 40
    df = spark.createDataFrame([(v, inf, nan) for v in values], "a double, only double, none double").repartition(4)
    got = exact_quantiles(df, ["a", "only", "none"], [0.0, 0.5, 1.0], accuracy)
    assert got == {"a": [-inf, 79.5, inf], "only": [inf] * 3, "none": [None] * 3}


def test_two_passes_do_whatever_the_distribution(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_narrow", None)
    data = quantile_data()
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data)).repartition(5)
    profiles, got = quantiles.profiled_quantiles(df, list(data), PROBABILITIES)
    for name, values in data.items():
        np.testing.assert_allclose(got[name], np.quantile(values, PROBABILITIES), rtol=1e-12)
        assert profiles[name].n == 999 and profiles[name].low == values.min()


def test_brackets_with_too_many_values_are_narrowed(spark, monkeypatch):
    rounds, narrow = [], quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    monkeypatch.setattr(quantiles, "LISTED", 10)
    values = quantile_data()["uniform"]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], 100)
    np.testing.assert_allclose(got["v"], np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-12)
    assert rounds


def test_quantiles_of_missing_and_single(rows):
    df = rows([(None, 1.0, 1), (None, None, 2)], "a double, b double, c int")
    assert exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [None], "b": [1.0], "c": [1.5]}


def test_correlation(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    y = x * 2 + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y)], "x double, y double, c double")
    df = df.unionByName(spark.createDataFrame([(None, 5.0, 1.0)], df.schema))
    r, none = df.agg(stats.correlation("x", "y"), stats.correlation("c", "y")).first()
    assert r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12) and none is None


def test_dropped_columns_still_drop_later_ones(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=300)
    frame = {"a": a, "b": a + rng.normal(size=300) * 0.1, "c": a + rng.normal(size=300) * 0.2, "d": rng.normal(size=300), "k": np.ones(300)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*frame.values())], list(frame))
    corr = np.abs(np.corrcoef(np.array([frame[c] for c in "abcd"])))
    want = ["abcd"[j] for j in range(4) if (corr[:j, j] > 0.95).any()]
    assert stats.correlated_columns(df, list(frame)) == want
    assert stats.select_features(df, list(frame)) == [c for c in frame if c not in want]


def test_pairs_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(stats, "PAIRS_PER_PASS", 2)
    df = spark.createDataFrame([(float(i), i * 2.0, float(i % 3), -float(i)) for i in range(20)], list("abcd"))
    assert stats.correlated_columns(df, list("abcd")) == ["b", "d"]


@pytest.mark.parametrize("n, pairs", [(0, 2), (1, 2), (2, 1), (7, 1), (9, 6), (10, 10), (40, 28), (5, 10)])
def test_passes_bring_each_two_columns_together(n, pairs, monkeypatch):
    monkeypatch.setattr(stats, "PAIRS_PER_PASS", pairs)
    passes = list(stats._passes(n))
    assert all(p == sorted(p) and len(p) * (len(p) - 1) // 2 <= pairs for p in passes)
    assert {(i, j) for p in passes for i in p for j in p if i < j} == {(i, j) for j in range(n) for i in range(j)}
    assert len(passes) == 1 or n * (n - 1) // 2 > pairs


def test_line_and_curve_against_polyfit(spark):
    rng = np.random.default_rng(11)
    x = np.arange(1990, 2015, dtype=float)
    y = 300 - 4 * (x - 2000) + 0.3 * (x - 2000) ** 2 + rng.normal(size=25)
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    fit = stats.line_fit(df, "x", "y", ["g"])
    row = fit.first()
    np.testing.assert_allclose([row.slope, row.intercept], np.polyfit(x, y, 1), rtol=1e-9)
    residual = y - np.polyval(np.polyfit(x, y, 1), x)
    assert row.sigma == pytest.approx(np.sqrt((residual**2).sum() / 23), rel=1e-9)
    grid = stats.trend_grid(fit, 100).orderBy("step").toPandas()
    np.testing.assert_allclose(grid.x, np.linspace(1990, 2014, 100))
    curve = stats.quadratic_fit(df, "x", "y", ["g"]).first()
    np.testing.assert_allclose([curve.a, curve.b, curve.c], np.polyfit(x - x.mean(), y, 2), rtol=1e-9)


def test_fits_on_constant_x(rows):
    df = rows([("g", 1.0, 2.0), ("g", 1.0, 3.0), ("g", 1.0, 4.0)], "g string, x double, y double")
    row = stats.line_fit(df, "x", "y", ["g"]).first()
    assert row.slope is None and stats.quadratic_fit(df, "x", "y", ["g"]).first().a is None


def test_metrics(rows):
    df = rows([("m", 1.0, 2.0), ("m", 2.0, 2.0), ("m", 4.0, 3.0), ("m", None, 1.0)], "model string, actual double, predicted double")
    m = stats.regression_metrics(df).first()
    y, p = np.array([1, 2, 4.0]), np.array([2, 2, 3.0])
    assert m.mae == pytest.approx(2 / 3) and m.rmse == pytest.approx(np.sqrt(2 / 3)) and m.n == 3
    assert m.r2 == pytest.approx(1 - 2 / ((y - y.mean()) ** 2).sum())
    assert m.mape == pytest.approx((1 + 0 + 0.25) / 3)
    other = stats.regression_metrics_rsq(df).first()
    assert other.rsq == pytest.approx(np.corrcoef(y, p)[0, 1] ** 2)
    assert other.mape == pytest.approx(np.sqrt(2 / 3) / y.mean() * 100)


def test_scalers_against_definition(spark):
    v = [1.0, 2.0, 2.5, 9.0, -3.0]
    df = spark.createDataFrame([(x, 7.0) for x in v], "v double, c double")
    assert stats.standard_parameters(df, ["v", "c"]) == {"v": (pytest.approx(np.mean(v)), pytest.approx(np.std(v))), "c": (7.0, 1.0)}
    q = np.quantile(v, [0.25, 0.5, 0.75])
    assert stats.robust_parameters(df, ["v", "c"]) == {"v": (q[1], pytest.approx(q[2] - q[0])), "c": (7.0, 1.0)}


# Published test errors and the weights published for them.
ERRORS = {"Ridge": 0.7445619278546637, "Random Forest": 0.17110314224523868, "Gradient Boosting": 0.16896905554337302, "Extra Trees": 0.4796194669076993, "XGBoost": 0.14578867864098485}
WEIGHTS = {"Ridge": 0.06091061007022131, "Random Forest": 0.26505367769703864, "Gradient Boosting": 0.2684012976468269, "Extra Trees": 0.09455764568117457, "XGBoost": 0.31107676890473857}


def test_published_weights(rows):
    df = rows(list(ERRORS.items()), "model string, mae double")
    got = {r.model: r.weight for r in ensemble.inverse_error_weights(df).collect()}
    assert got == {m: pytest.approx(w, abs=1e-12) for m, w in WEIGHTS.items()}
    assert sum(got.values()) == pytest.approx(1.0)


def test_pivots_first_and_last(rows):
    df = rows([(1, "a", None, 1), (1, "a", 2.0, 2), (1, "a", None, 3), (2, "b", 5.0, 1)], "y int, i string, v double, o int")
    first = {r.y: (r.a, r.b) for r in shape.pivot_first(df, ["y"], "i", ["a", "b"], "v", "o").collect()}
    last = {r.y: (r.a, r.b) for r in shape.pivot_last(df, ["y"], "i", ["a", "b"], "v", "o").collect()}
    assert first == {1: (2.0, None), 2: (None, 5.0)} and last == {1: (None, None), 2: (None, 5.0)}


def test_missing_report_only_names_gaps(rows):
    from panelwise.operators.aggregate import missing_report

    df = rows([(1, None, None), (2, None, 1.0)], "a int, b double, c double")
    assert [tuple(r) for r in missing_report(df).collect()] == [("b", 2), ("c", 1)]


def test_min_max_of_a_constant_is_null(rows):
    df = rows([(3,), (3,)], "v int")
    assert [r.n for r in stats.min_max(df, "v", "n").collect()] == [None, None]
    spread = stats.min_max(rows([(1,), (5,), (2,)], "v int"), "v", "n").orderBy(F.col("v"))
    assert [r.n for r in spread.collect()] == [0.0, 0.25, 1.0]


def test_co_moments_of_pairs_with_gaps(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 6)) * [1, 5, 1e-3, 1, 1, 1] + [1e6, 0, 3, -2, 0, 0]
    x[:, 3] = 2 * x[:, 1] + 1e-3 * x[:, 3]
    x[:, 5] = 7.0
    x[rng.random((700, 6)) < 0.2] = np.nan
    x[:, 4] = np.where(np.isnan(x[:, 0]), x[:, 4], np.nan)  # never known together with the first
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, [f"c{i}" for i in range(6)]).repartition(7)
    got = {(r.i, r.j): r for r in stats.co_moments(df, df.columns).collect()}
    assert (0, 4) not in got
    for (i, j), r in got.items():
        a, b = x[:, i], x[:, j]
        both = ~np.isnan(a) & ~np.isnan(b)
        a, b = a[both], b[both]
        assert r.n == both.sum() and r.mean_x == pytest.approx(a.mean()) and r.mean_y == pytest.approx(b.mean())
        want = [((a - a.mean()) ** 2).sum(), ((b - b.mean()) ** 2).sum(), ((a - a.mean()) * (b - b.mean())).sum()]
        np.testing.assert_allclose([r.sxx, r.syy, r.sxy], want, rtol=1e-7, atol=1e-7)
    assert stats.correlated_columns(df, df.columns) == ["c3"]


def test_correlations_of_many_columns_read_the_rows_once(spark, monkeypatch):
    df = spark.range(500).selectExpr(*[f"CAST(hash(id, {k}) AS DOUBLE) AS c{k}" for k in range(50)], "CAST(hash(id, 3) AS DOUBLE) * 2 + 1 AS c50")
    written = []
    landed = stats.landed
    monkeypatch.setattr(stats, "landed", lambda df, label: written.append(label) or landed(df, label))
    assert stats.correlated_columns(df, df.columns) == ["c50"] and written == ["moments"]
