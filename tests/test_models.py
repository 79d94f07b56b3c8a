import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwise.operators import cart, models, tuning
from panelwise.operators.models import Spec
from panelwise.plans.catalog import models as catalog
from panelwise.session import landed, new_folder
from panelwise.streaming import score

FEATURES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 3)) * [1, 10, 0.1] + [0, 100, 5]
    y = x @ [3.0, 0.2, -8.0] + rng.normal(size=240) * 0.3 + 40
    return x, y, np.arange(240) // 4  # four rows per period


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y, t = data
    rows = [(int(p), *map(float, r), float(v)) for p, r, v in zip(t, x, y)]
    return landed(spark.createDataFrame(rows, "t int, x1 double, x2 double, x3 double, y double"), "t")


def closed_form(x, y, alpha):
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return lambda new: y.mean() + (new - x.mean(0)) / x.std(0) @ w


@pytest.mark.parametrize("alpha", [0.0, 1.0, 50.0])
def test_linear_models_equal_the_closed_form(frame, data, alpha):
    x, y, _ = data
    model = models.fit(frame, FEATURES, "y", Spec("ridge", {"alpha": alpha}))
    got = models.predict({"p": model}, frame).toPandas()
    np.testing.assert_allclose(got.p, closed_form(x, y, alpha)(got[FEATURES].to_numpy()), rtol=1e-8)


def test_constant_features_and_more_features_than_rows(spark):
    rng = np.random.default_rng(2)
    x = np.hstack([rng.normal(size=(9, 12)), np.full((9, 1), 630.0)])
    y = rng.normal(size=9) * 20 + 100
    names = [f"f{i}" for i in range(13)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], [*names, "y"])
    model = models.fit(df, names, "y", Spec("ridge", {"alpha": 1.0}))
    got = models.predict({"p": model}, df).toPandas()
    np.testing.assert_allclose(got.p, closed_form(x[:, :12], y, 1.0)(got[names[:12]].to_numpy()), rtol=1e-9)
    shares = {r.feature: r.importance for r in models.importances(spark, model, names).collect()}
    assert len(shares) == 13 and shares["f12"] == 0.0 and sum(shares.values()) == pytest.approx(1.0)


def test_missing_inputs_take_the_training_median(spark, frame, data):
    x, _, _ = data
    model = models.fit(frame, FEATURES, "y", Spec("ols"))
    filled = [float(v) for v in np.median(x, axis=0)]
    requests = spark.createDataFrame([(1, None, filled[1]), (2, filled[0], None)], "id int, x1 double, x2 double")
    want = models.predict({"p": model}, spark.createDataFrame([tuple(filled)], FEATURES)).first().p
    out = models.batch_score(requests, model, FEATURES).collect()
    assert [r.predicted for r in out] == [pytest.approx(want, abs=0.006)] * 2
    assert set(out[0].asDict()) == {"id", "x1", "x2", "predicted", "risk"}
    zero = models.batch_score(requests, model, FEATURES, missing="zero").first()
    assert zero.predicted != out[0].predicted


def test_time_split_takes_whole_periods(frame):
    train, test = models.time_split(frame, "t", 5)
    assert train.agg(F.max("t")).first()[0] == 54 and test.count() == 20
    assert train.count() + test.count() == 240


def test_blocks_expand_in_time(frame):
    blocks = models.with_time_blocks(frame, "t", 3).groupBy("block").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    assert sorted(tuple(r) for r in blocks.collect()) == [(0, 0, 14), (1, 15, 29), (2, 30, 44), (3, 45, 59)]
    short = models.with_time_blocks(frame.filter("t < 2"), "t", 3)
    assert short.count() == 8


@pytest.mark.parametrize(
    "spec",
    [
        Spec("random_forest", {"trees": 10, "depth": 4, "min_leaf": 2}),
        Spec("extra_trees", {"trees": 10, "depth": 4}),
        Spec("gbt", {"iterations": 8, "depth": 3, "rate": 0.3}),
    ],
    ids=lambda s: s.kind,
)
def test_trees_beat_the_mean_and_rank_features(spark, frame, data, spec):
    model = models.fit(frame, FEATURES, "y", spec)
    table = models.prediction_table({spec.kind: model}, frame, ["t"], "y")
    error = table.agg(F.avg(F.abs("residual"))).first()[0]
    assert error < np.abs(data[1] - data[1].mean()).mean() * 0.7
    shares = models.importances(spark, model, FEATURES).collect()
    assert sum(r.importance for r in shares) == pytest.approx(1.0)
    assert [r.importance for r in shares] == sorted((r.importance for r in shares), reverse=True)


def test_tuning_matches_folds_done_by_hand(frame, data):
    x, y, t = data
    specs = models.candidates("ridge", {"alpha": [1.0, 500.0]})
    tuned = tuning.cross_validate(frame, FEATURES, "y", "t", specs, scaling="standard", parallelism=2)
    for spec, error in tuned.scores:
        folds = []
        for a, b in ((15, 30), (30, 45), (45, 60)):
            past, now = t < a, (t >= a) & (t < b)
            fit = closed_form(x[past], y[past], spec.params["alpha"])
            folds.append(np.abs(y[now] - fit(x[now])).mean())
        assert error == pytest.approx(np.mean(folds), rel=1e-8)
    assert tuned.winners()["ridge"] == (specs[0], min(e for _, e in tuned.scores))
    assert tuned.unseen.count() == 180 and tuned.column_of(specs[0]) in tuned.unseen.columns


def test_grids_have_thirty_candidates():
    assert sum(len(models.candidates(k, g)) for k, g in models.GRIDS.items()) == 30


def test_stack_learns_from_unseen_predictions(frame, data):
    specs = {"good": Spec("ols"), "flat": Spec("ridge", {"alpha": 1e9})}
    stacked = models.stack(frame, FEATURES, "y", "t", specs)
    out = stacked.transform(frame)
    assert "base_good" not in out.columns
    error = out.agg(F.avg(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    assert error < np.abs(data[1] - data[1].mean()).mean() * 0.3


def test_saved_model_predicts_the_same(frame, spark):
    model = models.fit(frame, FEATURES, "y", Spec("random_forest", {"trees": 5, "depth": 3}), scaling="robust")
    path = new_folder(spark, "model")
    models.save_model(model, path)
    loaded = models.load_first([path + "-newer", path])
    a = models.predict({"p": model}, frame).agg(F.sum("p")).first()[0]
    assert models.predict({"p": loaded}, frame).agg(F.sum("p")).first()[0] == a


def test_requests_stream_through_the_same_scoring(spark, frame):
    model = models.fit(frame, FEATURES, "y", Spec("ols"))
    folder = new_folder(spark, "requests")
    frame.select("t", *FEATURES).limit(50).write.json(folder)
    requests = score.read_requests(spark, folder, "t int, x1 double, x2 double, x3 double")
    out, checkpoint = new_folder(spark, "scored"), new_folder(spark, "progress")
    score.score_requests(requests, model, FEATURES, out, checkpoint, drain=True).awaitTermination()
    batch = models.batch_score(spark.read.schema("t int, x1 double, x2 double, x3 double").json(folder), model, FEATURES)
    got = spark.read.parquet(out)
    assert got.count() == 50 and got.exceptAll(batch.select(got.columns)).count() == 0


def by_folds(frame, spec):
    """Mean fold error of a candidate that is fitted alone."""
    blocks, folds = models.with_time_blocks(frame, "t", 3), []
    for i in (1, 2, 3):
        model = models.fit(blocks.filter(F.col("block") < i).coalesce(1), FEATURES, "y", spec, scaling="none")
        out = models.predict({"p": model}, blocks.filter(F.col("block") == i))
        folds.append(out.agg(F.avg(F.abs(F.col("y") - F.col("p")))).first()[0])
    return np.mean(folds)


def test_tuning_shares_one_boosting_between_iterations_and_kinds(frame):
    specs = models.candidates("gbt", {"iterations": [2, 5], "depth": [2], "rate": [0.3]})
    specs += [Spec("boosted_alt", specs[0].params), Spec("ridge", {"alpha": 1.0})]
    assert len(tuning.shared_fits(specs)) == 2
    errors = [e for _, e in tuning.cross_validate(frame, FEATURES, "y", "t", specs, scaling="none", rows_in_task=0).scores]
    assert errors[0] == errors[2] and len(set(errors)) == 3
    assert errors[:2] == pytest.approx([by_folds(frame, s) for s in specs[:2]], rel=1e-6)


def test_trees_cut_from_a_deeper_forest_are_those_of_a_shallow_one(frame):
    # Without bootstrap and with all features a tree is the same however many there are.
    grid = {"trees": [1, 3], "depth": [1, 3, 7], "min_leaf": [2], "bootstrap": [False]}
    specs = models.candidates("random_forest", grid)
    fits = tuning.shared_fits(specs)
    assert [f.spec.params["depth"] for f in fits.values()] == [7] and list(fits.values())[0].depths == (1, 3, 7)
    errors = [e for _, e in tuning.cross_validate(frame, FEATURES, "y", "t", specs, scaling="none", rows_in_task=0).scores]
    assert errors == pytest.approx([by_folds(frame, s) for s in specs], rel=1e-9)


@pytest.mark.parametrize("kind", ["random_forest", "extra_trees", "gbt"])
def test_leaves_and_their_values_give_the_models_own_predictions(spark, frame, kind):
    params = {"iterations": 6, "depth": 3, "rate": 0.3} if kind == "gbt" else {"trees": 6, "depth": 9}
    spec = Spec(kind, params)
    model = models.fit(frame, FEATURES, "y", spec, scaling="none")
    trees, path = model.stages[-1], new_folder(spark, "model")
    trees.write().save(path)
    weights = list(trees.treeWeights) if kind == "gbt" else [1.0] * 6
    cuts = {"fit0": [] if kind == "gbt" else [2]}
    values = tuning.leaf_values(tuning._nodes(spark.read.parquet(f"{path}/data"), "fit0", 1, weights), cuts)
    trees.setLeafCol("fit0_leaf")
    rows = model.transform(frame).withColumn("fit0_leaf", vector_to_array("fit0_leaf")).withColumn("fold", F.lit(1)).join(values, "fold")
    shared = tuning.shared_fits([spec, Spec(kind, params | {"depth": 2})] if cuts["fit0"] else [spec])[tuning._fit_of(spec)]
    got = rows.select("predicted", tuning._prediction(spec, "fit0", shared).alias("p")).toPandas()
    np.testing.assert_allclose(got.p, got.predicted, rtol=1e-12)
    if cuts["fit0"]:
        cut = rows.agg(F.countDistinct(tuning._prediction(Spec(kind, {"trees": 1, "depth": 2}), "fit0", shared))).first()[0]
        assert cut <= 4


def test_a_stack_of_tuned_candidates_fits_no_fold_again(frame, data, monkeypatch):
    specs = {"good": Spec("ols"), "flat": Spec("ridge", {"alpha": 1e9})}
    tuned = tuning.cross_validate(frame, FEATURES, "y", "t", list(specs.values()), scaling="robust")
    fits, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: fits.append(a) or fit(*a, **k))
    stacked = tuning.stacked(frame, FEATURES, "y", tuned, specs)
    assert len(fits) == 3  # the weights and each base once
    error = stacked.transform(frame).agg(F.avg(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    assert error < np.abs(data[1] - data[1].mean()).mean() * 0.3


def test_registered_grid_holds_every_candidate():
    asked = catalog.all_candidates()
    assert len(asked) == 30 and {s.kind for s in asked} == set(models.GRIDS)
    fits = tuning.shared_fits(asked)
    assert len(fits) == 2 + 2 + 1 + 4  # ridges, forests by leaf size, extra trees, boostings by depth and rate
    assert {f.spec.params["trees"] for k, f in fits.items() if k[0] in tuning.FORESTS} == {150}
    assert {f.spec.params["iterations"] for k, f in fits.items() if k[0] == "gbt"} == {150}


def test_folds_in_tasks_and_distributed_folds_agree(frame, data):
    specs = models.candidates("random_forest", {"trees": [20, 30], "depth": [2, 6], "min_leaf": [2]})
    specs += models.candidates("gbt", {"iterations": [5, 12], "depth": [3], "rate": [0.1]}) + models.candidates("extra_trees", {"trees": [40], "depth": [4, 30]})
    test = frame.filter("t >= 50")
    runs = [tuning.cross_validate(frame.filter("t < 50"), FEATURES, "y", "t", specs, test=test, rows_in_task=n) for n in (0, 10_000)]
    assert [t.unseen.filter("fold = 4").count() for t in runs] == [40, 40]
    for (spec, a), (_, b) in zip(runs[0].scores, runs[1].scores, strict=True):
        assert a == pytest.approx(b, rel=0.2), spec
    for t in runs:
        flat = np.abs(data[1] - data[1].mean()).mean()
        stack = tuning.stacked_test(t, "y", {"a": specs[0], "b": specs[-1]})
        assert stack.agg(F.avg(F.abs(F.col("y") - F.col("predicted")))).first()[0] < flat * 0.6


def test_trees_grown_in_a_task_find_the_splits():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 4))
    y = np.where(x[:, 1] > 0.2, 5.0, np.where(x[:, 3] > -0.5, 1.0, -4.0))
    new = draw.normal(size=(200, 4))
    want = np.where(new[:, 1] > 0.2, 5.0, np.where(new[:, 3] > -0.5, 1.0, -4.0))
    out = cart.forest(x, y, new, [1, 2], [0, 2, 9], 1, False, False, 0)
    assert np.allclose(out[1, 0], y.mean()) and (np.abs(out[2, 2] - want) > 0.5).mean() < 0.06
    boosted = cart.boosting(x, y, new, [1, 20], 2, 0.1, 1, 0)
    assert np.allclose(boosted[1, 2], out[1, 2]) and (np.abs(boosted[20, 2] - want) > 0.5).mean() < 0.12
    few = np.repeat([[1.0], [2.0], [4.0]], 5, axis=0)
    means = cart.forest(few, np.arange(15.0), few[::5], [3], [9], 2, False, True, 0)[3, 9]
    assert np.allclose(means, [2, 7, 12])  # each group its mean
    assert np.allclose(cart.boosting(few, np.ones(15), few, [9], 3, 0.1, 1, 0)[9, 3], 1.0)
