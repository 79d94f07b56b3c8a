"""Cross-validation over expanding folds in which nested candidates share one fit.

A forest of 100 trees is the first 100 of a larger one, a shallower tree is the top of a deeper one that
sees the same features, and a shorter boosting is the beginning of a longer one. So candidates that differ
in trees, depth (forests) or iterations (boostings) are one fit a fold, the largest of them. All predictions
for unseen periods are written once: fold errors are aggregates of them, and a stack learns its weights
from them without fitting anything again.

Folds of up to ``rows_in_task`` rows need not pay for a job a tree level: each fit of each fold is one task
(``cart``), all of them one job. Larger folds are fitted by the distributed learner. Its models are saved;
their node tables are read back and turned into the value of each leaf at each wanted depth. Rows meet
those by their leaf numbers, one equi-join on the fold for all models, and predictions are sums over the
first trees.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwise.operators import cart, models
from panelwise.operators.models import VECTOR, Spec
from panelwise.session import landed, new_folder, on_workers

BOOSTED = ("gbt", "boosted_alt")
FORESTS = ("random_forest", "extra_trees")
#: Rows a task of the distributed learner works on; more tasks only add to each level of each tree.
ROWS_PER_TASK = 100_000
#: Rows up to which a task fits a fold alone.
ROWS_IN_TASK = 20_000
SEED = 42


@dataclass(frozen=True)
class Tuned:
    """Fold errors of all candidates and the predictions behind them.

    ``unseen`` holds fold, label and a column for each different candidate, each row predicted by models
    of earlier periods only; ``column_of`` names the column of a candidate. Rows to test on, if any, are
    one fold more, predicted by models of all of ``train``, and count in no error.
    """

    scores: list[tuple[Spec, float]]
    unseen: DataFrame
    columns: Mapping[tuple, str]
    folds: int = 3

    def column_of(self, spec: Spec) -> str:
        return self.columns[_candidate(spec)]

    def winners(self) -> dict[str, tuple[Spec, float]]:
        """Per kind the candidate of smallest error; the earlier one of equals."""
        best: dict[str, tuple[Spec, float]] = {}
        for spec, error in self.scores:
            if spec.kind not in best or error < best[spec.kind][1]:
                best[spec.kind] = (spec, error)
        return best


@dataclass(frozen=True)
class Shared:
    """One fit for many candidates: its largest trees or iterations, and the depths wanted of it."""

    spec: Spec
    depths: tuple[int, ...]


def _kind(spec: Spec) -> str:
    return "gbt" if spec.kind in BOOSTED else spec.kind


def _candidate(spec: Spec) -> tuple:
    """What two candidates must have in common to be the same model."""
    return _kind(spec), tuple(sorted(spec.params.items()))


def _fit_of(spec: Spec) -> tuple:
    """What candidates that share a fit have in common."""
    free = {"iterations"} if spec.kind in BOOSTED else {"trees", "depth"} if spec.kind in FORESTS else set()
    return _kind(spec), tuple(sorted((k, v) for k, v in spec.params.items() if k not in free))


def _depth(spec: Spec) -> int:
    return int(spec.params.get("depth", 3 if spec.kind in BOOSTED else 5))


def _trees(spec: Spec) -> int:
    return int(spec.params.get("iterations" if spec.kind in BOOSTED else "trees", 100))


def shared_fits(specs: Sequence[Spec]) -> dict[tuple, Shared]:
    """The fits that serve all candidates."""
    groups: dict[tuple, list[Spec]] = {}
    for s in specs:
        groups.setdefault(_fit_of(s), []).append(s)
    out = {}
    for key, some in groups.items():
        params = dict(key[1])
        if key[0] in FORESTS:
            params |= {"trees": max(map(_trees, some)), "depth": max(map(_depth, some))}
        elif key[0] == "gbt":
            params["iterations"] = max(map(_trees, some))
        depths = tuple(sorted({_depth(s) for s in some})) if key[0] in FORESTS else ()
        out[key] = Shared(Spec(key[0], params), depths)
    return out


def cross_validate(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    period: str,
    specs: Sequence[Spec],
    folds: int = 3,
    scaling: str = "robust",
    parallelism: int = 12,
    test: DataFrame | None = None,
    rows_in_task: int = ROWS_IN_TASK,
) -> Tuned:
    """Errors (MAE, mean of the folds) of every candidate, and all predictions for unseen periods.

    Folds expand in time, and each is prepared by itself. Linear models and large folds are fitted side
    by side, as ordinary distributed jobs, from a small thread pool.
    """
    wanted = [F.col(label).cast("double").alias(label), *features, "block"]
    blocks = models.with_time_blocks(train.dropna(subset=[label]), period, folds).select(*wanted)
    if test is not None:
        blocks = blocks.unionByName(test.dropna(subset=[label]).withColumn("block", F.lit(folds + 1)).select(*wanted))
    blocks = landed(blocks.withColumn("row", F.monotonically_increasing_id()), "folds")
    numbers = range(1, folds + 1 + (test is not None))
    small = blocks.limit(rows_in_task + 1).count() <= rows_in_task
    fits = shared_fits(specs)
    names = {key: f"fit{n}" for n, key in enumerate(fits)}
    leaves = [key for key in fits if key[0] in (*FORESTS, "gbt")]

    with ThreadPool(parallelism) as pool:

        def prepared(i: int) -> tuple[DataFrame, DataFrame, tuple]:
            past, following = blocks.filter(F.col("block") < i), blocks.filter(F.col("block") == i)
            stages = PipelineModel(models.preparation(past, features, scaling))
            past, following = (stages.transform(x).select("row", label, VECTOR) for x in (past, following))
            n, deviation = past.agg(F.count(label), F.stddev_pop(label)).first()
            return past.coalesce(max(1, -(-n // ROWS_PER_TASK))), following, (n, deviation or 0.0)

        parts = dict(zip(numbers, pool.map(prepared, numbers, chunksize=1), strict=True))

        def linear(task: tuple[tuple, int]):
            key, i = task
            past, _, (n, deviation) = parts[i]
            return models._estimator(fits[key].spec, label, names[key], n, deviation).fit(past)

        tasks = [(key, i) for key in fits if key not in leaves for i in numbers]
        lines = dict(zip(tasks, pool.map(linear, tasks, chunksize=1), strict=True))
        made = (_in_tasks if small else _distributed)(parts, label, fits, names, specs, pool) if leaves else None

    scored = []
    for i, (_, following, _) in parts.items():
        for key in fits:
            following = lines[key, i].transform(following) if key not in leaves else following
        scored.append(following.drop(VECTOR).withColumn("fold", F.lit(i)))
    rows = reduce(DataFrame.unionByName, scored)
    rows = rows.join(made, ["fold", "row"]) if made is not None else rows

    columns = {c: f"candidate{n}" for n, c in enumerate(dict.fromkeys(map(_candidate, specs)))}
    chosen = {_candidate(s): F.col(columns[_candidate(s)] if _fit_of(s) in leaves else names[_fit_of(s)]) for s in specs}
    unseen = landed(rows.select("fold", label, *[chosen[c].alias(n) for c, n in columns.items()]), "unseen")
    each = unseen.filter(F.col("fold") <= folds).groupBy("fold").agg(*[F.avg(F.abs(F.col(label) - F.col(c))).alias(c) for c in columns.values()]).collect()
    errors = {c: sum(r[c] for r in each) / len(each) if each else math.nan for c in columns.values()}
    return Tuned([(s, errors[columns[_candidate(s)]]) for s in specs], unseen, columns, folds)


def _candidate_columns(specs: Sequence[Spec]) -> dict[str, Spec]:
    """The columns of tree candidates, as ``cross_validate`` names them."""
    different = {_candidate(s): s for s in reversed(specs)}
    order = dict.fromkeys(map(_candidate, specs))
    return {f"candidate{n}": different[c] for n, c in enumerate(order) if c[0] in (*FORESTS, "gbt")}


def _in_tasks(parts, label: str, fits: Mapping[tuple, Shared], names: Mapping[tuple, str], specs: Sequence[Spec], _pool) -> DataFrame:
    """fold, row and a column for each tree candidate: a task for each fit of each fold."""
    columns = _candidate_columns(specs)
    by_fit: dict[str, list[tuple[str, Spec]]] = {}
    for c, s in columns.items():
        by_fit.setdefault(names[_fit_of(s)], []).append((c, s))
    sides = []
    for i, (past, following, _) in parts.items():
        for is_past, rows in ((True, past), (False, following)):
            sides.append(rows.select(F.lit(i).alias("fold"), F.lit(is_past).alias("past"), "row", F.col(label).alias("y"), vector_to_array(VECTOR).alias("x")))
    on_workers(sides[0].sparkSession)
    asked = reduce(DataFrame.unionByName, sides).withColumn("fit", F.explode(F.array(*[F.lit(f) for f in by_fit])))
    shared = {names[key]: f.spec for key, f in fits.items()}

    def one_fit(rows: pa.Table) -> pa.Table:
        fit, fold = rows["fit"][0].as_py(), rows["fold"][0].as_py()
        values = _fitted_in_task(rows, shared[fit], [s for _, s in by_fit[fit]])
        seen = rows.filter(pc.invert(rows["past"]))
        return pa.table({
            "fold": pa.array([fold] * len(seen), pa.int32()), "row": seen["row"], "fit": pa.array([fit] * len(seen)),
            "p": pa.array(list(np.stack(values, axis=1)), pa.list_(pa.float64())),
        })

    found = asked.groupBy("fit", "fold").applyInArrow(one_fit, "fold int, row long, fit string, p array<double>")
    cells = [F.max(F.when(F.col("fit") == f, F.get("p", F.lit(n)))).alias(c) for f, some in by_fit.items() for n, (c, _) in enumerate(some)]
    return found.groupBy("fold", "row").agg(*cells)


def _fitted_in_task(rows: pa.Table, spec: Spec, candidates: Sequence[Spec]) -> list[np.ndarray]:
    """Each candidate's predictions for the rows that are not past; rows count in the order of their values."""
    past, y = rows["past"].to_numpy(), rows["y"].to_numpy()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    mine, others = np.flatnonzero(past), np.flatnonzero(~past)
    mine = mine[np.lexsort((*x[mine].T, y[mine]))]
    p, min_leaf = spec.params, int(spec.params.get("min_leaf", 1))
    sizes, depths = sorted({_trees(s) for s in candidates}), sorted({_depth(s) for s in candidates})
    if spec.kind in FORESTS:
        extra = spec.kind == "extra_trees"
        out = cart.forest(x[mine], y[mine], x[others], sizes, depths, min_leaf, bool(p.get("bootstrap", not extra)), extra, SEED)
    else:
        out = cart.boosting(x[mine], y[mine], x[others], sizes, depths[0], float(p.get("rate", 0.1)), min_leaf, SEED)
    return [out[_trees(s), _depth(s)] for s in candidates]


def _distributed(parts, label: str, fits: Mapping[tuple, Shared], names: Mapping[tuple, str], specs: Sequence[Spec], pool: ThreadPool) -> DataFrame:
    """fold, row and a column for each tree candidate, from models of the distributed learner."""
    leaves = [key for key in fits if key[0] in (*FORESTS, "gbt")]
    kept = {i: past.persist(StorageLevel.MEMORY_AND_DISK) for i, (past, _, _) in parts.items()}
    spark = kept[1].sparkSession

    def fitted(task: tuple[tuple, int]):
        key, i = task
        n, deviation = parts[i][2]
        model = models._estimator(fits[key].spec, label, names[key], n, deviation).fit(kept[i])
        path = new_folder(spark, "tree-model")
        model.write().save(path)
        return model, path

    try:
        # The longest fits first, so that no thread ends with one of them.
        tasks = sorted(((key, i) for key in leaves for i in parts), key=lambda t: -_trees(fits[t[0]].spec) * _depth(fits[t[0]].spec))
        done = dict(zip(tasks, pool.map(fitted, tasks, chunksize=1), strict=True))
    finally:
        for frame in kept.values():
            frame.unpersist()

    scored, tables = [], []
    for i, (_, following, _) in parts.items():
        for key in leaves:
            model, path = done[key, i]
            leaf = f"{names[key]}_leaf"
            following = model.setLeafCol(leaf).setPredictionCol("").transform(following).withColumn(leaf, vector_to_array(leaf))
            weights = [1.0] * _trees(fits[key].spec) if key[0] in FORESTS else list(model.treeWeights)
            tables.append(_nodes(spark.read.parquet(f"{path}/data"), names[key], i, weights))
        scored.append(following.drop(VECTOR).withColumn("fold", F.lit(i)))
    cuts = {names[key]: list(fits[key].depths[:-1]) for key in leaves}
    rows = reduce(DataFrame.unionByName, scored).join(leaf_values(reduce(DataFrame.unionByName, tables), cuts), "fold")
    wanted = [_prediction(s, names[_fit_of(s)], fits[_fit_of(s)]).alias(c) for c, s in _candidate_columns(specs).items()]
    return rows.select("fold", "row", *wanted)


def _nodes(data: DataFrame, fit: str, fold: int, weights: Sequence[float]) -> DataFrame:
    """The nodes of a saved model: fit, fold, tree, id (in pre-order), value (prediction times the tree's weight), left, right."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("treeID") + 1)
    return data.select(
        F.lit(fit).alias("fit"), F.lit(fold).alias("fold"), F.col("treeID").alias("tree"), "nodeData.id",
        (F.col("nodeData.prediction") * weight).alias("value"), F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
    )


def leaf_values(nodes: DataFrame, cuts: Mapping[str, Sequence[int]]) -> DataFrame:
    """One row a fold, with a column for each fit and depth: for each tree the values of its leaves, left to right.

    ``cuts`` lists, for each fit, depths at which trees are cut: a deeper leaf takes the value of the node
    above it there. Nodes are numbered in pre-order, so that is the last node of that depth before the leaf.
    """
    tree = ["fit", "fold", "tree"]
    deepest = max((d for some in cuts.values() for d in some), default=0)
    cut_fits = [f for f, some in cuts.items() if some]
    level = nodes.filter((F.col("id") == 0) & F.col("fit").isin(cut_fits)).select(*tree, "id", F.lit(0).alias("depth"))
    levels = level
    inner = nodes.filter((F.col("left") >= 0) & F.col("fit").isin(cut_fits)).select(*tree, "id", F.array("left", "right").alias("below"))
    for d in range(1, deepest + 1):
        level = level.join(inner, [*tree, "id"]).select(*tree, F.explode("below").alias("id"), F.lit(d).alias("depth"))
        levels = levels.unionByName(level)
    known = nodes.join(levels, [*tree, "id"], "left") if deepest else nodes.withColumn("depth", F.lit(None).cast("int"))
    in_order = Window.partitionBy(*tree).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    depths = sorted({d for some in cuts.values() for d in some})
    above = {f"at{d}": F.when(F.col("depth") <= d, F.col("value")).otherwise(F.last(F.when(F.col("depth") == d, F.col("value")), ignorenulls=True).over(in_order)) for d in depths}
    values = known.withColumns(above).filter("left < 0").groupBy(*tree)
    shown = ["value", *above]
    arrays = values.agg(*[_listed("id", c).alias(c) for c in shown])
    by_fit = arrays.groupBy("fit", "fold").agg(*[_listed("tree", c).alias(c) for c in shown])
    out = []
    for f, some in cuts.items():
        for column, name in [("value", f), *((f"at{d}", f"{f}_{d}") for d in some)]:
            out.append(F.max(F.when(F.col("fit") == f, F.struct(F.lit(1), column))).getField(column).alias(f"{name}_values"))
    return by_fit.groupBy("fold").agg(*out)


def _listed(order: str, column: str) -> Column:
    """The values of a column in a group as one array, in that order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, column))), lambda x: x[column])


def _prediction(spec: Spec, name: str, shared: Shared) -> Column:
    """A candidate's prediction from leaves and their values."""
    cut = spec.kind in FORESTS and _depth(spec) < shared.depths[-1]
    values, n = F.col(f"{name}_{_depth(spec)}_values" if cut else f"{name}_values"), _trees(spec)
    first = F.slice(F.arrays_zip(F.col(f"{name}_leaf").alias("leaf"), values.alias("values")), 1, n)
    total = F.aggregate(first, F.lit(0.0), lambda sum_, t: sum_ + F.get(t["values"], t["leaf"].cast("int")))
    return total / n if spec.kind in FORESTS else total


def meta_model(tuned: Tuned, label: str, specs: Mapping[str, Spec], meta: Spec = Spec("ridge", {"alpha": 1.0})) -> PipelineModel:
    """The model over the candidates' predictions of unseen periods, columns ``base_<name>``."""
    names = {f"base_{name}": spec for name, spec in specs.items()}
    unseen = base_predictions(tuned, label, specs).filter(F.col("fold") <= tuned.folds)
    return models.fit(unseen, list(names), label, meta, scaling="none")


def base_predictions(tuned: Tuned, label: str, specs: Mapping[str, Spec]) -> DataFrame:
    return tuned.unseen.select("fold", label, *[F.col(tuned.column_of(s)).alias(f"base_{n}") for n, s in specs.items()])


def stacked_test(tuned: Tuned, label: str, specs: Mapping[str, Spec]) -> DataFrame:
    """label, predicted: the test fold as the stack of these candidates predicts it."""
    test = base_predictions(tuned, label, specs).filter(F.col("fold") == tuned.folds + 1)
    return models.predict({"predicted": meta_model(tuned, label, specs)}, test).select(label, "predicted")


def base_weights(errors: Mapping[str, float]) -> dict[str, float]:
    """Weights that go with 1 / error and add up to 1."""
    raw = {name: 1 / (error + 1e-6) for name, error in errors.items()}
    return {name: r / sum(raw.values()) for name, r in raw.items()}


def ensemble_errors(tuned: Tuned, label: str, specs: Mapping[str, Spec], stack_of: Sequence[str]) -> dict[str, float]:
    """Fold errors of the weighted mean of all candidates and of the stack of some, each learnt on the other folds."""
    rows = base_predictions(tuned, label, specs).filter(F.col("fold") <= tuned.folds)
    error = {n: F.avg(F.abs(F.col(label) - F.col(f"base_{n}"))).alias(n) for n in specs}
    each = {r["fold"]: r for r in rows.groupBy("fold").agg(*error.values()).collect()}
    sums = {"weighted": 0.0, "stacking": 0.0}
    for k in each:
        others = [r for fold, r in each.items() if fold != k] or list(each.values())
        weights = base_weights({n: sum(r[n] for r in others) / len(others) for n in specs})
        mean = reduce(lambda a, b: a + b, [F.col(f"base_{n}") * w for n, w in weights.items()])
        learnt = rows.filter(F.col("fold") != k) if len(each) > 1 else rows
        meta = models.fit(learnt, [f"base_{n}" for n in stack_of], label, Spec("ridge", {"alpha": 1.0}), scaling="none")
        seen = models.predict({"stacking": meta}, rows.filter(F.col("fold") == k).withColumn("weighted", mean))
        found = seen.agg(*[F.avg(F.abs(F.col(label) - F.col(n))).alias(n) for n in sums]).first()
        sums = {n: sums[n] + found[n] for n in sums}
    return {n: total / max(1, len(each)) for n, total in sums.items()}


def stacked(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    tuned: Tuned,
    specs: Mapping[str, Spec],
    scaling: str = "robust",
    parallelism: int = 4,
) -> models.Stack:
    """A stack to keep: weights from the tuning's predictions, bases fitted on all of ``train``."""
    prepared = models.preparation(train.dropna(subset=[label]), features, scaling)
    names = {f"base_{name}": spec for name, spec in specs.items()}
    with ThreadPool(parallelism) as pool:
        bases = pool.map(lambda item: models.fit(train, features, label, item[1], prepared=prepared, output=item[0]), names.items(), chunksize=1)
    return models.Stack(dict(zip(names, bases, strict=True)), meta_model(tuned, label, specs))
