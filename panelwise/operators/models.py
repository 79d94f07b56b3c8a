"""Regression on panels with MLlib.

A fitted model is one ``PipelineModel``: fill and scale (SQL expressions with the fitted numbers
in them), assemble, predict. What is saved, loaded or applied to a stream is that one object, so
inputs can never meet a scaler other than the one the model was trained with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelwise.functions.derive import risk_band, split_tag
from panelwise.operators import stats
from panelwise.operators.quantiles import profiled_quantiles
from panelwise.operators.shape import union_all

SEED = 42
VECTOR = "_features"
INPUT = "_in_"


@dataclass(frozen=True)
class Spec:
    """A kind of model and its parameters."""

    kind: str
    params: Mapping[str, float] = field(default_factory=dict)


# The annual model line-up.
ANNUAL_MODELS = {
    "ridge": Spec("ridge", {"alpha": 1.0}),
    "random_forest": Spec("random_forest", {"trees": 100, "depth": 5, "min_leaf": 2}),
    "gbt": Spec("gbt", {"iterations": 100, "depth": 3, "rate": 0.1, "min_leaf": 2}),
    "boosted_alt": Spec("gbt", {"iterations": 200, "depth": 4, "rate": 0.1}),
}

# The parameter grids of the tuned models, 30 candidates.
GRIDS: dict[str, dict[str, list]] = {
    "ridge": {"alpha": [1.0, 10.0]},
    "random_forest": {"trees": [100, 150], "depth": [5, 10], "min_leaf": [3, 5]},
    "gbt": {"iterations": [100, 150], "depth": [3, 5], "rate": [0.05, 0.1]},
    "extra_trees": {"trees": [100, 150], "depth": [5, 30]},
    "boosted_alt": {"iterations": [100, 150], "depth": [3, 5], "rate": [0.05, 0.1]},
}


def candidates(kind: str, grid: Mapping[str, Sequence]) -> list[Spec]:
    names = list(grid)
    return [Spec(kind, dict(zip(names, values, strict=True))) for values in product(*grid.values())]


# --- splits ---------------------------------------------------------------------------------


def time_split(df: DataFrame, period: str, n_test: int = 5) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``n_test`` distinct periods are the test side."""
    return split_at(df, period, first_test_period(df, period, n_test))


def first_test_period(df: DataFrame, period: str, n_test: int) -> Column:
    """The earliest of the last ``n_test`` distinct periods."""
    last = df.select(period).distinct().orderBy(F.desc(period)).limit(n_test)
    return last.agg(F.min(period)).scalar()


def split_at(
    df: DataFrame, period: str, first_test: int | Column
) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(period) < first_test), df.filter(F.col(period) >= first_test)


def with_time_blocks(df: DataFrame, period: str, blocks: int, name: str = "block") -> DataFrame:
    """Number the rows 0..blocks by consecutive runs of distinct periods.

    Runs 1..blocks have equal length and end at the last period, run 0 takes the rest: training
    on all runs below i and testing on run i gives expanding folds. Only the distinct periods,
    a calendar, are numbered in one task.
    """
    calendar = df.select(period).distinct()
    w = Window.partitionBy(F.lit(1))
    ordered = calendar.select(
        period,
        F.row_number().over(w.orderBy(F.desc(period))).alias("from_end"),
        F.greatest(F.floor(F.count(F.lit(1)).over(w) / (blocks + 1)), F.lit(1)).alias("size"),
    )
    block = F.greatest(blocks - F.floor((F.col("from_end") - 1) / F.col("size")), F.lit(0))
    return df.join(ordered.select(period, block.cast("int").alias(name)), period, "left")


# --- fitting --------------------------------------------------------------------------------


def preparation(
    train: DataFrame, features: Sequence[str], scaling: str = "standard", fill: str = "median"
) -> list:
    """[fill and scale, assemble], fitted on ``train``.

    A feature that is constant there can neither be weighed nor split on and is left out; the
    linear solver would otherwise meet a singular system and settle for an approximation.
    """
    profiles, fills = profiled_quantiles(train, features, [0.5] if fill == "median" else [])
    known = {f: float((fills.get(f) or [None])[0] or 0.0) for f in features}
    varying = [
        f
        for f, p in profiles.items()
        if p.n and (p.low != p.high or (p.n_missing and known[f] != p.low))
    ] or list(features)
    filled = train.select(*varying).fillna({f: known[f] for f in varying})
    if scaling == "standard":
        parameters = stats.standard_parameters(filled, varying)
    elif scaling == "robust":
        parameters = stats.robust_parameters(filled, varying)
    else:
        parameters = {f: (0.0, 1.0) for f in varying}
    columns = ", ".join(
        f"(coalesce(`{f}`, {known[f]!r}D) - ({parameters[f][0]!r}D)) / ({parameters[f][1]!r}D) AS `{INPUT}{f}`"
        for f in varying
    )
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=[INPUT + f for f in varying], outputCol=VECTOR),
    ]


def _estimator(spec: Spec, label: str, output: str, n: int, label_deviation: float):
    common = {"featuresCol": VECTOR, "labelCol": label, "predictionCol": output}
    p = spec.params
    if spec.kind in ("ridge", "ols"):
        # MLlib minimises mean squared error with the label scaled to unit deviation.
        penalty = p.get("alpha", 0.0) * label_deviation / n
        return LinearRegression(
            regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal", **common
        )
    if spec.kind in ("random_forest", "extra_trees"):
        extra = spec.kind == "extra_trees"
        return RandomForestRegressor(
            numTrees=int(p.get("trees", 100)),
            maxDepth=int(p.get("depth", 5)),
            minInstancesPerNode=int(p.get("min_leaf", 1)),
            bootstrap=bool(p.get("bootstrap", not extra)),
            featureSubsetStrategy=p.get("subset", "onethird" if extra else "all"),
            seed=SEED,
            **common,
        )
    if spec.kind in ("gbt", "boosted_alt"):
        return GBTRegressor(
            maxIter=int(p.get("iterations", 100)),
            maxDepth=int(p.get("depth", 3)),
            stepSize=float(p.get("rate", 0.1)),
            minInstancesPerNode=int(p.get("min_leaf", 1)),
            seed=SEED,
            **common,
        )
    raise ValueError(f"unknown kind of model: {spec.kind}")


def fit(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    spec: Spec,
    scaling: str = "standard",
    output: str = "predicted",
    prepared: Sequence | None = None,
) -> PipelineModel:
    """Fit one model on the rows with a label; ``prepared`` reuses fitted preparation stages.

    Preparation and fitting go over the rows several times, so the columns they need are kept.
    """
    rows = train.dropna(subset=[label]).select(F.col(label).cast("double").alias(label), *features)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = list(prepared or preparation(rows, features, scaling))
        inputs = PipelineModel(stages).transform(rows).select(label, VECTOR)
        n, deviation = inputs.agg(F.count(label), F.stddev_pop(label)).first()
        model = _estimator(spec, label, output, n, deviation or 0.0).fit(inputs)
    finally:
        rows.unpersist()
    return PipelineModel([*stages, model])


def predict(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``df`` with one more column per model, all in the same pass over the rows."""

    def add(frame: DataFrame, item: tuple[str, PipelineModel | Stack]) -> DataFrame:
        name, model = item
        if isinstance(model, Stack):
            return model.transform(frame).withColumnRenamed("predicted", name)
        output = model.stages[-1].getPredictionCol()
        scored = model.transform(frame)
        helpers = [c for c in scored.columns if c == VECTOR or c.startswith(INPUT)]
        return scored.drop(*helpers).withColumnRenamed(output, name)

    return reduce(add, models.items(), df)


def prediction_table(
    models: Mapping[str, PipelineModel], df: DataFrame, keys: Sequence[str], label: str
) -> DataFrame:
    """(keys, model, actual, predicted, residual), long by model."""
    wide = predict(models, df)
    long = wide.select(*keys, F.col(label).alias("actual"), *models).unpivot(
        [*keys, "actual"], list(models), "model", "predicted"
    )
    return long.withColumn("residual", F.col("actual") - F.col("predicted"))


def tagged_predictions(
    model: PipelineModel, df: DataFrame, keys: Sequence[str], label: str, period: str, first_test: int
) -> DataFrame:
    """Predictions of all rows, the model column saying ``train`` or ``test``."""
    table = prediction_table({"predicted": model}, df, keys, label)
    return table.withColumn("model", split_tag(F.col(period), first_test))


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance): impurity shares, or coefficient sizes, adding up to 1."""
    fitted = model.stages[-1]
    raw = (
        fitted.featureImportances.toArray()
        if hasattr(fitted, "featureImportances")
        else abs(fitted.coefficients.toArray())
    )
    total = float(raw.sum()) or 1.0
    used = [c.removeprefix(INPUT) for c in model.stages[-2].getInputCols()]
    shares = dict(zip(used, raw, strict=True))
    rows = [(f, float(shares.get(f, 0.0)) / total) for f in features]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


# --- stacking --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Stack:
    """Base models and what makes one prediction of theirs: a fitted linear model or an expression."""

    bases: Mapping[str, PipelineModel]
    meta: PipelineModel

    @staticmethod
    def weighted(bases: Mapping[str, PipelineModel], weights: Mapping[str, float]) -> Stack:
        """The mean of the bases by weight."""
        mean = " + ".join(f"`{name}` * {float(weights[name])!r}D" for name in bases)
        return Stack(bases, PipelineModel([SQLTransformer(statement=f"SELECT *, {mean} AS predicted FROM __THIS__")]))

    def transform(self, df: DataFrame) -> DataFrame:
        scored = predict(self.bases, df)
        if isinstance(self.meta.stages[-1], SQLTransformer):
            return self.meta.transform(scored).drop(*self.bases)
        return predict({"predicted": self.meta}, scored).drop(*self.bases)

    def save(self, folder: str) -> None:
        """The meta-model and every base below one folder; ``bases`` lists their names."""
        for name, model in self.bases.items():
            save_model(model, f"{folder}/bases/{name}")
        save_model(self.meta, f"{folder}/meta")
        spark = SparkSession.getActiveSession()
        names = spark.createDataFrame([(n,) for n in self.bases], "name string")
        names.coalesce(1).write.mode("overwrite").json(f"{folder}/names")

    @staticmethod
    def load(folder: str) -> Stack:
        names = [r["name"] for r in SparkSession.getActiveSession().read.json(f"{folder}/names").collect()]
        bases = {n: PipelineModel.load(f"{folder}/bases/{n}") for n in sorted(names)}
        return Stack(bases, PipelineModel.load(f"{folder}/meta"))


def stack(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    period: str,
    specs: Mapping[str, Spec],
    folds: int = 2,
    scaling: str = "robust",
    meta: Spec = Spec("ridge", {"alpha": 1.0}),
) -> Stack:
    """Fit the meta-model on predictions for periods the bases have not seen.

    Every fold is scored by bases fitted on the other folds; the parts are stacked row by row,
    so no join brings predictions and labels back together.
    """
    names = {f"base_{name}": spec for name, spec in specs.items()}

    def bases_for(rows: DataFrame) -> dict[str, PipelineModel]:
        prepared = preparation(rows, features, scaling)
        return {n: fit(rows, features, label, s, prepared=prepared, output=n) for n, s in names.items()}

    rows = with_time_blocks(train.dropna(subset=[label]), period, folds - 1, "fold").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        unseen = union_all(
            [
                predict(bases_for(rows.filter(F.col("fold") != k)), rows.filter(F.col("fold") == k))
                for k in range(folds)
            ]
        )
        meta_model = fit(unseen, list(names), label, meta, scaling="none")
        return Stack(bases_for(rows), meta_model)
    finally:
        rows.unpersist()


# --- persistence and scoring ------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_first(paths: Sequence[str]) -> PipelineModel:
    """The first of the saved models that is there, newest path first."""
    for path in paths[:-1]:
        try:
            return PipelineModel.load(path)
        except Exception as e:  # Hadoop's and Spark's "no such folder" differ by version.
            if not isinstance(e, AnalysisException) and "not exist" not in str(e):
                raise
    return PipelineModel.load(paths[-1])


def batch_score(
    requests: DataFrame, model: PipelineModel | Stack, features: Sequence[str], missing: str = "median"
) -> DataFrame:
    """Prediction (2 digits) and risk band per request, for tables and streams alike.

    Missing inputs take the training median, which the model carries, or 0.
    """
    absent = {f: F.lit(None).cast("double") for f in features if f not in requests.columns}
    inputs = requests.withColumns(absent) if absent else requests
    if missing == "zero":
        inputs = inputs.fillna(0.0, subset=list(features))
    scored = predict({"predicted": model}, inputs).drop(*absent)
    return scored.withColumns(
        {"risk": risk_band(F.col("predicted")), "predicted": F.round("predicted", 2)}
    )
