"""Training runs over a feature table: annual line-up, and tuned models with ensembles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.functions.derive import split_tag
from panelwise.operators import ensemble, forecast, models, rank, stats, tuning
from panelwise.operators.models import ANNUAL_MODELS, GRIDS, Spec, Stack
from panelwise.session import landed
from panelwise.sources import text


@dataclass(frozen=True)
class Run:
    """What a training run leaves behind; frames are lazy, models fitted."""

    features: list[str]
    models: Mapping[str, PipelineModel]
    metrics: DataFrame
    best: str
    final: PipelineModel | Stack
    predictions: DataFrame
    importances: DataFrame
    cv_errors: Mapping[str, float] | None = None
    ensemble: DataFrame | None = None
    stacked: Stack | None = None
    forecasts: DataFrame | None = None
    specs: Mapping[str, Spec] | None = None
    samples: Mapping[str, int] | None = None
    winner: PipelineModel | Stack | None = None

    def weights(self) -> dict[str, float]:
        """Of the weighted ensemble: the single models' shares."""
        return tuning.base_weights({n: e for n, e in (self.cv_errors or {}).items() if n in self.models})

    def report(self, importances: int | None = None) -> DataFrame:
        """One row: best model, features, sample counts, results, importances, best parameters, fold errors and weights.

        The lists have one entry per model or feature; ``importances`` may cut the longest of them.
        Forecasts have a row for each key and period and are a table of their own.
        """

        def listed(df: DataFrame):
            return df.select(F.array_sort(F.collect_list(F.struct("*")))).scalar()

        spark = self.metrics.sparkSession
        columns = {
            "best_model": F.lit(self.best),
            "n_features": F.lit(len(self.features)),
            "features": F.array(*[F.lit(f) for f in self.features]),
            "results": listed(self.metrics),
            "feature_importance": listed(
                self.importances
                if importances is None
                else rank.top_k(self.importances, F.desc("importance"), importances, "feature")
            ),
        }
        if self.samples:
            columns["samples"] = F.struct(*[F.lit(n).alias(name) for name, n in self.samples.items()])
        if self.specs:
            rows = [(n, s.kind, {k: float(v) for k, v in s.params.items()}) for n, s in self.specs.items()]
            best = spark.createDataFrame(rows, "model string, kind string, params map<string,double>")
            columns["best_params"] = listed(best.select("model", "kind", F.array_sort(F.map_entries("params")).alias("params")))
        if self.cv_errors:
            errors = list(self.cv_errors.items())
            columns["cv_mae"] = listed(spark.createDataFrame(errors, "model string, mae double"))
            columns["ensemble_weights"] = listed(spark.createDataFrame(list(self.weights().items()), "model string, weight double"))
        return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def _metrics_by_split(table: DataFrame, period: str, first_test: int) -> DataFrame:
    tagged = table.withColumn("split", split_tag(F.col(period), first_test))
    return stats.regression_metrics(tagged, ["model", "split"])


def _first_test(rows: DataFrame, period: str, n_test: int) -> int:
    """The first test period, a single number."""
    return rows.select(models.first_test_period(rows, period, n_test)).first()[0]


def _best(metrics: DataFrame, by: str) -> str:
    test = metrics.filter("split = 'test'")
    picked = rank.best_by(test, scores=["r2"]) if by == "r2" else rank.best_by(test, errors=[by])
    return picked.first()[0]


def train_annual(
    table: DataFrame,
    label: str,
    candidates: Sequence[str],
    required: Sequence[str],
    period: str = "year",
    n_test: int = 5,
    specs: Mapping[str, Spec] = ANNUAL_MODELS,
    fill_from_all: bool = False,
) -> Run:
    """Fit the line-up on all but the last periods, pick the best r2, refit it on everything.

    Features must be half filled; anything computed from the current label does not belong in
    ``candidates``. Missing inputs take medians of the training periods, or of all periods with
    ``fill_from_all``, which lets the test periods colour the training data.
    """
    rows = landed(table.dropna(subset=[label, *required]), "training")
    features = stats.filled_columns(rows, [c for c in candidates if c in rows.columns])
    if fill_from_all:
        rows = stats.fill_medians(rows, features)
    first_test = _first_test(rows, period, n_test)
    train, _ = models.split_at(rows, period, first_test)
    prepared = models.preparation(train, features)
    fitted = {n: models.fit(train, features, label, s, prepared=prepared) for n, s in specs.items()}
    table_of_all = models.prediction_table(fitted, rows, [period], label)
    metrics = _metrics_by_split(table_of_all, period, first_test)
    best = _best(metrics, "r2")
    shown = table_of_all.filter(F.col("model") == best)
    name = F.when(F.col(period) < first_test, F.concat("model", F.lit(" (train)"))).otherwise(F.col("model"))
    counts = rows.agg(F.count_if(F.col(period) < first_test).alias("train"), F.count_if(F.col(period) >= first_test).alias("test")).first()
    return Run(
        features=features,
        models=fitted,
        metrics=metrics,
        best=best,
        specs=specs,
        samples=counts.asDict(),
        final=models.fit(rows, features, label, specs[best]),
        predictions=shown.withColumn("model", name),
        importances=models.importances(rows.sparkSession, fitted[best], features),
    )


def train_tuned(
    panel: DataFrame,
    label: str,
    candidates: Sequence[str],
    keys: Sequence[str],
    period: str,
    n_test: int,
    grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
    stack_top: int = 4,
    horizon: int = 5,
) -> Run:
    """Tune every kind on expanding folds, weight and stack the winners, forecast with the stack.

    Weights, the stack's members and the best of all, ensembles included, come from fold errors, never
    from the test periods, which only the metrics show. An ensemble's fold error is that of weights learnt
    on the other folds. The best is fitted again on all rows and can be saved, loaded and served.
    """
    rows = landed(panel.dropna(subset=[label]), "training")
    features = stats.select_features(rows, [c for c in candidates if c in rows.columns])
    first_test = _first_test(rows, period, n_test)
    train, _ = models.split_at(rows, period, first_test)
    specs = [s for kind, grid in grids.items() for s in models.candidates(kind, grid)]
    tuned = tuning.cross_validate(train, features, label, period, specs)
    winners = {kind: spec for kind, (spec, _) in tuned.winners().items()}
    errors = {kind: error for kind, (_, error) in tuned.winners().items()}
    prepared = models.preparation(train, features, "robust")
    fitted = {kind: models.fit(train, features, label, spec, prepared=prepared) for kind, spec in winners.items()}
    table = models.prediction_table(fitted, rows, [*keys, period], label)
    spark = rows.sparkSession
    cv = spark.createDataFrame(list(errors.items()), "model string, mae double")
    weighted = ensemble.weighted_ensemble(table, [*keys, period], cv)

    top = sorted(errors, key=errors.get)[:stack_top]
    stacked = tuning.stacked(train, features, label, tuned, {k: winners[k] for k in top})
    stack_rows = stacked.transform(rows).select(*keys, period, F.col(label).alias("actual"), "predicted")
    everything = table.select(*keys, period, "model", "actual", "predicted")
    for name, more in (("weighted", weighted), ("stacking", stack_rows)):
        everything = everything.unionByName(more.withColumn("model", F.lit(name)))
    metrics = _metrics_by_split(everything, period, first_test)
    importance_of = "random_forest" if "random_forest" in fitted else top[0]
    errors |= tuning.ensemble_errors(tuned, label, winners, top)
    best = min(errors, key=errors.get)
    weights = tuning.base_weights({n: errors[n] for n in fitted})
    served = {"weighted": models.Stack.weighted({f"base_{n}": _named(m, f"base_{n}") for n, m in fitted.items()}, {f"base_{n}": w for n, w in weights.items()}), "stacking": stacked}

    def on_all() -> PipelineModel | Stack:
        """The best of all, on all rows; an ensemble keeps its weights."""
        if best == "stacking":
            return tuning.stacked(rows, features, label, tuned, {k: winners[k] for k in top})
        if best == "weighted":
            again = models.preparation(rows, features, "robust")
            bases = {f"base_{k}": models.fit(rows, features, label, s, prepared=again, output=f"base_{k}") for k, s in winners.items()}
            return models.Stack.weighted(bases, {f"base_{k}": w for k, w in weights.items()})
        return models.fit(rows, features, label, winners[best], "robust")

    counts = rows.agg(F.count_if(F.col(period) < first_test).alias("train"), F.count_if(F.col(period) >= first_test).alias("test")).first()
    base = Run(
        features=features,
        models=fitted,
        metrics=metrics,
        best=best,
        final=on_all(),
        predictions=table,
        importances=models.importances(spark, fitted[importance_of], features),
        cv_errors=errors,
        ensemble=weighted,
        stacked=stacked,
        specs=winners,
        samples=counts.asDict(),
        winner=served.get(best) or fitted[best],
    )
    return replace(base, forecasts=forecast_with(stacked, rows, features, keys, period, horizon))


def _named(model: PipelineModel, output: str) -> PipelineModel:
    """The model with another output column."""
    return PipelineModel([*model.stages[:-1], model.stages[-1].copy().setPredictionCol(output)])


def forecast_with(
    model: Stack, rows: DataFrame, features: Sequence[str], keys: Sequence[str], period: str, horizon: int
) -> DataFrame:
    """Carry every feature on by its trend, predict, and add bounds."""
    long = forecast.forecast_trend(rows, features, keys, [period], period, horizon)
    wide = long.groupBy(*keys, period).pivot("feature", list(features)).agg(F.first("value"))
    scored = model.transform(wide).select(*keys, period, "predicted")
    return forecast.with_forecast_bounds(scored)


def save_run(run: Run, folder: str) -> None:
    """The fitted winner, its refit, all models, the stack, weights, tables and report below one folder."""
    _save(run.winner or run.models[run.best], f"{folder}/model")
    _save(run.final, f"{folder}/model_final")
    for name, model in run.models.items():
        models.save_model(model, f"{folder}/models/{name}")
    if run.stacked is not None:
        run.stacked.save(f"{folder}/stack")
    if run.cv_errors:
        weights = run.metrics.sparkSession.createDataFrame(list(run.weights().items()), "model string, weight double")
        weights.write.mode("overwrite").parquet(f"{folder}/weights")
    run.predictions.write.mode("overwrite").parquet(f"{folder}/predictions")
    if run.forecasts is not None:
        run.forecasts.write.mode("overwrite").parquet(f"{folder}/forecasts")
    run.report().write.mode("overwrite").json(f"{folder}/report")


def _save(model: PipelineModel | Stack, path: str) -> None:
    if isinstance(model, Stack):
        model.save(path)
    else:
        models.save_model(model, path)


def load_model(folder: str) -> PipelineModel | Stack:
    """The model for scoring, be it single or an ensemble: the refit one, else the one from the split."""
    spark = SparkSession.getActiveSession()
    for path in (f"{folder}/model_final", f"{folder}/model"):
        if text.scan_or_empty(spark, f"{path}/names", "name string", "json").limit(1).count():
            return Stack.load(path)
    return models.load_first([f"{folder}/model_final", f"{folder}/model"])
