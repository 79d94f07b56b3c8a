"""Weighted and stacked combinations of predictions that are long by model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from panelwise.operators.stats import regression_metrics


def inverse_error_weights(metrics: DataFrame, error: str = "mae") -> DataFrame:
    """(model, weight): weights go with 1 / error and add up to 1. One row per model."""
    raw = 1 / (F.col(error) + 1e-6)
    total = F.sum(raw).over(Window.partitionBy(F.lit(1)))
    return metrics.select("model", (raw / total).alias("weight"))


def weighted_ensemble(
    predictions: DataFrame, keys: Sequence[str], errors: DataFrame | None = None
) -> DataFrame:
    """(keys, actual, predicted) with the models' predictions averaged by weight.

    ``errors`` holds (model, mae) from validation folds. Without it the errors of the very
    predictions are used, which flatters the result.
    """
    weights = inverse_error_weights(regression_metrics(predictions) if errors is None else errors)
    return (
        predictions.join(weights, "model")
        .groupBy(*keys)
        .agg(
            F.max("actual").alias("actual"),
            F.sum(F.col("weight") * F.col("predicted")).alias("predicted"),
        )
    )
