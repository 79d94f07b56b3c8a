"""Spreading annual values, extrapolating trends, bounds, and knob-driven scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwise.functions.derive import clip, or_zero, risk_band

# Share of the year's cases per month; they add up to 1.
SEASON_SHARES = (0.06, 0.05, 0.08, 0.12, 0.14, 0.10, 0.06, 0.05, 0.06, 0.10, 0.12, 0.06)

# Two-sided 95 % normal quantile as used for bounds, and the assumed relative error.
Z95 = 1.96
RELATIVE_ERROR = 0.15


def seasonal_disaggregate(
    df: DataFrame, annual: str, keys: Sequence[str], shares: Sequence[float] = SEASON_SHARES
) -> DataFrame:
    """Each positive annual value to twelve monthly ones."""
    months = F.array(
        *[
            F.struct(F.lit(m).alias("month"), F.lit(s).alias("_share"))
            for m, s in enumerate(shares, start=1)
        ]
    )
    return (
        df.filter(F.col(annual) > 0)
        .select(*keys, F.col(annual).alias("annual"), F.inline(months))
        .select(*keys, "month", (F.col("annual") * F.col("_share")).alias("monthly"), "annual")
    )


def forecast_trend(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    period: str = "year",
    horizon: int = 5,
) -> DataFrame:
    """(keys, feature, period, value): each feature carried on ``horizon`` periods.

    Three or more known values: the least-squares line over their running number i = 0..n-1,
    read at n + h. One or two: the last one. None: 0.
    """
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("_y")) for f in features
    ]
    long = df.select(*keys, *order, F.inline(F.array(*cells)))
    entity = [*keys, "feature"]
    w = Window.partitionBy(*entity).orderBy(*order)
    known_before = F.count("_y").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    numbered = long.withColumn("_i", F.when(F.col("_y").isNotNull(), known_before.cast("double")))
    fits = numbered.groupBy(*entity).agg(
        F.count("_y").alias("_n"),
        F.regr_slope("_y", "_i").alias("_slope"),
        F.regr_intercept("_y", "_i").alias("_intercept"),
        F.max_by("_y", "_i").alias("_last"),
        F.max(period).alias("_end"),
    )
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h")
    line = F.col("_intercept") + F.col("_slope") * (F.col("_n") + F.col("_h"))
    value = F.when(F.col("_n") >= 3, line).when(F.col("_n") >= 1, F.col("_last")).otherwise(0.0)
    return fits.select("*", h).select(
        *entity, (F.col("_end") + F.col("_h")).alias(period), value.alias("value")
    )


def with_forecast_bounds(
    df: DataFrame,
    predicted: str = "predicted",
    digits: int = 2,
    z: float = Z95,
    relative_error: float = RELATIVE_ERROR,
) -> DataFrame:
    """Bounds a fixed share of the prediction wide; the lower one is at least 0."""
    p = F.col(predicted)
    width = F.abs(p) * relative_error * z
    return df.withColumns(
        {
            predicted: F.round(p, digits),
            "lower_bound": F.round(clip(p - width, lower=0.0), digits),
            "upper_bound": F.round(p + width, digits),
            "confidence": F.lit("95%"),
        }
    )


def prediction_interval(
    df: DataFrame, keys: Sequence[str], z: float = 1.959964, heuristic_share: float = 0.1
) -> DataFrame:
    """Interval per row from long (keys, estimator, predicted).

    Several estimators: their mean and population deviation. A single one has no spread, so a
    tenth of its prediction stands in for the deviation, with the rounded quantile.
    """
    spread = df.groupBy(*keys).agg(
        F.avg("predicted").alias("predicted"),
        F.stddev_pop("predicted").alias("deviation"),
        F.count("predicted").alias("n_estimators"),
    )
    several = F.col("n_estimators") > 1
    width = F.when(several, F.col("deviation") * z).otherwise(
        F.abs("predicted") * heuristic_share * Z95
    )
    return spread.select(
        *keys,
        "predicted",
        (F.col("predicted") - width).alias("lower"),
        (F.col("predicted") + width).alias("upper"),
        "n_estimators",
    )


def scenario_features(df: DataFrame) -> DataFrame:
    """Model inputs from knobs: lag1, lag2, change, precip, temp, humidity, population, urban, health."""
    rain, temp = F.col("precip"), F.col("temp")
    # How the inputs without a knob follow from those with one.
    derived: Mapping[str, Column] = {
        "precip_days": rain / 10,
        "precip_anomaly": F.lit(0.0),
        "temp_max": temp + 8,
        "temp_anomaly": F.lit(0.0),
        "wind_mean": F.lit(3.0),
        "solar_mean": F.lit(18.0),
        "precip_lag1": rain * 0.95,
        "precip_lag2": rain * 1.05,
        "temp_lag1": temp - 0.2,
        "temp_lag2": temp + 0.1,
        "farm_precip": rain * 0.6,
    }
    return df.withColumns(dict(derived))


def scenario_score(df: DataFrame, digits: int = 1, noise_seed: int | None = None) -> DataFrame:
    """Score five knobs and band the result; noise only on request."""
    # Weights, reference points and limits of the score.
    score = (
        F.col("lag1") * 0.45
        + F.col("precip") / 100 * 2.5
        + (F.col("temp") - 21) * 5
        + (F.col("humidity") - 70) * 0.3
        - F.col("urban") / 10 * 0.5
    )
    if noise_seed is not None:
        score = score + F.randn(noise_seed) * 1.5
    limited = df.withColumn("score", clip(score, 10.0, 300.0))
    return limited.withColumns(
        {"risk": risk_band(F.col("score")), "score": F.round("score", digits)}
    )


def with_defaults(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every feature as a column; absent or missing ones are 0."""
    return df.withColumns(
        {f: or_zero(F.col(f).cast("double")) if f in df.columns else F.lit(0.0) for f in features}
    )
