"""The feature chains: everything between cleaned readings and a model's input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelwise.functions import derive
from panelwise.operators import aggregate, clean, forecast, join, stats, window


def annual_features(
    target: DataFrame,
    climate: DataFrame,
    keys: Sequence[str],
    target_column: str = "incidence",
    extra: Sequence[DataFrame] = (),
) -> DataFrame:
    """Merge annual tables per key and year and add lags, changes and anomalies.

    All windows share one partitioning and order, so the chain sorts once after the merge.
    """
    on = [*keys, "year"]
    merged = join.merge_full(target, climate, on, "_climate")
    for i, more in enumerate(extra):
        merged = join.merge_full(merged, more, on, f"_extra{i}")
    time = ["year"]
    out = window.with_lags(merged, {target_column: (1, 2)}, keys, time)
    out = window.with_change(out, target_column, keys, time, f"{target_column}_change")
    out = window.with_pct_change(
        out, target_column, keys, time, f"{target_column}_change_pct", fill_gaps=True
    )
    out = window.with_lags(
        out, {c: (1, 2) for c in ("precip_total", "temp_mean", "humidity_mean")}, keys, time
    )
    for column, name in (("precip_total", "precip_anomaly"), ("temp_mean", "temp_anomaly")):
        out = window.with_trailing_anomaly(out, column, 5, keys, time, name)
    return out


def monthly_features(panel: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Lags, rolling statistics, calendar encodings, anomalies and products per city-month.

    Lags are taken within each city: 12 rows back is the same month a year ago.
    """
    time = ["year", "month"]
    measures = ("precip_total", "temp_mean", "humidity_mean")
    out = window.with_lags(panel, {target: (1, 3, 6, 12, 24, 36)}, keys, time)
    others = [m for m in measures if m != target]
    out = window.with_lags(out, {m: (1, 2, 3, 6, 12) for m in others}, keys, time)
    out = window.with_rolling(out, measures, keys, time, means=(3, 6, 12), deviations=(3, 6))
    for column, name in (("precip_total", "precip_anomaly"), ("temp_mean", "temp_anomaly")):
        out = window.with_trailing_anomaly(out, column, 12, keys, time, name)
    out = window.with_anomaly_pct(out, "precip_total", 12, keys, time, "precip_anomaly_pct")
    sine, cosine = derive.month_angle(F.col("month"))
    return out.withColumns(
        {
            "month_sin": sine,
            "month_cos": cosine,
            "is_wet_season": derive.in_season(F.col("month")),
            "precip_x_temp": F.col("precip_total") * F.col("temp_mean"),
            "humidity_x_temp": F.col("humidity_mean") * F.col("temp_mean"),
        }
    )


def spread_features(
    target: DataFrame,
    climate: DataFrame,
    keys: Sequence[str],
    on: Sequence[str] = (),
    value: str = "incidence",
    annual_tables: Sequence[DataFrame] = (),
) -> DataFrame:
    """Annual values spread over months, with the months' climate, yearly means of other tables and all features.

    ``keys`` tell the series apart, which may be finer than those of the annual tables, ``on``: each of a
    country's cities then gets the country's values. Only positive annual values are spread. ``monthly`` is
    the target, ``annual`` what it was spread from; neither may be an input, their lags may.
    """
    out = forecast.seasonal_disaggregate(target, value, [*on, "year"])
    out = join.merge_left(out, climate, [*on, "year", "month"], "_climate")
    for i, more in enumerate(annual_tables):
        out = join.merge_left(out, aggregate.mean_of_numeric(more, [*on, "year"]), [*on, "year"], f"_annual{i or ''}")
    out = stats.min_max(out, "year", "year_normalized")
    out = window.with_lags(out, {"annual": (12, 24, 36)}, keys, ["year", "month"])
    return monthly_features(out, "monthly", keys)


def spread_inputs(table: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    """Columns of ``spread_features`` that may be a model's input."""
    return clean.numeric_columns(table, [*keys, "year", "month", "monthly", "annual"])
