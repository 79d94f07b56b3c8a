"""Derived columns: bands, flags, labels, scaling and calendar encodings."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Upper limits and names of the risk bands.
RISK_BANDS = ((50.0, "LOW"), (80.0, "MODERATE"), (120.0, "HIGH"))
RISK_TOP = "VERY HIGH"

# The advice that goes with each risk band.
RISK_ADVICE = {
    "LOW": "Low risk. Maintain surveillance.",
    "MODERATE": "Moderate risk. Increase monitoring. Pre-position diagnostic kits.",
    "HIGH": "High risk. Deploy rapid response teams. Increase bed net distribution.",
}

# Months of the two rainy seasons.
WET_MONTHS = (3, 4, 5, 10, 11, 12)

# Month names.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def risk_band(value: Column) -> Column:
    band = F.when(value.isNull(), None)
    for limit, name in RISK_BANDS:
        band = band.when(value < limit, name)
    return band.otherwise(RISK_TOP)


def risk_advice(band: Column, top: str) -> Column:
    """Text for a band; the caller words the advice for the highest one."""
    return recode(F.when(band == RISK_TOP, F.lit(top)).otherwise(band), RISK_ADVICE)


def residual_band(residual: Column, width: float = 5.0) -> Column:
    return (
        F.when(residual <= -width, "over")
        .when(residual <= width, "close")
        .when(residual > width, "under")
    )


def anomaly_sign(value: Column) -> Column:
    return F.when(value < 0, "negative").when(value >= 0, "non_negative")


def importance_band(share: Column) -> Column:
    return (
        F.when(share > 0.1, "strong")
        .when(share > 0.01, "moderate")
        .when(share.isNotNull(), "weak")
    )


def recode(value: Column, names: Mapping[str, str]) -> Column:
    """Replace known codes by their display name and leave the others alone."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def month_name(month: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int"))


def month_angle(month: Column) -> tuple[Column, Column]:
    """(sine, cosine) of the month's place in the year."""
    turn = month * F.lit(2.0 * math.pi) / 12
    return F.sin(turn), F.cos(turn)


def in_season(month: Column, months: Sequence[int] = WET_MONTHS) -> Column:
    return month.isin(*months).cast("int")


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Limit a value on one or both sides; NULL stays NULL."""
    out = value
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(value.isNotNull(), out)


def band_between(a: Column, b: Column) -> tuple[Column, Column]:
    """(lower, upper) of two values; NULL as soon as one of them is NULL."""
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.least(a, b)), F.when(both, F.greatest(a, b))


def split_tag(period: Column, first_test: Column | int) -> Column:
    return F.when(period < first_test, "train").when(period >= first_test, "test")


def focal_weight(entity: Column, focal: str, other: float = 0.5) -> Column:
    return F.when(entity == focal, 1.0).otherwise(other)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("double"))
