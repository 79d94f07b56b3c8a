"""Exact interpolated quantiles of whole columns without gathering a column anywhere.

``percentile`` keeps every distinct value of a group in one buffer. Here two passes do. The first takes
counts, ends and one mergeable sketch (``percentile_approx``) a column that is asked for the neighbourhood
of all wanted ranks at once; brackets that overlap are merged. The second gives each value one entry a
column: the part of the column it lies in, and the value itself inside a bracket, where a few in
``ACCURACY`` of the values lie. Entries are combined on the map side, and the counts name the value of each
rank. Only where brackets still hold more than ``LISTED`` different values, beyond some 10^9 of them, do
further passes narrow them down; one value is always a part of its own, so that ends at every size and
for every distribution. Only comparisons are used, so infinities are values like others; NaN counts as missing.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from panelwise.session import landed

ACCURACY = 10_000
#: Different values between brackets that the driver may list; more are narrowed down first.
LISTED = 200_000


class Interval(NamedTuple):
    """``count`` values of ``column`` lie in [low, high], ``below`` are smaller than ``low``."""

    column: str
    low: float
    high: float
    below: int
    count: int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Per column the quantiles with linear interpolation; None for a column without values."""
    return profiled_quantiles(landed(df.select(*columns), "quantiles"), columns, probabilities, accuracy)[1]


class Profile(NamedTuple):
    n: int
    n_missing: int
    mean: float | None
    low: float | None
    high: float | None


def known(column: str) -> Column:
    """The values as doubles; NaN is missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def profiled_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
) -> tuple[dict[str, Profile], dict[str, list[float | None]]]:
    """Counts, mean and ends per column, and the quantiles. ``df`` is read twice and must be the same both times."""
    reach = 2 / accuracy
    shares = [x for p in probabilities for x in (max(0.0, p - reach), min(1.0, p + reach))]
    row = df.agg(
        *[
            F.struct(
                F.count(known(c)), F.count_if(known(c).isNull()), F.avg(known(c)), F.min(known(c)), F.max(known(c)),
                F.percentile_approx(known(c), shares, accuracy) if shares else F.lit(None),
            ).alias(c)
            for c in columns
        ]
    ).first()
    profiles = {c: Profile(*row[c][:5]) for c in columns}
    brackets = {c: _brackets(row[c][5]) for c, p in profiles.items() if p.n and shares}
    ranks = {c: {f(x * (profiles[c].n - 1)) for x in probabilities for f in (math.floor, math.ceil)} for c in brackets}
    parts = _parts(df, brackets) if brackets else []
    found: dict[tuple[str, int], float] = {}
    pending: dict[tuple[str, int], Interval] = {}
    for c in brackets:
        below = 0
        for part in sorted((p for p in parts if p.column == c), key=lambda p: p.low):
            for rank in ranks[c]:
                if below <= rank < below + part.count:
                    pending[c, rank] = part._replace(below=below)
            below += part.count
    while pending:
        found |= {key: i.low for key, i in pending.items() if i.low == i.high or key[1] == i.below}
        found |= {key: i.high for key, i in pending.items() if key[1] == i.below + i.count - 1}
        pending = {key: i for key, i in pending.items() if key not in found}
        pending = _narrow(df, pending, accuracy) if pending else pending

    def interpolate(c: str, place: float) -> float:
        low, high = found[c, math.floor(place)], found[c, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    quantiles = {c: [interpolate(c, x * (p.n - 1)) if p.n else None for x in probabilities] for c, p in profiles.items()}
    return profiles, quantiles


def _brackets(values: Sequence[float]) -> list[tuple[float, float]]:
    """(low, high) pairs in order, those that meet as one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(zip(values[::2], values[1::2], strict=True)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _parts(df: DataFrame, brackets: Mapping[str, Sequence[tuple[float, float]]]) -> list[Interval]:
    """How many values lie below, between and above the brackets of each column, and at each value inside them."""
    entries = []
    for k, (c, some) in enumerate(brackets.items()):
        v = known(c)
        part = reduce(lambda a, b: a + b, [(v >= low).cast("int") + (v > high).cast("int") for low, high in some])
        entries.append(F.struct(F.lit(k).alias("k"), part.alias("part"), v.alias("v")))
    each = df.select(*brackets).select(F.inline(F.array(*entries))).filter("v IS NOT NULL")
    inside = F.when(F.col("part") % 2 == 1, F.col("v")).alias("inside")
    counted = each.groupBy("k", "part", inside).agg(F.count("v").alias("count"), F.min("v").alias("low"), F.max("v").alias("high"))
    counted = landed(counted, "parts")
    if counted.count() > LISTED:
        counted = counted.groupBy("k", "part").agg(F.sum("count").alias("count"), F.min("low").alias("low"), F.max("high").alias("high"))
    names = list(brackets)
    return [Interval(names[r["k"]], r["low"], r["high"], 0, r["count"]) for r in counted.collect()]


def _inside(df: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """(number of the interval, value) for every value inside one of the intervals."""
    conditions = [F.col(i.column).between(i.low, i.high) for i in intervals]  # NaN is beyond infinity
    entries = [
        F.when(hit, F.struct(F.lit(k).alias("k"), F.col(i.column).cast("double").alias("v")))
        for k, (i, hit) in enumerate(zip(intervals, conditions, strict=True))
    ]
    needed = df.select(*{i.column for i in intervals}).filter(reduce(or_, conditions))
    return needed.select(F.inline(F.array_compact(F.array(*entries))))


def _around(df: DataFrame, wanted: Sequence[tuple[int, Interval]], accuracy: int) -> list[list[float]]:
    """Per wanted rank three values: somewhat below it, about at it, somewhat above it."""
    picks = []
    for k, (rank, i) in enumerate(wanted):
        middle, reach = (rank - i.below + 0.5) / i.count, 2 / accuracy
        shares = [max(0.0, middle - reach), middle, min(1.0, middle + reach)]
        inside = F.when(F.col(i.column).between(i.low, i.high), F.col(i.column).cast("double"))
        picks.append(F.percentile_approx(inside, shares, accuracy).alias(f"_{k}"))
    needed = df.select(*{i.column for _, i in wanted})
    reached = reduce(or_, [F.col(i.column).between(i.low, i.high) for _, i in wanted])
    row = needed.filter(reached).agg(*picks).first()
    return [list(row[f"_{k}"]) for k in range(len(wanted))]


def _narrow(
    df: DataFrame, pending: Mapping[tuple[str, int], Interval], accuracy: int
) -> dict[tuple[str, int], Interval]:
    """Replace each interval by that of its parts (below, lower, at, upper, above) that holds the rank."""
    keys, intervals = list(pending), list(pending.values())
    cuts = _around(df, [(rank, i) for (_, rank), i in pending.items()], accuracy)

    def cut(n: int) -> Column:
        return F.get(F.array(*[F.lit(float(c[n])) for c in cuts]), F.col("k"))

    v = F.col("v")
    part = (
        F.when(v == cut(1), 2).when(v < cut(0), 0).when(v < cut(1), 1).when(v <= cut(2), 3).otherwise(4)
    )
    counted = (
        _inside(df, intervals)
        .groupBy("k", part.alias("part"))
        .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()  # five rows for each wanted rank
    )
    narrowed: dict[tuple[str, int], Interval] = {}
    upto = [i.below for i in intervals]
    for row in sorted(counted, key=lambda r: (r.k, r.part)):
        column, rank = keys[row.k]
        if upto[row.k] <= rank < upto[row.k] + row.n:
            narrowed[column, rank] = Interval(column, row.low, row.high, upto[row.k], row.n)
        upto[row.k] += row.n
    return narrowed
