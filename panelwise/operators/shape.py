"""Long to wide, wide to long, and row unions.

Pivots take the list of names: Spark then needs no extra pass to find them and the columns
do not depend on the data. When several rows fall on one cell an explicit ordinal decides,
by an aggregate that combines on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _pivot(df: DataFrame, keys, name, names, *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).pivot(name, list(names)).agg(*aggs)


def pivot_first(
    df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str], value: str, ordinal: str
) -> DataFrame:
    """The non-null value with the smallest ordinal per cell."""
    known = df.dropna(subset=[value])
    return _pivot(known, keys, name, names, F.min_by(value, ordinal))


def pivot_last(
    df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str], value: str, ordinal: str
) -> DataFrame:
    """The value with the largest ordinal per cell, NULL included."""
    last = _pivot(
        df, keys, name, names, F.max_by(F.struct(F.col(value).alias("v")), F.col(ordinal))
    )
    return last.select(*keys, *[F.col(n)["v"].alias(n) for n in names])


def pivot_bounds(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    names: Sequence[str],
    values: Sequence[str],
    ordinal: str,
    last: bool = False,
) -> DataFrame:
    """Several values per cell, the first (or last) known ones; columns are ``{name}_{value}``."""
    pick = F.max_by if last else F.min_by
    picked = [pick(v, F.when(F.col(v).isNotNull(), F.col(ordinal))).alias(v) for v in values]
    return _pivot(df, keys, name, names, *picked)


def pivot_mean(
    df: DataFrame, keys: Sequence[str], name: str, names: Sequence, value: str, prefix: str = ""
) -> DataFrame:
    """Matrix of means; ``prefix`` goes before each name."""
    wide = _pivot(df, keys, name, names, F.avg(value))
    return wide.select(*keys, *[F.col(str(n)).alias(f"{prefix}{n}") for n in names])


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "var", value: str = "val"
) -> DataFrame:
    """One row per id and column; cells without a value stay."""
    typed = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return typed.unpivot(list(ids), list(values), name, value)


def union_all(frames: Sequence[DataFrame], fill: bool = False) -> DataFrame:
    """Stack frames by column name; ``fill`` allows columns that only some frames have."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def union_tagged(frames: dict[str, DataFrame], tag: str = "type") -> DataFrame:
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def key_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of all frames; each is reduced before the union."""
    return union_all([df.select(*keys).distinct() for df in frames]).distinct()
