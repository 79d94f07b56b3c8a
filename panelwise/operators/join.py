"""Equi-joins of panels and facts.

No side is forced to be broadcast unless it is a literal of fixed size: Catalyst broadcasts
by file size (spark.sql.autoBroadcastJoinThreshold), AQE re-plans with the measured sizes
and splits partitions that a hot key has blown up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from panelwise.functions.derive import or_zero
from panelwise.operators.clean import contains_tag


def suffix_collisions(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str
) -> DataFrame:
    """``right`` with every non-key column that ``left`` also has renamed by the suffix."""
    taken = set(left.columns) - set(keys)
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in taken})


def merge_full(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right"
) -> DataFrame:
    """Full outer join on coalesced keys."""
    return left.join(suffix_collisions(left, right, keys, suffix), list(keys), "full_outer")


def merge_left(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right"
) -> DataFrame:
    return left.join(suffix_collisions(left, right, keys, suffix), list(keys), "left")


def merge_long(
    df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Mapping[object, str]
) -> DataFrame:
    """Full outer join of the parts of a long table, one column for each name listed, in one aggregate.

    ``df`` holds one row per key and name. As in a join, a row with a NULL key meets no other.
    """
    apart = F.when(reduce(or_, [F.col(k).isNull() for k in keys]), F.col(name))
    listed = df.filter(F.col(name).isin(list(columns)))
    cells = [F.max(F.when(F.col(name) == n, F.col(value))).alias(c) for n, c in columns.items()]
    return listed.groupBy(*keys, apart.alias("_apart")).agg(*cells).drop("_apart")


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``per_key``, which holds one row per key of ``df`` itself.

    The null-safe comparison keeps rows with a NULL key together with their group. It also adds
    no not-null filter to one side only, so both sides share one scan and shuffle.
    """
    renamed = per_key.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_key_{k}" for k in keys])


def keep_keys(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*keys), list(keys), "left_semi")


def drop_keys(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*keys), list(keys), "left_anti")


def trends(
    actuals: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    tag: str = "train",
) -> DataFrame:
    """Actual values beside the predictions whose model name lacks the tag, in key order.

    Missing measures of a known period count as 0; a period on one side only keeps NULLs.
    """
    known = actuals.select(*keys, *[or_zero(F.col(m)).alias(m) for m in measures])
    shown = predictions.filter(~contains_tag("model", tag)).select(
        *keys, or_zero(F.col("predicted")).alias("predicted")
    )
    return merge_full(known, shown, keys).orderBy(*keys)


def focal_difference(
    df: DataFrame, entity: str, focal: str, value: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Difference to the focal entity's value, within ``keys`` or over the whole table."""
    focal_value = F.max(F.when(F.col(entity) == focal, F.col(value)))
    if not keys:
        return df.withColumn("diff", F.col(value) - df.select(focal_value).scalar())
    base = df.groupBy(*keys).agg(focal_value.alias("_focal"))
    return attach(df, base, keys).withColumn("diff", F.col(value) - F.col("_focal")).drop("_focal")
