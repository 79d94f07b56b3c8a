"""Connected components of links, and groups cut into pairs of bounded blocks. DataFrames only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelwise.llm.common import landed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest reachable node) for every node that a link names.

    Large-star and small-star steps: each hangs neighbours onto the smallest node seen, with
    aggregates that combine before the shuffle, so a node with very many links is no burden. Each
    round is written to the shared folder, which cuts the lineage; rounds grow with the logarithm of
    the longest path, and links that are stars already need none.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = landed(edges, "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = landed(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
    return stars(edges)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs onto one centre at most, and centres onto none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return nodes.agg(F.count_if(F.expr("up > 1 OR up > 0 AND down > 0"))).first()[0] == 0


def stars(edges: DataFrame) -> DataFrame:
    """Every node beside its centre, centres too; a node's smallest centre counts."""
    leaves = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def block_pairs(rows: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """Rows of each group dealt into blocks of about ``block`` rows, and each block to every pair it is part of.

    Adds ``lo``, ``hi`` (the pair) and ``at`` (the row's own block). A group of one block stays as it
    is; a larger one is compared block by block in as many tasks as it has pairs of blocks, so no task
    ever holds more than two blocks and no pair of rows is left out or met twice. Groups of one row
    have no pair and drop out.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    mine = rows.join(sizes, group).withColumn("_k", blocks).withColumn("at", F.pmod(F.xxhash64(key), F.col("_k")).cast("int"))
    other = mine.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return other.withColumns({"lo": F.least("at", "_o"), "hi": F.greatest("at", "_o")}).drop("_n", "_k", "_o")


class Union:
    """Union-find over the places of an array; the smaller place stands for a set."""

    def __init__(self, n: int):
        self.top = list(range(n))

    def find(self, i: int) -> int:
        top = self.top
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.top[max(i, j)] = min(i, j)
        return True

    def labels(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.top))], np.int64)


def join_matrix(union: Union, near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
    """Join the places that a matrix of rows against columns marks, by spreading the smallest place."""
    r, c = near.any(axis=1), near.any(axis=0)
    if not r.any():
        return
    near, rows, columns = near[r][:, c], rows[r], columns[c]
    left, right = (np.array([union.find(i) for i in x.tolist()]) for x in (rows, columns))
    while True:
        new_left = np.minimum(left, np.where(near, right[None, :], len(union.top)).min(axis=1))
        new_right = np.minimum(right, np.where(near, new_left[:, None], len(union.top)).min(axis=0))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    for place, top in (*zip(rows.tolist(), left.tolist(), strict=True), *zip(columns.tolist(), right.tolist(), strict=True)):
        union.join(place, top)


def whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of complete runs of equal keys, with the runs' starts and the end; rows arrive in order of the keys."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy(np.int64)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        if last is not None and (values[0] != last).any():
            cuts = np.r_[0, cuts]
        last = values[-1]
        if not len(cuts):
            held.append(batch)
            continue
        done = pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True)
        before = len(done) - cuts[-1]
        yield done, np.unique(np.r_[0, cuts + before])
        held = [batch.iloc[cuts[-1] :]]
    if held:
        done = pd.concat(held, ignore_index=True)
        yield done, np.array([0, len(done)])


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """One frame for each run of equal keys; each is bounded by two blocks."""
    for rows, cuts in whole_runs(batches, keys):
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield rows.iloc[a:b].reset_index(drop=True)


def star_rows(union: Union, ids: np.ndarray) -> pd.DataFrame:
    """A row (a, b) for each place that is not its set's first."""
    tops = union.labels()
    some = np.flatnonzero(tops != np.arange(len(tops)))
    return pd.DataFrame({"a": ids[some], "b": ids[tops[some]]})


def pair_stars(pairs: np.ndarray) -> pd.DataFrame:
    """Star rows (a, b) that join what pairs of ids (two columns) join."""
    ids, places = np.unique(pairs, return_inverse=True)
    union = Union(len(ids))
    for i, j in np.unique(places.reshape(-1, 2), axis=0).tolist():
        union.join(i, j)
    return star_rows(union, ids)
