"""Exact top-k by integer inner product, pruned with segment means and deviations, coarse to fine.

Vectors are cut into segments. With means m and deviations s over segments of n components,
``dist(q, c)^2 >= sum n ((m_q - m_c)^2 + (s_q - s_c)^2)``; as ``q.c = (|q|^2 + |c|^2 - dist^2) / 2``
this bounds the score from above by ``sum n (m_q m_c + s_q s_c)``, a small matrix product. Levels go
from few segments to many; only what may still reach a query's k-th best score so far goes on, and
survivors get exact scores.

Queries are packed into blocks of ``block`` rows, candidates as they are scanned; a block of queries
goes to ``stripes`` tasks, each of which meets a share of the candidates and keeps k rows a query. So
a task holds one block and one pack, and what is shuffled are packs and k rows a query and task.

Scores beyond 64 bits are set to the end of the range. Vectors that are null, empty, of another length
than most, or hold nulls or non-finite numbers take no part, nor do rows without an id. An id that
repeats is one query (its smallest vector) but as many candidates as rows, none of them its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelwise.llm.common import on_workers, partitions

LEVELS = (4, 16)
#: Sums of integers up to this are exact in doubles.
EXACT = 2.0**53


def _packed(batches: Iterator[pa.RecordBatch], scale: float, rows: int) -> Iterator[pa.RecordBatch]:
    """Each run of rows as one row: ids and floored components as bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(scale * part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([int(ids[0])]), pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())], ["first", "ids", "data"])


def _packed_block(scale: float, whole: pa.Table) -> pa.Table:
    packs = list(_packed(iter(whole.select(["vec_id", "v"]).to_batches()), scale, max(1, len(whole))))
    return pa.Table.from_batches(packs).append_column("block", pa.array([whole["block"][0].as_py()] * len(packs), pa.int32())).select(["block", "ids", "data"])


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of their lengths."""
    parts = np.array_split(x, min(segments, x.shape[1]), axis=1)
    mean = np.stack([p.mean(axis=1) * np.sqrt(p.shape[1]) for p in parts], axis=1)
    dev = np.stack([p.std(axis=1) * np.sqrt(p.shape[1]) for p in parts], axis=1)
    return np.concatenate([mean, dev], axis=1)


class Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.features = [segment_features(vectors, s) for s in LEVELS]
        self.row, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(len(ids), -np.inf)
        self.largest = np.abs(vectors).max(initial=0.0)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, tile: int = 1024) -> None:
        exact = self.largest * np.abs(vectors).max(initial=0.0) * vectors.shape[1] < EXACT
        levels = [segment_features(vectors, s) for s in LEVELS]
        for a in range(0, len(self.ids), tile):
            for b in range(0, len(ids), tile):
                self._tile(slice(a, a + tile), slice(b, b + tile), ids, vectors, levels, exact)

    def _tile(self, q: slice, c: slice, ids: np.ndarray, vectors: np.ndarray, levels: list[np.ndarray], exact: bool) -> None:
        rows, columns = np.arange(len(self.ids))[q], np.arange(len(ids))[c]
        for mine, theirs in zip(self.features, levels, strict=True):
            bound = mine[rows] @ theirs[columns].T
            slack = 1e-9 * np.abs(mine[rows]).max(initial=0.0) * np.abs(theirs[columns]).max(initial=0.0) * theirs.shape[1] + 1e-6
            alive = bound + slack >= self.floor[rows][:, None]
            rows, columns = rows[alive.any(axis=1)], columns[alive.any(axis=0)]
            if not len(rows) or not len(columns):
                return
        if exact:
            scores = self.vectors[rows] @ vectors[columns].T
        else:
            whole = [[int(x) for x in v] for v in vectors[columns]]
            scores = np.array([[sum(x * y for x, y in zip(map(int, v), w, strict=True)) for w in whole] for v in self.vectors[rows]], object)
            scores = np.clip(scores, -(2**63), 2**63 - 1)
        own = self.ids[rows][:, None] == ids[columns][None, :]
        ranked = np.where(own, -np.inf, scores.astype(np.float64))
        floor = self.floor[rows]
        if len(columns) > self.k:
            floor = np.maximum(floor, np.partition(ranked, -self.k, axis=1)[:, -self.k])
        i, j = np.nonzero((ranked >= floor[:, None]) & ~own)
        self._merge(rows[i], scores[i, j].astype(np.int64), ids[columns[j]])

    def _merge(self, row: np.ndarray, score: np.ndarray, found: np.ndarray) -> None:
        touched = np.zeros(len(self.ids), bool)
        touched[row] = True
        old = touched[self.row]
        row, score, found = (np.concatenate([x[old], y]) for x, y in ((self.row, row), (self.score, score), (self.found, found)))
        order = np.lexsort((found, ~score, row))
        row, score, found = row[order], score[order], found[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[row[last]] = score[last]
        self.row, self.score, self.found = (np.concatenate([x[~old], y[keep]]) for x, y in ((self.row, row), (self.score, score), (self.found, found)))


def _best(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, Best] = {}
    for batch in batches:
        for r in range(batch.num_rows):
            row = {n: batch.column(n)[r] for n in ("block", "qids", "qdata", "ids", "data")}
            n = row["block"].as_py()
            if n not in blocks:
                ids = np.frombuffer(row["qids"].as_buffer(), np.int64)
                blocks[n] = Best(ids, np.frombuffer(row["qdata"].as_buffer(), np.float64).reshape(len(ids), -1).copy(), k)
            ids = np.frombuffer(row["ids"].as_buffer(), np.int64)
            blocks[n].meet(ids, np.frombuffer(row["data"].as_buffer(), np.float64).reshape(len(ids), -1))
    for b in blocks.values():
        yield pa.RecordBatch.from_arrays([pa.array(b.ids[b.row]), pa.array(b.found), pa.array(b.score)], ["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding",
    k: int = 20, scale: float = 64.0, block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row for which ``is_query`` holds.

    Components are ``floor(scale * x)``; ties go to the smaller id; with fewer rows all are returned.
    """
    spark = on_workers(vectors.sparkSession)
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("v") > 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.expr(is_query).alias("asks")).where(good & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asked")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if sizes is None or not sizes["asked"]:
        return empty
    rows = rows.where(F.size("v") == sizes["d"])
    blocks = -(-sizes["asked"] // block)
    stripes = max(1, -(-2 * partitions(spark) // blocks))
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def one_block(whole: pa.Table) -> pa.Table:
        return _packed_block(scale, whole.combine_chunks())

    packs = asked.groupBy("block").applyInArrow(one_block, "block int, ids binary, data binary")
    asking = packs.select("block", F.col("ids").alias("qids"), F.col("data").alias("qdata"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    scanned = rows.select("vec_id", "v").mapInArrow(partial(_packed, scale=scale, rows=1024), "first long, ids binary, data binary")
    stripe = F.pmod(F.xxhash64("first", F.length("ids")), F.lit(stripes)).cast("int")
    met = scanned.select("ids", "data", stripe.alias("stripe"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    pairs = met.join(asking.hint("shuffle_hash"), ["block", "stripe"]).select("block", "qids", "qdata", "ids", "data")
    best = pairs.mapInArrow(partial(_best, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, vectors: np.ndarray, asks: np.ndarray, k: int = 20, scale: float = 64.0) -> pd.DataFrame:
    """The same by one matrix product, for tests."""
    whole = np.floor(scale * vectors.astype(np.float64)).astype(np.int64)
    scores, out = whole[asks] @ whole.T, []
    for q, row in zip(ids[asks], scores, strict=True):
        order = [j for j in np.lexsort((ids, -row)) if ids[j] != q][:k]
        out += [(q, n + 1, ids[j], row[j]) for n, j in enumerate(order)]
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
