"""Approximate nearest neighbours by inner product: a graph made by NN-descent, searched greedily.

1. Equal vectors are one node, which carries the smallest ids it can be asked for (``k + 1``). Each node
   has a code: its numbers as bytes of its largest number. Graph and search compare codes.
2. First lists come from ``trees`` orders of all nodes by the signs of random projections; neighbours in
   such an order are compared in leaves of ``leaf`` nodes. Orders are range partitioned with a hash as
   the last key, so leaves are even whatever the vectors.
3. NN-descent: every node is sent, as an edge's other end, to all nodes it neighbours (either way), and
   what meets there is compared. A pair counts where one of its edges is new and the score beats the
   ``degree``-th of one end; each task keeps the best for each node before they are shuffled. Rounds end
   when fewer than ``least_new`` of all edges are new, or after ``rounds``.
4. Greedy search: a query starts from its own node's list and from the best of ``entries`` nodes, which
   are broadcast. Each round expands all of its ``beam`` best that are not expanded yet, by a join with the
   neighbours' codes; it ends when no query has any left.
5. The best by code get exact inner products in double precision; members of nodes become rows.

A node that very many others point to is dealt, by hash, to groups of about ``block`` ends; each group
has all of its own neighbours. Nothing is capped. Recall is what the method gives: it is measured in the
tests and stated in the README. Vectors that are null, zero, of another length than most, or hold nulls or
non-finite numbers take no part, nor do rows without an id. A repeated id asks once for each of its
different vectors, and only its own row is left out of the answer. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwise.llm.common import landed, on_workers, partitions, whole_groups

LISTS = "node long, ids array<long>, scores array<double>"
#: Signs of projections that order the nodes.
SIGNS = 30
#: Pairs held before the best of each node are picked.
HELD = 1 << 20


# --- nodes ------------------------------------------------------------------------------------


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, but for vectors of another length."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & good)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            largest = np.abs(v).max(axis=1)
            codes = np.rint(v / largest[:, None] * 127).astype(np.int8)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(largest / 127)], [*batch.schema.names, "code", "scale"])


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """(node, v, ids, code, scale): one row for each different vector, with its ``keep`` smallest ids."""
    hashed = rows.withColumn("h", F.xxhash64("v"))
    first = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    some = hashed.withColumn("n", first).where(F.col("n") <= keep)
    classes = some.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    numbered = landed(classes.select(F.monotonically_increasing_id().alias("node"), "v", "ids"), "nodes")
    return landed(numbered.mapInArrow(_coded, "node long, v array<double>, ids array<long>, code binary, scale double"), "codes")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Codes of equal length as a matrix."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.int8).reshape(len(data), -1)


def products(a: np.ndarray, b: np.ndarray, scale_a: np.ndarray, scale_b: np.ndarray) -> np.ndarray:
    """Inner products of codes: whole numbers times the product of scales, the same from either side."""
    kind = np.float32 if a.shape[1] <= 1024 else np.float64
    return (a.astype(kind) @ b.astype(kind).T) * np.multiply.outer(scale_a, scale_b)


# --- lists ------------------------------------------------------------------------------------


def best(node: np.ndarray, other: np.ndarray, score: np.ndarray, k: int, known: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The k best different others of each node: (node, other, score, whether any of it was known), by node."""
    seen = np.zeros(len(node), bool) if known is None else known
    order = np.lexsort((~seen, other, -score, node))
    node, other, score, seen = node[order], other[order], score[order], seen[order]
    keep = np.ones(len(node), bool)
    keep[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, score, seen = node[keep], other[keep], score[keep], seen[keep]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    rank = np.arange(len(node)) - np.repeat(starts, np.diff(np.r_[starts, len(node)]))
    keep = rank < k
    return node[keep], other[keep], score[keep], seen[keep]


def listed(node: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """Values as one list for each run of equal nodes."""
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[starts, len(node)], pa.int32())
    return [pa.array(node[starts]), *(pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values)]


def flat(rows: pa.Table, *names: str) -> list[np.ndarray]:
    """List columns end to end, with the number of the row before them."""
    columns = [rows.column(n).combine_chunks() for n in names]
    sizes = pc.list_value_length(columns[0]).to_numpy(zero_copy_only=False)
    return [np.repeat(np.arange(len(rows)), sizes), *(c.flatten().to_numpy(zero_copy_only=False) for c in columns)]


class Pairs:
    """Scored pairs of a task, as lists of the best once enough are held."""

    def __init__(self, k: int):
        self.k, self.parts, self.held = k, [], 0

    def add(self, node: np.ndarray, other: np.ndarray, score: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((node, other, score))
        self.held += len(node)
        if self.held >= HELD:
            yield from self.made()

    def made(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            node, other, score, _ = best(*(np.concatenate(x) for x in zip(*self.parts, strict=True)), self.k)
            yield pa.RecordBatch.from_arrays(listed(node, other, score), ["node", "ids", "scores"])
        self.parts, self.held = [], 0


def _leaves(batches: Iterator[pa.RecordBatch], leaf: int, k: int) -> Iterator[pa.RecordBatch]:
    """Compare the nodes of each ``leaf`` rows that follow one another in one order."""
    pairs = Pairs(k)
    for rows, cuts in _runs_of(batches, leaf):
        node, codes, scale = rows.column("node").to_numpy(), matrix(rows.column("code")), rows.column("scale").to_numpy()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                score = products(codes[a:b], codes[a:b], scale[a:b], scale[a:b])
                np.fill_diagonal(score, -np.inf)
                top = np.argpartition(-score, min(k, b - a - 1) - 1, axis=1)[:, : min(k, b - a - 1)]
                yield from pairs.add(np.repeat(node[a:b], top.shape[1]), node[a:b][top].ravel(), np.take_along_axis(score, top, axis=1).ravel())
    yield from pairs.made()


def _runs_of(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of one order at a time, cut every ``leaf`` rows; a short end goes with the run before it."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        tree = rows.column("tree").to_numpy()
        while len(rows) and (tree[0] != tree[-1] or len(rows) >= 3 * leaf):
            end = int(np.searchsorted(tree, tree[0], side="right"))
            end = end if end < len(rows) else len(rows) // leaf * leaf - leaf
            yield rows.slice(0, end).combine_chunks(), _cuts(end, leaf)
            rows, tree = rows.slice(end).combine_chunks(), tree[end:]
        held = rows
    if held is not None and len(held):
        yield held, _cuts(len(held), leaf)


def _cuts(n: int, leaf: int) -> np.ndarray:
    return np.r_[np.arange(0, max(1, n // leaf)) * leaf, n]


def _ordered(batches: Iterator[pa.RecordBatch], planes: np.ndarray, middle: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each node once for each order: tree, place (its signs, first plane first)."""
    weights = 1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        codes = matrix(batch.column("code")).astype(np.float32) if batch.num_rows else None
        for tree in range(len(planes) if batch.num_rows else 0):
            place = (codes @ planes[tree] > middle[tree]) @ weights
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, tree, np.int32)), pa.array(place), *(batch.column(c) for c in ("node", "code", "scale"))], ["tree", "place", "node", "code", "scale"])


def _merged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Lists of one node as one list of its k best; new are those no known list had."""
    for rows, _ in whole_groups(batches, ["node"]):
        row, other, score = flat(rows, "ids", "scores")
        node, known = rows.column("node").to_numpy()[row], rows.column("known").to_numpy()[row]
        node, other, score, known = best(node, other, score, k, known)
        yield pa.RecordBatch.from_arrays(listed(node, other, score, ~known), ["node", "ids", "scores", "new"])


def merged(lists: DataFrame, k: int) -> DataFrame:
    """(node, ids, scores, new) from lists with ``known``."""
    spread = lists.repartition(partitions(lists.sparkSession), "node").sortWithinPartitions("node")
    return spread.mapInArrow(partial(_merged, k=k), LISTS + ", new array<boolean>")


def sampled(nodes: DataFrame, n: int, rows: int) -> pa.Table:
    """About ``rows`` of ``n`` nodes by hash, never more than twice that in any task."""
    share = min(1.0, 2 * rows / max(n, 1))
    h = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30))
    return nodes.where(h <= share * (1 << 30)).orderBy(h, "node").limit(rows).select("node", "code", "scale").toArrow()


# --- NN-descent -------------------------------------------------------------------------------


def first_lists(nodes: DataFrame, n: int, degree: int, trees: int, leaf: int, sample: int = 2000, seed: int = 3) -> DataFrame:
    """Lists from the leaves of ``trees`` orders by signs of random projections, as many above as below the middle."""
    codes = matrix(sampled(nodes, n, sample)["code"]).astype(np.float32)
    planes = np.random.default_rng(seed).normal(size=(trees, codes.shape[1], SIGNS)).astype(np.float32)
    middle = np.stack([np.median(codes @ p, axis=0) for p in planes])
    spread = nodes.select("node", "code", "scale").mapInArrow(partial(_ordered, planes=planes, middle=middle), "tree int, place long, node long, code binary, scale double")
    keys = ["tree", "place", F.xxhash64("node")]
    ordered = spread.repartitionByRange(partitions(nodes.sparkSession), *keys).sortWithinPartitions(*keys)
    found = ordered.mapInArrow(partial(_leaves, leaf=leaf, k=degree), LISTS)
    return landed(merged(found.withColumn("known", F.lit(False)), degree), "graph")


def _met(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The pairs of each group that have a new edge and beat what one end has."""
    pairs = Pairs(k)
    for rows, cuts in whole_groups(batches, ["centre", "part"]):
        node, new, scale, floor = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("member", "new", "scale", "floor"))
        codes, found = matrix(rows.column("code")), []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1 and new[a:b].any():
                score = products(codes[a:b], codes[a:b], scale[a:b], scale[a:b])
                better = (score > floor[a:b, None]) & (new[a:b, None] | new[None, a:b]) & (node[a:b, None] != node[None, a:b])
                i, j = np.nonzero(better)
                found.append((node[a + i], node[a + j], score[i, j]))
        if found:
            yield from pairs.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
    yield from pairs.made()


def _floor(degree: int) -> Column:
    return F.when(F.size("ids") < degree, float("-inf")).otherwise(F.element_at("scores", -1))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode(F.arrays_zip(F.col("ids").alias("other"), "new")).alias("e")).select("node", "e.other", "e.new")


def descend(nodes: DataFrame, graph: DataFrame, degree: int, block: int) -> DataFrame:
    """One round: each node's neighbours, and those it is a neighbour of, are compared with one another."""
    edges = _edges(graph)
    ends = graph.select(F.col("node").alias("member"), _floor(degree).alias("floor")).join(nodes.select(F.col("node").alias("member"), "code", "scale"), "member")
    forward = edges.select(F.col("node").alias("centre"), F.col("other").alias("member"), "new")
    back = edges.select(F.col("other").alias("centre"), F.col("node").alias("member"), "new")
    hubs = back.groupBy("centre").agg(F.count("*").alias("n")).where(F.col("n") > block)
    parts = landed(hubs.select("centre", F.ceil(F.col("n") / block).cast("int").alias("parts")), "hubs")
    if parts.limit(1).count():
        parts_of = F.coalesce("parts", F.lit(1))
        back = back.join(parts, "centre", "left").withColumn("part", F.pmod(F.xxhash64("member"), parts_of).cast("int")).drop("parts")
        forward = forward.join(parts, "centre", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts_of - 1))).drop("parts")
    else:
        back, forward = (x.withColumn("part", F.lit(0)) for x in (back, forward))
    members = forward.unionByName(back).groupBy("centre", "part", "member").agg(F.max("new").alias("new"))
    full = members.join(ends, "member")
    met = full.repartition(partitions(nodes.sparkSession), "centre", "part").sortWithinPartitions("centre", "part")
    found = met.mapInArrow(partial(_met, k=degree), LISTS).withColumn("known", F.lit(False))
    known = graph.select("node", "ids", "scores").withColumn("known", F.lit(True))
    return landed(merged(known.unionByName(found), degree), "graph")


def built(nodes: DataFrame, n: int, degree: int, trees: int, leaf: int, rounds: int, least_new: float, block: int) -> DataFrame:
    """The neighbour graph: (node, ids, scores, new), lists of ``degree`` in order of their scores."""
    graph = first_lists(nodes, n, degree, trees, leaf)
    for _ in range(rounds if n > leaf else 0):
        graph = descend(nodes, graph, degree, block)
        new, all_edges = graph.agg(F.sum(F.size(F.filter("new", lambda x: x))), F.sum(F.size("ids"))).first()
        if not all_edges or new < least_new * all_edges:
            break
    return graph


# --- search -----------------------------------------------------------------------------------


def _started(batches: Iterator[pa.RecordBatch], entries: Broadcast, seeds: int) -> Iterator[pa.RecordBatch]:
    """Each query's list with the best entries added; nothing but itself counts as expanded."""
    ids, codes, scales = entries.value
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            mine, scale, node = matrix(rows.column("code")), rows.column("scale").to_numpy(), rows.column("node").to_numpy()
            score = products(mine, codes, scale, scales)
            top = np.argsort(-score, axis=1, kind="stable")[:, :seeds]
            own = (mine.astype(np.float64) ** 2).sum(axis=1) * scale**2
            row, other, old = flat(rows, "ids", "scores")
            every = np.concatenate([node, node[row], np.repeat(node, top.shape[1])])
            others = np.concatenate([node, other, ids[top].ravel()])
            values = np.concatenate([own, old, np.take_along_axis(score, top, axis=1).ravel()])
            n, o, s, _ = best(every, others, values, len(others))
            arrays = listed(n, o, s, o == n)
            at = pc.index_in(arrays[0], rows.column("node").combine_chunks())
            yield pa.RecordBatch.from_arrays([*arrays, *(rows.column(c).combine_chunks().take(at) for c in ("code", "scale"))], ["node", "ids", "scores", "done", "code", "scale"])


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of a query with the neighbours of one node: those that may enter its beam."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).combine_chunks()
        row, other, scale = flat(rows, "ids", "scales")
        codes, d = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.int8), len(rows.column("code")[0].as_py())
        codes, mine = codes.reshape(-1, d).astype(np.float32), matrix(rows.column("code")).astype(np.float32)
        score = np.concatenate([np.einsum("ij,ij->i", codes[a : a + 65536], mine[row[a : a + 65536]]) for a in range(0, len(row), 65536)]) if len(row) else np.zeros(0)
        score = score * (scale * rows.column("scale").to_numpy()[row])
        some = score > rows.column("floor").to_numpy()[row]
        node = rows.column("query").to_numpy()[row[some]]
        yield pa.RecordBatch.from_arrays(listed(*best(node, other[some], score[some], len(row))[:3]), ["node", "ids", "scores"])


def _beams(batches: Iterator[pa.RecordBatch], beam: int) -> Iterator[pa.RecordBatch]:
    """State and finds of each query as its new state; finds follow the state."""
    for rows, cuts in whole_groups(batches, ["node"]):
        row, other, score, done = flat(rows, "ids", "scores", "done")
        node = rows.column("node").to_numpy()
        n, o, s, d = best(node[row], other, score, beam, done.astype(bool))
        arrays = listed(n, o, s, d)
        at = pa.array(cuts[:-1])
        yield pa.RecordBatch.from_arrays([*arrays, *(rows.column(c).combine_chunks().take(at) for c in ("code", "scale"))], ["node", "ids", "scores", "done", "code", "scale"])


STATE = LISTS + ", done array<boolean>, code binary, scale double"


def searched(nodes: DataFrame, graph: DataFrame, queries: DataFrame, n: int, beam: int, entries: int, seeds: int) -> DataFrame:
    """(node, ids, scores) for each node of ``queries`` (node): the ``beam`` best found by greedy search."""
    spark = nodes.sparkSession
    codes = nodes.select("node", "code", "scale")
    far = _edges(graph).join(codes.withColumnsRenamed({"node": "other"}), "other").groupBy("node")
    lists = far.agg(F.collect_list(F.struct("other", "scale", "code")).alias("e")).select(
        "node", F.col("e.other").alias("ids"), F.col("e.scale").alias("scales"), F.expr("aggregate(e, cast('' AS binary), (x, y) -> concat(x, y.code))").alias("codes")
    )
    lists = landed(lists, "neighbours")
    starts = sampled(nodes, n, entries)
    known = spark.sparkContext.broadcast((starts["node"].to_numpy(), matrix(starts["code"]), starts["scale"].to_numpy()))
    own = queries.join(codes, "node").join(graph.select("node", "ids", "scores"), "node", "left")
    own = own.withColumns({c: F.coalesce(c, F.array().cast(kind)) for c, kind in (("ids", "array<long>"), ("scores", "array<double>"))})
    state = landed(own.mapInArrow(partial(_started, entries=known, seeds=seeds), STATE), "beams")
    while True:
        best_of = F.slice(F.arrays_zip("ids", "done"), 1, beam)
        open_ones = F.transform(F.filter(best_of, lambda e: ~e["done"]), lambda e: e["ids"])
        floor = F.when(F.size("scores") < beam, float("-inf")).otherwise(F.element_at("scores", beam))
        frontier = state.select(F.col("node").alias("query"), "code", "scale", floor.alias("floor"), F.explode(open_ones).alias("node"))
        if not frontier.limit(1).count():
            return state.select("node", "ids", "scores")
        found = frontier.join(lists, "node").select("query", "code", "scale", "floor", "ids", "scales", "codes").mapInArrow(_expanded, LISTS)
        kept = state.select("node", "ids", "scores", F.transform("ids", lambda _: F.lit(True)).alias("done"), "code", "scale")
        more = found.select("node", "ids", "scores", F.transform("ids", lambda _: F.lit(False)).alias("done"), F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("scale"))
        both = kept.unionByName(more).repartition(partitions(spark), "node").sortWithinPartitions("node", F.col("code").isNull())
        state = landed(both.mapInArrow(partial(_beams, beam=beam), STATE), "beams")


def nearest(
    vectors: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    degree: int = 32, trees: int = 8, leaf: int = 256, rounds: int = 10, least_new: float = 0.05,
    beam: int = 200, entries: int = 1024, seeds: int = 8, block: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row for which ``is_query`` holds."""
    spark = on_workers(vectors.sparkSession)
    rows = usable(vectors, key, vector)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == size["d"])
    nodes = nodes_of(rows, k + 1)
    n = nodes.count()
    asked = rows.where(F.expr(is_query.replace(key, "vec_id"))).select("vec_id", F.xxhash64("v").alias("h"), "v").distinct()
    named = nodes.select("node", F.xxhash64("v").alias("h"), "v")
    queries = landed(asked.join(named, ["h", "v"]).select(F.col("vec_id").alias("query_id"), "node"), "queries")
    graph = built(nodes, n, degree, trees, leaf, rounds, least_new, block)
    found = searched(nodes, graph, queries.select("node").distinct(), n, beam, entries, seeds)

    near = found.select("node", F.explode(F.slice("ids", 1, 3 * (k + 1))).alias("other"))
    mine = near.join(nodes.select("node", F.col("v").alias("q")), "node")
    pairs = mine.join(nodes.select(F.col("node").alias("other"), "v", "ids"), "other")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    exact = pairs.select("node", "other", "ids", score.alias("score"))
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), F.element_at("ids", 1)))
    exact = exact.withColumn("n", first).where(F.col("n") <= k + 1)
    at = F.array_position("ids", F.col("query_id")).cast("int")
    others = F.when((F.col("node") != F.col("other")) | (at == 0), F.col("ids")).otherwise(F.concat(F.slice("ids", F.lit(1), at - 1), F.slice("ids", at + 1, F.size("ids"))))
    answers = queries.join(exact, "node").select("query_id", "node", F.explode(others).alias("vec_id"), "score")
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
