"""Approximate neighbours: recall and exact scores against brute force."""

import numpy as np
import pytest

from panelwise.llm import descent
from panelwise.llm.queries import QUERIES
from tests.llm.test_vectors import BAD, frame, planted


def brute(rows, k, every=20):
    ids, x = np.array([i for i, _ in rows]), np.array([np.array(v, np.float32) for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(got, want, every=20):
    """Share of the right scores met; ranks, orders and scores are checked exactly."""
    hits = total = 0
    for q, right in want.items():
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, len(right) + 1)) and q not in set(mine.vec_id)
        assert mine.vec_id.is_unique
        order = list(zip(-mine.score, mine.vec_id, strict=True))
        assert order == sorted(order)
        floor = right[-1][1] - 1e-12
        hits += sum(s >= floor for s in mine.score)
        total += len(right)
    assert len(got) == total
    return hits / total


def scores_are_exact(got, rows):
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for r in got.itertuples():
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9


def test_neighbours_on_given_tables(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op11_nearest_neighbours"](spark, sf).toPandas()
    assert recall(got, brute(rows, 20)) >= 0.95
    scores_are_exact(got, rows)


@pytest.mark.parametrize("kind", ["spread", "clusters", "lengths"])
def test_recall_of_small_leaves(spark, kind):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(1500, 24))
    if kind == "clusters":
        x = 0.3 * x + draw.normal(size=(30, 24))[draw.integers(30, size=1500)]
    if kind != "lengths":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    got = descent.nearest(frame(spark, rows), "vec_id % 20 = 0", k=10, degree=16, trees=3, leaf=32, beam=48, entries=64, block=16).toPandas()
    assert recall(got, brute(rows, 10)) >= 0.9
    scores_are_exact(got, rows)


def test_repeated_vectors_bad_rows_and_few_rows(spark):
    rows = planted(3)
    rows += [(2000 + i, rows[5][1]) for i in range(60)] + [(4000, rows[7][1]), (4000, rows[9][1]), (4000, rows[9][1])]
    got = descent.nearest(frame(spark, rows + BAD + [(None, rows[0][1])]), "vec_id % 20 = 0").toPandas()
    want = brute(rows, 20)
    hot = got[got.query_id == 2000].sort_values("rank")
    assert hot.vec_id.tolist() == [i for i, _ in want[2000]] and {5, 2001, 2002} < set(hot.vec_id)
    assert set(got.query_id) == set(want) and not set(got.vec_id) & {i for i, _ in BAD}
    assert len(got[got.query_id == 4000]) == 40  # twenty for each of its two vectors
    few = descent.nearest(frame(spark, rows[:5] + [(0, rows[6][1])]), "vec_id % 20 = 0").toPandas()
    assert len(few) == 2 * 5 and few.groupby("rank").size().to_dict() == dict.fromkeys(range(1, 6), 2)


def test_neighbours_without_usable_rows(spark):
    for rows in ([], BAD[:5], [(1, [1.0, 2.0])], [(20, [1.0, 2.0])]):
        assert descent.nearest(frame(spark, rows), "vec_id % 20 = 0").count() == 0


def test_a_round_finds_better_neighbours(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(draw.normal(size=(800, 16)))]
    nodes = descent.nodes_of(descent.usable(frame(spark, rows), "vec_id", "embedding"), 5)
    graph = descent.first_lists(nodes, 800, 8, 2, 32)
    better = descent.descend(nodes, graph, 8, 16)  # every hub of more than 16 ends is dealt out
    means = [g.selectExpr("avg(aggregate(scores, 0D, (a, b) -> a + b))").first()[0] for g in (graph, better)]
    assert means[1] > means[0] * 1.05
    assert better.where("size(ids) <> 8 OR size(array_distinct(ids)) <> 8 OR array_contains(ids, node)").count() == 0


def test_the_best_of_a_task_are_the_best_of_all():
    draw = np.random.default_rng(1)
    node, other = draw.integers(5, size=400), draw.integers(30, size=400)
    score = (node * 31 + other * 17) % 23 * 1.0
    got = list(zip(*(x.tolist() for x in descent.best(node, other, score, 4)[:3]), strict=True))
    want = []
    for n in range(5):
        mine = sorted({(-s, o) for a, o, s in zip(node.tolist(), other.tolist(), score.tolist(), strict=True) if a == n})[:4]
        want += [(n, o, -s) for s, o in mine]
    assert got == want
