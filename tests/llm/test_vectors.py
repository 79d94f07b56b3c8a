import numpy as np
import pandas as pd
import pytest

from panelwise.llm import near_vectors, top_k
from panelwise.llm.queries import ORACLES, QUERIES
from tools.check_oracles import connect, difference

SCHEMA = "vec_id long, embedding array<float>, cls long, v string, n long, rank int, score string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None, None) for i, v in rows], SCHEMA).repartition(3)


def planted(seed=0, groups=12, d=16):
    draw, rows = np.random.default_rng(seed), []
    for g in range(groups):
        centre = draw.normal(size=d)
        rows += [centre + draw.normal(scale=0.02 + 0.03 * (g % 5), size=d) for _ in range(2 + 3 * g)]
    rows += list(draw.normal(size=(60, d)))
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


BAD = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [float("inf")] * 16), (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [])]


def cosine_groups(rows):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.array(v, np.float32) for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    top = np.arange(len(rows))
    for _ in rows:
        top = np.minimum(top, np.where(near, top[None, :], len(rows)).min(axis=1))
    least = {t: ids[top == t].min() for t in set(top.tolist())}
    return near, ids, np.array([least[t] for t in top.tolist()])


def test_near_vectors_against_brute_force(spark):
    rows = planted()
    rows += [(500, rows[3][1]), (501, rows[3][1]), (501, rows[70][1])]
    near, ids, part = cosine_groups(rows)
    got = near_vectors.near_vectors(frame(spark, rows + BAD), block=8).toPandas()
    alone = got[got.vec_id >= 900]
    assert len(alone) == len(BAD) and (alone.n_links == 0).all() and alone.kept.all()
    got = got[got.vec_id < 900]
    want = pd.DataFrame({"vec_id": ids, "n": near.sum(axis=1)})
    assert got.n_links.sum() <= want.n.sum() and got.n_links.sum() >= 0.9 * want.n.sum()
    if got.n_links.sum() == want.n.sum():
        a = sorted(zip(got.vec_id, got.n_links, got.component_id, strict=True))
        assert a == sorted(zip(ids, want.n, part, strict=True))


def test_ids_shared_by_different_vectors_keep_their_own_counts(spark):
    draw = np.random.default_rng(5)
    a, b, c = draw.normal(size=(3, 16))
    near = [v + draw.normal(scale=0.01, size=16) for v in (a, b, b)]
    rows = [(1, a), (1, b), (7, near[0]), (8, near[1]), (9, near[2]), (1, c), (3, a), (0, draw.normal(size=16)), (0, near[0])]
    rows += [(20 + i, v) for i, v in enumerate(draw.normal(size=(40, 16)))]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    links, ids, part = cosine_groups(rows)
    got = near_vectors.near_vectors(frame(spark, rows)).toPandas()
    assert sorted(zip(got.vec_id, got.n_links, got.component_id, strict=True)) == sorted(zip(ids, links.sum(axis=1), part, strict=True))
    assert sorted(got[got.vec_id == 1].n_links) == [0, 2, 3]


def test_near_vectors_on_given_tables(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    near, *_ = cosine_groups([(r.vec_id, r.embedding) for r in rows])
    got = QUERIES["op10_embedding_near_dedup"](spark, sf).toPandas()
    assert len(got) == len(rows) and 0.9 * near.sum() <= got.n_links.sum() <= near.sum()


def test_near_vectors_without_usable_rows(spark):
    assert near_vectors.near_vectors(frame(spark, [])).count() == 0
    got = near_vectors.near_vectors(frame(spark, BAD)).collect()
    assert len(got) == len(BAD) and all(r.kept and r.n_links == 0 for r in got)


def test_codes_are_balanced_and_keep_neighbours():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 16))
    bits = near_vectors.fit(x, bits=64).bits(x)
    assert bits.shape == (400, 64) and 0.35 < bits.mean() < 0.65
    moved = near_vectors.fit(x, bits=64).bits(x + draw.normal(scale=0.01, size=x.shape))
    assert (bits != moved).mean() < 0.05


def test_top_k_equals_sql_and_brute_force(spark, sf):
    got = QUERIES["op9_exact_top_k"](spark, sf).toPandas()
    assert difference(got, connect(sf).execute(ORACLES["op9_exact_top_k"]).df()) is None


def test_top_k_with_ties_bad_rows_and_small_blocks(spark):
    rows = [(i, [float(x) for x in np.round(v, 1)]) for i, v in planted(4)]
    rows += [(600 + i, rows[i][1]) for i in range(30)]
    got = top_k.top_k(frame(spark, rows + BAD + [(None, rows[0][1])]), "vec_id % 5 = 0", k=7, block=16).toPandas()
    ids, x = np.array([i for i, _ in rows]), np.array([np.array(v, np.float32) for _, v in rows])
    want = top_k.brute_force(ids, x, np.flatnonzero(ids % 5 == 0), 7)
    assert difference(got, want.astype({"rank": "int32"})) is None


def test_top_k_with_large_components_and_few_rows(spark):
    rows = [(0, [3e30, -1e20]), (20, [1e10, 2e10]), (40, [1e9, 5.0])]
    got = {(r.query_id, r.vec_id): r.score for r in top_k.top_k(frame(spark, rows), "vec_id % 20 = 0").collect()}
    assert len(got) == 6 and got[0, 20] == 2**63 - 1
    exact = [int(np.floor(64 * float(np.float32(x)))) for x in (1e10, 1e9, 2e10, 5.0)]
    assert got[20, 40] == min(2**63 - 1, exact[0] * exact[1] + exact[2] * exact[3])
    assert top_k.top_k(frame(spark, []), "vec_id % 20 = 0").count() == 0


def isolated_pairs(d, shift, n=400, single=1200, seed=5, cosine=0.902):
    """Pairs just above the threshold among rows that share a direction; mean norm is about ``shift``."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n + single, d))
    x *= np.sqrt(1 - shift**2) / np.linalg.norm(x, axis=1, keepdims=True)
    x[:, 0] += shift
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    way = draw.normal(size=(n, d))
    way -= (way * x[:n]).sum(axis=1, keepdims=True) * x[:n]
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    y = cosine * x[:n] + np.sqrt(1 - cosine**2) * way
    return [(i, [float(z) for z in v]) for i, v in enumerate([*x, *y])]


@pytest.mark.parametrize(("d", "shift"), [(64, 0.7), (50, 0.0), (384, 0.0), (768, 0.0)])
def test_near_vectors_with_common_direction_and_other_widths(spark, d, shift):
    rows = isolated_pairs(d, shift)
    near, *_ = cosine_groups(rows)
    got = near_vectors.near_vectors(frame(spark, rows), sample=800).toPandas()
    assert len(got) == len(rows) and 0.9 * near.sum() < got.n_links.sum() <= near.sum()


def test_radius_and_keys_follow_the_fitted_code():
    x = np.array([v for _, v in isolated_pairs(64, 0.9)])
    codes, radius, places = near_vectors.fitted(x)
    bits = [codes.bits(v) for v in near_vectors.turned(x[:500] / np.linalg.norm(x[:500], axis=1, keepdims=True), x, 0.9)[0]]
    apart = bits[0] != bits[1]
    met = np.logical_or.reduce([~apart[:, k].any(axis=1) for k in places])
    assert (met & (apart.sum(axis=1) <= radius)).mean() > 0.9
    for few in (np.ones((1, 3)), np.eye(2), np.array([[1.0], [-1.0]])):
        assert len(near_vectors.fitted(few)[2])
