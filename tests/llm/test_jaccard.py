import random
import re

import numpy as np
import pyarrow as pa
import pytest

from panelwise.llm import jaccard
from panelwise.llm.links import components
from panelwise.llm.queries import ORACLES, QUERIES
from panelwise.llm.shingles import shingle_hashes
from tests.llm.data import frame, hard_documents, words
from tools.check_oracles import connect, difference


def sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_force(rows):
    """(id, size, component) of each row by comparing all pairs."""
    s, top = sets([t for _, t in rows]), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(s[i] & s[j])
            if s[i] and s[j] and 100 * common >= 75 * len(s[i] | s[j]):
                low, high = sorted((top[i], top[j]))
                top = [low if t == high else t for t in top]
    ids = {}
    for (i, _), t in zip(rows, top, strict=True):
        ids.setdefault(t, []).append(i)
    least = {t: min((i for i in x if i is not None), default=None) for t, x in ids.items()}
    return sorted(((i, len(x), least[t]) for (i, _), x, t in zip(rows, s, top, strict=True)), key=repr)


def got(spark, rows, **more):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(frame(spark, rows), **more).collect()), key=repr)


def test_hard_documents(spark):
    rows = hard_documents()
    assert got(spark, rows, limit=4096) == brute_force(rows)


def test_random_near_copies_in_small_blocks(spark):
    """Groups beyond a block are joined in blocks, by heads, then in pairs of blocks."""
    draw, rows = random.Random(3), []
    for g in range(6):
        base = words(80, 100 + g).split()
        for _ in range(25):
            copy = list(base)
            for _ in range(draw.randrange(0, 7)):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(30)}"
            rows.append((len(rows), " ".join(copy[: draw.randrange(60, 81)])))
    draw.shuffle(rows)
    assert got(spark, rows, block=4, limit=8192) == brute_force(rows)


def test_empty_table_and_no_links(spark):
    assert got(spark, []) == []
    rows = [(i, words(20, i)) for i in range(5)]
    assert got(spark, rows) == brute_force(rows)


def test_query_equals_sql(spark, sf):
    name = "op8_ngram_jaccard_join"
    assert difference(QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLES[name]).df()) is None


def test_shingles_of_many_texts_equal_those_of_each():
    texts = [t or "" for _, t in hard_documents()]
    hashes, owner = shingle_hashes(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        alone = shingle_hashes(pa.array([t], pa.large_string()))[0]
        assert np.array_equal(np.sort(hashes[owner == i]), alone)
        assert len(alone) == len(sets([t])[0])


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(5, 9), (9, 2), (7, 8), (8, 7), (2, 7)]])
def test_components(spark, links):
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: n for link in links if link[0] != link[1] for n in link}
    for _ in links:
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert found == want
