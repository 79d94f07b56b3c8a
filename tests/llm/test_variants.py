"""Spelling variants against SQL, and against the definition on hard rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from panelwise.llm import variants
from panelwise.llm.queries import ORACLES, QUERIES
from tests.llm.data import CLASHING, hard_documents
from tools.check_oracles import connect, difference

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows):
    counts = Counter()
    for name, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            at = h % len(run)
            counts[run if h % 199 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_definition(counts):
    out = []
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return pd.DataFrame(out, columns=COLUMNS)


def texts(seed=2, words=60):
    draw = random.Random(seed)
    letters, rows, known = "abcdeéÿñ÷", [], []
    for i in range(words):
        w = "".join(draw.choice(letters) for _ in range(draw.randint(6, 9)))
        known.append((w, 5 + i * i * 3))
        for _ in range(5):
            at = draw.randrange(len(w))
            x = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :], w[:at] + w[at] + w[at:]])
            known.append((x, draw.randint(4, 30)))
    said = [w.upper() if draw.random() < 0.2 else w for w, n in known for _ in range(n)]
    draw.shuffle(said)
    for i in range(0, len(said), 400):
        rows.append((i % 3_000, draw.choice([" ", "一", "_1 "]).join(said[i : i + 400])))
    return rows + [(None, "hidden"), (1, None), (2, "")] + [(3, "équipe équipé ÉQUIPE ÀÉÎÕÜ×÷ÿ" * 3)] * 4 + hard_documents()


def frame(spark, rows):
    schema = f"doc_id long, text string, {CLASHING}, word string, form string, size int, h int"
    return spark.createDataFrame([(*r, *[None] * (schema.count(",") - 1)) for r in rows], schema).repartition(4)


def test_variants_equal_sql(spark, sf):
    got = QUERIES["op12_spelling_variants"](spark, sf).toPandas()
    assert difference(got, connect(sf).execute(ORACLES["op12_spelling_variants"]).df()) is None


def test_variants_equal_their_definition(spark):
    rows = texts()
    want = by_definition(counted(rows))
    assert want.form.notna().sum() > 50 and (want.root != want.form).sum() and want.n_near.max() > 3
    got = variants.spelling_variants(frame(spark, rows)).toPandas()
    assert difference(got, want) is None


def test_many_shards_rounds_and_flushes_change_nothing(spark):
    rows = texts(3, 40)
    want = by_definition(counted(rows))
    counts = variants.word_counts(frame(spark, rows), memory=1 << 12)
    got = variants.variants(counts, shard_words=8, filter_bytes=100).toPandas()
    assert difference(got, want) is None


def test_long_chains_and_long_words(spark):
    chain = [("abcdef" + "g" * i, 5 * 5**i) for i in range(9)]
    rows = chain + [("x" * 3000, 5), ("x" * 2999, 40), ("x" * 1500 + "y" + "x" * 1499, 500), ("zzzzzz", 9)]
    got = variants.variants(spark.createDataFrame(rows, "word string, n long")).toPandas()
    assert difference(got, by_definition(dict(rows))) is None
    assert set(got[got.word.str.startswith("abc")].root) == {chain[-1][0]}


def test_tables_without_words(spark):
    for rows in ([], [(1, None), (2, "a b c"), (3, "123456")]):
        assert variants.spelling_variants(frame(spark, rows)).count() == 0


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = ["aabbcc", "zyxyzz", "÷÷÷÷÷÷"]
    matrix, symbols = variants.letters(words), np.frombuffer("abyz÷ÿ".encode("latin-1"), np.uint8)

    def hashed(word):
        return variants._word_hashes(variants.letters([word]))[0]

    row, place, hashes = variants.shorter(matrix)
    edits = [words[r][:p] + words[r][p + 1 :] for r, p in zip(row, place, strict=True)]
    assert len(edits) == len(set(edits)) and [hashed(e) for e in edits] == hashes.tolist()
    for row, place, symbol, hashes in variants.replaced(matrix, symbols):
        edits = [words[r][:p] + chr(s) + words[r][p + 1 :] for r, p, s in zip(row, place, symbol, strict=True)]
        assert len(edits) == len(set(edits)) and [hashed(e) for e in edits] == hashes.tolist()


def test_filters_keep_what_they_were_given():
    draw = np.random.default_rng(0)
    hashes, others = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (20_000, 200_000))
    made = variants.bloom(hashes)
    assert len(variants.held(made, hashes)) == len(hashes) and len(variants.held(made, others)) < 0.01 * len(others)
    assert variants.rounds([(6, 0, 50), (6, 1, 50), (7, 0, 120), (8, 0, 10)], 100) == [[(6, 0), (6, 1)], [(7, 0)], [(8, 0)]]
