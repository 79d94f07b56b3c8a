import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelwise.llm import quality, toxicity
from panelwise.llm.labelled import fresh, labelled_sample, with_score
from panelwise.llm.queries import QUERIES
from tests.llm.data import frame, hard_documents


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 3 == 1


def auc(score, y):
    order = np.argsort(np.argsort(score))
    n = y.sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("name", "label", "least", "threshold"), [("op2_quality_classifier", "quality", 0.99, 0.5), ("op5_toxicity", "toxic", 0.85, 0.7)])
def test_held_out_documents(spark, name, label, least, threshold):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES[name](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in got)
    rows = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    score, y = (np.array(x) for x in zip(*rows, strict=True))
    assert auc(score, y) >= least


def fitted(spark, model, rows, label, labels):
    known = spark.createDataFrame(labels, f"doc_id long, {label} int, text string")
    return model.fit(frame(spark, rows), known)


JUNK = [(100 + i, "buy!! now!! cheap!! $$$ " * (5 + i)) for i in range(30)]
GOOD = [(200 + i, " ".join(f"plain word number text {chr(97 + (i + j) % 26)}" for j in range(20)) + ".") for i in range(30)]
SAID = [(i, int(i >= 200), "a clashing column") for i, _ in JUNK + GOOD] + [(None, 1, ""), (100, 1, ""), (7, None, "")]


def test_quality_of_hard_documents(spark):
    rows = JUNK + GOOD + hard_documents()
    voters = fitted(spark, quality, rows, "quality", SAID)
    assert not np.isnan(voters.vectors).any() and set(voters.labels) == {0, 1}
    docs = frame(spark, rows)
    got = quality.quality_scores(docs, voters, k=5, out=fresh(docs, "score"))
    assert got.columns == [*docs.columns, "_score"]
    by_text = {}
    for r in got.collect():
        assert 0 <= r._score <= 1 and by_text.setdefault(r.text or "", r._score) == r._score
    assert by_text[""] == voters.prior
    assert all(by_text[t] < 0.5 for _, t in JUNK) and all(by_text[t] > 0.5 for _, t in GOOD)


def test_toxicity_of_hard_documents(spark):
    bad = [(300 + i, f"you are a mean ogre number {i} and more words follow here") for i in range(30)]
    clean = [(400 + i, f"you are a kind reader number {i} and a wooden ogre stands here") for i in range(30)]
    labels = [(i, int(i < 400), "") for i, _ in bad + clean]
    lexicon = fitted(spark, toxicity, bad + clean + hard_documents(), "toxic", labels)
    assert " wooden ogre " in lexicon.exceptions or " ogre " not in lexicon.weights
    docs = frame(spark, bad + clean + hard_documents())
    got = {r.text or "": r.tox for r in toxicity.toxicity_scores(docs, lexicon, out="tox").collect()}
    assert all(got[t] >= 0.7 for _, t in bad) and all(got[t] < 0.7 for _, t in clean) and got[""] < 0.7


@pytest.mark.parametrize("model", [quality, toxicity])
def test_without_labels_or_documents(spark, model):
    label = "quality" if model is quality else "toxic"
    fit = fitted(spark, model, hard_documents(), label, [])
    docs = frame(spark, hard_documents())
    scores = quality.quality_scores if model is quality else toxicity.toxicity_scores
    assert {r._score for r in scores(docs, fit, out="_score").collect()} == ({0.5} if model is quality else {0.0})
    assert scores(frame(spark, []), fit, out="_score").count() == 0


def test_folding():
    plain = toxicity.folded("loser idiot").split()
    assert toxicity.folded("L0SER 1D1OT").split() == plain
    assert toxicity.folded("lоsеr ｉdіot").split() == plain
    assert toxicity.folded("lo​ser id!ot").split() == plain
    assert toxicity.folded("a.b,c!").split() == ["a", "b", "c"]


@pytest.mark.parametrize("text", ["“loser” idiot", "loser—idiot", "loser…idiot", "«loser»\u00a0idiot", "loser\u2028idiot", "loser\x85idiot", "loser、idiot！", "loser→idiot"])
def test_marks_of_any_script_part_words(text):
    assert toxicity.folded(text).split() == toxicity.folded("loser idiot").split()
    assert all(w in toxicity.folded(text) for w in (toxicity.folded("loser"), toxicity.folded("idiot")))


def test_phrases_hold_whole_words():
    long = "w" * 300
    text = toxicity.folded(f"{long}  ogre   {long} end")
    assert toxicity.around(text, text.index(" ogre")) == [f" {long} ogre ", f" ogre {long} "]
    assert toxicity.around(" ogre ", 0) == [] and toxicity.around(" a ogre ", 2) == [" a ogre "]


def test_exceptions_cancel_hits():
    lexicon = toxicity.Lexicon({" ogre ": 5.0, " ogr": 4.0}, frozenset({" wooden ogre "}), (-3.0, 2.0, 1.0))
    automaton = lexicon.automaton()
    hits = [sum(toxicity.found_in(toxicity.folded(t), automaton).values()) for t in ("an ogre", "a wooden ogre", "ogres here", "none")]
    assert hits == [5.0, 0, 4.0, 0]


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    got = labelled_sample(docs, labels, "quality", 50).collect()
    assert len(got) == 100 and not any(held(int(r.text[1:])) for r in got)


def test_shapes():
    assert quality.shape("Ingou###") == "Aa#" and quality.shape("ÉLLE!!") == "A!" and quality.shape("12,5") == "0,0"
    counts = quality.term_counts(pa.array(["a a a", "", "x y"], pa.large_string()))
    assert counts[0, quality.AGAIN] == 2 and counts[1].sum() == 0 and counts[2, quality.AGAIN] == 0


def test_score_column_keeps_all_others(spark):
    docs = spark.sql("SELECT 1L AS doc_id, map('k', array(1)) AS m, 'abc' AS text, timestamp'2024-01-01 00:00:00' AS at")
    row = with_score(docs, lambda t: np.array([float(len(x.as_py())) for x in t]), "s").first()
    assert row.s == 3.0 and row.m == {"k": [1]} and row.doc_id == 1


def test_folding_of_styled_capitals_and_accents():
    styled = "".join(chr(0x1D400 + ord(c) - ord("A")) for c in "VENOM")
    for text in (styled, "V\u00c9N\u00d6M", "ve\u0301nom", "\uff36\uff25\uff2e\uff2f\uff2d"):
        assert toxicity.folded(text) == toxicity.folded("venom") == " venom "


def test_labelled_sample_draws_from_the_documents_at_hand(spark):
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    docs = spark.range(2900, 3000).selectExpr("id AS doc_id", "'some text' AS text")
    got = labelled_sample(docs, labels, "toxic", 5).groupBy("y").count().collect()
    assert {(r.y, r["count"]) for r in got} == {(0, 5), (1, 5)}
