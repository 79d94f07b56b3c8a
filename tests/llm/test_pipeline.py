import pytest

from tests.llm.data import CLASHING, hard_documents
from tests.llm.test_jaccard import brute_force

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.01"


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    good = pipeline.good_quality(spark, docs, SF)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    said = [i for i in before if i in labels]
    assert sum((i in kept) == labels[i][0] for i in said) >= 0.97 * len(said)
    one = pipeline.one_of_each_group(spark, docs, SF)
    groups = {}
    for i, _, top in brute_force(list(before.items())):
        groups.setdefault(top, []).append(i)
    assert sorted(r.doc_id for r in one.collect()) == sorted(groups)


def test_run_packs_what_the_stages_keep(spark):
    got = pipeline.run(spark, SF).collect()
    assert len(got) > 500 and max(r.offset + r.length for r in got) <= 4096


def test_hard_documents_with_more_columns(spark):
    clash = ", ".join(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in CLASHING.split(", ") if c.split()[0] != "score")
    docs = spark.createDataFrame([(*r, 0.5) for r in hard_documents()], "doc_id long, text string, score double").selectExpr("*", *clash.split(", "))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    texts = [r.text for r in pipeline.one_of_each_group(spark, docs, SF).collect()]
    assert len([t for t in texts if t == "one two three"]) == 1 and None in texts and "" in texts
