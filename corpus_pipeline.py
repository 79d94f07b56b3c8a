"""A corpus from documents to packed sequences: four stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the
last return the columns they were given. Null and empty texts pass the classifiers as their models
score them; rows that repeat in id and text are one document for the duplicate stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelwise.llm import jaccard, packing, quality, toxicity
from panelwise.llm.common import landed, table
from panelwise.llm.labelled import fresh

#: SQL cannot express the classifiers; the stages are tested against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours vote for."""
    voters, out = quality.fit(docs, table(spark, sf_dir, "labels")), fresh(docs, "score")
    return quality.quality_scores(docs, voters, out=out).where(F.col(out) >= 0.5).drop(out)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    lexicon, out = toxicity.fit(docs, table(spark, sf_dir, "labels")), fresh(docs, "score")
    return toxicity.toxicity_scores(docs, lexicon, out=out).where(F.col(out) < 0.7).drop(out)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the document of smallest id; of rows with equal id and text, one.

    A row is known by a hash of id and text, so ids may repeat with other texts.
    """
    row = fresh(docs, "row")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_groups(keyed.select(row, "text"), key=row).select(F.col("doc_id").alias(row), "component_id").distinct()
    heads = groups.join(keyed.select(row, "doc_id").distinct(), row)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = heads.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{row}").alias(row))
    n = fresh(docs, "n")
    once = F.row_number().over(Window.partitionBy(row).orderBy("doc_id"))
    return keyed.join(kept, row, "left_semi").withColumn(n, once).where(F.col(n) == 1).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each_group),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
