"""Bounded samples of labelled documents, from rows that are not held out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from panelwise.llm.common import held_out, landed, slices, texts_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """text, y of at most ``per_class`` ids of each label that ``docs`` has, those of smallest hash.

    Only the ids are broadcast, ``2 * per_class`` of them at most. An id with several labels counts
    with the smaller one; repeated documents of one id are all taken. The sample is written once.
    """
    y = F.col(label).cast("int")
    known = labels.select(F.col(key).cast("long").alias("_id"), y.alias("y")).where("y IN (0, 1) AND _id IS NOT NULL").where(~held_out("_id"))
    known = known.groupBy("_id").agg(F.min("y").alias("y"))
    present = docs.select(F.col(key).cast("long").alias("_id"))
    known = landed(known.join(present, "_id", "left_semi"), "known-labels")
    drawn = [known.where(F.col("y") == c).orderBy(F.xxhash64("_id", F.lit(5)), "_id").limit(per_class) for c in (0, 1)]
    texts = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return landed(texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), "_id").select("text", "y"), "labelled")


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_score(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], out: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and a score of each whole text, in one pass without a shuffle."""
    at = docs.columns.index(text)

    def scored_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, [str(i) for i in range(batch.num_columns)])
            for part in slices(named, str(at)):
                column = pa.array(score(texts_of(part.column(at))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*batch.schema.names, out])

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema] + [T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(scored_batches, schema)


def scored(rows: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of rows with a score."""
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
