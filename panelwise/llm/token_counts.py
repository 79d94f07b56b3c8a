"""Token counts of whole texts: Arrow batches in, lengths out.

Batches are cut into runs of about equal bytes, texts at blanks, which no token crosses; distinct
chunks go to the library in batches of about equal bytes and only their lengths come back. One pass,
no shuffle: a long text or a hot source costs no more than its bytes.

Nulls count as empty texts with no bytes and no tokens; a null id stays null; repeated rows are
counted each; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from panelwise.llm.common import on_workers, slices, texts_of
from panelwise.llm.wordpieces import encoder


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = texts_of(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(encoder(vocabulary).counts(texts), pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; ``vocabulary`` is a word tokenizer's file."""
    on_workers(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = narrow.mapInArrow(partial(_counted, vocabulary=vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
