"""The scoring service as a stream: request documents in, scored rows out.

Scoring looks at one request at a time and keeps no state, so it is the batch operator on a
streaming frame; exactly-once output comes from the checkpoint and the file sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from panelwise.operators.models import batch_score


def read_requests(
    spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 1000
) -> DataFrame:
    """JSON request documents, one per line, as they land in ``folder``."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )


def score_requests(
    requests: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    out: str,
    checkpoint: str,
    drain: bool = False,
) -> StreamingQuery:
    """Write scored requests to ``out``; ``drain`` stops when everything there is scored."""
    writer = (
        batch_score(requests, model, features)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()
