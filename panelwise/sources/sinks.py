"""Writers. Parquet is the default format; CSV and JSON serve readers outside Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)


def write_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Parquet; ``by`` lays out folders that later scans prune on."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
