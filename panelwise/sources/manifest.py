"""What input is there, and how much of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE_IN_PATH = r"([^/]+)\.parquet"


def file_manifest(spark: SparkSession, folder: str, required: Sequence[str]) -> DataFrame:
    """(name, present, bytes) per required table, from the file listing alone.

    A table is one file or a folder of part files; contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.regexp_extract("path", TABLE_IN_PATH, 1).alias("name"), "length")
        .groupBy("name")
        .agg(F.sum("length").alias("bytes"))
    )
    wanted = spark.createDataFrame([(n,) for n in required], "name string")
    return wanted.join(files, "name", "left").select(
        "name",
        F.col("bytes").isNotNull().alias("present"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows) per table; the count of a Parquet table needs its footers only."""
    counts = [
        df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.select("name", "n_rows")
