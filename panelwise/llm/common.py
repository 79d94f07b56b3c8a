"""What the operators of this subpackage share: worker imports, tables, written steps, byte slices."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwise.plans.bindings import table
from panelwise.session import landed, new_folder

__all__ = ["held_out", "landed", "new_folder", "on_workers", "partitions", "pieces", "slices", "table", "texts_of", "whole_groups"]


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    A cluster without that path gets the package with ``--py-files`` as usual.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_column: str) -> Column:
    """Rows that no model learns from; a row without an id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(True))


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one array with 64-bit offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows and about ``limit`` bytes of text; a longer text is a run alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes, dtype=np.int64) - 1) // limit
    cuts = sorted({0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), *range(0, batch.num_rows, rows), batch.num_rows})
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def pieces(text: bytes, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """What is left between blanks after ``table`` is applied to a text's bytes, about a megabyte at a time."""
    clean, at = text.translate(table), 0
    while at < len(clean):
        end = clean.find(b" ", at + size) if len(clean) > at + size else -1
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete runs of equal keys, with the runs' starts and the end; rows arrive in order of the keys.

    Holds a batch and the last run, so runs must be bounded.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and all(batch.column(k)[0] == held[-1].column(k)[-1] for k in keys) and not len(_changes(batch, keys)):
            held.append(batch)  # the run goes on
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        cuts = _changes(rows, keys)
        if len(cuts):
            yield rows.slice(0, cuts[-1]), np.r_[0, cuts]
        held = rows.slice(cuts[-1] if len(cuts) else 0).to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, np.array([0, len(rows)])


def _changes(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The places whose keys differ from the row before."""
    n, differs = rows.num_rows, np.zeros(max(rows.num_rows - 1, 0), bool)
    for k in keys:
        column = rows.column(k)
        differs |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False) if n > 1 else differs
    return np.flatnonzero(differs) + 1
