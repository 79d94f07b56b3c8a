"""Training order on disk: every sequence gets a slot from a keyed permutation, shards hold slots in order.

1. Texts become ids and are cut into sequences of at most ``stride`` ids. Each scan task writes its
   sequences, packed by runs of some MB, with the number of sequences before each run; totals of the
   tasks give every run its first number. Nothing is tokenised twice and nothing is gathered.
2. A Feistel network with keyed rounds permutes the numbers; walking its cycles until a number lies
   below the count makes it a permutation of exactly that many slots.
3. Slots are dealt by shard (a range of slots); each shard is a few files, its parts, of records of one
   size in order of slots, so a record's place is arithmetic: shard ``slot // rows``, part ``slot % rows
   // part``, byte ``slot % rows % part * record``. A reading task holds a file, so parts are small
   whatever the shard. Files go through Spark's own writer, which survives lost executors. A reader may
   begin at any slot and goes on sequentially.

A record: doc_id (8 bytes), piece (4), length (4), flags (1: the id is null), ids (2 each, padded with
zeros), a line feed. Null texts are empty; an empty text is one sequence without ids; ids may be null
or repeat; further columns are ignored; an empty table gives no shards.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.llm.common import landed, new_folder, on_workers, slices, texts_of
from panelwise.llm.shingles import mixed
from panelwise.llm.wordpieces import encoder

FACTS = np.dtype([("doc_id", "<i8"), ("piece", "<u4"), ("length", "<u4"), ("null", "u1")])


def record_type(stride: int) -> np.dtype:
    return np.dtype([*FACTS.descr, ("ids", "<u2", (stride,)), ("end", "u1")])


@dataclass(frozen=True)
class Order:
    """A permutation of ``range(count)``: a balanced Feistel network over the next even power of two."""

    count: int
    key: int
    rounds: int = 6

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        half = np.uint64(max(1, -(-max(1, int(self.count - 1).bit_length()) // 2)))
        low = (np.uint64(1) << half) - np.uint64(1)
        keys = mixed(np.arange(1, self.rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.key & (2**64 - 1)))
        out = numbers.astype(np.uint64)
        todo = np.arange(len(out))
        while len(todo):
            left, right = out[todo] >> half, out[todo] & low
            for k in keys:
                left, right = right, left ^ (mixed(right ^ k) & low)
            out[todo] = (left << half) | right
            todo = todo[out[todo] >= self.count]
        return out.astype(np.int64)


def _pack(facts: np.ndarray, ids: np.ndarray, level: int = 3) -> bytes:
    """Facts and ids of some sequences, compressed; from level 3 on, repeated words are found in pairs of bytes."""
    raw = facts.tobytes() + ids.astype("<u2").tobytes()
    return len(facts).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True) + len(raw).to_bytes(8, "little")


def _unpack(blob: bytes, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    n, size = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[-8:], "little")
    raw = pa.decompress(blob[8:-8], size, "zstd", asbytes=True)
    facts = np.frombuffer(raw, kind, n)
    return facts, np.frombuffer(raw, "<u2", -1, facts.nbytes)


def _sequences(batches: Iterator[pa.RecordBatch], vocabulary: str, stride: int) -> Iterator[pa.RecordBatch]:
    task, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, "text"):
            ids, bounds = encoder(vocabulary).ids(texts_of(part.column("text")))
            count = np.diff(bounds)
            n = np.maximum(1, -(-count // stride))
            facts = np.zeros(int(n.sum()), FACTS)
            doc = part.column("doc_id").to_pandas()
            facts["doc_id"], facts["null"] = np.repeat(doc.fillna(0).to_numpy(np.int64), n), np.repeat(doc.isna().to_numpy(), n)
            facts["piece"] = np.arange(len(facts)) - np.repeat(np.cumsum(n) - n, n)
            facts["length"] = np.minimum(np.repeat(count, n) - facts["piece"].astype(np.int64) * stride, stride)
            columns = [pa.array([task], pa.int32()), pa.array([before], pa.int64()), pa.array([len(facts)], pa.int64()), pa.array([_pack(facts, ids, 6)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["task", "before", "n", "packed"])
            before += len(facts)


def _dealt(batches: Iterator[pa.RecordBatch], order: Order, first: Broadcast, rows: int, flush: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Sequences with their slots, packed by shard."""
    kind = np.dtype([("slot", "<i8"), *FACTS.descr])
    held: dict[int, list] = defaultdict(list)
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for shard, parts in held.items():
            blob = _pack(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([blob], pa.binary())], ["shard", "packed"])
        held.clear()

    for batch in batches:
        for r in batch.to_pylist():
            facts, ids = _unpack(r["packed"], FACTS)
            slot = order.slots(first.value[r["task"]] + r["before"] + np.arange(len(facts)))
            length = facts["length"].astype(np.int64)
            start = np.cumsum(length) - length
            by_shard = np.argsort(slot // rows, kind="stable")
            at = np.repeat(start[by_shard] - (np.cumsum(length[by_shard]) - length[by_shard]), length[by_shard]) + np.arange(length.sum())
            sorted_ids, ends = ids[at], np.r_[0, np.cumsum(length[by_shard])]
            shard = (slot // rows)[by_shard]
            whole = np.zeros(len(facts), kind)
            whole["slot"] = slot[by_shard]
            for name in FACTS.names:
                whole[name] = facts[name][by_shard]
            cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)].tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    held[int(shard[a])].append((whole[a:b], sorted_ids[ends[a] : ends[b]]))
            size += 2 * len(ids)
            if size > flush:
                yield from flushed()
                size = 0
    yield from flushed()


def _records(batches: Iterator[pa.RecordBatch], stride: int, rows: int, part: int) -> Iterator[pa.RecordBatch]:
    """Records of one shard after the other, in order of slots; rows arrive by shard."""
    kind = np.dtype([("slot", "<i8"), *FACTS.descr])

    def whole(shard: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(b, kind) for b in blobs]
        facts, ids = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        length = facts["length"].astype(np.int64)
        out = np.zeros(len(facts), record_type(stride))
        for name in FACTS.names:
            out[name] = facts[name]
        out["ids"][np.arange(stride)[None, :] < length[:, None]] = ids
        order = np.argsort(facts["slot"], kind="stable")
        slot, size = facts["slot"][order], out.dtype.itemsize - 1
        for a in range(0, len(out), 2048):
            raw, at = out[order[a : a + 2048]].tobytes(), slot[a : a + 2048]
            some = [raw[i : i + size] for i in range(0, len(raw), size + 1)]
            columns = [pa.array([shard] * len(some), pa.int64()), pa.array(at % rows // part), pa.array(at), pa.array(some, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "part", "slot", "record"])

    last, blobs = None, []
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            if shard != last and blobs:
                yield from whole(last, blobs)
                blobs = []
            last = shard
            blobs.append(blob)
    if blobs:
        yield from whole(last, blobs)


@dataclass(frozen=True)
class Shards:
    """Where the shards are, and what a reader must know of them."""

    path: str
    count: int
    rows: int
    stride: int
    part: int


def materialize(docs: DataFrame, vocabulary: str, path: str | None = None, stride: int = 256, rows: int = 16_384, seed: int = 17, key: str = "doc_id", text: str = "text", part: int = 4096) -> Shards:
    """Write the shards below ``path`` (a new folder in the shared one by default)."""
    spark = on_workers(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    runs = landed(narrow.mapInArrow(partial(_sequences, vocabulary=vocabulary, stride=stride), "task int, before long, n long, packed binary"), "sequences")
    totals = runs.groupBy("task").agg(F.sum("n").alias("n")).orderBy("task").collect()  # one row for each scan task
    count, first = 0, {}
    for r in totals:
        first[r["task"]] = count
        count += r["n"]
    shards = Shards(path or new_folder(spark, "shards"), count, rows, stride, part)
    if not count:
        return shards
    dealt = runs.mapInArrow(partial(_dealt, order=Order(count, seed), first=spark.sparkContext.broadcast(first), rows=rows), "shard long, packed binary")
    ordered = dealt.repartition("shard").sortWithinPartitions("shard")
    records = ordered.mapInArrow(partial(_records, stride=stride, rows=rows, part=part), "shard long, part long, slot long, record binary")
    # Sorted by slot too: the writer's own sort, by shard and part alone, does not keep the order once it spills.
    written = records.sortWithinPartitions("shard", "part", "slot").select(F.col("record").cast("string").alias("value"), "shard", "part")
    written.write.partitionBy("shard", "part").option("compression", "none").text(shards.path)
    return shards


def _read(batches: Iterator[pa.RecordBatch], stride: int, rows: int, part: int, start: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, n, content in zip(batch.column("shard").to_pylist(), batch.column("part").to_pylist(), batch.column("content"), strict=True):
            records = np.frombuffer(content.as_buffer(), record_type(stride))
            slot = shard * rows + n * part + np.arange(len(records))
            records, slot = records[slot >= start], slot[slot >= start]
            for a in range(0, len(records), 2048):
                some = records[a : a + 2048]
                ids = [r["ids"][: r["length"]].astype("<u4").tobytes() for r in some]
                columns = [
                    pa.array(some["doc_id"], mask=some["null"] == 1), pa.array(some["piece"].astype(np.int32)), pa.array(slot[a : a + 2048]),
                    pa.array([shard] * len(some), pa.int64()), pa.array(some["length"].astype(np.int32)), pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "slot", "shard", "length", "ids"])


def read(spark: SparkSession, shards: Shards, start: int = 0) -> DataFrame:
    """doc_id, piece, slot, shard, length, ids (32-bit) of all records from a slot on; earlier files are not opened."""
    on_workers(spark)
    if not shards.count:
        return spark.createDataFrame([], "doc_id long, piece int, slot long, shard long, length int, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(shards.path)
    first, within = start // shards.rows, start % shards.rows // shards.part
    later = (F.col("shard") > first) | (F.col("shard") == first) & (F.col("part") >= within)
    kept = files.where(later).select(F.col("shard").cast("long").alias("shard"), F.col("part").cast("long").alias("part"), "content")
    return kept.mapInArrow(partial(_read, stride=shards.stride, rows=shards.rows, part=shards.part, start=start), "doc_id long, piece int, slot long, shard long, length int, ids binary")
