"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact reranking.

1. Equal vectors are one class; classes go on as one vector each, known by a number of their own.
2. Rotations that spread the variance evenly over the bits are learnt on a bounded sample (the
   ``sample`` classes of smallest hash); every class gets a code of ``64 * rotations`` bits.
3. The code is cut into keys of ``key_bits``; classes that share any key meet in that key's bucket,
   where pairs beyond a radius of differing bits are set aside. What is left joins classes into
   candidate groups. Radius and keys are measured, not given: vectors that took no part in the fit
   are turned to a cosine of exactly the threshold, evenly and along differences of the data. The
   radius lies four deviations beyond their mean distance; keys of other bits are added, and shortened
   where ``tables`` keys do not do, until both kinds of pairs meet with a share of ``recall``. At no bits at
   all everything meets everything.
4. Inside a candidate group, and only there, cosines of the original vectors are computed in double
   precision, block by block; each pair is met once, so links can be counted without listing them.

Buckets and groups of any size are cut into pairs of bounded blocks (``links.block_pairs``): none is
capped. Vectors that are null, zero, of another length than the rest, or hold nulls or non-finite
numbers link with nothing. Repeated ids are rows of their own and count as vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwise.llm.common import landed, on_workers
from panelwise.llm.links import Union, block_pairs, components, join_matrix, pair_stars, runs, star_rows, whole_runs


#: Rows of a bucket up to which buckets are compared together.
FEW = 64


@dataclass(frozen=True)
class Codes:
    """A fitted quantiser: the sample's mean and rotations, each as many bits as a vector has numbers."""

    mean: np.ndarray
    rotations: tuple[np.ndarray, ...]

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.concatenate([(unit - self.mean) @ r > 0 for r in self.rotations], axis=1)


def fit(sample: np.ndarray, bits: int = 512, rounds: int = 30, seed: int = 7) -> Codes:
    """Learn rotations of the principal axes that bring the sample nearest to the corners of a cube."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    axes = np.linalg.eigh((unit - mean).T @ (unit - mean))[1]
    flat, d, random, found = (unit - mean) @ axes, unit.shape[1], np.random.default_rng(seed), []
    for _ in range(-(-bits // d)):
        turn = np.linalg.qr(random.normal(size=(d, d)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        found.append(axes @ turn)
    return Codes(mean, tuple(found))


def turned(probes: np.ndarray, sample: np.ndarray, cosine: float, seed: int = 13) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at exactly ``cosine``: probes turned in any direction, and along differences of sample vectors."""
    random = np.random.default_rng(seed)
    a, b = (sample[random.integers(len(sample), size=len(probes))] for _ in range(2))
    pairs = []
    for way in (random.normal(size=probes.shape), a - b):
        way = way - (way * probes).sum(axis=1, keepdims=True) * probes
        size = np.linalg.norm(way, axis=1)
        some = size > 1e-9
        if some.any():
            pairs.append((probes[some], cosine * probes[some] + np.sqrt(1 - cosine**2) * way[some] / size[some, None]))
    return pairs


def measured(codes: Codes, pairs: list[tuple[np.ndarray, np.ndarray]], key_bits: int, tables: int, recall: float, seed: int = 17) -> tuple[int, np.ndarray]:
    """(radius, a row of bit places for each key) with which each kind of pairs is found with a share of ``recall``."""
    apart = [codes.bits(a) != codes.bits(b) for a, b in pairs]
    bits = sum(r.shape[1] for r in codes.rotations)
    distances = [x.sum(axis=1) for x in apart]
    radius = min(bits, int(np.ceil(max((x.mean() + 4 * x.std() for x in distances), default=0))))
    for width in range(min(key_bits, bits), 0, -2):
        random, places = np.random.default_rng(seed), []
        met, order = [np.zeros(len(x), bool) for x in apart], np.arange(bits)
        while len(places) < tables:
            for key in order[: bits // width * width].reshape(-1, width):
                places.append(key)
                for m, x in zip(met, apart, strict=True):
                    m |= ~x[:, key].any(axis=1)
                whole = len(places) >= bits // width
                if whole and all((m & (n <= radius)).mean() >= recall for m, n in zip(met, distances, strict=True)):
                    return radius, np.array(places)
                if len(places) >= tables:
                    break
            order = random.permutation(bits)
    return radius, np.zeros((1, 0), np.int64)


def fitted(
    sample: np.ndarray, threshold: float = 0.9, bits: int = 512, key_bits: int = 16, tables: int = 256, recall: float = 0.95, probes: int = 1000
) -> tuple[Codes, int, np.ndarray]:
    """(codes, radius, places of keys): fitted on the sample but for the probes, a quarter at most, measured on those."""
    held = min(probes, len(sample) // 4)
    rest, unit = sample[held:], sample / np.linalg.norm(sample, axis=1, keepdims=True)
    codes = fit(rest, bits)
    return codes, *measured(codes, turned(unit[:held] if held else unit, unit[held:], threshold), key_bits, tables, recall)


def _keys(batches: Iterator[pa.RecordBatch], codes: Codes, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each key of each class: key (with the table's number), class, code (whole 64-bit words)."""
    tables, key_bits = places.shape
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
        bits = codes.bits(vectors)
        packed = np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1)
        codes_of = [x.tobytes() for x in packed]
        ids = batch.column("cls").to_numpy(zero_copy_only=False)
        for t in range(0, tables, 8):
            numbers = np.arange(t, min(t + 8, tables), dtype=np.int64)
            some = (bits[:, places[numbers]] @ (1 << np.arange(key_bits, dtype=np.int64))) + (numbers << key_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.ravel()), pa.array(np.repeat(ids, some.shape[1])), pa.array(np.repeat(np.array(codes_of, object), some.shape[1]), pa.binary())],
                ["bucket", "cls", "code"],
            )


def _bucket_links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links of near codes inside buckets that arrive in order of (bucket, lo, hi).

    Buckets of a few rows are compared all at once, row by next row, next but one and so on; larger
    ones, and pairs of blocks, each by matrix products.
    """
    for rows, cuts in whole_runs(batches, ["bucket", "lo", "hi"]):
        size = np.diff(cuts)
        few = (size <= FEW) & (rows["lo"].to_numpy()[cuts[:-1]] == rows["hi"].to_numpy()[cuts[:-1]])
        codes = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(len(rows), -1)
        cls, run = rows["cls"].to_numpy(), np.repeat(np.where(few, np.arange(len(size)), -1), size)
        pairs = []
        for step in range(1, int(size[few].max(initial=1))):
            i = np.flatnonzero((run[:-step] == run[step:]) & (run[step:] >= 0))
            i = i[np.bitwise_count(codes[i] ^ codes[i + step]).sum(axis=1) <= radius]
            pairs.append(np.stack([cls[i], cls[i + step]], axis=1))
        if pairs:
            yield pair_stars(np.concatenate(pairs))
        for a, b in zip(cuts[:-1][~few].tolist(), cuts[1:][~few].tolist(), strict=True):
            group = rows.iloc[a:b].reset_index(drop=True)
            bits = np.unpackbits(codes[a:b].view(np.uint8), axis=1).astype(np.float32) * 2 - 1
            union = Union(len(group))
            for r, c in tiles(group):
                near = bits[r] @ bits[c].T >= bits.shape[1] - 2 * radius
                join_matrix(union, near & (r[:, None] != c[None, :]), r, c)
            yield star_rows(union, group["cls"].to_numpy())


def _vector_links(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Exact links inside candidate groups: star rows (a, b) and link counts (a, n)."""
    for group in runs(batches, ["component", "lo", "hi"]):
        vectors = np.stack(group["v"].to_numpy()).astype(np.float64)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        size, ids = group["size"].to_numpy(np.int64), group["cls"].to_numpy()
        union, count = Union(len(group)), np.zeros(len(group), np.int64)
        for r, c in tiles(group):
            near = (vectors[r] @ vectors[c].T >= threshold) & (r[:, None] != c[None, :])
            count[r] += near @ size[c]
            join_matrix(union, near, r, c)
            if group["lo"].iat[0] != group["hi"].iat[0]:
                count[c] += near.T @ size[r]
        yield star_rows(union, ids).assign(n=0)
        some = np.flatnonzero(count)
        yield pd.DataFrame({"a": ids[some], "b": ids[some], "n": count[some]})


def tiles(group: pd.DataFrame, side: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places to compare: all of one block with itself, or one block with the other; in tiles."""
    at, lo, hi = group["at"].to_numpy(), group["lo"].iat[0], group["hi"].iat[0]
    rows, columns = np.flatnonzero(at == lo), np.flatnonzero(at == hi)
    for i in range(0, len(rows), side):
        for j in range(0, len(columns), side):
            yield rows[i : i + side], columns[j : j + side]


def near_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
    sample: int = 20_000, bits: int = 512, key_bits: int = 16, block: int = 2048, tables: int = 256, recall: float = 0.95, probes: int = 1000,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row; see the module for the method.

    ``recall`` is that of pairs at exactly ``threshold``; closer ones meet more often.
    """
    spark = on_workers(rows.sparkSession)
    narrow = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    narrow = narrow.withColumn("v", F.when(good & F.col("vec_id").isNotNull(), F.col("v")))
    length = narrow.where("v IS NOT NULL").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return _alone(narrow)
    usable = narrow.withColumn("v", F.when(F.size("v") == length["d"], F.col("v")))
    equal = usable.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = landed(equal.withColumn("cls", F.monotonically_increasing_id()), "vectors")
    # By hash, from a share that holds about twice the sample: tasks send that many in all, not each.
    h, share = F.pmod(F.xxhash64("v", F.lit(11)), F.lit(1 << 30)), min(1.0, 2 * sample / max(1, classes.count()))
    drawn = classes.where(h <= share * (1 << 30)).orderBy(h, "cls").limit(sample).select("v").toArrow()["v"].combine_chunks()
    codes, radius, places = fitted(drawn.flatten().to_numpy().reshape(len(drawn), -1), threshold, bits, key_bits, tables, recall, probes)
    keyed = classes.select("cls", "v").mapInArrow(partial(_keys, codes=codes, places=places), "bucket long, cls long, code binary")
    buckets = block_pairs(keyed, "bucket", "cls", block).repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    candidate = buckets.mapInPandas(partial(_bucket_links, radius=radius), "a long, b long")
    groups = components(candidate).withColumnRenamed("node", "cls")
    members = block_pairs(classes.join(groups, "cls"), "component", "cls", block)
    checked = members.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
    found = landed(checked.mapInPandas(partial(_vector_links, threshold=threshold), "a long, b long, n long"), "vector-links")
    counts = found.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    parts = components(found).withColumnRenamed("node", "cls")
    # A group is named by its smallest id in the end; until then by a class's number, as ids may repeat.
    grouped = classes.join(counts, "cls", "left").join(parts, "cls", "left").select("v", "least", "size", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "cls").alias("group"))
    names = grouped.groupBy("group").agg(F.min("least").alias("component"))
    known = grouped.join(names, "group")
    out = usable.join(known, usable["v"] == known["v"], "left").select("vec_id", (F.col("size") - 1 + F.col("n")).alias("n_links"), F.col("component").alias("component_id"))
    return _alone(out)


def _alone(rows: DataFrame) -> DataFrame:
    have = set(rows.columns)
    links = F.coalesce("n_links", F.lit(0)) if "n_links" in have else F.lit(0)
    part = F.coalesce("component_id", "vec_id") if "component_id" in have else F.col("vec_id")
    return rows.select("vec_id", links.cast("long").alias("n_links"), part.alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
