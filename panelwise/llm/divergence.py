"""How far the sources of a language are apart in their words: single-pass in-memory indexing, exact sums.

1. A task counts the terms of its documents in one block (term, group) until the block holds about
   ``memory`` bytes, then spills it: for each hash shard one run, sorted by term, in segments of
   ``segment`` postings. A document lies in one block, so documents of a term add up over blocks.
2. A shard's segments arrive in the order of their first terms; a heap merges the runs, holding only
   segments that overlap, and gives each term's documents and each group's occurrences.
3. With p = 1 + floor(1e9 (count + 2) / (N + 2 V)) and f(p, q) = floor((p - q)^2 / (p + q)), two groups
   differ by the sum of f over all kept terms. Most terms are absent from most groups, so the sum
   starts from V times f of two absent terms; terms of one side alone correct it by counts of equal p,
   and terms that both have by a stream of pair corrections, term by term. No table of all terms times
   all groups is made.

All numbers are whole: shares are divided in three steps of three digits, exact while a language has
fewer than 9e15 occurrences. Null text, lang and source are ''. Every row is a document, also where ids
repeat. A group without terms takes part with counts of 0; in a language without kept terms all pairs
are 0. Other columns are not read. An empty table gives no rows. Texts of any length are split piece by
piece at term ends, so only distinct terms are held.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import partial
from heapq import heappop, heappush, heapreplace
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwise.llm.common import landed, on_workers, partitions, pieces, slices, whole_groups

#: Bytes of UTF-8 to themselves, A-Z to a-z, other ASCII to blanks.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: A block's bytes for each entry, beside its term's letters.
ENTRY = 120
RUN = "shard int, lang string, first binary, names array<string>, terms array<binary>, docs array<long>, sizes array<int>, sources array<int>, counts array<long>"


class Block:
    """Postings of the documents read so far."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        """Count one document; the empty term counts a group's documents."""
        counts, docs = self.counts[lang][source], self.docs[lang]
        before, seen = len(counts) + len(docs), {b""}
        for terms in pieces(text, TERMS):
            counts.update(terms)
            seen.update(terms)
        counts[b""] += 1
        docs.update(seen)
        if grown := len(counts) + len(docs) - before:
            letters = sum(map(len, seen))
            self.size += grown * (ENTRY + letters // len(seen)) + (letters if letters > 64 * len(seen) else 0)

    def spill(self, shards: int, segment: int) -> Iterator[pa.RecordBatch]:
        """The block as term-sorted runs, one for each language and shard, in segments."""
        for lang, docs in self.docs.items():
            terms = sorted(docs)
            shard = np.array([zlib.crc32(t) % shards for t in terms])
            order = np.argsort(shard, kind="stable")
            place = np.empty(len(terms), np.int64)
            place[order] = np.arange(len(terms))
            at = dict(zip(terms, place.tolist(), strict=True))
            names, groups = list(self.counts[lang]), list(self.counts[lang].values())
            term = np.concatenate([np.fromiter(map(at.__getitem__, g), np.int64, len(g)) for g in groups])
            source = np.repeat(np.arange(len(groups), dtype=np.int32), [len(g) for g in groups])
            count = np.concatenate([np.fromiter(g.values(), np.int64, len(g)) for g in groups])
            by_term = np.argsort(term, kind="stable")
            sizes = np.bincount(term, minlength=len(terms)).astype(np.int32)
            terms, shard = [terms[i] for i in order], shard[order]
            yield from _run_rows(lang, names, shard, terms, [docs[t] for t in terms], sizes, source[by_term], count[by_term], segment)


def _run_rows(lang: str, names: list[str], shard: np.ndarray, terms: list[bytes], docs: list[int], sizes: np.ndarray, sources: np.ndarray, counts: np.ndarray, segment: int) -> Iterator[pa.RecordBatch]:
    """A run for each shard, terms in order, cut where ``segment`` postings are full."""
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    full = (ends - sizes - np.repeat((ends - sizes)[starts], np.diff(np.r_[starts, len(terms)]))) // segment
    cuts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (full[1:] != full[:-1])])
    for a in range(0, len(cuts), 256):
        some = np.r_[cuts[a : a + 256], cuts[a + 256] if a + 256 < len(cuts) else len(terms)]
        low, high = int(some[0]), int(some[-1])
        posts = np.r_[(ends - sizes)[some[:-1]], ends[high - 1]]
        mine = [np.unique(sources[i:j], return_inverse=True) for i, j in zip(posts[:-1], posts[1:], strict=True)]
        by_term, by_post = pa.array(some - low, pa.int32()), pa.array(posts - posts[0], pa.int32())
        arrays = [
            pa.array(shard[some[:-1]], pa.int32()), pa.array([lang] * len(mine)), pa.array([terms[i] for i in some[:-1]], pa.binary()),
            pa.array([[names[i] for i in used] for used, _ in mine], pa.list_(pa.string())),
            *(pa.ListArray.from_arrays(by_term, pa.array(x, k)) for x, k in ((terms[low:high], pa.binary()), (docs[low:high], pa.int64()), (sizes[low:high], pa.int32()))),
            pa.ListArray.from_arrays(by_post, pa.array(np.concatenate([codes for _, codes in mine]), pa.int32())),
            pa.ListArray.from_arrays(by_post, pa.array(counts[posts[0] : posts[-1]], pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, [x.split(" ")[0] for x in RUN.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch], shards: int, segment: int, memory: int) -> Iterator[pa.RecordBatch]:
    block = Block()
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = batch.column("text").cast(pa.large_binary())
            for i, (lang, source) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)):
                block.add(lang, source, texts[i].as_py())
                if block.size >= memory:
                    yield from block.spill(shards, segment)
                    block = Block()
    yield from block.spill(shards, segment)


class Segment(NamedTuple):
    """Part of a run: the postings of term i are those from ``ends[i]`` to ``ends[i + 1]``."""

    shard: int
    lang: str
    terms: list[bytes]
    docs: list[int]
    ends: list[int]
    sources: list[int]
    counts: list[int]


def _segments(batches: Iterator[pa.RecordBatch], codes: dict[str, int]) -> Iterator[Segment]:
    """One segment after the other, with sources as this task's numbers."""
    for batch in batches:
        shard, lang, names = (batch.column(c).to_pylist() for c in ("shard", "lang", "names"))
        for r in range(batch.num_rows):
            terms, docs, sizes, sources, counts = (batch.column(c)[r].values for c in ("terms", "docs", "sizes", "sources", "counts"))
            mine = np.array([codes.setdefault(x, len(codes)) for x in names[r]])
            ends = np.r_[0, np.cumsum(sizes.to_numpy())].tolist()
            yield Segment(shard[r], lang[r], terms.to_pylist(), docs.to_pylist(), ends, mine[sources.to_numpy()].tolist(), counts.to_pylist())


def in_order(segments: Iterable[Segment]) -> Iterator[tuple[str, bytes, int, list[tuple[Segment, int]]]]:
    """Heap merge: (lang, term, documents, [(segment, place of the term in it)]) for each term of each shard.

    Segments come in the order of (shard, lang, first term), so one is opened when the merge gets there.
    """
    for (_, lang), some in groupby(segments, key=lambda s: (s.shard, s.lang)):
        heap: list[tuple[bytes, int, int, Segment]] = []
        coming = enumerate(some)
        n, following = next(coming)
        while heap or following is not None:
            if following is not None and (not heap or following.terms[0] <= heap[0][0]):
                heappush(heap, (following.terms[0], n, 0, following))
                n, following = next(coming, (n, None))
                continue
            term, docs, parts = heap[0][0], 0, []
            while heap and heap[0][0] == term:
                _, m, i, segment = heap[0]
                docs += segment.docs[i]
                parts.append((segment, i))
                if i + 1 < len(segment.terms):
                    heapreplace(heap, (segment.terms[i + 1], m, i + 1, segment))
                else:
                    heappop(heap)
            yield lang, term, docs, parts


def _frequencies(batches: Iterator[pa.RecordBatch], least: int, rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """(lang, term, source, count, total, head): a row for each group of each kept term; head marks a term's first."""
    codes: dict[str, int] = {}
    langs, terms, sizes, sources, counts = ([] for _ in range(5))

    def made() -> pa.RecordBatch:
        names, size, n = pa.array(list(codes), pa.string()), np.array(sizes), np.array(counts, np.int64)
        row, first = pa.array(np.repeat(np.arange(len(size)), size)), np.cumsum(size) - size
        head = np.zeros(len(n), bool)
        head[first] = True
        arrays = [
            pa.array(langs, pa.string()).take(row), pa.array(terms, pa.binary()).cast(pa.string()).take(row), names.take(pa.array(sources, pa.int32())),
            pa.array(n), pa.array(np.repeat(np.add.reduceat(n, first), size)), pa.array(head),
        ]
        for x in (langs, terms, sizes, sources, counts):
            x.clear()
        return pa.RecordBatch.from_arrays(arrays, ["lang", "term", "source", "count", "total", "head"])

    for lang, term, docs, parts in in_order(_segments(batches, codes)):
        if docs < least and term != b"":
            continue
        sums: dict[int, int] = {}
        for segment, i in parts:
            a, b = segment.ends[i], segment.ends[i + 1]
            for source, count in zip(segment.sources[a:b], segment.counts[a:b], strict=True):
                sums[source] = sums.get(source, 0) + count
        langs.append(lang)
        terms.append(term)
        sizes.append(len(sums))
        sources.extend(sums)
        counts.extend(sums.values())
        if len(counts) >= rows:
            yield made()
    if counts:
        yield made()


def term_frequencies(docs: DataFrame, least: int = 10, memory: int = 128 << 20, segment: int = 4096) -> DataFrame:
    """(lang, term, source, count, total, head) of terms in at least ``least`` documents of a language.

    Rows with the empty term count the documents of each group, groups without terms included.
    """
    spark = on_workers(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    n = partitions(spark)
    runs = rows.mapInArrow(partial(_runs, shards=4 * n, segment=segment, memory=memory), RUN)
    sharded = runs.repartition(n, "shard").sortWithinPartitions("shard", "lang", "first")
    return sharded.mapInArrow(partial(_frequencies, least=least), "lang string, term string, source string, count long, total long, head boolean")


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(1e9 (count + 2) / (total + 2 kept)) in whole numbers, three digits a step."""
    whole, rest = f"greatest({total} + 2 * {kept}, 1)", f"({count} + 2)"
    digits = [f"({rest} div {whole})"]
    for _ in range(3):
        rest = f"(({rest} % {whole}) * 1000)"
        digits.append(f"({rest} div {whole})")
    return F.expr(f"1 + {digits[0]} * 1000000000 + {digits[1]} * 1000000 + {digits[2]} * 1000 + {digits[3]}")


def apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that two groups have: (lang, a, b, value), a before b, one row a pair and run of rows.

    Rows come by (lang, term, source), with each group's p of the term and z, its p of an absent one.
    """
    for rows, cuts in whole_groups(batches, ["lang", "term"]):
        names = rows.column("source").combine_chunks().dictionary_encode()
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        source, lang = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (names, langs))
        p, z = (rows.column(c).to_numpy() for c in ("p", "z"))
        run, k = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), len(names.dictionary)
        codes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, int(np.diff(cuts).max(initial=1))):
            i = np.flatnonzero(run[:-step] == run[step:])
            j = i + step
            codes.append((lang[i] * k + source[i]) * k + source[j])
            values.append(_f(p[i], p[j]) - _f(p[i], z[j]) - _f(z[i], p[j]) + _f(z[i], z[j]))
        code, value = np.concatenate(codes), np.concatenate(values)
        if not len(code):
            continue
        order = np.argsort(code, kind="stable")
        code, value = code[order], value[order]
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        code, value = code[starts], np.add.reduceat(value, starts)
        out = [langs.dictionary.take(pa.array(code // k // k)), names.dictionary.take(pa.array(code // k % k)), names.dictionary.take(pa.array(code % k))]
        yield pa.RecordBatch.from_arrays([*out, pa.array(value)], ["lang", "a", "b", "value"])


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def source_divergence(docs: DataFrame, least: int = 10, top: int = 10, memory: int = 128 << 20, segment: int = 4096) -> DataFrame:
    """lang, source, part, item, value, rank: each group beside the other sources of its language (part
    ``pair``), and the ``top`` terms it has more of than its language (part ``term``)."""
    found = landed(term_frequencies(docs, least, memory, segment), "frequencies")
    kept = found.where("term <> ''")
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("count").alias("n_lang"), F.count_if("head").alias("v"))
    groups = found.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = landed(groups.withColumn("z", share("0", "n", "v")), "groups")
    posts = kept.join(groups, ["lang", "source"]).withColumn("p", share("count", "n", "v"))

    others = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"))
    absent = groups.join(others, "lang").where("source < other")
    base = absent.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), F.when(F.col("v") > 0, F.col("v") * apart("z", "other_z")).otherwise(F.lit(0)).alias("value"))
    equal = posts.groupBy("lang", "source", "p", "z").agg(F.count("*").alias("terms"))
    alone = equal.join(others, "lang").where("source <> other").select(
        "lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
        (F.col("terms") * (apart("p", "other_z") - apart("z", "other_z"))).alias("value"),
    )
    by_term = posts.select("lang", "term", "source", "p", "z").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = by_term.mapInArrow(_both, "lang string, a string, b string, value long")
    sides = base.unionByName(alone).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = sides.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"))
    pairs = pairs.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

    more = posts.withColumn("q", share("total", "n_lang", "v")).where("count > 0 AND p > q")
    terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
