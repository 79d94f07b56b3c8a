"""Best-fit packing by a configuration linear program over the length histogram.

1. Texts become ids and an end mark; what is longer than a sequence is cut into full pieces and a rest.
2. The histogram of piece lengths, at most as many numbers as a sequence has tokens, goes to the
   driver, where the configuration program (fewest patterns that hold every length often enough) is
   solved by multiplicative weights: each round prices lengths by how far behind their cover is, a
   knapsack table over all capacities gives the most valuable pattern through each length, and the
   lengths furthest behind get a share of theirs. Amounts are rounded at random to whole copies and the
   program is solved again on what is left; only the last remainder is packed best-fit, also as patterns
   with copies, so the work depends on the number of lengths and not of pieces.
3. Each piece gets its rank among those of its length, from counts of salted groups, so one length
   may hold most rows. The plan's table (length, ranks, sequence, offset) is as bounded as the
   histogram and is what tasks look ranks up in.

Null texts are empty and hold the end mark alone; ids may be null or repeat, their rows are packed
each; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from panelwise.llm.common import landed, on_workers, partitions, slices, texts_of
from panelwise.llm.wordpieces import encoder


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, size: int, end: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            ids, bounds = encoder(vocabulary).ids(texts_of(part.column("text")))
            count = np.diff(bounds) + 1
            whole = np.insert(ids, bounds[1:], end).astype("<u4")
            n = -(-count // size)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = piece * size
            length = np.minimum(np.repeat(count, n) - start, size)
            at = np.repeat(np.cumsum(count) - count, n) + start
            view = memoryview(whole).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            owner = pa.array(np.repeat(np.arange(part.num_rows), n))
            columns = [part.column("doc_id").take(owner), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])


def best_patterns(value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Knapsack over all capacities: the largest value that fits each, the length taken last (0: a gap), and
    the capacity left when the gap is passed."""
    worth = value[1:]
    # Backwards, so that the rest of a capacity after each length is one slice.
    best, taken = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for capacity in range(1, size + 1):
        total = best[capacity - 1 :: -1] if capacity > 1 else best[:1]
        total = total + worth[:capacity]
        top = int(total.argmax())
        if total[top] > best[capacity - 1]:
            best[capacity], taken[capacity] = total[top], top + 1
        else:
            best[capacity] = best[capacity - 1]
    return best, taken, np.maximum.accumulate(np.where(taken > 0, np.arange(size + 1), 0))


def pattern_of(capacity: int, taken: np.ndarray, filled: np.ndarray) -> list[int]:
    out = []
    while capacity := int(filled[capacity]):
        out.append(int(taken[capacity]))
        capacity -= out[-1]
    return out


def fractional(count: np.ndarray, size: int, rounds: int = 40, wide: int = 256, rate: float = 4.0, step: float | None = None) -> tuple[dict[tuple[int, ...], float], float]:
    """Patterns with fractional copies that cover the histogram about once, and a lower bound on their number.

    With a ``step``, a length of many pieces gets at most that share of its cover in a round and no more than all
    of it: the patterns of a round do not all spend the same short pieces at one price, but fewer are found.
    """
    lengths = np.flatnonzero(count)
    cover, use = np.zeros(size + 1), {}
    bound = float((lengths * count[lengths]).sum()) / size
    for _ in range(rounds):
        value = np.zeros(size + 1)
        value[lengths] = lengths / size * np.exp(-rate * (cover[lengths] - cover[lengths].min()))
        best, taken, filled = best_patterns(value, size)
        # Prices over the most valuable pattern are a solution of the dual program.
        bound = max(bound, float((value[lengths] * count[lengths]).sum()) / best[size])
        room = np.full(size + 1, np.inf)
        if step:
            room[step * count > 1] = (1 - cover[step * count > 1]).clip(0, step)
        behind = lengths[np.argsort(cover[lengths], kind="stable")][:wide]
        for length in behind.tolist():
            if cover[length] >= 1:
                continue
            pattern = tuple(sorted([length, *pattern_of(size - length, taken, filled)], reverse=True))
            kinds, times = np.unique(pattern, return_counts=True)
            share = (1 - cover[kinds]).clip(0.02) / 2
            copies = float((np.where(room[kinds] < np.inf, room[kinds], share) * count[kinds] / times).min())
            if copies <= 0:
                continue
            room[kinds] -= copies * times / count[kinds]
            use[pattern] = use.get(pattern, 0.0) + copies
            cover[kinds] += copies * times / count[kinds]
        if cover[lengths].min() >= 1:
            break
    return use, bound


@dataclass(frozen=True)
class Plan:
    """Whole copies of patterns, the program's first; ``programmed`` is how many pieces those place."""

    patterns: list[tuple[int, ...]]
    copies: list[int]
    bound: float
    programmed: int = 0

    @property
    def sequences(self) -> int:
        return sum(self.copies)


def solved(count: np.ndarray, size: int, steps: tuple[float | None, ...] = (None, 0.05, 0.02)) -> Plan:
    """The plan of fewest sequences over the program's steps, which end once a plan is within a thousandth of the bound."""
    best: Plan | None = None
    for step in steps:
        if best is None or best.sequences > np.ceil(1.001 * best.bound) and (step * count > 1).any():
            plan = _solved(count, size, step)
            if best is None or plan.sequences < best.sequences:
                best = plan
    return best


def _solved(count: np.ndarray, size: int, step: float | None, rest: float = 0.02, few: int = 64, gain: float = 0.1, seed: int = 7) -> Plan:
    """Whole copies that place the histogram: the program is solved, rounded at random, and solved again on what is left.

    Amounts are rounded down, those below one to one with a probability of their size, so what is left keeps the
    shape of the histogram. Patterns with more room than half the program's mean wait for a later solution, where
    shorter pieces may still fill them. Once a solution places less than ``gain`` of what is left, or no more
    than a ``rest`` of all pieces or ``few`` are left, these are packed best-fit.
    """
    draw, left, bound, chosen = np.random.default_rng(seed), count.copy(), 0.0, []
    before = int(left.sum())
    while before > max(few, rest * count.sum()):
        use, least = fractional(left, size, step=step)
        bound = bound or least
        mean = sum(n * (size - sum(p)) for p, n in use.items()) / sum(use.values())
        for pattern, amount in sorted(use.items(), reverse=True):
            if size - sum(pattern) > mean / 2:
                continue
            kinds, times = np.unique(pattern, return_counts=True)
            n = min(int(amount) or int(amount + draw.random()), int((left[kinds] // times).min()))
            if n > 0:
                left[kinds] -= n * times
                chosen.append((pattern, n))
        now = int(left.sum())
        if before - now < gain * before:
            break
        before = now
    last = list(best_fit(left, size))
    bound = bound or fractional(count, size)[1]
    return Plan([p for p, _ in chosen + last], [n for _, n in chosen + last], bound, int(count.sum() - left.sum()))


def best_fit(left: np.ndarray, size: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Longest first, then always the longest that fits; equal sequences together."""
    left = left.copy()
    have = np.flatnonzero(left).tolist()
    while have:
        pattern, room, at = [], size, len(have)
        while at:
            at = bisect_left(have, room + 1, 0, at)
            if not at:
                break
            length = have[at - 1]
            n = min(room // length, int(left[length]))
            pattern += [length] * n
            room -= n * length
            at -= 1
        kinds, times = np.unique(pattern, return_counts=True)
        n = int((left[kinds] // times).min())
        left[kinds] -= n * times
        yield tuple(pattern), n
        have = [x for x in have if left[x]]


def lookup(plan: Plan) -> dict[str, np.ndarray]:
    """Rows (length, first rank, sequence, copies a sequence holds, offset) in order of length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, copies in zip(plan.patterns, plan.copies, strict=True):
        offset = 0
        for length, times in sorted(((x, pattern.count(x)) for x in set(pattern)), reverse=True):
            rows.append((length, used.get(length, 0), sequence, times, offset))
            used[length] = used.get(length, 0) + times * copies
            offset += length * times
        sequence += copies
    rows.sort()
    return {n: np.array(c, np.int64) for n, c in zip(("length", "rank", "sequence", "times", "offset"), zip(*rows, strict=True), strict=True)}


def _placed(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    plan = held.value
    width = int(plan["rank"].max(initial=0)) + 1
    keys = plan["length"] * width + plan["rank"]
    for batch in batches:
        length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
        row = np.searchsorted(keys, length * width + np.minimum(rank, width - 1), "right") - 1
        copy, slot = np.divmod(rank - plan["rank"][row], plan["times"][row])
        more = [pa.array(plan["sequence"][row] + copy), pa.array(plan["offset"][row] + slot * length)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kept = [batch.column(n) for n in names[:3]] + [pa.array(length), batch.column("ids_crc32")]
        yield pa.RecordBatch.from_arrays([*kept, *more], [*names, "sequence_id", "offset"])


def packed(docs: DataFrame, vocabulary: str, size: int = 4096, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    spark = on_workers(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    cut = partial(_pieces, vocabulary=vocabulary, size=size, end=end)
    pieces = landed(narrow.mapInArrow(cut, "doc_id long, piece int, start long, length int, ids_crc32 long"), "pieces")
    count = np.zeros(size + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        count[r["length"]] = r["count"]
    if not count.any():
        return spark.createDataFrame([], "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    plan = solved(count, size)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * partitions(spark))).cast("int"))
    order = Window.partitionBy("length").orderBy("salt")
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", (F.sum("n").over(order) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("inside", inside).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("inside"))
    held = spark.sparkContext.broadcast(lookup(plan))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(partial(_placed, held=held), schema)
