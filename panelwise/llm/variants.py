"""Spelling variants: words one edit apart, found by probing Bloom filters with every generated edit.

1. Words are counted task by task and combined before the shuffle.
2. Each word goes into the filter of its length: blocked (one block of 256 bits a word, a bit in each
   of its eight parts), 16 bits a word. A length of more than ``shard_words`` words has several
   filters, dealt by hash, so that each is built by one task.
3. Each word's edits are made as hashes: shorter by one code point, or one code point replaced by a
   larger one that occurs at all. That meets each near pair exactly once, from its longer or smaller
   word. Hashes are sums over places, so an edit's hash takes one step and no string.
4. Filters are broadcast in rounds of at most ``filter_bytes``; however many words there are, each
   round probes with all of them. Only edits that a filter has become strings and are shuffled, to a
   join with the words that drops what the filter took for a word.
5. A word's form occurs five times as often as the word, so chains of forms are short and have no
   cycles; roots follow from doubling steps, as many as the largest count allows.

Runs of letters are ``[A-Za-z\\u00C0-\\u00FF]+``; only A-Z is lower-cased. Null text is empty, a null id
is an empty text in the check sum. Every row counts, also where ids repeat. Without words the result is
empty. Words and texts may be of any length; long texts are split piece by piece at the ends of runs.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from panelwise.llm.common import landed, on_workers, partitions, pieces, slices

#: Latin-1 to itself for letters (A-Z to a-z), everything else to blanks.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: A counted word's bytes in a task, beside its letters.
ENTRY = 100
PARTS = 8
#: Candidates hashed at once.
CHUNK = 1 << 20
_ODD = np.array([2 * (0x9E3779B97F4A7C15 * (i + 1) % 2**31) + 1 for i in range(PARTS)], np.uint64)


# --- words ------------------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch], every: int, shortest: int, memory: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of each task, in rounds of about ``memory`` bytes."""
    counts: Counter = Counter()
    size = 0
    for whole in batches:
        for batch in slices(whole, "text"):
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                size += _count(counts, f"{name}:".encode(), text.as_py().encode("latin-1", "replace"), every, shortest)
                if size >= memory:
                    yield _counted(counts, shortest)
                    counts, size = Counter(), 0
    yield _counted(counts, shortest)


def _count(counts: Counter, name: bytes, text: bytes, every: int, shortest: int) -> int:
    """Add a document's words; the bytes that new ones take."""
    seed, before, seen = zlib.crc32(name), len(counts), set()
    for runs in pieces(text, LETTERS):
        counts.update(runs)
        some = set(runs)
        for run in some:
            if len(run) >= shortest:
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                if h % every == 0:
                    n, at = runs.count(run), h % len(run)
                    counts[run] -= n
                    counts[run[:at] + run[at + 1 :]] += n
        seen |= some
    grown = len(counts) - before
    return grown * ENTRY + sum(map(len, seen)) if grown else 0


def _counted(counts: Counter, shortest: int) -> pa.RecordBatch:
    kept = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= shortest and n]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5, memory: int = 64 << 20) -> DataFrame:
    """(word, n) of all words of at least ``shortest`` code points and ``least`` occurrences.

    Runs whose check sum with the document's id ``every`` divides lose one code point first.
    """
    spark = on_workers(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(partial(_word_counts, every=every, shortest=shortest, memory=memory), "word string, n long")
    return landed(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")


# --- filters ----------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits scattered over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def placed(places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The hash of a symbol at a place; a word's hash is their sum."""
    return mixed((places.astype(np.uint64) << np.uint64(8)) + symbols.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(0x632BE59BD9B4E019)) % np.uint64(shards)).astype(np.int64)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places of the words that have it)."""
    sizes = np.array([len(w) for w in words], np.int64)
    for n in np.unique(sizes).tolist():
        yield n, np.flatnonzero(sizes == n)


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(hashes)
    return ((h >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64), h & np.uint64(0xFFFFFFFF)


def _bit(low: np.ndarray, part: int) -> np.ndarray:
    return (((low * _ODD[part]) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)).astype(np.uint32)


def bloom(hashes: np.ndarray, bits: int = 16) -> np.ndarray:
    """A filter of the hashes: a row of eight words for each block."""
    out = np.zeros((max(1, -(-len(hashes) * bits // (32 * PARTS))), PARTS), np.uint32)
    block, low = _bits(hashes, len(out))
    for part in range(PARTS):
        np.bitwise_or.at(out[:, part], block, np.uint32(1) << _bit(low, part))
    return out


def held(filter: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter has; few that it was not given."""
    alive = np.arange(len(hashes))
    block, low = _bits(hashes, len(filter))
    for part in range(PARTS):
        hit = (filter[block, part] >> _bit(low, part)) & np.uint32(1) > 0
        alive, block, low = alive[hit], block[hit], low[hit]
    return alive


def _word_hashes(words: np.ndarray) -> np.ndarray:
    n, size = words.shape
    out = np.zeros(n, np.uint64)
    for at in range(0, size, 4096):
        part = words[:, at : at + 4096]
        out += placed(np.arange(at, at + part.shape[1])[None, :], part).sum(axis=1, dtype=np.uint64)
    return out


def _sharded(batches: Iterator[pa.RecordBatch], shards: Mapping[int, int]) -> Iterator[pa.RecordBatch]:
    """Each word's hash beside its length and shard."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        for size, places in by_length(words):
            hashes = _word_hashes(letters([words[i] for i in places]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(places), size, np.int32)), pa.array(shard_of(hashes, shards[size]).astype(np.int32)), pa.array(hashes.view(np.int64))], ["size", "shard", "hash"]
            )


def _filter_of(whole: pa.Table) -> pa.Table:
    made = bloom(whole.column("hash").to_numpy().view(np.uint64))
    return pa.table({"size": whole.column("size")[:1], "shard": whole.column("shard")[:1], "data": pa.array([made.tobytes()], pa.binary())})


def filters(words: DataFrame, shard_words: int) -> tuple[DataFrame, dict[int, int]]:
    """((size, shard, data), shards of each length)."""
    counts = words.groupBy(F.length("word").alias("size")).count().collect()  # a row for each length
    shards = {r["size"]: -(-r["count"] // shard_words) for r in counts}
    hashed = words.select("word").mapInArrow(partial(_sharded, shards=shards), "size int, shard int, hash long")
    return landed(hashed.groupBy("size", "shard").applyInArrow(_filter_of, "size int, shard int, data binary"), "filters"), shards


def rounds(sizes: list[tuple[int, int, int]], most: int) -> list[list[tuple[int, int]]]:
    """(length, shard, bytes) dealt to rounds of at most ``most`` bytes, one filter at least."""
    out: list[list[tuple[int, int]]] = []
    room = 0
    for size, shard, n in sorted(sizes):
        if not out or n > room:
            out.append([])
            room = most
        out[-1].append((size, shard))
        room -= n
    return out


# --- edits ------------------------------------------------------------------------------------


def shorter(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of every deletion; of equal neighbours only the first is deleted."""
    n, size = words.shape
    places = np.arange(size)[None, :]
    here, moved = placed(places, words), placed(places[:, 1:] - 1, words[:, 1:])
    before = np.cumsum(here, axis=1, dtype=np.uint64) - here
    after = np.zeros((n, size), np.uint64)
    after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    first = np.ones((n, size), bool)
    first[:, 1:] = words[:, 1:] != words[:, :-1]
    row, place = np.nonzero(first)
    return row, place, (before + after)[row, place]


def replaced(words: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, symbol, hash) of every replacement by a larger symbol, some places at a time."""
    hashes = _word_hashes(words)
    step = max(1, CHUNK // max(1, len(words) * len(symbols)))
    for at in range(0, words.shape[1], step):
        some = words[:, at : at + step]
        places = np.arange(at, at + some.shape[1])
        less = hashes[:, None] - placed(places[None, :], some)
        new = placed(places[:, None], symbols[None, :])
        row, place, symbol = np.nonzero(symbols[None, None, :] > some[:, :, None])
        yield row, place + at, symbols[symbol], less[row, place] + new[place, symbol]


def _probed(batches: Iterator[pa.RecordBatch], known: Broadcast, shards: Mapping[int, int], symbols: bytes) -> Iterator[pa.RecordBatch]:
    """(edit, word, n): the edits of each word that a broadcast filter has."""
    alphabet = np.frombuffer(symbols, np.uint8)
    have = {key: np.frombuffer(data, np.uint32).reshape(-1, PARTS) for key, data in known.value.items()}

    def found(size: int, hashes: np.ndarray) -> np.ndarray:
        mine = [(shard, have[size, shard]) for shard in range(shards.get(size, 0)) if (size, shard) in have]
        if len(mine) == shards.get(size):
            of = shard_of(hashes, shards[size]) if len(mine) > 1 else np.zeros(len(hashes), np.int64)
        elif mine:
            of = shard_of(hashes, shards[size])
        else:
            return np.zeros(0, np.int64)
        parts = [np.flatnonzero(of == shard) for shard, _ in mine]
        return np.concatenate([p[held(f, hashes[p])] for p, (_, f) in zip(parts, mine, strict=True)])

    def made(edits: np.ndarray, rows: np.ndarray, words: list[str], counts: list[int]) -> pa.RecordBatch:
        size, data = edits.shape[1], edits.tobytes().decode("latin-1")
        arrays = [pa.array([data[i * size : (i + 1) * size] for i in range(len(rows))], pa.string()), pa.array([words[i] for i in rows], pa.string()), pa.array([counts[i] for i in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["edit", "word", "n"])

    for batch in batches:
        everything, n_of = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        for size, chosen in by_length(everything):
            step = max(1, CHUNK // (size * max(1, len(alphabet))))
            for at in range(0, len(chosen), step):
                words, counts = ([x[i] for i in chosen[at : at + step]] for x in (everything, n_of))
                matrix = letters(words)
                if any(s == size - 1 for s, _ in have):
                    row, place, hashes = shorter(matrix)
                    hit = found(size - 1, hashes)
                    for some in np.array_split(hit, max(1, -(-len(hit) * size // CHUNK))):
                        keep = np.ones((len(some), size), bool)
                        keep[np.arange(len(some)), place[some]] = False
                        yield made(matrix[row[some]][keep].reshape(len(some), size - 1), row[some], words, counts)
                if any(s == size for s, _ in have):
                    for row, place, symbol, hashes in replaced(matrix, alphabet):
                        hit = found(size, hashes)
                        for some in np.array_split(hit, max(1, -(-len(hit) * size // CHUNK))):
                            edits = matrix[row[some]]
                            edits[np.arange(len(some)), place[some]] = symbol[some]
                            yield made(edits, row[some], words, counts)


def near_pairs(words: DataFrame, shard_words: int = 1 << 20, filter_bytes: int = 64 << 20) -> DataFrame:
    """(a, a_n, b, b_n): each two words of ``words`` (word, n) that differ by one code point, once."""
    spark = on_workers(words.sparkSession)
    made, shards = filters(words, shard_words)
    sizes = [tuple(r) for r in made.select("size", "shard", F.length("data")).collect()]  # a row for each filter
    used = [r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()]  # 90 rows at most
    symbols = "".join(sorted(used)).encode("latin-1")
    spread = words.repartition(2 * partitions(spark))
    parts = [spark.createDataFrame([], "edit string, word string, n long")]
    for keys in rounds(sizes, filter_bytes):
        name = F.concat_ws(":", "size", "shard")
        some = made.where(name.isin([f"{a}:{b}" for a, b in keys])).collect()  # filter_bytes at most
        known = spark.sparkContext.broadcast({(r["size"], r["shard"]): bytes(r["data"]) for r in some})
        probe = partial(_probed, known=known, shards=shards, symbols=symbols)
        parts.append(landed(spread.mapInArrow(probe, "edit string, word string, n long"), "edits"))
        known.destroy()
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    real = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    return hits.join(real, hits["edit"] == real["b"]).select(F.col("word").alias("a"), F.col("n").alias("a_n"), "b", "b_n")


# --- forms and roots --------------------------------------------------------------------------


def variants(words: DataFrame, times: int = 5, shard_words: int = 1 << 20, filter_bytes: int = 64 << 20) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; each word once).

    A form is the near word of largest n (ties: the smallest), if that is at least ``times`` n.
    """
    pairs = near_pairs(words, shard_words, filter_bytes)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )).alias("s")).select("s.*")
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    known = words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")
    )
    known = landed(known, "forms")
    up = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = known.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1.0, math.log(most, times) + 1)))):
        next_up = up.select(F.col("word").alias("at"), F.col("root").alias("then"))
        up = landed(up.join(next_up, up["root"] == next_up["at"], "left").select("word", F.coalesce("then", "root").alias("root")), "roots")
    return known.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5, times: int = 5) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text)."""
    return variants(word_counts(docs, every, shortest, least), times)
