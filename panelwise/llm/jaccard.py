"""Similarity join on word shingles by prefix trees: who is linked, and with whom in the end.

Two texts link when ``100 * common >= 75 * all`` over their sets of distinct shingles.

1. Each run of texts (some MB) sends every shingle hash once, packed by hash range. A range's task
   finds the hashes that occur in more than one text anywhere and how widespread they are; only
   these return. Nothing else can be common to two texts, and a text of which less than 75 % returns
   links with nothing. Hashes that repeat inside a run are sent as one mark, so a passage that all
   texts share is as many entries as runs.
2. Texts with equal sets are one class. A class holds its repeated hashes in one global order, rare
   first; classes that may link share one of the first ``common - least + 1``. Chains over these
   prefixes join classes to candidate groups, with one row for each hash and batch.
3. Inside a group, classes go through a prefix tree: shared beginnings are walked once with their
   overlap so far, and subtrees are left as soon as the remaining lengths cannot reach the needed
   overlap, or when all they hold is linked with the text already. Groups beyond ``block`` classes
   are joined within blocks, then by one text for each block's part, then, where parts are still
   apart, in all pairs of blocks. No pair of different sets that could still matter is left out.

Texts without words, and null texts, have empty sets and link with nothing; an id may repeat, its
rows are texts of their own; ids may be null (such rows come back with a null component unless
linked); other columns are ignored. Rows must come from a table, not from an unstable expression.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from panelwise.llm.common import landed, on_workers, partitions, slices, texts_of
from panelwise.llm.links import Union, block_pairs, components, runs, star_rows
from panelwise.llm.shingles import mixed, shingle_hashes

#: 100 * common >= 75 * all, as common / (size + size) >= SHARE / OF.
SHARE, OF = 3, 7
LOW48 = np.uint64((1 << 48) - 1)
MARK = 0xFFFF
PACK = "run long, kind int, bucket int, hash binary, text binary, more binary"
PACK_NAMES = ["run", "kind", "bucket", "hash", "text", "more"]


def least_of_own(n: np.ndarray) -> np.ndarray:
    """Hashes that a set of n must share at least to link with any other."""
    return (75 * n + 99) // 100


def _packs(batches: Iterator[pa.RecordBatch], buckets: int, words: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of texts: one row of ids, sizes and repeated hashes, and one row of hashes for each bucket."""
    run = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", limit, MARK - 1):
            hashes, text = shingle_hashes(texts_of(part.column("text")), words)
            size = np.bincount(text, minlength=part.num_rows).astype(np.int64)
            keys = np.zeros((part.num_rows, 2), np.uint64)
            np.add.at(keys[:, 0], text, mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)))
            np.bitwise_xor.at(keys[:, 1], text, hashes)
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            starts = np.flatnonzero(new)
            many = np.diff(np.r_[starts, len(hashes)]) > 1
            single = np.where(many, MARK, text[starts]).astype(np.uint16)
            distinct = hashes[starts]
            repeated = np.repeat(many, np.diff(np.r_[starts, len(hashes)]))
            ids = part.column("doc_id").to_pandas()
            known = ids.notna().to_numpy()
            facts = b"".join([np.int64(part.num_rows).tobytes(), ids.fillna(0).to_numpy(np.int64).tobytes(), known.tobytes(), size.tobytes(), keys.tobytes()])
            rows = [(run, 0, run % buckets, hashes[repeated].tobytes(), text[repeated].astype(np.uint16).tobytes(), facts)]
            bucket = (distinct % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rest = (distinct // np.uint64(buckets)) & LOW48
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[b] : cuts[b + 1]]
                six = rest[at].view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append((run, 1, b, six.tobytes(), single[at].tobytes(), b""))
            yield pa.RecordBatch.from_pylist([dict(zip(PACK_NAMES, r, strict=True)) for r in rows], _PACK_SCHEMA)
            run += 1


_PACK_SCHEMA = pa.schema([("run", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("hash", pa.binary()), ("text", pa.binary()), ("more", pa.binary())])


def _wide(six: bytes) -> np.ndarray:
    out = np.zeros((len(six) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def _repeated(whole: pa.Table) -> pa.Table:
    """Of one bucket's hashes those that occur in several texts, with how widespread they are; other rows pass."""
    kept = [r for r in whole.select(PACK_NAMES).to_pylist() if r["kind"] == 0]
    packs = [(r["run"].as_py(), r["bucket"].as_py(), r["hash"].as_py(), r["text"].as_py()) for r in _rows(whole) if r["kind"].as_py() == 1]
    if packs:
        hashes = np.concatenate([_wide(p[2]) for p in packs])
        text = np.concatenate([np.frombuffer(p[3], np.uint16) for p in packs])
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        spread = np.add.reduceat(np.where(text[order] == MARK, 2, 1), starts)
        many = np.zeros(len(hashes), np.int64)
        many[order] = np.repeat(spread, np.diff(np.r_[starts, len(ordered)]))
        level = np.minimum(np.ceil(np.log2(np.maximum(many, 1))), 255).astype(np.uint8)
        at = 0
        for run, bucket, six, _ in packs:
            n = len(six) // 6
            some = at + np.flatnonzero(many[at : at + n] > 1)
            if len(some):
                kept.append({"run": run, "kind": 1, "bucket": bucket, "hash": hashes[some].tobytes(), "text": text[some].tobytes(), "more": level[some].tobytes()})
            at += n
    return pa.Table.from_pylist(kept, _PACK_SCHEMA)


def _rows(whole: pa.Table) -> Iterator[dict]:
    for batch in whole.to_batches():
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in PACK_NAMES}


def _sets(whole: pa.Table, buckets: int) -> pa.Table:
    """A run's texts: id, size and key of the set, and the repeated hashes, rare first, where they may link."""
    rows = whole.select(PACK_NAMES).to_pylist()
    head = next(r for r in rows if r["kind"] == 0)
    facts = head["more"]
    n = int(np.frombuffer(facts, np.int64, 1)[0])
    ids, known = np.frombuffer(facts, np.int64, n, 8), np.frombuffer(facts, bool, n, 8 + 8 * n)
    size, keys = np.frombuffer(facts, np.int64, n, 8 + 9 * n), np.frombuffer(facts, np.uint64, 2 * n, 8 + 17 * n).reshape(n, 2)
    items, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    inside, texts = np.frombuffer(head["hash"], np.uint64), np.frombuffer(head["text"], np.uint16)
    place = (inside % np.uint64(buckets)).astype(np.int64)
    rest = (inside // np.uint64(buckets)) & LOW48
    by_place = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[by_place], np.arange(buckets + 1))
    for r in rows:
        if r["kind"] == 0:
            continue
        hashes, text, level = np.frombuffer(r["hash"], np.uint64), np.frombuffer(r["text"], np.uint16), np.frombuffer(r["more"], np.uint8)
        item = _item(hashes, r["bucket"], level)
        one = text != MARK
        items.append(item[one])
        owner.append(text[one].astype(np.int64))
        if not one.all():  # marks stand for the texts that the run keeps
            mine = by_place[edges[r["bucket"]] : edges[r["bucket"] + 1]]
            marks = np.flatnonzero(~one)
            order = marks[np.argsort(hashes[marks])]
            at = order[np.searchsorted(hashes[order], rest[mine])]
            items.append(item[at])
            owner.append(texts[mine].astype(np.int64))
    item, text = np.concatenate(items), np.concatenate(owner)
    order = np.lexsort((item, text))
    item, cuts = item[order], np.searchsorted(text[order], np.arange(n + 1))
    may = (np.diff(cuts) >= least_of_own(size)) & (size > 0)
    blobs = [item[cuts[i] : cuts[i + 1]].tobytes() if may[i] else None for i in range(n)]
    columns = [pa.array(ids, mask=~known), pa.array(size), pa.array(keys.view(np.int64)[:, 0].copy()), pa.array(keys.view(np.int64)[:, 1].copy()), pa.array(blobs, pa.binary())]
    return pa.Table.from_arrays(columns, ["doc_id", "n", "k1", "k2", "items"])


def _item(hashes: np.ndarray, bucket: int, level: np.ndarray) -> np.ndarray:
    """A hash as one number whose order is the global one: level, then hash."""
    spread = np.uint64((bucket * 0x9E3779B97F4A7C15) & ((1 << 56) - 1))
    return (level.astype(np.uint64) << np.uint64(56)) | (hashes ^ spread)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch: its prefix hashes with the smallest class of each, and links between classes that share one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("cls").to_numpy()
        size = batch.column("n").to_numpy()
        blobs = batch.column("items").to_pylist()
        length = np.array([len(b) // 8 for b in blobs], np.int64) - least_of_own(size) + 1
        item = np.concatenate([np.frombuffer(b, np.uint64, k) for b, k in zip(blobs, length.tolist(), strict=True)])
        cls = np.repeat(ids, length)
        order = np.lexsort((cls, item))
        item, cls = item[order], cls[order]
        new = np.r_[True, item[1:] != item[:-1]]
        again = np.flatnonzero(~new)
        pairs = np.unique(np.stack([cls[again], cls[again - 1]], axis=1), axis=0) if len(again) else np.zeros((0, 2), np.int64)
        columns = [
            pa.array(np.concatenate([item[new].view(np.int64), np.zeros(len(pairs), np.int64)]), mask=np.r_[np.zeros(new.sum(), bool), np.ones(len(pairs), bool)]),
            pa.array(np.concatenate([cls[new], pairs[:, 0]])),
            pa.array(np.concatenate([cls[new], pairs[:, 1]])),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "a", "b"])


class Node:
    __slots__ = ("part", "below", "here", "small", "large", "longest", "same")

    def __init__(self, part: tuple[int, ...]):
        self.part, self.below, self.here = part, {}, []
        self.small, self.large, self.longest, self.same = 1 << 62, 0, 0, None


class Tree:
    """Sets in one global order as paths; links found by walking it with a set."""

    def __init__(self, sets: list[tuple[int, ...]], sizes: list[int], union: Union):
        self.sets, self.sizes, self.union, self.root = sets, sizes, union, Node(())

    def add(self, x: int) -> None:
        items, node, at = self.sets[x], self.root, 0
        self._count(node, x)
        while at < len(items):
            child = node.below.get(items[at])
            if child is None:
                child = node.below[items[at]] = Node(items[at:])
            part, common = child.part, 0
            while common < len(part) and at + common < len(items) and part[common] == items[at + common]:
                common += 1
            if common < len(part):
                upper = node.below[items[at]] = Node(part[:common])
                upper.small, upper.large, upper.longest, upper.same = child.small, child.large, child.longest, child.same
                child.part = part[common:]
                upper.below[child.part[0]] = child
                child = upper
            node, at = child, at + common
            self._count(node, x)
        node.here.append(x)

    def _count(self, node: Node, x: int) -> None:
        alike = not node.large or node.same is not None and self.union.find(node.same) == self.union.find(x)
        node.same = x if alike else None
        node.small, node.large, node.longest = min(node.small, self.sizes[x]), max(node.large, self.sizes[x]), max(node.longest, len(self.sets[x]))

    def link(self, x: int) -> None:
        """Join x with every set of the tree that it links with and is not joined with yet."""
        items, size, union = self.sets[x], self.sizes[x], self.union
        mine = set(items)
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            if node.same is not None and union.find(node.same) == union.find(x):
                continue
            # No set below can have fewer elements than the smallest, nor share more than what is left on either side.
            least = max(node.small, (3 * size + 3) // 4)
            if least > node.large or 3 * least > 4 * size:
                continue
            need = -(-SHARE * (size + least) // OF)
            left = len(items) - bisect_right(items, node.part[0] - 1) if node.part else len(items)
            if overlap + min(left, node.longest - depth) < need:
                continue
            overlap += len(mine.intersection(node.part))
            depth += len(node.part)
            if node.part:
                left = len(items) - bisect_right(items, node.part[-1])
            for y in node.here:
                if OF * overlap >= SHARE * (size + self.sizes[y]):
                    union.join(x, y)
            if node.below and overlap + min(left, node.longest - depth) >= need:
                stack += [(child, depth, overlap) for child in node.below.values()]


def _tree_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Star rows (a, b) of links inside a block, or between two blocks; ``part`` is what is joined already."""
    for group in runs(batches, ["component", "lo", "hi"]):
        group = group.sort_values(["n", "cls"], ignore_index=True)
        union = Union(len(group))
        first: dict[int, int] = {}
        for i, part in enumerate(group["part"].tolist()):
            union.join(first.setdefault(part, i), i)
        sets = [tuple(np.frombuffer(b, np.uint64).tolist()) for b in group["items"]]
        tree, lo, hi = Tree(sets, group["n"].tolist(), union), group["lo"].iat[0], group["hi"].iat[0]
        at = group["at"].tolist()
        if lo == hi:
            for x in range(len(group)):
                tree.link(x)
                tree.add(x)
        else:
            for x in range(len(group)):
                if at[x] == lo:
                    tree.add(x)
            for x in range(len(group)):
                if at[x] == hi:
                    tree.link(x)
        yield star_rows(union, group["cls"].to_numpy())


def _joined(members: DataFrame, block: int, which: str) -> DataFrame:
    dealt = block_pairs(members, "component", "cls", block).where(which)
    ordered = dealt.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
    return landed(ordered.mapInPandas(_tree_links, "a long, b long"), "jaccard-links")


def _parts(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the smallest class that they are joined with so far."""
    known = components(links).select(F.col("node").alias("cls"), F.col("component").alias("_part"))
    return members.drop("part").join(known, "cls", "left").withColumn("part", F.coalesce("_part", "cls")).drop("_part")


def linked_groups(classes: DataFrame, block: int = 1024) -> DataFrame:
    """node, component over classes (cls, n, items) that link with others."""
    rows = landed(classes.mapInArrow(_prefixes, "item long, a long, b long"), "prefixes")
    chain = F.lag("a").over(Window.partitionBy("item").orderBy("a"))
    met = rows.where("item IS NOT NULL").select("a", chain.alias("b")).where("b IS NOT NULL")
    candidates = components(rows.where("item IS NULL").select("a", "b").unionByName(met))
    members = classes.join(candidates.withColumnRenamed("node", "cls"), "cls").withColumn("part", F.col("cls"))
    links = _joined(members, block, "lo = hi")
    large = landed(members.groupBy("component").count().where(F.col("count") > block).select("component"), "large")
    if not large.isEmpty():
        inside = members.join(large, "component", "left_semi")
        links = links.unionByName(_joined(_parts(inside, links).where("cls = part"), block, "lo = hi"))
        known = landed(_parts(inside, links), "parts")
        apart = known.groupBy("component").agg((F.min("part") < F.max("part")).alias("more")).where("more").select("component")
        links = links.unionByName(_joined(known.join(apart, "component", "left_semi"), block, "lo < hi"))
    return components(links)


def jaccard_groups(docs: DataFrame, words: int = 5, key: str = "doc_id", text: str = "text", block: int = 1024, limit: int = 3 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id of each row; see the module for the method."""
    spark = on_workers(docs.sparkSession)
    buckets = 2 * partitions(spark)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    packs = narrow.mapInArrow(partial(_packs, buckets=buckets, words=words, limit=limit), PACK)

    def repeated(whole: pa.Table) -> pa.Table:
        return _repeated(whole)

    def sets_of(whole: pa.Table) -> pa.Table:
        return _sets(whole, buckets)

    returned = packs.groupBy("bucket").applyInArrow(repeated, PACK)
    sets = returned.groupBy("run").applyInArrow(sets_of, "doc_id long, n long, k1 long, k2 long, items binary")
    sets = landed(sets.withColumn("cls", F.xxhash64("k1", "k2", "n")), "sets")
    held = sets.where("items IS NOT NULL")
    classes = landed(held.select("cls", "n", "items").dropDuplicates(["cls"]), "classes")
    groups = linked_groups(classes, block).withColumnRenamed("node", "cls")
    placed = held.select("doc_id", "cls").join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    heads = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size")).where("size > 1")
    known = placed.select("cls", "component").distinct().join(heads, "component").select("cls", "component_id")
    whole = sets.select("doc_id", "n", F.when(F.col("items").isNotNull(), F.col("cls")).alias("cls"))
    out = whole.join(known, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
