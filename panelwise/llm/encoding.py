"""Byte-level BPE both ways: a mapped transducer for frequent words, exact merges for all others.

Words of the tokenizer's own pattern are counted over all texts; the ``frequent`` commonest are merged
once and compiled into a transducer (``automaton``), whose file every executor gets and maps. A
worker splits texts into words, follows the transducer for words it has not met, and merges what
the transducer lacks pair by pair in order of rank, all unseen words of a run at once. So the choice
of words decides about speed only. Decoding joins the bytes of each id.

Special strings inside texts become their id, as is the library's default. Null texts are empty;
repeated rows are encoded each; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from panelwise.llm import automaton
from panelwise.llm.common import on_workers, slices, texts_of
from panelwise.llm.wordpieces import Chunks

#: Fixed value: the word pattern of the byte-level tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Two blanks in a row, or the cut mark itself: such texts are split by the pattern, others before each blank.
_TWO_BLANKS = r"[\s\v\x1c-\x1f\x85\p{Z}][\s\v\x1c-\x1f\x85\p{Z}]|\x01"
LONG = 48
#: Below it all letters are of the pattern's kind in every version of Unicode.
_PLAIN = "\u0370"

_open: dict[tuple[str, str | None], "Coder"] = {}


def alphabet() -> list[str]:
    """The character that stands for each byte: itself if visible in Latin-1, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in visible else extra))
        extra += b not in visible
    return out


class Merges:
    """Ranks of pairs and bytes of ids, from the vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        vocabulary, merges = whole["model"]["vocab"], whole["model"]["merges"]
        letters = alphabet()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.first = np.array([vocabulary[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.text = [b""] * self.size
        for piece, i in vocabulary.items():
            self.text[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
        for piece, i in self.special.items():
            self.text[i] = piece.encode()
        self.none = len(pairs)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; pairs with a gap, or that never merge, come last."""
        want = left * self.size + right
        at = np.searchsorted(self.keys, want).clip(0, len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (left >= 0) & (right >= 0), self.rank[at], self.none)

    def merged(self, words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Exact ids of all words, some at a time: their places, ids in a row, lengths."""
        short = sorted((i for i, w in enumerate(words) if len(w) <= LONG), key=lambda i: len(words[i]))
        for a in range(0, len(short), 8192):
            some = short[a : a + 8192]
            yield some, *self._together([words[i] for i in some])
        for i, w in enumerate(words):
            if len(w) > LONG:
                ids = self._alone(w)
                yield [i], np.array(ids, np.uint32), np.array([len(ids)])

    def ids_of(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in words]
        for places, ids, lengths in self.merged(words):
            for i, x in zip(places, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
                out[i] = x.tolist()
        return out

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words at once: each round merges the first pair of lowest rank in every word that has one."""
        length = np.array([len(w) for w in words])
        width = int(length.max()) + 1
        ids = np.full((len(words), width), -1, np.int64)
        filled = np.arange(width)[None, :] < length[:, None]
        ids[filled] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(words))
        while len(live):
            at = rank[live].argmin(axis=1)
            low = rank[live, at]
            live, at, low = live[low < self.none], at[low < self.none], low[low < self.none]
            if not len(live):
                break
            column = np.arange(width - 1)[None, :]
            row = np.take_along_axis(ids[live], np.minimum(column + (column > at[:, None]), width - 1), axis=1)
            row[np.arange(len(live)), at] = self.made[low]
            ids[live, :-1] = row
            ids[live, -1] = -1
            moved = np.take_along_axis(rank[live], np.minimum(column + (column > at[:, None]), width - 2), axis=1)
            moved[:, -1] = self.none
            n = np.arange(len(live))
            right = np.where(at + 1 < width - 1, row[n, np.minimum(at + 1, width - 2)], -1)
            moved[n, at] = self.ranks(row[n, at], right)
            before = at > 0
            moved[n[before], at[before] - 1] = self.ranks(row[n[before], at[before] - 1], row[n[before], at[before]])
            rank[live] = moved
        left = ids >= 0
        return ids[left].astype(np.uint32), left.sum(axis=1)

    def _alone(self, word: bytes) -> list[int]:
        """A long word with a heap of its pairs and links between what is left."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before, version = [*range(1, n), -1], [-1, *range(n - 1)], [0] * n
        heap = [(int(r), i, 0, 0) for i, r in enumerate(self.ranks(np.array(ids[:-1]), np.array(ids[1:]))) if r < self.none]
        heapq.heapify(heap)
        while heap:
            r, i, mine, theirs = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or version[i] != mine or version[j] != theirs:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            version[i] += 1
            version[j] += 1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    low = int(self.ranks(np.array([ids[a]]), np.array([ids[b]]))[0])
                    if low < self.none:
                        heapq.heappush(heap, (low, a, version[a], version[b]))
        return [i for i in ids if i >= 0]


class Coder(Chunks):
    """A worker's encoder and decoder; ``lexicon`` is the mapped file's place, or None."""

    def __init__(self, vocabulary: str, lexicon: str | None):
        super().__init__()
        self.merges = Merges(vocabulary)
        self.lexicon = None if lexicon is None else automaton.mapped(lexicon)
        self.words_of = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")").split if self.merges.special else None

    def pieces(self, text: str) -> list[str]:
        """Words and special strings in order."""
        if (text.isalpha() or text[:1] == " " and text[1:].isalpha()) and (text.isascii() or max(text) < _PLAIN):
            return [text]
        if self.cut is None or not any(s in text for s in self.merges.special):
            return self.words_of(text)
        return [w for part in self.cut(text) for w in ([part] if part in self.merges.special else self.words_of(part))]

    def _split(self, texts: pa.Array) -> pa.Array:
        """Cut before and after line breaks, before blanks, and between a letter and a mark: words end there."""
        odd = pc.match_substring_regex(texts, _TWO_BLANKS)
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x01 "), "\n", "\x01\n\x01")
        marked = pc.replace_substring_regex(marked, r"(\pL)([.,])", "\\1\x01\\2")
        split = pc.split_pattern(pc.if_else(odd, "", marked), "\x01")
        if not pc.any(odd).as_py():
            return split
        lists = [self.pieces(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)]
        return pc.if_else(odd, pa.array(lists, split.type), split)

    def _learn(self, chunks: list[str]) -> None:
        parts = [self.pieces(c) for c in chunks]
        words = list(dict.fromkeys(w for p in parts for w in p if w not in self.row))
        raw, special = [w.encode() for w in words], self.merges.special
        rest = np.ones(len(words), bool)
        for i, w in enumerate(words):
            if w[0] == "<" and w in special:
                self._keep([w], np.array([special[w]]), np.array([1]))
                rest[i] = False
        if self.lexicon is not None and words:
            bounds, ids = self.lexicon["bounds"], self.lexicon["ids"]
            number = automaton.numbers(self.lexicon, raw)
            there = np.flatnonzero(rest & (number >= 0))
            first, length = bounds[number[there]], bounds[number[there] + 1] - bounds[number[there]]
            at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
            self._keep([words[i] for i in there.tolist()], ids[at], length)
            rest[there] = False
        left = np.flatnonzero(rest).tolist()
        for places, ids, lengths in self.merges.merged([raw[i] for i in left]):
            self._keep([words[left[i]] for i in places], ids, lengths)
        more = [(c, p) for c, p in zip(chunks, parts, strict=True) if c not in self.row]
        self._keep_joined([c for c, _ in more], [p for _, p in more])

    def decoded(self, ids: np.ndarray) -> str:
        return b"".join(map(self.merges.text.__getitem__, ids.tolist())).decode("utf-8", "replace")


def coder(vocabulary: str, lexicon: str | None = None) -> Coder:
    """The worker's coder for a vocabulary and a shipped lexicon."""
    if (vocabulary, lexicon) not in _open:
        _open.clear()
        _open[vocabulary, lexicon] = Coder(vocabulary, None if lexicon is None else SparkFiles.get(lexicon))
    return _open[vocabulary, lexicon]


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Words of each run with their number."""
    known = coder(vocabulary)
    for batch in batches:
        for part in slices(batch, "text", 8 << 20):
            coded = known._split(texts_of(part.column("text"))).flatten().dictionary_encode()
            times, count = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary)), {}
            for chunk, n in zip(coded.dictionary.to_pylist(), times.tolist(), strict=True):
                words = known.pieces(chunk)
                if len(words) == 1 and words[0] is chunk:
                    count[chunk] = count.get(chunk, 0) + n
                else:
                    for w in words:
                        count[w] = count.get(w, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])


def lexicon(docs: DataFrame, vocabulary: str, frequent: int = 16_384, longest: int = 64) -> str:
    """Compile the commonest words and give their file to every executor; its name there."""
    spark = on_workers(docs.sparkSession)
    words = docs.select("text").mapInArrow(partial(_counted, vocabulary=vocabulary), "word string, n long")
    counts = words.where(F.length("word") <= longest).groupBy("word").agg(F.sum("n").alias("n"))
    top = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(frequent).collect()]
    merges = Merges(vocabulary)
    top = [w for w in top if w and w not in merges.special]
    raw = [w.encode() for w in top]
    arrays = automaton.compile_words(dict(zip(raw, merges.ids_of(raw), strict=True)))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    with tempfile.TemporaryDirectory(prefix="lexicon-", delete=False) as folder:
        automaton.save(arrays, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def _coded(batches: Iterator[pa.RecordBatch], vocabulary: str, name: str) -> Iterator[pa.RecordBatch]:
    known = coder(vocabulary, name)
    for batch in batches:
        for part in slices(batch, "text"):
            ids, bounds = known.ids(texts_of(part.column("text")))
            ids = ids.astype("<u4")
            spans = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            columns = [part.column("doc_id"), pa.array([s.tobytes() for s in spans], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])


def encoded(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", frequent: int = 16_384) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of each row."""
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    name = lexicon(narrow, vocabulary, frequent)
    return narrow.mapInArrow(partial(_coded, vocabulary=vocabulary, name=name), "doc_id long, ids binary")


def _read(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    known = coder(vocabulary)
    for batch in batches:
        texts = [known.decoded(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid and len(x.as_buffer()) else "" for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def decoded(rows: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, text of each row of ids."""
    on_workers(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(partial(_read, vocabulary=vocabulary), "doc_id long, ids binary, text string")


def _both_ways(batches: Iterator[pa.RecordBatch], vocabulary: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in _coded(batches, vocabulary, name):
        texts = [coder(vocabulary, name).decoded(np.frombuffer(x.as_buffer(), "<u4")) if len(x.as_buffer()) else "" for x in batch.column("ids")]
        yield batch.append_column("text", pa.array(texts, pa.string()))


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", frequent: int = 16_384) -> DataFrame:
    """``decoded(encoded(docs))`` in one worker a task: doc_id, ids and the text that they say."""
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    name = lexicon(narrow, vocabulary, frequent)
    return narrow.mapInArrow(partial(_both_ways, vocabulary=vocabulary, name=name), "doc_id long, ids binary, text string")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
