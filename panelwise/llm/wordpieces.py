"""Exact ids of whole texts, with each distinct chunk between blanks encoded once by the tokenizers library.

The word tokenizer drops white space and never lets a token, a special string or a normalisation
step reach over a blank, so a text's ids are those of its blank-separated chunks in a row. Chunks
are split and numbered by Arrow. A chunk of Latin letters with ASCII marks behind them is its word
in small letters and its marks; only words, marks and other chunks that the worker has not met yet
go to the library, such words to its model without the normalisation that they have had.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable
from itertools import compress
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Bytes of chunks handed to the library at once.
BATCH_BYTES = 1 << 18
#: Bytes of plain words that make one text of such a batch.
LINE_BYTES = 1 << 10
#: A word and its marks: letters that normalisation changes in their case alone, marks that compose with nothing before
#: them. The tokenizer cuts between the two and nowhere else.
WORD_AND_MARKS = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"
#: Bytes of chunks and ids a worker remembers before it starts anew; bounds its memory, not the result.
REMEMBERED = 40 << 20

_open: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """The worker's encoder for a vocabulary file."""
    if path not in _open:
        _open[path] = ChunkEncoder(path)
    return _open[path]


class Chunks:
    """What a worker remembers: chunks of text, each with its ids in one store."""

    def __init__(self, remembered: int = REMEMBERED):
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.held = 0
        self.start, self.length, self.store = array("q"), array("q"), array("I")

    def _keep(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Add chunks, their ids in a row."""
        at = len(self.start)
        self.row.update(zip(chunks, range(at, at + len(chunks)), strict=True))
        lengths = np.asarray(lengths, np.int64)
        self.start.frombytes((len(self.store) + np.cumsum(lengths) - lengths).tobytes())
        self.length.frombytes(lengths.tobytes())
        self.store.frombytes(np.asarray(ids, np.uint32).tobytes())
        self.held += 120 * len(chunks) + 4 * len(ids) + sum(map(len, chunks))

    def _keep_joined(self, chunks: list[str], parts: list[list[str]]) -> None:
        """Add chunks that are known parts in a row; a chunk of one part shares its ids."""
        for chunk, p in zip(chunks, parts, strict=True):
            if len(p) == 1:
                self.row[chunk] = self.row[p[0]]
        several = [n for n, p in enumerate(parts) if len(p) != 1]
        if not several:
            return
        rows = np.array([self.row[x] for n in several for x in parts[n]], np.int64)
        start, length = np.array(self.start, np.int64)[rows], np.array(self.length, np.int64)[rows]
        total = _totals(length)
        at = np.repeat(start - total[:-1], length) + np.arange(total[-1])
        bounds = total[_totals(np.array([len(parts[n]) for n in several]))]
        self._keep([chunks[n] for n in several], np.array(self.store, np.uint32)[at], np.diff(bounds))

    def _learn(self, chunks: list[str]) -> None:
        """Keep the ids of chunks that are not known yet."""
        raise NotImplementedError

    def _split(self, texts: pa.Array) -> pa.Array:
        """Lists of chunks whose ids in a row are the text's."""
        raise NotImplementedError

    def _look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunk bounds of each text, each chunk's place and length in a store, and that store."""
        if self.held > self.remembered:
            self._forget()
        split = self._split(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        if unknown := [x for x in chunks if x not in self.row]:
            self._learn(unknown)
        rows = np.fromiter(map(self.row.__getitem__, chunks), np.int64, len(chunks))
        of = coded.indices.to_numpy(zero_copy_only=False)
        start, length = np.array(self.start, np.int64), np.array(self.length, np.int64)
        return bounds - bounds[0], start[rows][of], length[rows][of], np.array(self.store, np.uint32)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        bounds, _, length, _ = self._look_up(texts)
        total = _totals(length)
        return total[bounds[1:]] - total[bounds[:-1]]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row as unsigned 32-bit numbers, and the bounds of each text."""
        bounds, start, length, store = self._look_up(texts)
        total = _totals(length)
        at = np.repeat(start - total[:-1], length) + np.arange(total[-1])
        return store[at], total[bounds]


class ChunkEncoder(Chunks):
    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        blanks = pre_tokenizers.WhitespaceSplit()
        self.ascii_words, self.words = Tokenizer(self.library.model), Tokenizer(self.library.model)
        self.ascii_words.pre_tokenizer = blanks
        self.words.pre_tokenizer = pre_tokenizers.Sequence([blanks, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        super().__init__(remembered)

    def _forget(self) -> None:
        super()._forget()
        self._keep([""], np.array([], np.uint32), np.array([0]))

    def _split(self, texts: pa.Array) -> pa.Array:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def _look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As of any chunks; the store holds the run's distinct chunks, each its word and its marks in a row."""
        if self.held > self.remembered:
            self._forget()
        split = self._split(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        cut = pc.extract_regex(coded.dictionary, WORD_AND_MARKS)
        plain = cut.is_valid().to_numpy(zero_copy_only=False)
        word, marks = (cut.filter(pa.array(plain)).field(k) for k in (0, 1))
        parts = np.zeros((len(plain), 2), np.int64)
        parts[plain, 0] = self._rows(pc.utf8_lower(word), self._learn_words)
        parts[plain, 1] = self._rows(marks, self._learn)
        parts[~plain, 0] = self._rows(coded.dictionary.filter(pa.array(~plain)), self._learn)
        start, length = np.array(self.start, np.int64)[parts].ravel(), np.array(self.length, np.int64)[parts].ravel()
        total = _totals(length)
        at = np.repeat(start - total[:-1], length) + np.arange(total[-1])
        of, total = coded.indices.to_numpy(zero_copy_only=False), total[::2]
        return bounds - bounds[0], total[:-1][of], np.diff(total)[of], np.array(self.store, np.uint32)[at]

    def _rows(self, parts: pa.Array, learn: Callable[[list[str]], None]) -> np.ndarray:
        """The rows of parts of chunks; those not known yet are learnt."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if unknown := [x for x in distinct if x not in self.row]:
            learn(unknown)
        rows = np.fromiter(map(self.row.__getitem__, distinct), np.int64, len(distinct))
        return rows[coded.indices.to_numpy(zero_copy_only=False)]

    def _learn_words(self, words: list[str]) -> None:
        """Small Latin letters alone, which the library's model takes as they are."""
        self._learn_lines([w for w in words if w.isascii()], self.ascii_words)
        self._learn_lines([w for w in words if not w.isascii()], self.words)

    def _learn(self, chunks: list[str]) -> None:
        self._learn_lines([x for x in chunks if x.isalpha()], self.library)
        self._learn_alone([x for x in chunks if not x.isalpha()])

    def _learn_lines(self, words: list[str], library: Tokenizer) -> None:
        """Words joined to lines; each ends with a token that says so."""
        lines = list(_by_bytes(words, LINE_BYTES))
        for batch in _by_bytes([" ".join(line) for line in lines]):
            some, lines = lines[: len(batch)], lines[len(batch) :]
            made = [np.array(e.ids, np.uint32) for e in library.encode_batch_fast(batch, add_special_tokens=False)]
            length = [np.diff(np.flatnonzero(self.ends_word[ids]) + 1, prepend=0) for ids in made]
            whole = [len(n) == len(line) for n, line in zip(length, some, strict=True)]
            if not all(whole):  # a letter that normalisation splits
                self._learn_alone([x for line, w in zip(some, whole, strict=True) if not w for x in line])
                some, made, length = (list(compress(x, whole)) for x in (some, made, length))
            if some:
                self._keep([x for line in some for x in line], np.concatenate(made), np.concatenate(length))

    def _learn_alone(self, chunks: list[str]) -> None:
        for some in _by_bytes(chunks):
            made = [e.ids for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
            self._keep(some, np.array([i for ids in made for i in ids], np.uint32), np.array([len(ids) for ids in made]))


def _totals(length: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(length)]).astype(np.int64)


def _by_bytes(chunks: list[str], limit: int = BATCH_BYTES):
    """Lists of about equal size in characters."""
    some, size = [], 0
    for x in chunks:
        some.append(x)
        size += len(x) + 1
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some
