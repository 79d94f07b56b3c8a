"""Quality by nearest neighbours: labelled latent-semantic vectors vote, weighted by cosine.

Terms of a text are the shapes of its blank-separated words (runs of capitals, small letters, digits
and the marks among them), the lengths of words and words said again at once. Square roots of term
shares, weighted by rarity, are projected onto the leading axes of a labelled sample; unit vectors
of the sample are broadcast, at most ``2 * per_class`` rows of ``axes`` numbers. Every document is
compared with all of them by blocked matrix products; the ``k`` most similar vote.

Null texts are empty; an empty text has no neighbours and gets the sample's share of label 1, as do
all texts when nothing is labelled (0.5 then). Repeated rows are scored each; one pass, no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from panelwise.llm.common import on_workers, slices, texts_of
from panelwise.llm.labelled import labelled_sample, with_score

SHAPES, LENGTHS = 1024, 16
TERMS = SHAPES + LENGTHS + 1
AGAIN = TERMS - 1
_CLASSES = str.maketrans({**{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}, **{chr(c): "0" for c in range(48, 58)}})
_OTHER = re.compile(r"[^\x00-\x7f]")
_RUN = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """``Ingou###`` becomes ``Aa#``."""
    word = word.translate(_CLASSES)
    if not word.isascii():
        word = _OTHER.sub(lambda m: "A" if m[0].isupper() else "a" if m[0].isalpha() else "0" if m[0].isnumeric() else "?", word)
    return _RUN.sub(r"\1", word)


def term_counts(texts: pa.Array) -> np.ndarray:
    """Terms of each text, counted."""
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    of, bounds = coded.indices.to_numpy(zero_copy_only=False), split.offsets.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    shapes: dict[str, int] = {}
    first = np.empty(len(words), np.int64)
    for i, w in enumerate(words):
        s = shape(w)
        first[i] = shapes[s] if s in shapes else shapes.setdefault(s, zlib.crc32(s.encode()) % SHAPES)
    second = SHAPES + np.minimum([len(w) for w in words], LENGTHS - 1) if words else first
    filled = np.array([bool(w) for w in words], bool)[of] if words else np.zeros(0, bool)
    again = np.zeros(len(of), bool)
    again[1:] = (of[1:] == of[:-1]) & (text[1:] == text[:-1]) & filled[1:]
    at = np.concatenate([text[filled] * TERMS + first[of[filled]], text[filled] * TERMS + second[of[filled]], text[again] * TERMS + AGAIN])
    return np.bincount(at, minlength=len(texts) * TERMS).reshape(len(texts), TERMS)


def _shares(counts: np.ndarray) -> np.ndarray:
    words = counts[:, :SHAPES].sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(words, 1)).astype(np.float32)


@dataclass(frozen=True)
class Voters:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def place(self, counts: np.ndarray) -> np.ndarray:
        x = (_shares(counts) * self.weights) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray, k: int, block: int = 512) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.labels):
            return out
        k = min(k, len(self.labels))
        for a in range(0, len(counts), block):
            some = counts[a : a + block]
            cosine = self.place(some) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
            total = weight.sum(axis=1)
            voted = (total > 0) & (some.sum(axis=1) > 0)
            out[a : a + block][voted] = np.clip((weight * self.labels[near]).sum(axis=1)[voted] / total[voted], 0, 1)
        return out


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            counts = term_counts(texts_of(part.column("text")))
            rows = [pa.array([c.astype(np.uint32).tobytes() for c in counts], pa.binary()), part.column("y")]
            yield pa.RecordBatch.from_arrays(rows, ["counts", "y"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2000, axes: int = 48) -> Voters:
    """Learn the projection and place the voters; at most ``2 * per_class`` count rows reach the driver."""
    on_workers(docs.sparkSession)
    rows = labelled_sample(docs, labels, label, per_class).mapInArrow(_sample_terms, "counts binary, y int").toPandas().sort_values(["y", "counts"])
    counts = np.frombuffer(b"".join(rows["counts"]), np.uint32).reshape(len(rows), TERMS)
    if not len(counts):
        return Voters(np.ones(TERMS, np.float32), np.eye(TERMS, axes, dtype=np.float32), np.zeros((0, axes), np.float32), np.zeros(0))
    weights = np.log(1 + len(counts) / (1 + (counts > 0).sum(axis=0))).astype(np.float32)
    x = _shares(counts) * weights
    values, found = np.linalg.eigh((x.T @ x).astype(np.float64))
    base = Voters(weights, found[:, ::-1][:, :axes].astype(np.float32), np.zeros((0, axes), np.float32), np.zeros(0))
    return Voters(weights, base.axes, base.place(counts), rows["y"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, voters: Voters, k: int = 15, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score of each row in a further column."""
    held = on_workers(docs.sparkSession).sparkContext.broadcast(voters)
    return with_score(docs, lambda texts: held.value.score(term_counts(texts), k), out, text)
