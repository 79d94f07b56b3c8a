"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text and normalised by length.

Texts are folded: small letters, no accents, compatibility forms and homoglyphs to plain Latin, digits and marks that stand for
letters to those letters, everything else to blanks. Lexicon entries are whole words and word
beginnings whose share among toxic rows is far above that among others, weighted by the log of the
ratio; two words in a row that hold an entry but occur in clean rows only are exceptions and cancel
it. The weights of the hits, as a sum and for each hundred words, go through a logistic curve.

Lexicon, exceptions and curve come from at most ``2 * per_class`` labelled rows; only counted
entries, at most ``entries``, and two numbers a sampled row reach the driver. Scoring is one pass
without a shuffle. Null texts are empty; empty texts score as texts without hits; without toxic
labels all scores are 0; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwise.llm.common import on_workers
from panelwise.llm.labelled import labelled_sample, with_score

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
#: Digits and marks that stand for letters; l and i are one letter here.
STAND_INS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "l": "i"}
INSIDE = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
_ASCII = {c: (STAND_INS.get(chr(c), chr(c)) if chr(c).isalnum() else " ") for c in range(128)}
_FOLD = str.maketrans({**{chr(c): v for c, v in _ASCII.items()}, **HOMOGLYPHS, **{chr(c): None for c in (0x200B, 0x200C, 0x200D, 0x00AD, 0xFEFF)}})
#: What a text that is not all ASCII loses first: accents go, and marks and blanks of other scripts part words as ASCII ones do.
_MARKS = {c: " " for c in range(128, 0x110000) if unicodedata.category(chr(c))[0] in "PSZ" or unicodedata.category(chr(c)) == "Cc"}
_MARKS |= {c: None for c in range(0x110000) if unicodedata.combining(chr(c))}
_INSIDE = re.compile(r"(?<=[^\W_])[@$!|+](?=[^\W_])")
_TWO = re.compile(" +([^ ]+)(?: +([^ ]+))?")
STEMS = range(4, 9)


def folded(text: str) -> str:
    """Words between single or more blanks, with one at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_MARKS)
    text = text.lower()
    text = _INSIDE.sub(lambda m: INSIDE[m[0]], text)
    return f" {text.translate(_FOLD)} "


def entries_of(words: set[str]) -> set[str]:
    out = {f" {w} " for w in words}
    for n in STEMS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for entry in self.exceptions:
            found.add_word(entry, (len(entry), -1.0))
        if not len(found):
            return None
        found.make_automaton()
        return found

    def score(self, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(hits))
        a, b, c = self.curve
        x = np.clip(a + features(hits, words) @ np.array([b, c]), -50, 50)
        return 1 / (1 + np.exp(-x))


def features(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.log1p(hits), np.log1p(100 * hits / (words + 20))], axis=1)


def found_in(text: str, automaton: ahocorasick.Automaton | None) -> dict[int, float]:
    """Places of the words that hold an entry, with the largest weight there; exceptions taken off."""
    hits: dict[int, float] = {}
    spans = []
    for end, (n, weight) in automaton.iter(text) if automaton is not None else ():
        start = end - n + 1
        if weight < 0:
            spans.append((start, end))
        elif weight > hits.get(start, 0):
            hits[start] = weight
    for a, b in spans:
        for at in [at for at in hits if a <= at < b]:
            del hits[at]
    return hits


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each entry by label."""
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            (toxic if y else clean).update(entries_of(set(folded(text).split())))
        names = list(toxic | clean)
        columns = [pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([clean[x] for x in names], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "clean"])


def _met(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, phrases: bool) -> Iterator[pa.RecordBatch]:
    """What the lexicon finds in sampled rows: hits and words of each, or the phrases around hits."""
    automaton = lexicon.automaton()
    for batch in batches:
        ys, out = batch.column("y").to_pylist(), []
        for text, y in zip(batch.column("text").to_pylist(), ys, strict=True):
            text = folded(text)
            hits = found_in(text, automaton)
            if phrases:
                out += [(p, y) for p in {p for at in hits for p in around(text, at)}]
            else:
                out.append((sum(hits.values()), len(text.split()), y))
        names = ["phrase", "y"] if phrases else ["hits", "words", "y"]
        kinds = [pa.string(), pa.int32()] if phrases else [pa.float64(), pa.int64(), pa.int32()]
        columns = zip(*out, strict=True) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def around(text: str, at: int) -> list[str]:
    """The whole word after the blank at a place, with the one before it and with the one after it."""
    word, after = _TWO.match(text, at).groups()
    end = at
    while end and text[end - 1] == " ":
        end -= 1
    before = text[text.rfind(" ", 0, end) + 1 : end]
    return [f" {a} {b} " for a, b in ((before, word), (word, after)) if a and b]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 3000, entries: int = 20_000, least: float = 3.0) -> Lexicon:
    spark = on_workers(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, per_class).dropDuplicates()
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if not n.get(1):
        return Lexicon()
    counts = sample.mapInArrow(_counted, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    weight = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n.get(0, 0) + 1))
    kept = counts.where(F.col("t") >= max(3, math.ceil(0.002 * n[1]))).withColumn("w", weight).where(F.col("w") >= least)
    rows = kept.orderBy(F.desc(F.col("w") * F.log1p("t")), "entry").limit(entries).collect()
    lexicon = Lexicon({r["entry"]: round(r["w"], 6) for r in rows})
    held = sample.repartition(spark.sparkContext.defaultParallelism)
    said = held.mapInArrow(partial(_met, lexicon=lexicon, phrases=True), "phrase string, y int")
    clean = said.groupBy("phrase").agg(F.sum("y").alias("t"), F.count("*").alias("n")).where("t = 0 AND n > 1").orderBy(F.desc("n"), "phrase").limit(entries)
    lexicon.exceptions = frozenset(r["phrase"] for r in clean.collect())
    met = held.mapInArrow(partial(_met, lexicon=lexicon, phrases=False), "hits double, words long, y int").toArrow()
    hits, words, y = (met[c].to_numpy().astype(np.float64) for c in ("hits", "words", "y"))
    order = np.lexsort((y, words, hits))
    lexicon.curve = _curve(features(hits, words)[order], y[order])
    return lexicon


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Logistic fit with both classes of equal weight and a small ridge."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (share * (y - p)) - ridge * w
        step = np.linalg.solve(x.T @ (x * (share * p * (1 - p))[:, None]) + ridge * np.eye(len(w)), slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


_automata: dict[int, tuple[Lexicon, ahocorasick.Automaton | None]] = {}


def _automaton_of(lexicon: Lexicon) -> ahocorasick.Automaton | None:
    """The automaton of the lexicon that this worker holds, built once."""
    if id(lexicon) not in _automata:
        _automata.clear()
        _automata[id(lexicon)] = lexicon, lexicon.automaton()
    return _automata[id(lexicon)][1]


def score_texts(lexicon: Lexicon, texts: pa.Array) -> np.ndarray:
    automaton, hits, words = _automaton_of(lexicon), np.zeros(len(texts)), np.zeros(len(texts))
    for i, text in enumerate(texts):
        text = folded(text.as_py())
        hits[i], words[i] = sum(found_in(text, automaton).values()), len(text.split())
    return lexicon.score(hits, words)


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score of each row in a further column."""
    held = on_workers(docs.sparkSession).sparkContext.broadcast(lexicon)
    return with_score(docs, lambda texts: score_texts(held.value, texts), out, text)
