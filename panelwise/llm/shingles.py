"""Hashes of word shingles, computed for many texts at once.

Words are runs of bytes other than blanks and control blanks (0x20, 0x09 to 0x0D), with A-Z in small
letters. A word's hash is the sum of its bytes times random odd numbers by place, mixed; a shingle's
hash does the same with its words. With 64 bits, two different shingles of one pair of texts of a
thousand words share a hash with a probability of about 10^-13.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SMALL = np.arange(256, dtype=np.uint64)
_SMALL[65:91] += 32
_by_place = np.zeros(0, np.uint64)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(seed)).integers(0, 2**64, n, np.uint64) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    """One random odd number for each place in a word; longer tables begin with the shorter ones."""
    global _by_place
    if len(_by_place) < n:
        _by_place = _odd(max(64, 1 << (n - 1).bit_length()), 1)
    return _by_place


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread each bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of the text each is in; texts are 64-bit strings without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    word = ~_BLANK[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = word[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw, word = raw[starts[0] :], word[starts[0] :]
    place = np.arange(len(raw)) - np.repeat(starts - starts[0], np.diff(np.r_[starts, starts[0] + len(raw)]))
    parts = np.where(word, (_SMALL[raw] + np.uint64(1)) * _places(int(place.max()) + 1)[place], np.uint64(0))
    return mixed(np.add.reduceat(parts, starts - starts[0])), np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, text number) of each text's n-word shingles, in order of hash, then text.

    A text of fewer words has one shingle of all of them, a text without words has none.
    """
    words, text = word_hashes(texts)
    times = _odd(n + 1, 2)
    count = np.bincount(text, minlength=len(texts))
    hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= n:
        total = sum((words[j : len(words) - n + 1 + j] * times[j] for j in range(n)), np.zeros(len(words) - n + 1, np.uint64))
        whole = text[n - 1 :] == text[: len(words) - n + 1]
        hashes, owner = total[whole], text[: len(words) - n + 1][whole]
    short = (count > 0) & (count < n)
    if short.any():
        mine = short[text]
        place = (np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count))[mine]
        start = np.flatnonzero(place == 0)
        sums = np.add.reduceat(words[mine] * times[place], start)
        hashes = np.concatenate([hashes, sums + count[short].astype(np.uint64) * times[n]])
        owner = np.concatenate([owner, np.flatnonzero(short)])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    hashes = mixed(hashes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
