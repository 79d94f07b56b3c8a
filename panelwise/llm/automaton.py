"""A minimal acyclic transducer: words share beginnings and endings, and arcs add up to a word's number.

Built from sorted words; states with equal futures are one. An arc carries how many words come before
those behind it, so the sum along a path numbers the words and finds their ids in one table. All of
it lies in a few flat arrays of one file, which workers map into memory.
"""

from __future__ import annotations

import numpy as np


def compile_words(words: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the transducer from words to ids; words are not empty."""
    ordered = sorted(words)
    states: list[tuple[bool, list[tuple[int, int]]]] = []
    known: dict[tuple, int] = {}

    def settled(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append((node[0], list(node[1])))
        return known[key]

    path: list[list] = [[False, []]]  # of the word before: final, arcs to settled states
    last = b""
    for word in ordered:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for at in range(len(last), common, -1):
            node = path.pop()
            path[-1][1].append((last[at - 1], settled(node)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    for at in range(len(last), 0, -1):
        node = path.pop()
        path[-1][1].append((last[at - 1], settled(node)))
    root = settled(path[0])
    final = np.array([f for f, _ in states], bool)
    below = np.zeros(len(states), np.int64)
    key, target, adds = [], [], []
    for s, (f, arcs) in enumerate(states):  # targets are settled before their sources
        seen = int(f)
        for byte, to in arcs:
            key.append(s * 256 + byte)
            target.append(to)
            adds.append(seen)
            seen += below[to]
        below[s] = seen
    lengths = [len(words[w]) for w in ordered]
    return {
        "key": np.array(key, np.int64), "target": np.array(target, np.int32), "adds": np.array(adds, np.int32),
        "final": final, "root": np.array([root], np.int32),
        "bounds": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        "ids": np.array([i for w in ordered for i in words[w]], np.uint32),
    }


def save(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a header line of names, types and lengths, then the arrays at multiples of 8 bytes."""
    head = ";".join(f"{n}:{a.dtype.str}:{len(a)}" for n, a in arrays.items()).encode()
    with open(path, "wb") as f:
        f.write(head.ljust(1024))
        for a in arrays.values():
            f.write(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0"))


def mapped(path: str) -> dict[str, np.ndarray]:
    whole, at, out = np.memmap(path, np.uint8, "r"), 1024, {}
    for part in bytes(whole[:1024]).decode().strip().split(";"):
        name, kind, n = part.split(":")
        size = np.dtype(kind).itemsize * int(n)
        out[name] = whole[at : at + size].view(kind)
        at += -(-size // 8) * 8
    return out


def numbers(arrays: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Each word's number, -1 for words outside; all words take a step at a time."""
    length = np.array([len(w) for w in words], np.int64)
    out = np.full(len(words), -1, np.int64)
    key = arrays["key"]
    if not len(words) or not len(key):
        return out
    text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    first = np.cumsum(length) - length
    live = np.flatnonzero(length > 0)
    state, number = np.full(len(words), arrays["root"][0], np.int64), np.zeros(len(words), np.int64)
    step = 0
    while len(live):
        want = state[live] * 256 + text[first[live] + step]
        arc = np.searchsorted(key, want).clip(0, len(key) - 1)
        there = key[arc] == want
        live, arc = live[there], arc[there]
        state[live], number[live] = arrays["target"][arc], number[live] + arrays["adds"][arc]
        step += 1
        ended = length[live] == step
        done = live[ended][arrays["final"][state[live[ended]]]]
        out[done] = number[done]
        live = live[~ended]
    return out
