"""Regression trees for panels that fit one task: fitted, and applied to unseen rows on the way down.

Tuning asks for the predictions of many forests and boostings on small folds and for no model. A tree is
grown level by level from histograms over at most ``BINS`` bins a feature; rows to predict go down with the
rows it is grown on, so predictions at every depth are at hand and no tree is kept. The rules are those of
the distributed learner: variance reduction, splits between quantiles, Poisson bootstrap, boosting of
doubled residuals after a first tree of weight 1.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

BINS = 32


def binned(past: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices as bins; borders lie halfway between values of ``past``, at quantiles if there are many."""
    out = np.zeros(past.shape, np.int64), np.zeros(following.shape, np.int64)
    for f in range(past.shape[1]):
        values, counts = np.unique(past[:, f], return_counts=True)
        if len(values) > BINS:
            upto = np.cumsum(counts)
            last = np.searchsorted(upto, len(past) * np.arange(1, BINS) / BINS)
            cuts = np.unique(np.minimum(last, len(values) - 2))
        else:
            cuts = np.arange(len(values) - 1)
        borders = (values[cuts] + values[cuts + 1]) / 2 if len(cuts) else np.zeros(0)
        for x, b in zip((past, following), out, strict=True):
            b[:, f] = np.searchsorted(borders, x[:, f], side="left")
    return out


def grown(
    past: np.ndarray, y: np.ndarray, weight: np.ndarray, following: np.ndarray, depth: int, min_leaf: int,
    depths: Sequence[int], features: int | None, draw: np.random.Generator,
) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(predictions of the rows it is grown on, predictions of ``following`` by the tree cut at each of ``depths``).

    ``features`` of all are drawn anew for each node, if given.
    """
    width = past.shape[1]
    node, at = np.zeros(len(past), np.int64), np.zeros(len(following), np.int64)
    fitted, shown, out = np.zeros(len(past)), np.zeros(len(following)), {}
    rows, others = np.flatnonzero(weight > 0), np.arange(len(following))
    settled = np.arange(len(past))  # rows of weight 0 go down too: boosting needs their predictions
    k, place = 1, np.arange(width) * BINS
    for level in range(depth + 1):
        n = np.bincount(node[rows], weight[rows], minlength=k)
        total = np.bincount(node[rows], weight[rows] * y[rows], minlength=k)
        mean = total / np.maximum(n, 1e-300)
        fitted[settled], shown[others] = mean[node[settled]], mean[at[others]]
        if level in depths:
            out[level] = shown.copy()
        if level == depth or not len(rows):
            break
        cell = (node[rows, None] * (width * BINS) + place + past[rows]).ravel()
        shape = (k, width, BINS)
        left_n = np.bincount(cell, np.repeat(weight[rows], width), minlength=k * width * BINS).reshape(shape).cumsum(axis=2)[:, :, :-1]
        left = np.bincount(cell, np.repeat(weight[rows] * y[rows], width), minlength=k * width * BINS).reshape(shape).cumsum(axis=2)[:, :, :-1]
        right_n, right = n[:, None, None] - left_n, total[:, None, None] - left
        ok = (left_n >= min_leaf) & (right_n >= min_leaf) & (left_n > 0) & (right_n > 0)
        if features is not None and features < width:
            chosen = draw.random((k, width)).argsort(axis=1).argsort(axis=1) < features
            ok &= chosen[:, :, None]
        gain = np.where(ok, left**2 / np.maximum(left_n, 1) + right**2 / np.maximum(right_n, 1), -np.inf).reshape(k, -1)
        best = gain.argmax(axis=1)
        splits = gain[np.arange(k), best] > mean * total * (1 + 1e-12) + 1e-12
        number = np.where(splits, 2 * (np.cumsum(splits) - 1), -1)
        feature, border = best // (BINS - 1), best % (BINS - 1)

        def below(bins: np.ndarray, of: np.ndarray, which: np.ndarray, number=number, feature=feature, border=border) -> np.ndarray:
            """Those of ``which`` whose node splits, moved to its children."""
            mine = of[which]
            which, mine = which[number[mine] >= 0], mine[number[mine] >= 0]
            of[which] = number[mine] + (bins[which, feature[mine]] > border[mine])
            return which

        settled, others = below(past, node, settled), below(following, at, others)
        rows = settled[weight[settled] > 0]
        k = 2 * int(splits.sum())
    for d in depths:
        out.setdefault(d, shown)
    return fitted, out


def forest(
    past: np.ndarray, y: np.ndarray, following: np.ndarray, trees: Sequence[int], depths: Sequence[int],
    min_leaf: int, bootstrap: bool, third: bool, seed: int,
) -> dict[tuple[int, int], np.ndarray]:
    """Predictions of ``following`` by the first trees of one forest, cut at each depth: {(trees, depth): values}."""
    past, following = binned(past, following)
    draw, sums, out = np.random.default_rng(seed), dict.fromkeys(depths, 0.0), {}
    features = -(-past.shape[1] // 3) if third else None
    for t in range(1, max(trees) + 1):
        weight = draw.poisson(1.0, len(y)).astype(float) if bootstrap else np.ones(len(y))
        _, some = grown(past, y, weight, following, max(depths), min_leaf, depths, features, draw)
        for d in depths:
            sums[d] = sums[d] + some[d]
        if t in trees:
            out |= {(t, d): sums[d] / t for d in depths}
    return out


def boosting(
    past: np.ndarray, y: np.ndarray, following: np.ndarray, iterations: Sequence[int], depth: int, rate: float, min_leaf: int, seed: int
) -> dict[tuple[int, int], np.ndarray]:
    """Predictions of ``following`` after each of ``iterations``: {(iterations, depth): values}."""
    past, following = binned(past, following)
    draw, weight, out = np.random.default_rng(seed), np.ones(len(y)), {}
    fitted, shown = np.zeros(len(y)), np.zeros(len(following))
    for t in range(1, max(iterations) + 1):
        step, some = grown(past, y if t == 1 else 2 * (y - fitted), weight, following, depth, min_leaf, [depth], None, draw)
        share = 1.0 if t == 1 else rate
        fitted, shown = fitted + share * step, shown + share * some[depth]
        if t in iterations:
            out[t, depth] = shown
    return out
