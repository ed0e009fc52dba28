"""Isolation forests of many groups at once, as array operations over one task's readings."""

from __future__ import annotations

import numpy as np

TREES, SAMPLE, DEPTH = 64, 24, 6
INNER = 2**DEPTH - 1  # nodes that may split; below them lie 2 ** DEPTH more
MARGIN = 1.0  # cuts are drawn from the sample's extremes widened by so many times their distance, so that readings outside of the sample are isolated too


def _mix(x: np.ndarray) -> np.ndarray:
    """A counter-based generator: equal counters give equal numbers, on any machine and in any order."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(counter: np.ndarray) -> np.ndarray:
    return (_mix(counter) >> np.uint64(11)).astype(np.float64) / 2.0**53


def average_path(n: np.ndarray) -> np.ndarray:
    """The mean depth of an unsuccessful search among n values."""
    m = np.maximum(n, 2).astype(np.float64)
    return np.where(n > 2, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m, (n == 2) * 1.0)


def forest_scores(x: np.ndarray, starts: np.ndarray, seeds: np.ndarray, at_once: int = 256) -> np.ndarray:
    """The score in (0, 1) of each reading by its own group's forest; high scores isolate early.

    x is readings by features, groups are contiguous from ``starts`` on, ``seeds`` is one number per group. Each tree
    of a group is grown on a sample of up to SAMPLE readings spread over the group, with random features and random
    cuts about the sample's extremes; every reading of the group then runs down all its trees. ``at_once`` groups'
    trees are held in memory.
    """
    ends = np.append(starts, len(x))
    parts = [_scores(x[ends[a] : ends[min(a + at_once, len(starts))]], starts[a : a + at_once] - ends[a], seeds[a : a + at_once]) for a in range(0, len(starts), at_once)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _scores(x: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n, width = x.shape
    groups = len(starts)
    sizes = np.diff(np.append(starts, n))
    rows = groups * TREES
    size, first = np.repeat(sizes, TREES), np.repeat(starts, TREES)
    with np.errstate(over="ignore"):
        seed = _mix(np.repeat(seeds.astype(np.uint64), TREES) * np.uint64(1000003) + np.tile(np.arange(TREES, dtype=np.uint64), groups))
        drawn = np.minimum(size, SAMPLE)
        k = np.arange(SAMPLE)
        u = _unit(seed[:, None] + k.astype(np.uint64)[None, :])
        pick = first[:, None] + np.minimum(((k[None, :] + u) * size[:, None] / drawn[:, None]).astype(np.int64), size[:, None] - 1)
        valid = k[None, :] < drawn[:, None]
        nodes = np.arange(INNER, dtype=np.uint64)
        feature = (_unit(seed[:, None] + nodes[None, :] + np.uint64(1 << 20)) * width).astype(np.int64)
        cut_at = _unit(seed[:, None] + nodes[None, :] + np.uint64(1 << 21)) * (1 + 2 * MARGIN) - MARGIN
    every = 2 * INNER + 1
    cuts = np.full((rows, every), np.inf, np.float32)
    r, c = np.nonzero(valid)
    reading, node = pick[r, c], np.zeros(len(r), np.int64)
    counts = np.bincount(r * every, minlength=rows * every).reshape(rows, every)
    for level in range(DEPTH):
        lo, hi = np.full(rows * INNER, np.inf), np.full(rows * INNER, -np.inf)
        value = x[reading, feature[r, node]]
        np.minimum.at(lo, r * INNER + node, value)
        np.maximum.at(hi, r * INNER + node, value)
        at = slice(2**level - 1, 2 ** (level + 1) - 1)
        low, span = lo.reshape(rows, INNER)[:, at], (hi - lo).reshape(rows, INNER)[:, at]
        with np.errstate(invalid="ignore"):
            cuts[:, at] = np.where((span > 0) & (counts[:, at] > 1), low + cut_at[:, at] * span, np.inf)
        node = 2 * node + 1 + (value.astype(np.float32) > cuts[r, node])
        counts += np.bincount(r * every + node, minlength=rows * every).reshape(rows, every)
    # a node with one reading of the sample or none is an end; the path to it is its depth and what its readings would still
    # take; where the drawn feature is the same for all, they go on together
    depth = np.floor(np.log2(np.arange(every) + 1))
    path = (depth[None, :] + average_path(np.arange(SAMPLE + 1))[counts]).astype(np.float32).ravel()
    down = np.where(counts[:, :INNER] > 1, 2 * np.arange(INNER)[None, :] + 1, np.arange(INNER)[None, :])
    child = np.concatenate([down, np.broadcast_to(np.arange(INNER, every), (rows, every - INNER))], axis=1).astype(np.int32).ravel()
    chosen = np.concatenate([feature, np.zeros((rows, every - INNER), np.int64)], axis=1).astype(np.int32).ravel()
    cuts, flat = cuts.ravel(), np.ascontiguousarray(x, np.float32).ravel()
    group = np.repeat(np.arange(groups), sizes)
    own, total = np.arange(n) * width, np.zeros(n)
    for t in range(TREES):
        base = (group * TREES + t) * every
        at = base.copy()
        for _ in range(DEPTH):
            at = base + child[at] + (flat[own + chosen[at]] > cuts[at])
        total += path[at]
    return 2.0 ** (-total / TREES / np.maximum(average_path(np.minimum(sizes, SAMPLE)), 1.0)[group])
