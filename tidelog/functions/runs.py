"""Sets of offsets as sorted runs [first, one past the last), in numpy; a set's size in memory follows its
runs, not its offsets."""

from __future__ import annotations

import numpy as np

EMPTY = np.zeros((0, 2), np.int64)


def of(offsets) -> np.ndarray:
    """The runs of offsets in any order, repeated ones once."""
    x = np.unique(np.asarray(offsets, np.int64))
    if not len(x):
        return EMPTY
    cut = np.flatnonzero(np.diff(x) > 1) + 1
    return np.stack([x[np.concatenate([[0], cut])], x[np.concatenate([cut - 1, [len(x) - 1]])] + 1], axis=1)


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = np.concatenate([a, b])
    if not len(x):
        return EMPTY
    x = x[np.argsort(x[:, 0], kind="stable")]
    reach = np.maximum.accumulate(x[:, 1])
    new = np.concatenate([[True], x[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(x) - 1]])
    return np.stack([x[new, 0], reach[last]], axis=1)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What is in a and not in b."""
    edges = np.unique(np.concatenate([a.ravel(), b.ravel()]))
    if len(edges) < 2:
        return EMPTY
    low, high = edges[:-1], edges[1:]
    keep = _holds(a, low) & ~_holds(b, low)
    return union(np.stack([low[keep], high[keep]], axis=1), EMPTY)


def _holds(runs: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(runs):
        return np.zeros(len(x), bool)
    k = np.searchsorted(runs[:, 0], x, side="right") - 1
    return (k >= 0) & (x < runs[np.maximum(k, 0), 1])


def size(runs: np.ndarray) -> int:
    return int((runs[:, 1] - runs[:, 0]).sum())


def packed(runs: np.ndarray) -> bytes:
    return runs.astype("<i8").tobytes()


def unpacked(raw) -> np.ndarray:
    return EMPTY if not raw else np.frombuffer(bytes(raw), "<i8").reshape(-1, 2).astype(np.int64)


# ---- many sets at once: rows [set, first, one past the last) in the order of set and first ----

NONE = np.zeros((0, 3), np.int64)


def of_many(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The runs of the offsets of each set, in any order, repeated ones once."""
    if not len(sets):
        return NONE
    order = np.lexsort((offsets, sets))
    s, x = sets[order], offsets[order]
    first, last = _spans((s[1:] != s[:-1]) | (x[1:] > x[:-1] + 1))
    return np.column_stack([s[first], x[first], x[last] + 1])


def union_many(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = np.concatenate([a, b])
    if not len(x):
        return NONE
    x = x[np.lexsort((x[:, 1], x[:, 0]))]
    # The furthest end so far within a set: ends are ranked by set first, so no set reaches into the next.
    by_end = np.lexsort((x[:, 2], x[:, 0]))
    rank = np.empty(len(x), np.int64)
    rank[by_end] = np.arange(len(x))
    reach = x[by_end[np.maximum.accumulate(rank)], 2]
    first, last = _spans((x[1:, 0] != x[:-1, 0]) | (x[1:, 1] > reach[:-1]))
    return np.column_stack([x[first, 0], x[first, 1], reach[last]])


def inside_many(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each run of a, whether its set in b holds all of it."""
    if not len(b):
        return np.zeros(len(a), bool)
    x = np.concatenate([b, a])
    order = np.lexsort((np.arange(len(x)) >= len(b), x[:, 1], x[:, 0]))
    before = np.empty(len(x), np.int64)
    before[order] = np.cumsum(order < len(b)) - 1
    k = before[len(b) :]
    near = b[np.maximum(k, 0)]
    return (k >= 0) & (near[:, 0] == a[:, 0]) & (near[:, 2] >= a[:, 2])


def packed_many(x: np.ndarray) -> bytes:
    """Column by column and with lengths for ends, which a store's compression shrinks well."""
    return np.stack([x[:, 0], x[:, 1], x[:, 2] - x[:, 1]]).astype("<i8").tobytes()


def unpacked_many(raw) -> np.ndarray:
    s, first, length = np.frombuffer(bytes(raw), "<i8").reshape(3, -1).astype(np.int64)
    return np.column_stack([s, first, first + length])


def _spans(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last row of each stretch of rows, where cut says of each row but the first that one begins."""
    first = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return first, np.concatenate([first[1:] - 1, [len(cut)]])
