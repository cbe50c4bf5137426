"""Content-defined anchors: a sparse choice of positions that equal strings make alike.

Every window of ``span`` grams picks the position of its smallest gram hash (the leftmost
among equals).  Equal windows pick the same relative position, and neighbouring windows
mostly share their pick, so a sequence falls into pieces: maximal runs of windows with one
anchor.  About 2 / (span + 1) of the positions are anchors.
"""

from __future__ import annotations

import numpy as np

#: Bits of an ordering key that hold the position; the rest is the upper part of the hash.
_POSITION = 28


def sliding_min(a: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive values, by doubling."""
    out, done = a, 1
    while 2 * done <= span:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < span:
        out = np.minimum(out[:len(a) - span + 1], out[span - done:span - done + len(a) - span + 1])
    return out


def pieces(grams: np.ndarray, span: int, starts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first window, windows, anchor position)`` of every piece.

    ``grams`` are hashes over a concatenation of sequences; sequence ``k`` has ``windows[k]``
    windows, the first at ``starts[k]``.  A window never crosses a sequence."""
    total = int(windows.sum())
    if not total or len(grams) < span:
        none = np.zeros(0, np.int64)
        return none, none, none
    if len(grams) >> _POSITION:
        raise ValueError("a slice of text has too many positions")
    mask = np.uint64((1 << _POSITION) - 1)
    best = sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), span)
    own = np.flatnonzero(windows)
    first = np.repeat(starts[own] - (np.cumsum(windows[own]) - windows[own]), windows[own]) + np.arange(total)
    at = (best[first] & mask).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    return first[cut], np.diff(np.append(cut, total)), at[cut]


def merged(ranges: list[tuple[int, int]], n: int) -> np.ndarray:
    """Disjoint sorted ranges that cover the same positions of ``[0, n)``, as rows (start, end)."""
    if not ranges:
        return np.zeros((0, 2), np.int64)
    r = np.array(ranges, np.int64).reshape(-1, 2)
    r = np.clip(r[np.argsort(r[:, 0], kind="stable")], 0, n)
    reach = np.maximum.accumulate(r[:, 1])
    new = np.concatenate([[True], r[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(r) - 1]])
    out = np.stack([r[new, 0], reach[last]], 1)
    return out[out[:, 1] > out[:, 0]]
