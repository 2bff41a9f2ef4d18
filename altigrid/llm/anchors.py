"""Cutting texts into anchored segments: equal windows fall into segments with equal anchors."""

from __future__ import annotations

import numpy as np

from altigrid.llm.common import mix64

GRAM = 32  # bytes of an anchor
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 2**64, 256, np.uint64)
_OTHER = _RNG.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ERA = 1 << 21
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_ERA - 1, _BASE, np.uint64))])
_INVERSE = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_ERA - 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64))])


def _window_minima(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of each run of `width` values, and whether it occurs there more than once.

    Made of disjoint runs of powers of two, so that no value counts twice.
    """
    n = len(x) - width + 1
    low, tied, span = x, np.zeros(len(x), bool), 1
    out, out_tied, done = None, None, 0
    while True:
        if width & span:
            a, t = low[done:done + n], tied[done:done + n]
            if out is None:
                out, out_tied = a, t
            else:
                out_tied = (a == out) | (t & (a < out)) | (out_tied & (out < a))
                out = np.minimum(out, a)
            done += span
        if span * 2 > width:
            return out, out_tied
        a, b = low[:-span], low[span:]
        tied = (a == b) | (tied[:-span] & (a < b)) | (tied[span:] & (b < a))
        low, span = np.minimum(a, b), span * 2


def segments(data: np.ndarray, bounds: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of window starts with one anchor: (text, start, starts, anchor, digest, again).

    data holds the bytes of several texts, bounds their ends (first 0). A window is
    `span` bytes inside one text; its anchor is the smallest hash among its grams, so
    equal windows have equal anchors wherever they stand. digest is a hash of
    the run's bytes, again whether two of its windows might be equal. At most _ERA
    bytes at once.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < span:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(bool)
    values = _BYTE[data]
    grams, width = values, 1
    while width < GRAM:
        grams = grams[:-width] * _POWERS[width] + grams[width:]
        width *= 2
    anchors, tied = _window_minima(mix64(grams), span - GRAM + 1)
    lengths = np.diff(bounds)
    starts = np.maximum(lengths - span + 1, 0)
    new = np.zeros(len(anchors) + 1, bool)
    usable = np.zeros(len(anchors) + 1, np.int8)
    able = starts > 0
    np.add.at(usable, bounds[:-1][able], 1)
    np.add.at(usable, (bounds[:-1] + starts)[able], -1)
    inside = np.cumsum(usable[:-1], dtype=np.int8) > 0
    new[0] = True
    new[1:-1] = anchors[1:] != anchors[:-1]
    new[bounds[:-1][able]] = True
    begin = np.flatnonzero(new[:-1] & inside)
    ends = np.flatnonzero(np.diff(inside.astype(np.int8), append=0) == -1) + 1
    stop = np.minimum(np.append(begin[1:], len(anchors)), ends[np.searchsorted(ends, begin, side="right")] if len(ends) else 0)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _POWERS[:len(values)], dtype=np.uint64)])
    digest = mix64((sums[stop + span - 1] - sums[begin]) * _INVERSE[begin] + (stop - begin).astype(np.uint64) * _BASE)
    ties = np.concatenate([[0], np.cumsum(tied)])
    again = (ties[stop] > ties[begin]) | (stop - begin > span - GRAM + 1)
    text = np.searchsorted(bounds, begin, side="right") - 1
    return text, begin - bounds[text], stop - begin, anchors[begin], digest, again


def window_hashes(data: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of all `span` bytes from each place in `at`. At most _ERA bytes at once."""
    out = []
    for table in (_BYTE, _OTHER):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(table[data] * _POWERS[:len(data)], dtype=np.uint64)])
        out.append(mix64((sums[at + span] - sums[at]) * _INVERSE[at]))
    return out[0], out[1]
