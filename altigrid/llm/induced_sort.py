"""Suffix order and common prefixes of one shard, by induced sorting with queues on disk.

The suffixes that start at a left-most S position are sorted first: their
substrings are named in order, and the string of names is sorted by doubling, whole
arrays at a time. From them all L suffixes are induced in ascending order and
all S suffixes in descending order. At the first level the queues carry
(position, common prefix) tuples by leading symbol, whole batches at a time;
what exceeds the memory limit goes to files, which are removed when read. The common
prefix of two neighbours in a queue is one more than the smallest one between
the suffixes that induced them. Common prefixes are counted up to `cap`.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

LONG = 40  # symbols of a substring that are compared some at a time


class DiskQueue:
    """First-in-first-out lists of (position, prefix) by symbol, in memory up to `limit` entries."""

    def __init__(self, limit: int):
        self.limit, self.held, self.folder = limit, 0, None
        self.parts: dict[int, list] = defaultdict(list)
        self.files: dict[int, int] = defaultdict(int)

    def push(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.parts[symbol].append((position, prefix))
        self.held += len(position)
        while self.held > self.limit:
            self._spill(max(self.parts, key=lambda s: sum(len(p) for p, _ in self.parts[s])))

    def _spill(self, symbol: int) -> None:
        self.folder = self.folder or tempfile.mkdtemp(prefix="suffixes-")
        position, prefix = (np.concatenate(c) for c in zip(*self.parts.pop(symbol)))
        np.savez(self._name(symbol, self.files[symbol]), position=position, prefix=prefix)
        self.files[symbol] += 1
        self.held -= len(position)

    def _name(self, symbol: int, k: int) -> str:
        return os.path.join(self.folder, f"{symbol}-{k}.npz")

    def pop(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of the symbol in order of entry, also those that enter meanwhile."""
        k = 0
        while k < self.files[symbol] or self.parts.get(symbol):
            if k < self.files[symbol]:
                with np.load(self._name(symbol, k)) as read:
                    batch = read["position"], read["prefix"]
                os.remove(self._name(symbol, k))
                k += 1
            else:
                batch = tuple(np.concatenate(c) for c in zip(*self.parts.pop(symbol)))
                self.held -= len(batch[0])
            yield batch

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def classify(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S type); s ends with its unique smallest symbol."""
    step = np.sign(np.diff(s.astype(np.int64)))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(step[following] > 0, True)


def _packed(values: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Each place's next few values as one number of at most 52 bits, zeros beyond the end: (numbers, how many values, bits of one)."""
    bits = max(1, int(values.max()).bit_length())
    per = max(1, 52 // bits)
    padded = np.append(values.astype(np.int64), np.zeros(per, np.int64))
    out = np.zeros(len(values), np.int64)
    for k in range(per):
        out = (out << bits) | padded[k:k + len(values)]
    return out, per, bits


def _refined(group: np.ndarray, key: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort members of groups (equal numbers, whose slots are `slots`, ascending) by key.

    Returns their order, the first slot of each one's new group, and which new groups have more than one member.
    """
    order = np.lexsort((key, group))
    group, key = group[order], key[order]
    head = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
    first = slots[np.flatnonzero(head)[np.cumsum(head) - 1]]
    return order, first, ~(head & np.append(head[1:], True))


def names(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the substrings between left-most S positions, equal for equal ones.

    Substrings are compared some symbols at a time, the next ones only among those equal so far, and what is
    left of long ones as a whole. None is the beginning of another, as symbols are told apart by their type.
    """
    code = s.astype(np.int64) * 2 + small
    words, per, bits = _packed(code)
    lengths = np.append(lms[1:], len(s) - 1) + 1 - lms
    rank, still, slots, done = np.zeros(len(lms), np.int64), np.arange(len(lms)), np.arange(len(lms)), 0
    while len(still):
        if done < LONG:
            gone = bits * (per - np.minimum(lengths[still] - done, per))
            key = words[lms[still] + done] >> gone << gone
            done += per
        else:
            parts = [code[a:b].astype(">u8").tobytes() for a, b in zip((lms[still] + done).tolist(), (lms + lengths)[still].tolist())]
            order = {p: k for k, p in enumerate(sorted(set(parts)))}
            key = np.fromiter(map(order.__getitem__, parts), np.int64, len(parts))
            done = len(s)
        order, first, _ = _refined(rank[still], key, slots)
        still = still[order]
        rank[still] = first
        longer = lengths[still] > done
        still, slots = still[longer], slots[longer]
    return rank


def _order(s: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names, by doubling: groups equal in h names are sorted by the group h names on."""
    order = np.argsort(s)
    slots = np.arange(len(s))
    sorted_names = s[order]
    head = np.append(True, sorted_names[1:] != sorted_names[:-1])
    rank = np.empty(len(s), np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    slots, h = slots[~(head & np.append(head[1:], True))], 1
    while len(slots):
        place = order[slots]
        by, first, tied = _refined(rank[place], rank[place + h], slots)
        place = place[by]
        order[slots] = place
        rank[place] = first
        slots, h = slots[tied], 2 * h
    return order


def _prefixes(s: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to cap (first 0)."""
    words, per, bits = _packed(s)
    out = np.zeros(len(order), np.int32)
    live = np.arange(1, len(order))
    for k in range(0, cap, per):  # both are inside s, as they differ where the shorter one ends
        other = words[order[live] + k] ^ words[order[live - 1] + k]
        out[live] = k + per - (np.frexp(other.astype(np.float64))[1] + bits - 1) // bits
        live = live[other == 0]
        if not len(live):
            break
    return np.minimum(out, cap)


class _Inducer:
    """Sends the predecessors of a sorted stream of suffixes to the queue of their symbol."""

    def __init__(self, s: np.ndarray, wanted: np.ndarray, queue: DiskQueue, cap: int):
        self.s, self.wanted, self.queue, self.cap = s, wanted, queue, cap
        self.pending = np.zeros(int(s.max()) + 1, np.int32)

    def push(self, position: np.ndarray, prefix: np.ndarray) -> None:
        at = np.flatnonzero((position > 0) & self.wanted[position - 1])
        floor = int(prefix.min())
        if len(at):
            before = position[at] - 1
            symbol = self.s[before]
            by = np.argsort(symbol, kind="stable")
            at, before, symbol = at[by], before[by], symbol[by]
            head = np.flatnonzero(np.diff(symbol, prepend=-1))
            spans = np.stack([np.append(0, at[:-1] + 1), at + 1], axis=1)
            spans[head, 0] = 0
            common = np.minimum.reduceat(np.append(prefix, self.cap), spans.ravel())[::2]
            keys = symbol[head]
            common[head] = np.minimum(common[head], self.pending[keys])
            common = np.minimum(common + 1, self.cap)
            stops = np.append(head[1:], len(at))
            for c, a, b in zip(keys.tolist(), head.tolist(), stops.tolist()):
                self.queue.push(c, before[a:b], common[a:b])
            np.minimum(self.pending, floor, out=self.pending)
            rest = np.minimum.accumulate(np.append(prefix, self.cap)[::-1])[::-1]
            self.pending[keys] = rest[at[stops - 1] + 1]
        else:
            np.minimum(self.pending, floor, out=self.pending)


def _run(s: np.ndarray, p: int, cap: int) -> int:
    """How often the symbol at p is repeated from there, up to cap."""
    window = s[p:p + cap]
    other = np.flatnonzero(window != window[0])
    return int(other[0]) if len(other) else len(window)


def sorted_suffixes(s: np.ndarray, cap: int, limit: int = 8_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (position, common prefix with the one before it in this stream), largest suffix first.

    s: non-negative symbols ending with a smallest one that occurs once.
    """
    if len(s) < 2:
        return
    small = classify(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = lms[_order(names(s, small, lms))] if len(lms) > 1 else lms
    prefix = _prefixes(s, seeds, cap)
    alphabet = np.unique(s)
    cuts = np.searchsorted(s[seeds], alphabet), np.searchsorted(s[seeds], alphabet, side="right")
    large, sorted_large, less = DiskQueue(limit), DiskQueue(limit), DiskQueue(limit)
    try:
        inducer = _Inducer(s, ~small, large, cap)
        for c, a, b in zip(alphabet.tolist(), *(k.tolist() for k in cuts)):
            last = None
            for position, common in large.pop(c):
                if last is None:
                    common[0] = 0
                sorted_large.push(c, position, common)
                inducer.push(position, common)
                last = position[-1]
            if b > a:
                common = prefix[a:b].copy()
                common[0] = 0 if last is None else min(_run(s, int(last), cap), _run(s, int(seeds[a]), cap))
                inducer.push(seeds[a:b], common)
        inducer = _Inducer(s, small, less, cap)
        less.push(int(s[-1]), np.array([len(s) - 1]), np.zeros(1, np.int32))
        for c in alphabet[::-1].tolist():
            last = None
            for position, common in less.pop(c):
                if last is None:
                    common[0] = 0
                inducer.push(position, common)
                last = position[-1]
                yield position, common
            batches = list(sorted_large.pop(c))
            for k in range(len(batches) - 1, -1, -1):
                position, common = batches[k]
                after = batches[k + 1][1][0] if k + 1 < len(batches) else None
                down = np.append(common[1:], 0)[::-1].copy()
                if after is not None:
                    down[0] = after
                else:
                    down[0] = 0 if last is None else min(_run(s, int(last), cap), _run(s, int(position[-1]), cap))
                inducer.push(position[::-1], down)
                yield position[::-1], down
    finally:
        for queue in (large, sorted_large, less):
            queue.close()


def repeated_starts(s: np.ndarray, cap: int, limit: int = 8_000_000) -> np.ndarray:
    """Which positions start `cap` symbols that also start at a smaller position."""
    out = np.zeros(len(s), bool)
    least = np.int64(-1)
    for position, common in sorted_suffixes(s, cap, limit):
        head = np.flatnonzero(np.append(True, common[1:] < cap))
        lowest = np.minimum.reduceat(position, head)
        goes_on = least >= 0 and common[0] >= cap
        if goes_on:
            if lowest[0] < least:
                out[least] = True
            else:
                lowest[0] = least
        run = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(position))))
        out[position[position != lowest[run]]] = True
        least = lowest[-1]
    return out
