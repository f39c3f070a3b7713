"""Suffixes of a shard, in order and with common prefixes, by external induced sorting.

Suffixes that begin a fall of the text (S*) are sorted first: the pieces between them are named in order, and the recursion on
the names orders the suffixes.  All other suffixes follow by induction: in a scan over sorted suffixes, the suffix one symbol
longer goes to the queue of its first symbol, and every queue fills in the order of its suffixes.  First come the
suffixes larger than their successor, in a rising scan, then the smaller ones, in a falling scan.  With each suffix goes its common prefix with
the one before it in the queue: one more than the least common prefix between the two suffixes that they came from.

Queues are ordered by first symbol, then rank, which is the order of arrival; beyond a budget they go to a temporary file
of the task, so memory holds the text and the buckets in work.
"""

from __future__ import annotations

import tempfile

import numpy as np

from basketlens.functions.shipping import by_value

by_value(__name__)

SYMBOLS = 257  # 0 ends a piece of text; a byte b is b + 1
MOST = 255  # common prefixes are kept in a byte
BUDGET = 64 << 20  # bytes of queues in memory


class Queues:
    """A priority queue of (suffix, common prefix) in symbol and arrival order, on disk beyond ``budget`` bytes."""

    def __init__(self, budget: int = BUDGET) -> None:
        self.budget, self.held = budget, 0
        self.parts: list[list] = [[] for _ in range(SYMBOLS)]
        self.file = None

    def push(self, symbol: int, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        self.parts[symbol].append((suffixes, prefixes))
        self.held += suffixes.nbytes + prefixes.nbytes
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(part[0].astype(np.int64).tobytes() + part[1].tobytes())
                    parts[k] = (at, len(part[0]))
        self.held = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All of a symbol's queue, which is then empty."""
        suffixes, prefixes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint8)]
        for a, b in self.parts[symbol]:
            if isinstance(a, np.ndarray):
                self.held -= a.nbytes + b.nbytes
            else:
                self.file.seek(a)
                a, b = np.frombuffer(self.file.read(8 * b), dtype=np.int64), np.frombuffer(self.file.read(b), dtype=np.uint8)
            suffixes.append(a)
            prefixes.append(b)
        self.parts[symbol] = []
        return np.concatenate(suffixes), np.concatenate(prefixes)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Least:
    """Least values of ranges of an array: a table of powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For ranges that include both ends; ``MOST`` for empty ones."""
        size = last - first + 1
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        out = np.full(len(first), MOST, dtype=np.uint8)
        for k in np.unique(level[size > 0]).tolist():
            here = np.flatnonzero((level == k) & (size > 0))
            out[here] = np.minimum(self.levels[k][first[here]], self.levels[k][last[here] - (1 << k) + 1])
        return out


def _smaller(text: np.ndarray) -> np.ndarray:
    """Is a suffix smaller than its successor?  One more entry for the empty suffix, which counts as such."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    step[-1] = -1
    told = np.where(step != 0, np.arange(n), n)
    told = np.minimum.accumulate(told[::-1])[::-1]
    return np.append(step[told] > 0, True)


def _runs(text: np.ndarray) -> np.ndarray:
    """Symbols equal to the first, from each position on."""
    n = len(text)
    ends = np.where(np.append(text[1:] != text[:-1], True), np.arange(1, n + 1), n + 1)
    return np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _order_seeds(text: np.ndarray, seeds: np.ndarray, depth: int) -> np.ndarray:
    """S* suffixes in order of their first ``depth`` symbols at least."""
    n = len(text)
    # The end of the text is below all symbols; what is beyond a piece above all, as a piece ends where the text begins to rise.
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, dtype=np.uint64)])
    size = np.diff(np.append(seeds, n)) + 1  # up to and with the next seed's symbol
    names = np.zeros(len(seeds), dtype=np.int64)
    for at in range(0, int(size.max()), 6):
        live = np.flatnonzero(size > at)
        key = np.zeros(len(live), dtype=np.uint64)
        for k in range(6):
            inside = size[live] > at + k
            key = key * np.uint64(512) + np.where(inside, padded[np.minimum(seeds[live] + at + k, n)], np.uint64(511))
        found = _ranks(key)
        ranks = np.full(len(seeds), found.max() + 1, dtype=np.int64)
        ranks[live] = found
        names = _ranks(names * (ranks.max() + 1) + ranks)
    # The recursion on the names: twice as many names decide in each step, and each name stands for two symbols or more.
    reach = 1
    while reach * 2 <= depth + 2 and names.max() + 1 < len(names):
        later = np.concatenate([names[reach:] + 1, np.zeros(min(reach, len(names)), dtype=np.int64)])
        names = _ranks(names * (len(names) + 1) + later)
        reach *= 2
    return np.argsort(names, kind="stable")


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to ``depth``."""
    n = len(text)
    padded = np.concatenate([text, np.full(depth + 8, 300, dtype=text.dtype)])
    out, live = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
    words = np.zeros(n + depth, dtype=np.uint64)
    for k in range(4):
        words = words * np.uint64(512) + padded[k : k + n + depth].astype(np.uint64)
    while len(live) and out[live[0]] + 4 <= depth:
        same = words[a[live] + out[live]] == words[b[live] + out[live]]
        same &= np.maximum(a[live], b[live]) + out[live] + 4 <= n
        live = live[same]
        out[live] += 4
    for _ in range(4):
        # All that have not reached the depth: the last few symbols one by one.
        live = np.flatnonzero((out < depth) & (np.maximum(a, b) + out < n))
        live = live[padded[a[live] + out[live]] == padded[b[live] + out[live]]]
        out[live] += 1
    return np.minimum(out, depth).astype(np.uint8)


def sorted_buckets(text: np.ndarray, depth: int = 100, budget: int = BUDGET):
    """(suffixes, common prefix with the one before) for every first symbol, largest first; exact up to ``depth`` symbols.

    ``text`` has values below ``SYMBOLS`` and ends with 0.  Suffixes that agree for longer than ``depth`` come in any order.
    """
    n = len(text)
    if not n:
        return
    smaller, runs = _smaller(text), _runs(text)
    seeds = np.flatnonzero(smaller[1:] & ~smaller[:-1])[:-1] + 1  # the last is the empty suffix
    if len(seeds):
        seeds = seeds[_order_seeds(text, seeds, depth)]
        seed_common = np.zeros(len(seeds), dtype=np.uint8)
        seed_common[1:] = _common(text, seeds[:-1], seeds[1:], depth + 4)
    seed_edges = np.searchsorted(text[seeds], np.arange(SYMBOLS + 1))

    def induce(found: np.ndarray, common: np.ndarray, want: bool, carry: np.ndarray, queues: Queues) -> None:
        """Queue what stands before the scanned suffixes; ``common`` is with the suffix scanned before."""
        before = found - 1
        at = np.flatnonzero((found > 0) & (smaller[before] == want))
        least, end = Least(common), len(common) - 1
        every = int(common.min()) if len(common) else MOST
        np.minimum(carry, every, out=carry)
        if not len(at):
            return
        symbols = text[before[at]]
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        first = np.append(True, symbols[1:] != symbols[:-1])
        begin = np.where(first, 0, np.append(0, at[:-1] + 1))
        value = least.of(begin, at)
        edges = np.flatnonzero(first)
        heads = symbols[edges]
        value[edges] = np.minimum(value[edges], old_carry[heads])
        value = np.minimum(value.astype(np.int64) + 1, MOST).astype(np.uint8)
        ends = np.append(edges[1:], len(at))
        carry[heads] = least.of(at[ends - 1] + 1, np.full(len(ends), end))
        moved = before[at]
        for a, b, s in zip(edges.tolist(), ends.tolist(), heads.tolist()):
            queues.push(s, moved[a:b], value[a:b])

    larger_of, scan = Queues(budget), Queues(budget)
    try:
        # Rising: suffixes larger than their successor.
        carry = np.zeros(SYMBOLS, dtype=np.uint8)
        old_carry = carry.copy()
        induce(np.array([n]), np.zeros(1, dtype=np.uint8), False, carry, scan)
        for symbol in range(SYMBOLS):
            fresh = True
            last = None
            while True:
                found, common = scan.pop(symbol)
                if not len(found):
                    break
                common = common.copy()
                if fresh:
                    common[0] = 0
                fresh, last = False, int(found[-1])
                larger_of.push(symbol, found, common)
                old_carry = carry.copy()
                induce(found, common, False, carry, scan)
            a, b = seed_edges[symbol], seed_edges[symbol + 1]
            if a < b:
                common = seed_common[a:b].copy()
                common[0] = 0 if last is None else min(int(runs[last]), int(runs[seeds[a]]), MOST)
                old_carry = carry.copy()
                induce(seeds[a:b], common, False, carry, scan)
        # Falling: suffixes smaller than their successor, largest first.
        carry[:] = 0
        for symbol in range(SYMBOLS - 1, -1, -1):
            falling, shared, last = [], [], None
            while True:
                found, common = scan.pop(symbol)
                if not len(found):
                    break
                common = common.copy()
                if last is None:
                    common[0] = 0
                last = int(found[-1])
                falling.append(found)
                shared.append(common)
                old_carry = carry.copy()
                induce(found, common, True, carry, scan)
            found, common = larger_of.pop(symbol)
            if len(found):
                down, with_next = found[::-1], np.append(np.uint8(0), common[:0:-1])
                with_next[0] = 0 if last is None else min(int(runs[last]), int(runs[down[0]]), MOST)
                falling.append(down)
                shared.append(with_next)
                old_carry = carry.copy()
                induce(down, with_next, True, carry, scan)
            if falling:
                yield np.concatenate(falling), np.concatenate(shared)
    finally:
        scan.close()
        larger_of.close()
