"""Suffix sorting by induction over disk-backed priority queues.

The suffixes that start where the text turns from falling to rising (LMS) are sorted first: their
substrings are sorted by one induction, named, and the string of names is sorted by recursion. From
their order all suffixes follow by two sweeps. Each sweep takes the suffix tuples (symbol, position)
from a monotone priority queue: least symbol first (then greatest first), equal symbols in the order
they came; every tuple taken puts the suffix one position before it into the queue. Queues keep
their tuples in small buffers per symbol and move them to an unnamed file beyond a memory limit, so
the sorted order never has to fit in memory; the text and its types can be memory-mapped.

All tuples of one symbol that are in the queue together are taken as one wave, and wide waves
(bytes at the top level) are handled with numpy.
"""

from __future__ import annotations

import heapq
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np

QUEUE_TUPLES = 4_000_000
WIDE = 48


class DiskQueue:
    """Priority queue of (symbol, position): lists of positions per symbol, first in first out."""

    def __init__(self, limit: int = QUEUE_TUPLES, descending: bool = False):
        self.limit, self.sign = limit, -1 if descending else 1
        self.buffers: dict[int, array] = {}
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.heap: list[int] = []
        self.file = None
        self.held = 0

    def buffer(self, symbol: int) -> array:
        """The symbol's open buffer, for appending; ``grew`` has to be told how much."""
        buffer = self.buffers.get(symbol)
        if buffer is None:
            buffer = self.buffers[symbol] = array("q")
            if symbol not in self.runs:
                heapq.heappush(self.heap, self.sign * symbol)
        return buffer

    def grew(self, n: int) -> None:
        self.held += n
        if self.held > self.limit:
            self._spill()

    def push_many(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
        for s, a, b in zip(symbols[first].tolist(), first.tolist(), [*first[1:].tolist(), len(symbols)], strict=True):
            self.buffer(s).frombytes(positions[a:b].tobytes())
        self.grew(len(positions))

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, buffer in self.buffers.items():
            self.runs.setdefault(symbol, []).append((self.file.tell(), len(buffer)))
            self.file.write(buffer)
        self.buffers.clear()
        self.held = 0

    def next_symbol(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def take(self, symbol: int) -> array:
        """All positions of ``symbol`` that are in the queue, in order; it must be the next one."""
        heapq.heappop(self.heap)
        buffer = self.buffers.pop(symbol, None)
        if buffer is not None:
            self.held -= len(buffer)
        if symbol not in self.runs:
            return buffer
        whole = array("q")
        for at, n in self.runs.pop(symbol):
            self.file.seek(at)
            whole.frombytes(self.file.read(8 * n))
        if buffer is not None:
            whole.extend(buffer)
        return whole


def rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is less than the next one (S type); the last symbol is the sentinel."""
    n = len(text)
    out = np.empty(n, np.uint8)
    out[n - 1] = 1
    step, end = 1 << 20, n - 1
    while end > 0:  # blocks from the right; the type carries over runs of equal symbols
        start = max(0, end - step)
        here, after = text[start:end], text[start + 1:end + 1]
        known = np.flatnonzero(here != after)
        less = np.concatenate(((here < after)[known], [out[end]]))
        out[start:end] = less[np.searchsorted(known, np.arange(end - start))]
        end = start
    return out


def _sweep(text: np.ndarray, types: np.ndarray, kind: int, sources: DiskQueue, found: list[DiskQueue], queue: DiskQueue) -> None:
    """Induces all suffixes of type ``kind`` from ``sources`` into each of ``found``; ``queue`` sets
    the direction. At one symbol, induced suffixes come before the sources."""
    symbol_at, type_at, buffers = memoryview(text), memoryview(types), queue.buffers
    sign, heap, others = queue.sign, queue.heap, sources.heap

    def induce(wave: array) -> None:
        if len(wave) >= WIDE:
            wave = np.frombuffer(wave, np.int64)
            before = wave[wave > 0] - 1
            before = before[types[before] == kind]
            if len(before):
                queue.push_many(text[before], before)
            return
        n = 0
        for p in wave:
            if p and type_at[p - 1] == kind:
                buffer = buffers.get(symbol_at[p - 1])
                (queue.buffer(symbol_at[p - 1]) if buffer is None else buffer).append(p - 1)
                n += 1
        queue.grew(n)

    while heap or others:  # both heaps hold sign * symbol
        if heap and (not others or heap[0] <= others[0]):
            symbol = sign * heap[0]
            wave = queue.take(symbol)
            for keep in found:
                keep.buffer(symbol).extend(wave)
                keep.grew(len(wave))
            induce(wave)
        else:
            wave = sources.take(sign * others[0])
            if sign < 0:
                wave.reverse()
            induce(wave)


def _induce(text: np.ndarray, types: np.ndarray, seeds: DiskQueue, limit: int) -> tuple[DiskQueue, DiskQueue]:
    """Falling suffixes (ascending) and rising suffixes (each symbol's list descending) by symbol."""
    falling, again, up = DiskQueue(limit), DiskQueue(limit, descending=True), DiskQueue(limit)
    _sweep(text, types, 0, seeds, [falling, again], DiskQueue(limit))
    _sweep(text, types, 1, again, [up], DiskQueue(limit, descending=True))
    return falling, up


def _in_order(sentinel: int, falling: DiskQueue, rising_found: DiskQueue) -> Iterator[np.ndarray]:
    yield np.array([sentinel])  # nothing induces it
    while True:
        a, b = falling.next_symbol(), rising_found.next_symbol()
        if a is None and b is None:
            return
        if b is None or a is not None and a <= b:
            yield np.frombuffer(falling.take(a), np.int64)
        else:
            yield np.frombuffer(rising_found.take(b), np.int64)[::-1]


def _gathered(blocks: Iterator[np.ndarray], size: int = 1 << 16) -> Iterator[np.ndarray]:
    held, n = [], 0
    for block in blocks:
        held.append(block)
        n += len(block)
        if n >= size:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _names(text: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of the substrings (start, length) in sorted ``order``: equal ones share a name."""
    fresh = np.ones(len(order), bool)
    a, b = order[:-1], order[1:]
    open_pairs = np.flatnonzero(length[:-1] == length[1:])
    at = 0
    while len(open_pairs):
        alike = text[a[open_pairs] + at] == text[b[open_pairs] + at]
        open_pairs = open_pairs[alike]
        at += 1
        done = length[open_pairs] <= at
        fresh[open_pairs[done] + 1] = False
        open_pairs = open_pairs[~done]
    return np.cumsum(fresh) - 1


def suffix_order(text: np.ndarray, limit: int = QUEUE_TUPLES) -> Iterator[np.ndarray]:
    """Blocks of suffix positions of ``text`` (int32, last symbol unique and least) in suffix order."""
    n = len(text)
    if n < 2:
        yield np.arange(n)
        return
    types = rising(text)
    lms = np.flatnonzero((types[1:] == 1) & (types[:-1] == 0)) + 1
    seeds = DiskQueue(limit)
    seeds.push_many(text[lms], lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = np.concatenate([b[is_lms[b]] for b in _gathered(_in_order(n - 1, *_induce(text, types, seeds, limit)))])
    rank = np.empty(n, np.int64)
    rank[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, 1)
    names = _names(text, order, length[rank[order]])
    seeds = DiskQueue(limit)
    if names[-1] + 1 == len(lms):
        seeds.push_many(text[order], order)
    else:
        reduced = np.empty(len(lms), np.int32)
        reduced[rank[order]] = names
        del is_lms, rank, order, names
        for block in _gathered(suffix_order(reduced, limit)):
            seeds.push_many(text[lms[block]], lms[block])
    yield from _in_order(n - 1, *_induce(text, types, seeds, limit))
