"""Elias-Fano sequences with vectorised queries, and files of arrays that are memory-mapped."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

_BLOCK = 512
#: position of the (k+1)-th set bit of a byte: rule-made table
_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], np.int64)


class EliasFano:
    """A non-decreasing sequence of n values below a universe in about 2 + log2(universe / n) bits
    each: packed low bits, and the high bits in unary as one bit string with a sample of its ones
    every 512 bits."""

    FIELDS = ("shape", "low", "high", "ones")

    def __init__(self, fields: dict[str, np.ndarray]):
        self.n, self.bits = (int(v) for v in fields["shape"])
        self.low, self.high, self.ones = fields["low"], fields["high"], fields["ones"]
        self.fields = fields

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (universe // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        packed = []
        step = 64 * 1024  # a multiple of 64 values fills whole words
        for i in range(0, n, step):
            part = values[i:i + step]
            spread = np.zeros((-(-len(part) // 64) * 64, bits), np.uint8)
            for j in range(bits):
                spread[:len(part), j] = (part >> np.uint64(j)) & np.uint64(1)
            packed.append(np.packbits(spread.ravel(), bitorder="little"))
        low = np.concatenate([*packed, np.zeros(16, np.uint8)]).view(np.uint64) if bits else np.zeros(2, np.uint64)
        top = (values >> np.uint64(bits)).astype(np.int64)
        size = n + (int(top[-1]) if n else 0) + 2
        flags = np.zeros(-(-size // _BLOCK) * _BLOCK, np.uint8)
        flags[top + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        per_block = np.bitwise_count(high).reshape(-1, _BLOCK // 64).sum(1, dtype=np.int64)
        return cls({"shape": np.array([n, bits]), "low": low, "high": high, "ones": np.concatenate(([0], np.cumsum(per_block)))})

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.bits) - 1)

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the one (or zero) with so many before it."""
        before = self.ones if ones else np.arange(len(self.ones)) * _BLOCK - self.ones
        block = np.searchsorted(before, rank, side="right") - 1
        left = rank - before[block]
        words = self.high[block[:, None] * 8 + np.arange(8)]
        if not ones:
            words = ~words
        for width, kind in ((64, np.uint64), (8, np.uint8)):  # the word, then the byte in it
            sums = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
            at = (sums <= left[:, None]).sum(1)
            at = np.minimum(at, 7)
            rows = np.arange(len(rank))
            left = left - np.where(at > 0, sums[rows, at - 1], 0)
            chosen = words[rows, at]
            if width == 64:
                word, words = at, chosen[:, None].view(np.uint8)
            else:
                byte = at
        return block * _BLOCK + word * 64 + byte * 8 + _SELECT[chosen, left]

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def find(self, values: np.ndarray, ranges: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Index of each value (the first, if repeated), -1 where it is not in the sequence, or not
        from begin to before end of its own one of ``ranges`` (begins, ends), where they are given."""
        out = np.full(len(values), -1)
        if not self.n or not len(values):
            return out
        values = values.astype(np.uint64)
        top = (values >> np.uint64(self.bits)).astype(np.int64)
        low = values & np.uint64((1 << self.bits) - 1)
        zeros = len(self.high) * 64 - self.n
        at = np.flatnonzero((top >= 0) & (top < zeros))  # values below the base have wrapped around
        top, low = top[at], low[at]
        end = self._select(top, False) - top  # values in the bucket and those before
        start = np.zeros(len(at), np.int64)
        later = top > 0
        start[later] = self._select(top[later] - 1, False) - (top[later] - 1)
        if ranges is not None:  # the successor is looked for in the asked range alone
            start, end = np.maximum(start, ranges[0][at]), np.minimum(end, ranges[1][at])
        last = end.copy()
        open_ones = np.flatnonzero(start < end)
        while len(open_ones):  # successor search in the bucket, most of which hold one or two values
            middle = (start[open_ones] + end[open_ones]) >> 1
            less = self._low(middle) < low[open_ones]
            start[open_ones[less]] = middle[less] + 1
            end[open_ones[~less]] = middle[~less]
            open_ones = open_ones[start[open_ones] < end[open_ones]]
        there = np.flatnonzero(start < last)
        there = there[self._low(start[there]) == low[there]]
        out[at[there]] = start[there]
        return out


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays, put in place at once, so that a repeated task leaves the same file."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    raw = json.dumps(head).encode()
    raw += b" " * (-(len(raw) + 8) % 8)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(len(raw).to_bytes(8, "little") + raw)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * (-a.nbytes % 8))
    os.replace(own, path)


def load(path: str) -> dict[str, np.ndarray]:
    whole = np.memmap(path, np.uint8, "r").view(np.ndarray)
    size = int.from_bytes(whole[:8].tobytes(), "little")
    head = json.loads(whole[8:8 + size].tobytes())
    start = 8 + size
    return {name: whole[start + at:start + at + np.dtype(kind).itemsize * n].view(kind) for name, (kind, n, at) in head.items()}


def fields(name: str, sequence: EliasFano) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in sequence.fields.items()}


def sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano({k: arrays[f"{name}.{k}"] for k in EliasFano.FIELDS})
