"""Hashes of all words of many texts at once, without making the words.

Words are runs of bytes that are no separators. With random constants per byte, a word's hash is
the difference of two prefix sums of ``constant[byte] * base^position``, freed of its position by
the inverse power; all in 64-bit arithmetic, then mixed with the length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = b" \t\n\x0b\x0c\r"
#: ASCII characters that are neither letters nor digits
PUNCTUATION = bytes(i for i in range(128) if not chr(i).isalnum())
CHUNK_BYTES = 1 << 18
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, CHUNK_BYTES + 1), np.uint64(base))
        table[0] = 1
        have = _powers[base] = np.multiply.accumulate(table)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice of ``data`` (bytes)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts]
    return mix(h + (ends - starts).astype(np.uint64))


class WordHasher:
    """Words between ``separators`` (bytes), A-Z lower-cased."""

    def __init__(self, separators: bytes = _SPACES):
        self.separators = separators
        self.folded = np.frombuffer(bytes(range(256)).lower(), np.uint8)
        self.inside = np.ones(256, np.int8)
        self.inside[list(separators)] = 0

    def words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words of ``raw``."""
        data = np.frombuffer(raw, np.uint8)
        edge = np.diff(self.inside[data], prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return slice_hashes(self.folded[data], starts, ends), starts, ends

    def _long(self, raw: bytes, see: Callable | None = None) -> np.ndarray:
        """Hashes of one long text, in parts cut at separators."""
        out, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + CHUNK_BYTES)
            while end < len(raw) and raw[end] not in self.separators:
                end += 1
            out.append(self._seen(raw[at:end], see)[0])
            at = end
        return np.concatenate(out)

    def _seen(self, raw: bytes, see: Callable | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.words(raw)
        if see is not None:
            see(raw, *found)
        return found

    def hashes(self, texts: list[str | None], see: Callable | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, word hashes, bounds) for bunches of consecutive texts; text k
        of a bunch has the hashes bounds[k]:bounds[k + 1]. ``see`` is called with the bytes,
        hashes, starts and ends of every part."""
        held, first, size = [], 0, 0

        def settle() -> tuple[int, np.ndarray, np.ndarray]:
            h, starts, _ = self._seen(b"\n".join(held) + b"\n", see)
            begins = np.concatenate(([0], np.cumsum([len(r) + 1 for r in held])))
            return first, h, np.searchsorted(starts, begins)

        for i, text in enumerate(texts):
            raw = text.encode() if text else b""
            if len(raw) > CHUNK_BYTES:
                if held:
                    yield settle()
                h = self._long(raw, see)
                yield i, h, np.array([0, len(h)])
                held, first, size = [], i + 1, 0
                continue
            held.append(raw)
            size += len(raw)
            if size >= CHUNK_BYTES:
                yield settle()
                held, first, size = [], i + 1, 0
        if held:
            yield settle()

    def of(self, words: list[str]) -> np.ndarray:
        """Hashes of single words."""
        return self.words("\n".join(words).encode() + b"\n")[0]
