"""Randomised-rotation binary codes (with correction factors) for unit vectors, and banded sign keys.

A unit vector o is turned by a random rotation P and stored as the signs of P o, that is as the unit
vector s = sign(P o) / sqrt(D), with the factor f = <s, P o>. For a query q, kept as P q in steps of a
255th of its range, <s, P q> / f is an unbiased estimate of <o, q>; it errs by more than
``CONFIDENCE`` * sqrt((1 - f^2) / f^2) / sqrt(D - 1) only with a probability that falls like
exp(-CONFIDENCE^2). At cosines near the threshold the error is smaller still, by the sine of the angle.

Bands of signs from further rotations bring vectors together: two at angle a share one sign with
probability 1 - a / pi, so ``bands`` tables of ``bits`` signs miss a pair of the threshold's angle with
probability (1 - (1 - a / pi)^bits)^bands.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

SEED = 13
#: half-width of the estimate's interval in standard deviations of a perpendicular query
CONFIDENCE = 3.0
#: probability that no band brings together a pair just at the threshold
MISSED = 1e-4
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=4)
def rotations(width: int, count: int) -> np.ndarray:
    """``count`` random rotations of ``width`` dimensions, one below the other."""
    rng = np.random.default_rng([SEED, width])
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.normal(size=(width, width)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest entry is taken out first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def banding(rows: int, cosine: float) -> tuple[int, int]:
    """(bits, bands) for the largest number of rows compared with each other: about eight unrelated rows
    share a band, and a pair at the threshold is missed by all bands with probability ``MISSED``."""
    bits = min(48, max(1, math.ceil(math.log2(max(2, rows))) - 3))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-agree)))


def band_keys(units: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """One int64 a row and band: the band's number mixed with its signs."""
    width = units.shape[1]
    turned = units @ rotations(width, 1 + math.ceil(bits * bands / width))[width:width + bits * bands].T
    signs = (turned >= 0).reshape(len(units), bands, bits)
    packed = (signs.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(2, dtype=np.uint64)
    mixed = (packed ^ (np.arange(bands, dtype=np.uint64) * _MIX)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code: packed signs, factor, query: P q in int8 steps, step)."""
    width = units.shape[1]
    turned = units @ rotations(width, 1)[:width].T
    signs = turned >= 0
    factor = np.abs(turned).sum(1) / math.sqrt(width)
    step = np.abs(turned).max(1) / 127
    query = np.rint(turned / step[:, None]).astype(np.int8)
    return np.packbits(signs, axis=1), factor.astype(np.float32), query, step.astype(np.float32)


def upper_cosines(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Upper end of the confidence interval of the cosine of each code with the query in its row."""
    width = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=width).astype(np.int8) * 2 - 1
    dots = np.einsum("ij,ij->i", signs, queries, dtype=np.int32, casting="unsafe").astype(np.float64)
    estimate = dots * steps / (math.sqrt(width) * factors)
    spread = CONFIDENCE * np.sqrt(np.maximum(0.0, 1 - factors.astype(np.float64) ** 2)) / factors / math.sqrt(max(1, width - 1))
    rounding = steps * (0.5 * math.sqrt(width) * 1.001) / factors
    return estimate + spread + rounding
