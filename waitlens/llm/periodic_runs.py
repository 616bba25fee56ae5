"""Periodic runs of words, found as maximal pairs of an LCP-interval tree.

A run is a stretch of consecutive words whose smallest period is q, at least ``min_exponent`` periods
and ``min_length`` words long, that no neighbouring word extends. A run of period q that starts at i is
the maximal pair (i, i + q): equal words from both places on, as far as the run goes, and different
words before and behind. So the runs are read off the maximal pairs (i, j) whose common length l is at
least (min_exponent - 1) * (j - i) and at least min_length - (j - i); nothing has to be extended.

Maximal pairs come from the tree of LCP intervals over all words of many documents, walked bottom-up.
Every interval keeps its places in order, each with the class of the word to its left; when a child is
merged, places of the child are paired with places of the other children whose left class differs.
Only neighbouring places need be paired: if a third occurrence lay between i and i + q, the common part
(at least 2q long) would have a period under q, and so would the run. Intervals shorter than the
shortest common part that a run can have, and those whose places lie too far apart, are passed over.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: words sorted together; a longer document is sorted alone
BATCH_WORDS = 1 << 17


def prefix_labels(words: np.ndarray, docs: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """labels[k][i] numbers the first 2^k words from place i: equal numbers mean equal words in one
    document, and numbers are in the order of the words' ids. The last one tells all places apart;
    ``ends`` is the end of each place's document. Only places not told apart yet are sorted again."""
    n = len(words)
    key = docs * (int(words.max(initial=0)) + 1) + words
    active = np.argsort(key, kind="stable")
    key = key[active]
    old = np.zeros(n, np.int64)
    label, labels, h = np.zeros(n, np.int64), [], 1
    while len(active):
        fresh = np.ones(len(active), bool)
        fresh[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        first = np.ones(len(active), bool)  # first place of a group of the round before
        first[1:] = old[1:] != old[:-1]
        base = np.flatnonzero(first)[np.cumsum(first) - 1]
        label = label.copy()
        label[active] = old + starts[group] - base
        labels.append(label.astype(np.int32) if n < 1 << 31 else label)
        sizes = np.diff(np.append(starts, len(active)))
        active = active[sizes[group] > 1]
        ahead = active + h
        second = np.where(ahead < ends[active], label[np.minimum(ahead, n - 1)] + 1, 0)
        key = label[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = label[active]
        h *= 2
    return labels


def _merge(large: list[int], small: list[int], common: int, left: list[int], rule: tuple[int, int], found: dict) -> list[int]:
    """Both ordered lists as one; runs between their places go to ``found``: (start, length) -> period."""
    if len(small) > len(large):
        large, small = small, large
    least, turns = rule
    far = common // turns
    for x in small:
        k = bisect_left(large, x)
        for y in large[max(k - 1, 0):k + 1]:
            q = abs(x - y)
            if q <= far and q + common >= least and left[x] != left[y]:
                spot = (min(x, y), q + common)
                if q < found.get(spot, q + 1):
                    found[spot] = q
    for x in small:  # only now, so that places of one child never meet as neighbours
        insort(large, x)
    return large


def _walk(places: list[int], lcp: list[int], left: list[int], rule: tuple[int, int], found: dict) -> None:
    """Bottom-up over the LCP intervals of suffixes in order; lcp[k] belongs to places k - 1 and k."""
    open_intervals: list[list] = []
    for k in range(1, len(places) + 1):
        node, common = [places[k - 1]], lcp[k] if k < len(places) else -1
        while open_intervals and open_intervals[-1][0] > common:
            depth, below = open_intervals.pop()
            node = _merge(below, node, depth, left, rule, found)
        if open_intervals and open_intervals[-1][0] == common:
            open_intervals[-1][1] = _merge(open_intervals[-1][1], node, common, left, rule, found)
        else:
            open_intervals.append([common, node])


def find_runs(documents: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, by start, then period; a document is an
    array of word ids."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    sizes = np.array([len(d) for d in documents], np.int64)
    if not sizes.sum():
        return out
    words = np.concatenate(documents).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    docs = np.repeat(np.arange(len(documents)), sizes)
    ends = bounds[1:][docs]
    labels = prefix_labels(words, docs, ends)
    turns = min_exponent - 1
    shortest = min(max(min_length - q, turns * q) for q in range(1, max(min_length, 1) + 1))
    deep = shortest.bit_length() - 1  # places that share 2^deep words with another one
    if len(labels) <= deep:
        return out
    order = np.argsort(labels[-1], kind="stable")
    shared = labels[deep][order]
    same = shared[1:] == shared[:-1]
    some = np.append(same, False) | np.append(False, same)
    order, shared = order[some], shared[some]
    if not len(order):
        return out
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(labels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < ends[a]) & (y < ends[b])
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        lcp += (inside & (labels[level][x] == labels[level][y])).astype(np.int64) << level
    lcp[shared[1:] != shared[:-1]] = 0
    block = np.concatenate(([0], np.cumsum(lcp < shortest)))
    by_place = np.lexsort((order, block))
    gaps = np.diff(order[by_place])
    close = np.full(block[-1] + 1, np.iinfo(np.int64).max)
    longest = np.zeros(block[-1] + 1, np.int64)
    inner = lcp >= shortest
    np.minimum.at(close, block[1:][inner], gaps[inner])  # blocks are contiguous in both orders
    np.maximum.at(longest, block[1:][inner], lcp[inner])
    worth = np.flatnonzero((longest > 0) & (close <= longest // turns))
    if not len(worth):
        return out
    left = np.concatenate(([-1], words[:-1]))
    left[bounds[:-1][sizes > 0]] = -1
    left, found = left.tolist(), {}
    firsts, lasts = np.searchsorted(block, worth, "left"), np.searchsorted(block, worth, "right")
    for lo, hi in zip(firsts.tolist(), lasts.tolist(), strict=True):
        _walk(order[lo:hi].tolist(), [0, *lcp[lo:hi - 1].tolist()], left, (min_length, turns), found)
    for (start, length), period in found.items():
        doc = int(docs[start])
        out[doc].append((start - int(bounds[doc]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that any run contains after its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def periodic_runs(documents: DataFrame, *, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period) and collapsed (the
    text's words joined by one space, every run cut to its first period) of whole texts. Words lie
    between the six ASCII white-space characters and are compared as they are. One pass over the rows,
    no shuffle: each row is judged by itself, whatever its doc_id.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows with null or repeated
    doc_id each give a row of their own. Only ``doc_id`` and ``text`` are read, so other columns may have
    any names; a table without rows gives none. A text longer than ``BATCH_WORDS`` words is sorted
    alone and needs about 100 bytes of memory a word. ``min_exponent`` has to be at least 3."""
    if min_exponent < 3 or min_length < 1:
        raise ValueError("runs need an exponent of at least 3 and a length of at least 1")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[bytes]] = []
            ids: list[np.ndarray] = []
            runs: list[list[tuple[int, int, int]]] = []
            texts, counts, known, size = [], [], {}, 0

            def settle() -> None:
                nonlocal held, ids, known, size
                got = find_runs(ids, min_length, min_exponent)
                runs.extend(got)
                texts.extend(collapse(w, r) for w, r in zip(held, got, strict=True))
                held, ids, known, size = [], [], {}, 0

            for text in batch.column(1).to_pylist():
                words = text.encode().split() if text else []
                if size and size + len(words) > BATCH_WORDS:
                    settle()
                held.append(words)
                counts.append(len(words))
                ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
                size += len(words)
            settle()
            yield _batch(batch, counts, texts, runs)

    def _batch(batch: pa.RecordBatch, counts: list[int], texts: list[bytes], runs: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
        flat = [r for some in runs for r in some]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
        parts = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        structs = pa.StructArray.from_arrays(parts, ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array([t.decode() for t in texts], pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
