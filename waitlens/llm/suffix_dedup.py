"""Suffix-array dedup: removes every byte covered by a 100-byte string that also starts earlier
(in a smaller doc_id, or earlier in the same document). Exact.

Sorting all suffixes of the corpus in one place is never needed, because equal strings can be
brought together by content. The anchor of a 100-byte string is its k-gram of least hash (leftmost
on ties), so equal strings have equal anchors at equal offsets:

1. runs: consecutive strings of a document with one anchor form a run; its text is a piece. Pieces
   are told apart by anchor and a second 64-bit hash. Each task settles the pieces that are equal
   to an earlier one of its own (all their strings start earlier), so that a passage in a third of
   all documents costs a row per task, not per copy, and sends one row of numbers for each other;
2. the anchor's shard settles the equal pieces of different tasks in the same way. An anchor with
   one piece only is done; of the others each different piece is requested once;
3. requested pieces are cut from the texts and meet in their anchor's shard. There a piece is
   trimmed to the longest text around the anchor that it shares with any other (nothing beyond can
   match), and dropped if that is under 100 bytes;
4. what is left is suffix-sorted by external induced sorting (``induced``); neighbours with a common
   prefix of 100 bytes are one class, and all but its first occurrence are repeats. The sorter's
   queues go to disk beyond a memory limit and its text is memory-mapped beyond another, so a
   shard may be far larger than memory;
5. the different pieces of an anchor that exceed the sorter's limit (a passage shared by many
   documents, at its edges) are not brought together: their 100-byte strings are told apart by the
   anchor and a hash of their own, settled in each task as in 1 and dealt to shards by that hash.

Common-prefix values are taken from neighbours in the sorted order, up to 100 bytes, instead of
being carried through the queues: the result only needs to know whether 100 bytes agree.

Defined cases: a null text is empty; texts under 100 bytes lose nothing; rows sharing a doc_id are
ordered by the SHA-256 of their text, and a repeated row (same doc_id and text) is one document, so
its copies come out alike; rows with a null doc_id come after all others; an empty table gives no
rows. ``remove_repeats`` returns text: an incomplete UTF-8 character at a cut is dropped.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import cut, numbered, packed, shuffle_partitions, unpacked
from waitlens.llm.wordhash import slice_hashes
from waitlens.llm.induced import _gathered, suffix_order

LENGTH = 100
GRAM = 24
SEGMENT_BYTES = 1 << 18
#: pieces sorted together; the strings of an anchor that has more are settled by hash
SORT_BYTES = 4 << 20
#: longer sorted texts are memory-mapped
MAPPED_BYTES = 32 << 20
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes at every position: polynomial by doubling, then mixed."""
    def power(n: int) -> np.uint64:
        return np.uint64(pow(_BASE, n, 1 << 64))

    block, width = data.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    while True:
        if size & width:
            if out is None:
                out, done = block, width
            else:  # the block's grams follow those so far
                n = len(data) - done - width + 1
                out, done = out[:n] * power(width) + block[done:done + n], done + width
        if 2 * width > size:
            break
        n = len(block) - width
        block, width = block[:n] * power(width) + block[width:], 2 * width
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[:-step], out[step:]), have + step
    return out


def find_runs(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs in segments laid one after another: anchor hash, piece hash, first string, and shape
    (number of strings, and the anchor's place from the first string on times 65536)."""
    hashes = gram_hashes(data, gram)
    ranked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (sliding_min(ranked, length - gram + 1) & _LOW).astype(np.int64)
    inside = np.concatenate([np.arange(b, b + n - length + 1) for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)])
    own = anchors[inside]
    at = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (np.diff(inside) > 1))))
    first, counts = inside[at], np.diff(np.append(at, len(inside)))
    return hashes[own[at]], slice_hashes(data, first, first + counts - 1 + length), first, counts + ((own[at] - first) << 16)


def _runs_of(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per bunch of segments: anchor hashes, piece hashes, keys, first strings, shapes."""
    held, size = [], 0

    def settle() -> tuple[np.ndarray, ...]:
        sizes = np.array([len(s) for _, _, s in held])
        begins = np.cumsum(sizes) - sizes
        h, piece, first, shape = find_runs(np.frombuffer(b"".join(s for _, _, s in held), np.uint8), begins, sizes, length, gram)
        at = np.searchsorted(begins, first, side="right") - 1
        keys, offsets = np.array([k for k, _, _ in held], np.int64), np.array([o for _, o, _ in held], np.int64)
        return h, piece, keys[at], first - begins[at] + offsets[at], shape.astype(np.uint32)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (text or "").encode()
            for start in range(0, len(raw) - length + 1, SEGMENT_BYTES):
                held.append((key, start, raw[start:start + SEGMENT_BYTES + length - 1]))
                size += len(held[-1][2])
                if size >= SEGMENT_BYTES:
                    yield settle()
                    held, size = [], 0
    if held:
        yield settle()


def _blocks(group: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(group, columns as bytes) for each value of ``group``."""
    order = np.argsort(group, kind="stable")
    group, columns = group[order], [c[order] for c in columns]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(group)], strict=True):
        yield int(group[a]), *(c[a:b].tobytes() for c in columns)


def _earliest(h: np.ndarray, piece: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by anchor, piece and place, and in it: which rows are the first of their piece."""
    order = np.lexsort((starts, keys, piece, h))
    h, piece = h[order], piece[order]
    return order, np.concatenate(([True], (h[1:] != h[:-1]) | (piece[1:] != piece[:-1])))


#: strings of such anchors that a task holds at a time
HELD_STRINGS = 1_000_000
RUNS = "shard int, settled boolean, hashes binary, pieces binary, keys binary, starts binary, shapes binary"


def run_rows(documents: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """Blocks of RUNS: first occurrences in a task on their way to the anchor's shard, and settled
    runs on their way to any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = list(_runs_of(batches, length, gram))
        if not every:
            return
        columns = [np.concatenate(c) for c in zip(*every, strict=True)]
        del every
        order, first = _earliest(*columns[:4])
        h, piece, keys, starts, shapes = (c[order] for c in columns)
        out = [(s, False, *c) for s, *c in _blocks((h[first] % np.uint64(shards)).astype(np.int64), *(c[first] for c in (h, piece, keys, starts, shapes)))]
        if not first.all():
            out += [(s, True, b"", b"", *c) for s, *c in _blocks(keys[~first] % shards, *(c[~first] for c in (keys, starts, shapes)))]
        kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                         ["shard", "settled", "hashes", "pieces", "keys", "starts", "shapes"])

    return documents.mapInArrow(run, RUNS)


def _joined(column: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def told_apart(rows: DataFrame, length: int, sort_bytes: int) -> DataFrame:
    """Per document and shard: _key, hashes, starts, shapes, hot. Without hashes: settled runs; else runs
    whose piece is requested because its anchor has others too (hot: more than ``sort_bytes`` of them)."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for settled, own in pdf.groupby("settled"):
            keys, starts, shapes = _joined(own["keys"], np.int64), _joined(own["starts"], np.int64), _joined(own["shapes"], np.uint32)
            if settled:
                out += [(k, None, *c, False) for k, *c in _blocks(keys, starts, shapes)]
                continue
            h, piece = _joined(own["hashes"], np.uint64), _joined(own["pieces"], np.uint64)
            order, first = _earliest(h, piece, keys, starts)
            h, keys, starts, shapes = h[order], keys[order], starts[order], shapes[order]
            if not first.all():
                out += [(k, None, *c, False) for k, *c in _blocks(keys[~first], starts[~first], shapes[~first])]
            h, keys, starts, shapes = h[first], keys[first], starts[first], shapes[first]
            several = np.zeros(len(h) + 1, bool)
            several[1:-1] = h[1:] == h[:-1]
            several = several[1:] | several[:-1]
            if not several.any():
                continue
            at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            total = np.add.reduceat((shapes & 0xFFFF).astype(np.int64) - 1 + length, at)
            large = np.repeat(total > sort_bytes, np.diff(np.append(at, len(h))))
            for hot in (False, True):
                use = several & (large == hot)
                if use.any():
                    out += [(*c, hot) for c in _blocks(keys[use], h[use], starts[use], shapes[use])]
        return pd.DataFrame(out, columns=["_key", "hashes", "starts", "shapes", "hot"])

    return rows.groupBy("shard").applyInPandas(shard, "_key long, hashes binary, starts binary, shapes binary, hot boolean")


PIECES = "shard int, hash long, _key long, start long, shape long, piece binary"


def _with_runs(documents: DataFrame, requests: DataFrame) -> DataFrame:
    wanted = requests.groupBy("_key").agg(F.collect_list(F.struct("hashes", "starts", "shapes")).alias("runs"))
    return documents.join(wanted, "_key").select("_key", "text", "runs")


def requested_pieces(documents: DataFrame, requests: DataFrame, shards: int, length: int) -> DataFrame:
    """Rows of PIECES, on their way to their anchor's shard."""
    schema = pa.schema([("shard", pa.int32()), ("hash", pa.int64()), ("_key", pa.int64()), ("start", pa.int64()), ("shape", pa.int64()), ("piece", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for key, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for block in own:
                    for h, start, shape in zip(np.frombuffer(block["hashes"], np.uint64).tolist(), np.frombuffer(block["starts"], np.int64).tolist(),
                                               np.frombuffer(block["shapes"], np.uint32).tolist(), strict=True):
                        piece = raw[start:start + (shape & 0xFFFF) - 1 + length]
                        out.append((h % shards, h - (1 << 64) if h >> 63 else h, key, start, shape, piece))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return _with_runs(documents, requests).mapInArrow(run, PIECES)


STRINGS = "shard int, hashes binary, strings binary, keys binary, starts binary, ends binary"
RANGES = "_key long, starts binary, ends binary"


def _ranges(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Rows of RANGES: the merged ranges of each key."""
    for key, a, b in _blocks(keys, starts, ends):
        a, b = _merge(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64))
        yield key, a.tobytes(), b.tobytes()


def hot_ranges(documents: DataFrame, requests: DataFrame, shards: int, length: int) -> DataFrame:
    """Rows of RANGES among the requested pieces, string by string: each string goes to the shard of
    its hash unless an earlier one of the same task has settled it."""
    schema = pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in ("hashes", "strings", "keys", "starts", "ends"))])

    def settle(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        order, first = _earliest(*columns)
        h, string, keys, starts = (c[order] for c in columns)
        out = [(s, *c, b"") for s, *c in _blocks((string[first] % np.uint64(shards)).astype(np.int64), *(c[first] for c in (h, string, keys, starts)))]
        for key, a, b in _ranges(keys[~first], starts[~first], starts[~first] + length):
            out.append((key % shards, b"", b"", np.full(len(a) // 8, key, np.int64).tobytes(), a, b))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            for key, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                for block in own:
                    counts = (np.frombuffer(block["shapes"], np.uint32) & 0xFFFF).astype(np.int64)
                    starts = np.repeat(np.frombuffer(block["starts"], np.int64), counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    begin = int(starts.min())
                    near = raw[begin:int(starts.max()) + length]
                    held.append((np.repeat(np.frombuffer(block["hashes"], np.uint64), counts), slice_hashes(near, starts - begin, starts - begin + length),
                                 np.full(len(starts), key, np.int64), starts))
                    size += len(starts)
                    if size >= HELD_STRINGS:
                        yield settle(held)
                        held, size = [], 0
        if held:
            yield settle(held)

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        settled = pdf["hashes"].str.len() == 0
        done, own = pdf[settled], pdf[~settled]
        order, first = _earliest(_joined(own["hashes"], np.uint64), _joined(own["strings"], np.uint64), keys := _joined(own["keys"], np.int64),
                                 starts := _joined(own["starts"], np.int64)) if len(own) else (np.zeros(0, np.int64), np.zeros(0, bool))
        again = order[~first]
        keys, starts = (keys[again], starts[again]) if len(own) else (again, again)
        found = _ranges(*(np.concatenate([_joined(done[c], np.int64), x]) for c, x in (("keys", keys), ("starts", starts), ("ends", starts + length))))
        return pd.DataFrame(list(found) if len(done) or len(again) else [], columns=["_key", "starts", "ends"])

    return _with_runs(documents, requests).mapInArrow(run, STRINGS).groupBy("shard").applyInPandas(shard, RANGES)


def repeated_strings(texts: list[bytes], counts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(piece, offset, class) of the strings that start in the first ``counts`` positions of each
    text, from the suffix order of all texts: equal strings share a class."""
    sizes = np.array([len(t) + 1 for t in texts])
    begins = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"\0".join(texts) + b"\0" * (length + 1), np.uint8)
    n = int(sizes.sum()) + 1
    if n > MAPPED_BYTES:
        symbols = np.memmap(tempfile.TemporaryFile(), np.int32, "w+", shape=n)
    else:
        symbols = np.empty(n, np.int32)
    symbols[:] = flat[:n]
    symbols += 2
    symbols[begins + sizes - 1] = 1  # between texts
    symbols[n - 1] = 0
    starting = np.zeros(n + 1, np.int8)
    np.add.at(starting, begins, 1)
    np.add.at(starting, begins + counts, -1)
    starting = np.cumsum(starting[:n], dtype=np.int8).astype(bool)
    strings = sliding_window_view(flat, length)
    last, number = None, -1
    for block in _gathered(suffix_order(symbols)):
        block = block[starting[block]]
        if not len(block):
            continue
        seen = strings[block]
        fresh = np.ones(len(block), bool)
        fresh[1:] = (seen[1:] != seen[:-1]).any(1)
        fresh[0] = last is None or bool((seen[0] != last).any())
        classes = np.cumsum(fresh) + number
        last, number = seen[-1], int(classes[-1])
        at = np.searchsorted(begins, block, side="right") - 1
        yield at, block - begins[at], classes


def _shared_lengths(groups: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Longest common prefix of each text with any other of its group."""
    order = sorted(range(len(texts)), key=lambda i: (groups[i], texts[i]))
    sizes = np.array([len(texts[i]) for i in order])
    width = max(1, int(sizes.max()))
    rows = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in order), np.uint8).reshape(-1, width)
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    own = groups[order]
    common[own[1:] != own[:-1]] = 0
    best = np.zeros(len(order), np.int64)
    best[1:] = common
    best[:-1] = np.maximum(best[:-1], common)
    out = np.empty(len(order), np.int64)
    out[order] = best
    return out


def _resolve(pdf: pd.DataFrame, length: int, sort_bytes: int = SORT_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, starts, ends) of the repeated ranges among the different pieces of a shard."""
    pdf = pdf.sort_values(["hash", "_key", "start"], kind="stable")
    group = (pdf["hash"] != pdf["hash"].shift()).cumsum()
    filled = pdf["piece"].str.len().groupby(group).sum().cumsum() // sort_bytes
    for _, own in pdf.groupby(group.map(filled), sort=False):
        groups, pieces = own["hash"].to_numpy(), own["piece"].tolist()
        shape = own["shape"].to_numpy()
        counts, anchor = shape & 0xFFFF, shape >> 16
        left = _shared_lengths(groups, [p[:a][::-1] for p, a in zip(pieces, anchor.tolist(), strict=True)])
        right = _shared_lengths(groups, [p[a:] for p, a in zip(pieces, anchor.tolist(), strict=True)])
        begin = anchor - left
        strings = np.minimum(counts, anchor + right - length + 1) - begin
        keep = np.flatnonzero(strings > 0)
        if not len(keep):
            continue
        begin, strings = begin[keep], strings[keep]
        texts = [pieces[i][b:b + n - 1 + length] for i, b, n in zip(keep.tolist(), begin.tolist(), strings.tolist(), strict=True)]
        keys, first = own["_key"].to_numpy()[keep], own["start"].to_numpy()[keep] + begin
        at, offset, classes = (np.concatenate(c) for c in zip(*repeated_strings(texts, strings, length), strict=True))
        key, start = keys[at], first[at] + offset
        order = np.lexsort((start, key, classes))
        key, start, classes = key[order], start[order], classes[order]
        repeat = np.concatenate(([False], classes[1:] == classes[:-1]))
        yield key[repeat], start[repeat], start[repeat] + length


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of the union (touching ranges are one)."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[first], reach[np.append(first[1:] - 1, len(starts) - 1)]


def repeated_ranges(documents: DataFrame, *, length: int = LENGTH, gram: int = GRAM, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """_key, starts, ends (lists of blocks of byte ranges to remove) per document of ``documents``
    (_key, text) that has any; ranges may overlap."""
    shards = shuffle_partitions(documents.sparkSession)
    apart = cut(told_apart(run_rows(documents, shards, length, gram), length, sort_bytes))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            sizes = [(np.frombuffer(x, np.uint32) & 0xFFFF).astype(np.int64) - 1 + length for x in batch.column(2).to_pylist()]
            merged = [_merge(a, a + n) for a, n in zip(starts, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[i].tobytes() for m in merged], pa.binary()) for i in (0, 1))],
                                             ["_key", "starts", "ends"])

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [f for f in _resolve(pdf, length, sort_bytes) if len(f[0])]
        out = list(_ranges(*(np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)))) if found else []
        return pd.DataFrame(out, columns=["_key", "starts", "ends"])

    settled = apart.filter("hashes is null").select("_key", "starts", "shapes").mapInArrow(ends, RANGES)
    asked = requested_pieces(documents, apart.filter("hashes is not null and not hot"), shards, length)
    found = settled.unionByName(asked.groupBy("shard").applyInPandas(shard, RANGES))
    if apart.filter("hot").limit(1).count():
        found = found.unionByName(hot_ranges(documents, apart.filter("hot"), shards, length))
    return found.groupBy("_key").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))


def keyed(documents: DataFrame) -> tuple[DataFrame, bool]:
    """``documents`` with a long _key that orders rows by doc_id: doc_id itself where it is unique
    and never null (then True), else the number of (doc_id, text) in sorted order."""
    total, ids, different = documents.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if total == ids == different:
        return documents.withColumn("_key", F.col("doc_id").cast("long")), True
    named = documents.withColumn("_text_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    order = ["doc_id", "_text_sha"]
    numbers = numbered(named.select(*order).distinct(), [F.asc_nulls_last("doc_id"), "_text_sha"], "_key").toDF("_id", "_sha", "_key")
    return named.join(numbers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_sha") == F.col("_sha"))).drop("_id", "_sha", "_text_sha"), False


def _cutter(kind: str):
    @F.pandas_udf(f"kept {kind}, n_spans long")
    def take_out(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        kept, spans = [], []
        for text, s, e in zip(texts, starts, ends, strict=True):
            if text is None:
                kept.append(None)
                spans.append(None)
                continue
            raw = text.encode()
            s, e = _merge(np.frombuffer(b"".join(s), np.int64), np.frombuffer(b"".join(e), np.int64))
            left = b"".join(raw[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
            kept.append(left if kind == "binary" else left.decode(errors="ignore"))
            spans.append(len(s))
        return pd.DataFrame({"kept": kept, "n_spans": pd.array(spans, "Int64")})

    return take_out


def _cut_rows(documents: DataFrame, kind: str, length: int, gram: int, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``documents`` with _key and _cut (kept, n_spans; null where nothing goes)."""
    rows, unique = keyed(documents)
    rows = rows.filter("_key is not null")  # true of all; makes both uses of the texts one shuffle
    own = rows.select("_key", "text")
    ranges = repeated_ranges(own if unique else own.dropDuplicates(["_key"]), length=length, gram=gram, sort_bytes=sort_bytes)
    rows = (own if unique and "_row" not in rows.columns else rows).join(ranges, "_key", "left")
    touched = F.when(F.col("starts").isNotNull(), F.col("text"))  # only these texts go to Python
    return rows.withColumn("_cut", _cutter(kind)(touched, "starts", "ends"))


def digests(documents: DataFrame, *, length: int = LENGTH, gram: int = GRAM, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = _cut_rows(documents.select("doc_id", "text"), "binary", length, gram, sort_bytes)
    if "doc_id" not in rows.columns:
        rows = rows.withColumn("doc_id", F.col("_key").cast(documents.schema["doc_id"].dataType))
    text = F.coalesce("text", F.lit("")).cast("binary")
    kept = F.coalesce(F.col("_cut.kept"), text)
    return rows.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                       (F.octet_length(text) - F.octet_length(kept)).cast("long").alias("n_removed"),
                       F.coalesce(F.col("_cut.n_spans"), F.lit(0)).cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


def remove_repeats(documents: DataFrame, *, length: int = LENGTH, gram: int = GRAM, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``documents`` with the repeated bytes taken out of text; other columns and all rows stay."""
    rows = _cut_rows(packed(documents), "string", length, gram, sort_bytes)
    return unpacked(rows, F.coalesce(F.col("_cut.kept"), F.col("text")))
