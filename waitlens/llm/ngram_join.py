"""N-gram Jaccard join by signature trees.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Two documents link when
their sets' Jaccard similarity reaches the threshold. The join is exact:

1. documents with equal sets form a class (a class is named by a 64-bit hash of its set); each task
   drops the copies it holds before anything is shuffled;
2. candidate groups: under one total order of all shingles (by how many sets have them, then by
   hash) two similar sets must share a shingle of their prefixes (the first n - ceil(t n) + 1).
   Classes that share one are joined by star edges to the least of them, and the connected
   components of these edges are the groups: no similar pair lies across two groups. Shingles are
   counted by the top 40 bits of their hashes, and those of several sets are kept in sorted,
   memory-mapped files of the shared folder; as they only shape the order, a clash loses nothing;
3. every group is searched by signature trees: leaves are the sets' token bitmaps, inner nodes
   OR-combine the bitmaps of their children and keep the range of their set sizes. A dual
   traversal drops a pair of nodes when the largest possible overlap of any two sets below them
   is less than the least overlap they need, or when all sets below both are linked already. What
   is left at the leaves is compared exactly. Links that only repeat a known connection are
   skipped, so a group of thousands of mutual near copies costs about one comparison per copy;
4. groups above ``block_shingles`` are dealt into blocks by size band and hash. Each block is
   searched by itself, then one leader per class of every block, then the pairs of blocks whose
   size bands allow a link and which still hold several classes; so no task holds more than two
   blocks, and one giant group is split over many tasks;
5. connected components of the links, and the least doc_id of each;
6. on request every link is counted, in the same cells: the same traversal without skipping known
   connections, and only one number per class leaves a task. Groups above ``block_shingles`` are
   counted by pairs of blocks, which are read from files of the shared folder, so that no set is
   shuffled once per pair. The work is that of all similar pairs.

Defined cases: texts of fewer than five words have one shingle, the whole sequence; null texts and
texts without words have the empty set and link with nothing, not even with one another; repeated
rows are copies; rows with a null doc_id take part, and a component of only such rows has a null id;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import cut, mounted_dir, shuffle_partitions
from waitlens.llm.components import components
from waitlens.llm.elias_fano import load, save
from waitlens.llm.lm_score import _add_up, _blocks, _spans, _unsqueeze
from waitlens.llm.wordhash import WordHasher

SHINGLE_WORDS = 5
THRESHOLD = (75, 100)
#: bits of the hashes by which shingles are counted (for the order only)
COUNT_BITS = 40
BLOCK_SHINGLES = 4_000_000
FAN_OUT = 8
_M1, _M2, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(31)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, made from the hashes of their words."""

    def __init__(self, size: int = SHINGLE_WORDS):
        self.size, self.hasher = size, WordHasher()

    def _chained(self, c: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words at every position."""
        n = len(c) - size + 1
        h = c[:n] * _M1
        for k in range(1, size):
            h = (h ^ (h >> _S)) * _M1 + c[k:n + k] * _M2
        return h ^ (h >> _S) ^ np.uint64(size)

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for _, c, bounds in self.hasher.hashes(texts):
            whole = self._chained(c, self.size) if len(c) >= self.size else None
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a >= self.size:
                    s = np.sort(whole[a:b - self.size + 1])
                    yield s[np.concatenate(([True], s[1:] != s[:-1]))]
                else:  # the whole sequence is one shingle
                    yield self._chained(c[a:b], b - a) if b > a else np.empty(0, np.uint64)


def class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def set_index(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keys``, n and class of every document."""
    kept = documents.select(*keys, "text")
    at = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler()
        for batch in batches:
            sizes, classes = [], []
            for s in make.sets(batch.column(at).to_pylist()):
                sizes.append(len(s))
                classes.append(class_of(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())], [*keys, "n", "class"])

    return kept.mapInArrow(run, ", ".join(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keys) + ", n long, class long")


class SetCounts:
    """How many different sets of some task have a shingle, from the files of ``count_shingles``."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self.files: dict[int, dict] = {}

    @staticmethod
    def shard(keys: np.ndarray, shards: int) -> np.ndarray:
        return ((keys * np.uint64(shards)) >> np.uint64(COUNT_BITS)).astype(np.int64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        order = np.argsort(shingles)
        keys = shingles[order] >> np.uint64(64 - COUNT_BITS)
        found = np.ones(len(keys), np.int64)
        for a, b in _spans(self.shard(keys, self.shards)):
            number = int(self.shard(keys[a:a + 1], self.shards)[0])
            if number not in self.files:
                path = os.path.join(self.folder, f"counts-{number}")
                self.files[number] = load(path) if os.path.exists(path) else {"keys": np.zeros(0, np.uint64)}
            held = self.files[number]
            if len(held["keys"]):
                at = np.minimum(np.searchsorted(held["keys"], keys[a:b]), len(held["keys"]) - 1)
                found[a:b] = np.where(held["keys"][at] == keys[a:b], held["counts"][at], 1)
        out = np.empty(len(keys), np.int64)
        out[order] = found
        return out


def count_shingles(documents: DataFrame) -> SetCounts:
    """Counts, per shingle, the different sets of each task that have it; keeps those above one."""
    spark = documents.sparkSession
    folder, shards = mounted_dir(spark, "shingles"), shuffle_partitions(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, waiting = Shingler(), set(), []
        for batch in batches:
            for s in make.sets(batch.column(0).to_pylist()):
                if len(s) and (own := class_of(s)) not in seen:
                    seen.add(own)
                    waiting.append((s >> np.uint64(64 - COUNT_BITS)))
        if waiting:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            yield _blocks(SetCounts.shard(keys, shards), keys, counts)

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _add_up([_unsqueeze(k) for k in pdf["keys"]], [np.frombuffer(c, np.uint32).astype(np.int64) for c in pdf["counts"]])
        several = counts > 1
        save(os.path.join(folder, f"counts-{pdf['shard'].iloc[0]}"), {"keys": keys[several], "counts": counts[several].astype(np.uint32)})
        return pd.DataFrame({"kept": [int(several.sum())]})

    blocks = documents.select("text").mapInArrow(run, "shard int, keys binary, counts binary")
    blocks.groupBy("shard").applyInPandas(shard, "kept long").agg(F.sum("kept")).collect()
    return SetCounts(folder, shards)


def prefix_length(n: int, threshold: tuple[int, int]) -> int:
    return n - -(-n * threshold[0] // threshold[1]) + 1


def prefixes(documents: DataFrame, counted: SetCounts, shards: int, threshold: tuple[int, int]) -> DataFrame:
    """Blocks (shard, shingles, owners, classes) of the prefix shingles of every different set of a
    task; owners index the block's classes."""

    folder, counted_shards = counted.folder, counted.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, counts = Shingler(), set(), SetCounts(folder, counted_shards)
        for batch in (b.slice(i, 2000) for b in batches for i in range(0, b.num_rows, 2000)):
            sets, classes = [], []
            for s in make.sets(batch.column(1).to_pylist()):
                if len(s) and (own := class_of(s)) not in seen:
                    seen.add(own)
                    sets.append(s)
                    classes.append(own)
            if not classes:
                continue
            often = np.split(counts.of(np.concatenate(sets)), np.cumsum([len(s) for s in sets])[:-1])
            picked = [s[np.argsort(k, kind="stable")][:prefix_length(len(s), threshold)] for s, k in zip(sets, often, strict=True)]
            s, c = np.concatenate(picked), np.array(classes, np.int64)
            o = np.repeat(np.arange(len(picked), dtype=np.uint32), [len(x) for x in picked])
            shard = (s % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            s, o, shard = s[order], o[order], shard[order]
            bounds = np.flatnonzero(np.diff(shard, prepend=-1))
            out = []
            for a, b in zip(bounds, [*bounds[1:], len(s)], strict=True):
                used, local = np.unique(o[a:b], return_inverse=True)
                out.append((int(shard[a]), s[a:b].tobytes(), local.astype(np.uint32).tobytes(), c[used].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), *[pa.binary()] * 3))],
                                             ["shard", "shingles", "owners", "classes"])

    return documents.select("doc_id", "text").mapInArrow(run, "shard int, shingles binary, owners binary, classes binary")


def star_edges(blocks: DataFrame) -> DataFrame:
    """(u, v): edges that connect the classes sharing a prefix shingle. Each shard contracts its own
    to edges from the least class of a connected set, which other shards mostly find too."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        s = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["shingles"]])
        c = np.concatenate([np.frombuffer(k, np.int64)[np.frombuffer(o, np.uint32)] for k, o in zip(pdf["classes"], pdf["owners"], strict=True)])
        order = np.lexsort((c, s))
        s, c = s[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        least = np.repeat(c[first], np.diff(np.append(first, len(s))))
        u, v = least[least != c], c[least != c]
        names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        pairs = np.unique(at[:len(u)] * len(names) + at[len(u):])
        union = Union(len(names))
        for i, j in zip((pairs // max(1, len(names))).tolist(), (pairs % max(1, len(names))).tolist(), strict=True):
            union.join(i, j)
        root = names[np.array([union.root(i) for i in range(len(names))], np.int64)]
        return pd.DataFrame({"u": root, "v": names})[root != names]

    return blocks.groupBy("shard").applyInPandas(shard, "u long, v long").distinct()


class Union:
    """Union-find over 0..n-1 that keeps the least member as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class SignatureTree:
    """Levels of nodes over sets: level 0 the sets, each upper node OR-combines FAN_OUT below it."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        sizes = np.array([len(s) for s in sets])
        words = bits // 64
        bitmap = np.zeros((len(sets), words), np.uint64)
        for i, s in enumerate(sets):
            bit = (s * _M1) >> np.uint64(64 - bits.bit_length() + 1)
            np.bitwise_or.at(bitmap[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        pop = np.bitwise_count(bitmap).sum(1).astype(np.int64)
        self.levels = [(bitmap, sizes, sizes, pop)]
        while len(self.levels[-1][0]) > 1:
            bitmap, low, high, pop = self.levels[-1]
            at = np.arange(0, len(bitmap), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(bitmap, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.minimum.reduceat(pop, at)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
        """Whether sets below nodes a and b (arrays) can link: size ranges, then the largest overlap
        that the common bits leave, against the least overlap that the smallest sizes need."""
        t, of = threshold
        bitmap, low, high, pop = self.levels[level]
        ok = (low[b] * t <= high[a] * of) & (low[a] * t <= high[b] * of)
        at = np.flatnonzero(ok)
        a, b = a[at], b[at]
        common = np.zeros(len(a), np.int64)
        step = max(1, 500_000 // bitmap.shape[1])  # 4 MB of each side
        for i in range(0, len(a), step):
            common[i:i + step] = np.bitwise_count(bitmap[a[i:i + step]] & bitmap[b[i:i + step]]).sum(1)
        most = np.minimum(high[a] - np.maximum(0, pop[a] - common), high[b] - np.maximum(0, pop[b] - common))
        ok[at] = most * (t + of) >= t * (low[a] + low[b])
        return ok


def _linked(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    t, of = threshold
    if min(len(a), len(b)) * of < t * max(len(a), len(b)):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int(np.count_nonzero(b[at] == a))
    return of * shared >= t * (len(a) + len(b) - shared)


def search(sets: list[np.ndarray], known: np.ndarray, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links among ``sets`` that connect what is not yet connected; ``known`` numbers the classes
    already found. All pairs are covered: skipped ones are in one class or cannot link."""
    n = len(sets)
    if n < 2:
        return []
    order = np.lexsort((np.arange(n), [int(s[0]) for s in sets]))  # similar sets often share their least hash
    sets = [sets[i] for i in order]
    union, links = Union(n), []
    at_class: dict[int, int] = {}
    for i, k in enumerate(known[order].tolist()):
        union.join(at_class.setdefault(k, i), i)

    def check(i: int, j: int) -> None:
        if union.root(i) != union.root(j) and _linked(sets[i], sets[j], threshold):
            union.join(i, j)
            links.append((int(order[i]), int(order[j])))

    for i in range(1, n):  # neighbours in the tree's order settle most near copies
        check(i - 1, i)
    largest = max(map(len, sets))
    bits = min(1 << 14, max(512, 1 << (2 * largest - 1).bit_length()))
    while bits > 512 and n * bits > 1 << 31:  # at most 256 MB of bitmaps
        bits //= 2
    tree = SignatureTree(sets, bits)

    def uniform() -> list[np.ndarray]:
        """Per level and node: the class of all sets below it, or -1."""
        out = [np.array([union.root(i) for i in range(n)])]
        while len(out[-1]) > 1:
            at = np.arange(0, len(out[-1]), FAN_OUT)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, low, -1))
        return out

    stack = [(len(tree.levels) - 1, np.array([0]), np.array([0]))]
    same, stale = uniform(), len(links)
    while stack:  # depth first in bounded chunks
        level, a, b = stack.pop()
        if len(a) > 4096:
            stack += [(level, a[4096:], b[4096:])]
            a, b = a[:4096], b[:4096]
        if len(links) > stale + 64:
            same, stale = uniform(), len(links)
        keep = ~((same[level][a] == same[level][b]) & (same[level][a] >= 0))
        a, b = a[keep], b[keep]
        keep = tree.possible(level, a, b, threshold)
        a, b = a[keep], b[keep]
        if not level:
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                check(i, j)
            continue
        below = len(tree.levels[level - 1][0])
        down = np.arange(FAN_OUT)
        ca = np.repeat((a[:, None] * FAN_OUT + down), FAN_OUT, axis=1).ravel()
        cb = np.tile((b[:, None] * FAN_OUT + down), (1, FAN_OUT)).ravel()
        keep = (ca < below) & (cb < below) & ((ca <= cb) if level > 1 else (ca < cb))
        if len(a):
            stack.append((level - 1, ca[keep], cb[keep]))
    return links


def _leaf_pairs(sets: list[np.ndarray], threshold: tuple[int, int], side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of all pairs that may link, each once; with ``side`` only pairs of two sides."""
    n = len(sets)
    if n <= 64:
        a, b = np.triu_indices(n, 1)
        yield (a, b) if side is None else (a[side[a] != side[b]], b[side[a] != side[b]])
        return
    bits = min(1 << 14, max(512, 1 << (2 * max(map(len, sets)) - 1).bit_length()))
    while bits > 512 and n * bits > 1 << 31:
        bits //= 2
    tree = SignatureTree(sets, bits)
    down = np.arange(FAN_OUT)
    stack = [(len(tree.levels) - 1, np.array([0]), np.array([0]))]
    while stack:
        level, a, b = stack.pop()
        if level and len(a) > 4096:
            stack.append((level, a[4096:], b[4096:]))
            a, b = a[:4096], b[:4096]
        if not level and side is not None:
            two = side[a] != side[b]
            a, b = a[two], b[two]
        keep = tree.possible(level, a, b, threshold)
        a, b = a[keep], b[keep]
        if not level:
            yield a, b
        elif len(a):
            below = len(tree.levels[level - 1][0])
            ca = np.repeat((a[:, None] * FAN_OUT + down), FAN_OUT, axis=1).ravel()
            cb = np.tile((b[:, None] * FAN_OUT + down), (1, FAN_OUT)).ravel()
            keep = (ca < below) & (cb < below) & ((ca <= cb) if level > 1 else (ca < cb))
            stack.append((level - 1, ca[keep], cb[keep]))


def degrees(sets: list[np.ndarray], weights: np.ndarray, threshold: tuple[int, int], side: np.ndarray | None = None) -> np.ndarray:
    """Per set the sum of the weights of all other sets it links with; with ``side`` (a number per
    set) only sets of another side count. Every pair that may link is compared exactly."""
    out = np.zeros(len(sets), np.int64)
    if len(sets) < 2:
        return out
    t, of = threshold
    order = np.lexsort((np.arange(len(sets)), [int(s[0]) for s in sets]))
    sets, weights = [sets[i] for i in order], weights[order]
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    begins = ends - size
    names, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    tokens, own = tokens.astype(np.int32), np.zeros(len(names), bool)
    for a, b in _leaf_pairs(sets, threshold, None if side is None else side[order]):
        by = np.argsort(a, kind="stable")
        a, b = a[by], b[by]
        for x, y in _spans(a):
            i, js = int(a[x]), b[x:y]
            mine = tokens[begins[i]:ends[i]]
            own[mine] = True
            for part in np.array_split(js, -(-len(js) // 1024)):
                stop = np.cumsum(size[part])
                at = np.arange(stop[-1]) + np.repeat(begins[part] - stop + size[part], size[part])
                shared = np.add.reduceat(own[tokens[at]], stop - size[part], dtype=np.int64)
                linked = part[of * shared >= t * (size[i] + size[part] - shared)]
                out[i] += weights[linked].sum()
                out[linked] += weights[i]
            own[mine] = False
    back = np.empty_like(out)
    back[order] = out
    return back


def _search_cells(cells: DataFrame, threshold: tuple[int, int], counted: bool = False) -> DataFrame:
    """Links (u, v) found in each cell of rows (cell, root, class, known, copies, shingles); with
    ``counted`` also rows (u, null, n): the copies of all classes that class u links with."""

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in pdf.groupby("root", sort=False):
            own = own.drop_duplicates("class")
            names = own["class"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in own["shingles"]]
            found += [(names[i], names[j], None) for i, j in search(sets, own["known"].to_numpy(), threshold)]
            if counted:
                n = degrees(sets, own["copies"].to_numpy(), threshold)
                found += [(names[i], None, n[i]) for i in np.flatnonzero(n)]
        rows = pd.DataFrame(found, columns=["u", "v", "n"], dtype="object").astype("Int64")
        return rows if counted else rows[["u", "v"]]

    return cells.groupBy("cell").applyInPandas(cell, "u long, v long" + ", n long" * counted)


def _text_hash():
    return F.xxhash64("text").alias("_text_hash")


def _set_rows(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (place, class, root, cell, copies) with the sets: class, root, cell, copies, n, shingles, known (the class).
    A class is found by the doc_id and the text hash of one of its rows; of rows equal in both a task sends one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, sent = Shingler(), set()
        for batch in batches:
            sets, right = list(make.sets(batch.column(4).to_pylist())), []
            for i, (s, c) in enumerate(zip(sets, batch.column(0).to_pylist(), strict=True)):
                if c not in sent and len(s) and class_of(s) == c:  # two texts may share a hash
                    sent.add(c)
                    right.append(i)
            take = pa.array(right, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in (0, 1, 2, 3)), pa.array([len(sets[i]) for i in right], pa.int64()),
                 pa.array([sets[i].tobytes() for i in right], pa.binary()), batch.column(0).take(take)],
                ["class", "root", "cell", "copies", "n", "shingles", "known"])

    texts = documents.select("doc_id", "text", _text_hash())
    joined = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("place.id")) & (F.col("_text_hash") == F.col("place.hash")))
    return joined.select("class", "root", "cell", "copies", "text").mapInArrow(
        run, "class long, root long, cell long, copies long, n long, shingles binary, known long")


def _leaders(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with known = the component its class has by ``links`` so far."""
    known = components(links).toDF("_node", "_known")
    return rows.drop("known").join(known, F.col("class") == F.col("_node"), "left").withColumn(
        "known", F.coalesce("_known", "class")).drop("_node", "_known")


def _in_blocks(rows: DataFrame, block_shingles: int, threshold: tuple[int, int]) -> DataFrame:
    """``rows`` of groups too large for one task with band (of sizes), parts and block."""
    base = -F.log(F.lit(threshold[0] / threshold[1]))
    rows = rows.drop("cell").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / base))
    blocks = rows.groupBy("root", "band").agg(F.ceil(F.sum("n") / block_shingles).alias("parts"))
    return cut(rows.join(blocks, ["root", "band"]).withColumn("part", F.pmod(F.xxhash64("class", F.lit(3)), F.col("parts")))
               .withColumn("block", F.xxhash64("root", "band", "part")))


def _near_blocks(state: DataFrame, *others: str) -> DataFrame:
    """Pairs of blocks of ``state`` whose bands allow a link: the columns, and o_ for the other's."""
    other = state.select("root", *[F.col(c).alias(f"o_{c}") for c in ("band", "block", *others)])
    near = (F.col("o_band") == F.col("band")) & (F.col("o_block") > F.col("block")) | (F.col("o_band") == F.col("band") + 1)
    return state.join(other, "root").filter(near)


def _block_degrees(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(u, n) per class and pair of blocks (or block) with links: the copies it links with there."""
    spark = rows.sparkSession
    folder = mounted_dir(spark, "blocks")

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.drop_duplicates("class")
        save(os.path.join(folder, f"block-{own['block'].iloc[0]}"), {
            "names": own["class"].to_numpy(np.int64), "copies": own["copies"].to_numpy(np.int64), "sizes": own["n"].to_numpy(np.int64),
            "shingles": np.frombuffer(b"".join(own["shingles"]), np.uint64)})
        return own[["root", "band", "block"]].head(1)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, other in zip(pdf["block"], pdf["o_block"], strict=True):
                held = [load(os.path.join(folder, f"block-{b}")) for b in dict.fromkeys((block, other))]
                sets = [s for h in held for s in np.split(np.asarray(h["shingles"]), np.cumsum(h["sizes"])[:-1])]
                names, copies = (np.concatenate([np.asarray(h[c]) for h in held]) for c in ("names", "copies"))
                side = np.repeat(np.arange(len(held)), [len(h["names"]) for h in held])
                n = degrees(sets, copies, threshold, side if len(held) > 1 else None)
                yield pd.DataFrame({"u": names, "n": n})[n > 0]

    state = cut(rows.groupBy("block").applyInPandas(keep, "root long, band long, block long"))
    pairs = _near_blocks(state).select("block", "o_block").unionByName(state.select("block", F.col("block").alias("o_block")))
    return pairs.repartition(shuffle_partitions(spark), "block", "o_block").mapInPandas(count, "u long, n long")


def _large_groups(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Links in groups too large for one task (rows of ``_in_blocks``): blocks, then leaders, then
    open pairs of blocks."""
    links = cut(_search_cells(rows.withColumn("cell", F.col("block")), threshold))
    # one leader per class of a block, in rounds, until a round no longer thins them out
    rows = cut(_leaders(rows, links))
    leaders = rows.groupBy("root", "block", "known").agg(F.min("class").alias("class")).select("class").distinct()
    first = rows.join(leaders, "class", "left_semi")
    cells = first.withColumn("cell", F.xxhash64("root", F.pmod(F.xxhash64("class", F.lit(5)), F.ceil(F.col("parts") / 8))))
    links = cut(links.unionByName(_search_cells(cells, threshold)))
    rows = cut(_leaders(rows, links))
    # pairs of blocks in the same or neighbouring bands that hold more than one class
    state = rows.groupBy("root", "band", "block").agg(F.min("known").alias("low"), F.max("known").alias("high"))
    open_pair = F.least("low", "o_low") != F.greatest("high", "o_high")
    pairs = _near_blocks(state, "low", "high").filter(open_pair).select(
        F.xxhash64("block", "o_block").alias("cell"), F.explode(F.array("block", "o_block")).alias("block"))
    again = rows.join(pairs, "block")
    return links.unionByName(_search_cells(again, threshold))


def ngram_components(documents: DataFrame, *, threshold: tuple[int, int] = THRESHOLD, block_shingles: int = BLOCK_SHINGLES,
                     counted: bool = False, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, n_shingles, class (of equal sets; null for the empty set), component_id (least doc_id
    reachable by links), n_links (links kept at its class to connect it, copies not counted) per row
    of ``documents``; with ``counted`` also n_similar: all other rows that the row links with, copies too.
    ``keys`` (doc_id first) are columns to return; component (a class; null for the empty set) tells
    components apart even where their least doc_id is the same or null."""
    spark = documents.sparkSession
    own = cut(set_index(documents.select(*keys, "text", _text_hash()), (*keys, "_text_hash")))
    place = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("_text_hash").alias("hash")))
    classes = cut(own.filter("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("rep"), place.alias("place"), F.max("n").alias("n"), F.count("*").alias("copies")), own.count())
    n_classes = classes.count()
    edges = star_edges(prefixes(documents, count_shingles(documents), shuffle_partitions(spark), threshold))
    groups = components(edges).toDF("class", "root")
    wanted = cut(groups.join(classes, "class"), n_classes)
    sizes = cut(wanted.groupBy("root").agg(F.sum("n").alias("total")), n_classes)
    fits = F.col("total") <= block_shingles
    all_small, n_large = sizes.agg(F.sum(F.when(fits, F.col("total"))), F.count_if(~fits)).first()
    cells = max(1, -(-(all_small or 0) // block_shingles), shuffle_partitions(spark))
    wanted = wanted.join(sizes, "root").withColumn("cell", F.pmod(F.xxhash64("root"), F.lit(cells)))
    links = _search_cells(_set_rows(documents, wanted.filter(fits)), threshold, counted)
    similar = None
    if counted:
        links = cut(links)
        similar, links = links.filter("v is null").select("u", "n"), links.filter("v is not null").select("u", "v")
    if n_large:
        rows = _in_blocks(_set_rows(documents, wanted.filter(~fits)), block_shingles, threshold)
        links = links.unionByName(_large_groups(rows, threshold))
        similar = similar.unionByName(_block_degrees(rows, threshold)) if counted else None
    links = cut(links)
    joined = components(links, links.count()).toDF("class", "component")
    degree = links.select("u").unionByName(links.select(F.col("v").alias("u"))).groupBy("u").agg(F.count("*").alias("n_links"))
    named = classes.join(joined, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").join(degree, F.col("class") == F.col("u"), "left").drop("u")
    kept = ["n_links"]
    if counted:
        similar = similar.groupBy("u").agg(F.sum("n").alias("n_other"))
        named = named.join(similar, F.col("class") == F.col("u"), "left").drop("u").withColumn(
            "n_similar", F.coalesce("n_other", F.lit(0)) + F.col("copies") - 1)
        kept.append("n_similar")
    return own.join(named.select("class", "component", "component_id", *kept), "class", "left").select(
        *keys, F.col("n").alias("n_shingles"), "class", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component", *[F.coalesce(c, F.lit(0)).alias(c) for c in kept])
