"""Language-model scoring with an Elias-Fano n-gram trie (bigrams).

Tokens are words between ASCII white space with A-Z lower-cased, then one end token per text. The
model is the bigram with absolute discounting, interpolated with the add-one-half unigram:

    p(w | v) = max(c(vw) - D, 0) / c(v) + D * N1(v) / c(v) * p1(w),   p1(w) = (c(w) + 1/2) / (N + (V + 1) / 2)

where N1(v) is the number of different successors of v; the first word's context is the end token,
and after a context never seen p is p1. D = n1 / (n1 + 2 n2) comes from the counts of counts.

The trie is two levels of files in the shared folder, cut into shards of equal token mass, written
by tasks and memory-mapped by the scoring tasks, so that no machine holds it in memory:

* level 1: the words in order of their 64-bit hashes (a word's id is its rank) and their counts;
* level 2: monotone keys context id * (V + 1) + word id in Elias-Fano form. The contexts and the
  pointers to their first successors are monotone Elias-Fano sequences too: a query finds its
  context, takes its range from the pointers and searches the successor there; the smoothed
  probabilities and back-off weights are quantised to 8 bits, rounded down, so that no context's
  probabilities sum to more than one.

Counting covers every training text: each task sends the distinct words, then the distinct bigrams,
of its texts with their counts, by ranges of hash, then of key. Level 1 gives the ranges of key their
bounds, and a context that holds more than a shard's mass is cut by successor.

Defined cases: null and empty texts are one end token; repeated rows are counted and scored as often
as they occur; without training rows N = V = 0 and all scores are 0; a null doc_id is no training
row; an empty table gives no rows. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import mounted_dir, shuffle_partitions
from waitlens.llm.elias_fano import EliasFano, fields, load, save, sequence
from waitlens.llm.wordhash import WordHasher

LEVELS = 256
#: log10 range of the 256 quantised steps (values below the range take its lowest step)
LOWEST = -12.0
BUNCH_TOKENS = 1 << 19


def is_training(doc_id: Column) -> Column:
    """The rows to learn from: crc32 of the id's text modulo 5 is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 1, F.lit(False))


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((log10 - LOWEST) / -LOWEST * (LEVELS - 1)), 0, LEVELS - 1).astype(np.uint8)


CODEBOOK = LOWEST - LOWEST * np.arange(LEVELS) / (LEVELS - 1)


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, highest bytes together: shuffle compression then drops them."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unsqueeze(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, int)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _counted(bunches: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for own in bunches:
        k, c = np.unique(own, return_counts=True)
        keys.append(k)
        counts.append(c)
    return _add_up(keys, counts)


def _spans(labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal labels."""
    first = np.flatnonzero(np.diff(labels, prepend=-1)).tolist()
    return zip(first, [*first[1:], len(labels)] if first else [], strict=True)


def _blocks(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """(shard, keys, counts) blocks of sorted keys whose shards ascend."""
    out = [(int(shard[a]), _squeeze(keys[a:b]), counts[a:b].astype(np.uint32).tobytes()) for a, b in _spans(shard)]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                                      ["shard", "keys", "counts"])


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[str | None]:
    for batch in batches:
        yield from batch.column(column).to_pylist()


def _bunches(hasher: WordHasher, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``hasher.hashes`` but gathered to about BUNCH_TOKENS tokens."""
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = 0

    def settle() -> tuple[int, np.ndarray, np.ndarray]:
        base = np.cumsum([0, *(len(h) for _, h, _ in held)])
        bounds = np.concatenate([[0], *(b[1:] + s for (_, _, b), s in zip(held, base[:-1], strict=True))])
        return held[0][0], np.concatenate([h for _, h, _ in held]), bounds

    for part in hasher.hashes(texts):
        held.append(part)
        size += len(part[1])
        if size >= BUNCH_TOKENS:
            yield settle()
            held, size = [], 0
    if held:
        yield settle()


class Trie:
    """The files of a model folder. ``meta`` holds N, V, the number of training texts, and the
    first id of each level-1 shard; after the second level also D, the key bounds and the
    successors of contexts that several shards share."""

    def __init__(self, folder: str, meta: dict):
        self.folder, self.meta = folder, meta
        self.words, self.tokens = meta["words"], meta["tokens"]
        self.end = self.words  # id of the end token, after all words
        self.first_id = np.array(meta["first_id"])
        self.opened: dict[str, dict] = {}

    def file(self, name: str) -> dict:
        if name not in self.opened:
            path = os.path.join(self.folder, name)
            self.opened[name] = load(path) if os.path.exists(path) else {}
        return self.opened[name]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        shard = word_shard(hashes, len(self.first_id))
        for a, b in _spans(shard):
            level = self.file(f"words-{shard[a]}")
            if level and len(level["hashes"]):
                at = np.minimum(np.searchsorted(level["hashes"], hashes[a:b]), len(level["hashes"]) - 1)
                hit = level["hashes"][at] == hashes[a:b]
                ids[a:b][hit] = self.first_id[shard[a]] + at[hit]
                counts[a:b][hit] = level["counts"][at[hit]]
        return ids, counts

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids, the end token's included."""
        out = np.full(len(ids), self.meta["texts"], np.int64)
        known = np.flatnonzero(ids < self.end)
        shard = np.searchsorted(self.first_id, ids[known], side="right") - 1
        for s in np.unique(shard).tolist():
            own = known[shard == s]
            out[own] = self.file(f"words-{s}")["counts"][ids[own] - self.first_id[s]]
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.meta["types"] + 1))

    def bigrams(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of ids, sorted and distinct: log10 of the stored probability (nan where the
        pair is not in the trie) and of the context's back-off weight."""
        keys = contexts.astype(np.uint64) * np.uint64(self.words + 1) + words.astype(np.uint64)
        shard = np.searchsorted(np.array(self.meta["bounds"], np.uint64), keys, side="right")
        seen, weight = np.full(len(keys), np.nan), np.zeros(len(keys))
        for a, b in _spans(shard):
            level = self.file(f"pairs-{shard[a]}")
            quantised = self.file(f"values-{shard[a]}")
            if not quantised:
                continue
            own, inverse = np.unique(contexts[a:b], return_inverse=True)
            place = sequence(level, "contexts").find(own.astype(np.uint64))
            known = np.flatnonzero(place >= 0)
            begin, end, backoff = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(len(own))
            pointers = sequence(level, "pointers")  # the range of each context's successors; none: an empty one
            begin[known] = pointers[place[known]].astype(np.int64)
            end[known] = pointers[place[known] + 1].astype(np.int64)
            at = sequence(level, "keys").find(keys[a:b] - level["base"][0], (begin[inverse], end[inverse]))
            hit = at >= 0
            seen[a:b][hit] = CODEBOOK[quantised["probability"][at[hit]]]
            backoff[known] = CODEBOOK[quantised["backoff"][place[known]]]
            weight[a:b] = backoff[inverse]
        shared = self.meta["shared"]  # contexts cut over shards: one weight, whichever shard was asked
        if shared:
            ids = np.array(sorted(shared))
            at = np.minimum(np.searchsorted(ids, contexts), len(ids) - 1)
            hit = ids[at] == contexts
            weight[hit] = CODEBOOK[np.array([shared[i] for i in ids.tolist()])[at[hit]]]
        return seen, weight


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash: equal ranges in hash order."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


@lru_cache(maxsize=1)  # one model per Python worker
def _opened(folder: str, stage: str, packed: bytes) -> Trie:
    import pickle

    return Trie(folder, pickle.loads(packed))


def _pairs(trie: Trie, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """ids and counts of the tokens of a bunch (each text's end token included), their contexts,
    and where each text begins."""
    distinct, inverse = np.unique(hashes, return_inverse=True)
    ids, counts = trie.ids(distinct)
    n = len(bounds) - 1
    ends = bounds[1:] + np.arange(n)
    begins = bounds[:-1] + np.arange(n)
    word = np.ones(len(hashes) + n, bool)
    word[ends] = False
    all_ids, all_counts = np.full(len(word), trie.end), np.full(len(word), trie.meta["texts"], np.int64)
    all_ids[word], all_counts[word] = ids[inverse], counts[inverse]
    contexts = np.empty(len(word), np.int64)
    contexts[1:] = all_ids[:-1]
    contexts[begins] = trie.end
    return all_ids, all_counts, contexts, begins


def build(documents: DataFrame) -> Trie:
    """Counts all of ``documents`` (text) and writes the trie to the shared folder."""
    import pickle

    spark = documents.sparkSession
    folder, shards = mounted_dir(spark, "trie"), shuffle_partitions(spark)
    texts = documents.select("text")
    block = "shard int, keys binary, counts binary"

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n = WordHasher(), 0

        def bunches() -> Iterator[np.ndarray]:
            nonlocal n
            for batch in batches:
                n += batch.num_rows
                for _, h, _ in _bunches(hasher, batch.column(0).to_pylist()):
                    yield h

        keys, counts = _counted(bunches())
        if len(keys):
            yield _blocks(word_shard(keys, shards), keys, counts)
        # the number of texts travels as a block without keys
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b""]), pa.array([np.array([n], np.uint32).tobytes()])],
                                         ["shard", "keys", "counts"])

    target = 4  # key ranges per level-1 shard at least, so that ranges are finer than shards

    def word_level(pdf: pd.DataFrame) -> pd.DataFrame:
        shard, texts_here = int(pdf["shard"].iloc[0]), 0
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, c in zip(pdf["keys"], pdf["counts"], strict=True):
            if k:
                keys.append(_unsqueeze(k))
                counts.append(np.frombuffer(c, np.uint32).astype(np.int64))
            else:
                texts_here += int(np.frombuffer(c, np.uint32)[0])
        hashes, total = _add_up(keys, counts)
        save(os.path.join(folder, f"words-{shard}"), {"hashes": hashes, "counts": total})
        # marks that cut the shard's token mass evenly: (index of the context, share of its successors before)
        mass = np.cumsum(total)
        marks = (mass[-1] * np.arange(1, target) // target) if len(total) else np.zeros(0, np.int64)
        at = np.searchsorted(mass, marks, side="right")
        inside = (marks - (mass[at] - total[at])) / total[at] if len(at) else marks
        return pd.DataFrame({"shard": [shard], "words": [len(hashes)], "tokens": [int(total.sum())], "texts": [texts_here],
                             "at": [at.astype(np.int64).tobytes()], "inside": [np.asarray(inside, np.float64).tobytes()]})

    rows = texts.mapInArrow(words, block).groupBy("shard").applyInPandas(
        word_level, "shard int, words long, tokens long, texts long, at binary, inside binary").collect()  # a row per shard
    sizes, n_texts = np.zeros(shards, np.int64), sum(r["texts"] for r in rows)
    for r in rows:
        sizes[r["shard"]] = r["words"]
    first_id = np.cumsum(sizes) - sizes
    n_words = int(sizes.sum())
    meta = {"words": n_words, "types": n_words + (n_texts > 0), "tokens": sum(r["tokens"] for r in rows) + n_texts, "texts": n_texts,
            "first_id": first_id.tolist(), "bounds": [], "shared": {}}
    marks = []
    for r in rows:
        ids, inside = np.frombuffer(r["at"], np.int64) + first_id[r["shard"]], np.frombuffer(r["inside"])
        marks += [int(i) * (n_words + 1) + int(share * n_words) for i, share in zip(ids, inside, strict=True)]
        marks.append(int(first_id[r["shard"]]) * (n_words + 1))
    marks.append(n_words * (n_words + 1))  # first words of texts: successors of the end token
    bounds = sorted({m for m in marks if m > 0})[:: max(1, target // 2)]
    meta["bounds"] = bounds
    packed = pickle.dumps(meta)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, hasher = _opened(folder, "words", packed), WordHasher()

        def bunches() -> Iterator[np.ndarray]:
            for batch in batches:
                for _, h, b in _bunches(hasher, batch.column(0).to_pylist()):
                    ids, _, contexts, _ = _pairs(trie, h, b)
                    yield contexts.astype(np.uint64) * np.uint64(n_words + 1) + ids.astype(np.uint64)

        keys, counts = _counted(bunches())
        if len(keys):
            yield _blocks(np.searchsorted(np.array(bounds, np.uint64), keys, side="right"), keys, counts)

    def pair_level(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        keys, counts = _add_up([_unsqueeze(k) for k in pdf["keys"]], [np.frombuffer(c, np.uint32).astype(np.int64) for c in pdf["counts"]])
        contexts, first = np.unique(keys // np.uint64(n_words + 1), return_index=True)
        base = keys[0]
        level = {"base": np.array([base]), **fields("keys", EliasFano.build(keys - base, int(keys[-1] - base) + 1)),
                 **fields("contexts", EliasFano.build(contexts, n_words + 1)),
                 **fields("pointers", EliasFano.build(np.append(first, len(keys)), len(keys) + 1))}
        save(os.path.join(folder, f"pairs-{shard}"), level)
        save(os.path.join(folder, f"counts-{shard}"), {"counts": counts.astype(np.uint32)})
        sizes = np.diff(np.append(first, len(keys)))
        return pd.DataFrame({"shard": [shard], "n1": [int((counts == 1).sum())], "n2": [int((counts == 2).sum())],
                             "head": [int(contexts[0])], "head_n": [int(sizes[0])], "tail": [int(contexts[-1])], "tail_n": [int(sizes[-1])]})

    rows = texts.mapInArrow(pairs, block).groupBy("shard").applyInPandas(
        pair_level, "shard int, n1 long, n2 long, head long, head_n long, tail long, tail_n long").collect()  # a row per shard
    n1, n2 = sum(r["n1"] for r in rows), sum(r["n2"] for r in rows)
    discount = n1 / (n1 + 2 * n2) if n1 else 0.5
    edges: dict[int, list[int]] = {}
    for r in rows:
        edges.setdefault(r["head"], []).append(r["head_n"])
        if r["tail"] != r["head"]:
            edges.setdefault(r["tail"], []).append(r["tail_n"])
    inside = {b // (n_words + 1) for b in bounds if b % (n_words + 1)}  # cut by a bound, maybe with all successors on one side
    successors = {k: sum(v) for k, v in edges.items() if len(v) > 1 or k in inside}  # at most one context per bound
    meta["discount"] = discount
    packed = pickle.dumps(meta)

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _opened(folder, "pairs", packed)
        for batch in batches:
            for shard in batch["shard"].tolist():
                level, counts = trie.file(f"pairs-{shard}"), trie.file(f"counts-{shard}")["counts"].astype(np.int64)
                contexts, pointers = sequence(level, "contexts"), sequence(level, "pointers")
                own = contexts[np.arange(contexts.n)].astype(np.int64)
                first = pointers[np.arange(pointers.n)].astype(np.int64)
                n_next = np.diff(first)
                for i in (0, len(own) - 1):
                    n_next[i] = successors.get(int(own[i]), n_next[i])
                total = trie.counts(own)
                spread = np.repeat(np.arange(len(own)), np.diff(first))
                probability = np.empty(len(counts), np.uint8)
                for a in range(0, len(counts), 1 << 20):
                    part = np.arange(a, min(len(counts), a + (1 << 20)))
                    key = sequence(level, "keys")[part] + level["base"][0]
                    context = spread[part]
                    word = (key - own[context].astype(np.uint64) * np.uint64(n_words + 1)).astype(np.int64)
                    p = (counts[part] - discount + discount * n_next[context] * trie.unigram(trie.counts(word))) / total[context]
                    probability[part] = quantise(np.log10(p))
                backoff = quantise(np.log10(discount * n_next / total))
                save(os.path.join(folder, f"values-{shard}"), {"probability": probability, "backoff": backoff})
            yield pd.DataFrame({"shard": batch["shard"], "head": [0] * len(batch)})[:0]

    numbers = spark.createDataFrame([(r["shard"],) for r in rows], "shard int").repartition(max(1, len(rows)))
    numbers.mapInPandas(values, "shard int, head int").count()
    trie = Trie(folder, meta)
    if successors:
        ids = np.array(sorted(successors))
        weights = quantise(np.log10(discount * np.array([successors[i] for i in ids.tolist()]) / trie.counts(ids)))
        meta["shared"] = dict(zip(ids.tolist(), weights.tolist(), strict=True))
    return trie


def score(documents: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10) of every row; a map over ``documents``."""
    import pickle

    packed, folder = pickle.dumps(trie.meta), trie.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, hasher = _opened(folder, "values", packed), WordHasher()
        for batch in batches:
            n_tokens, n_known = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            base, whole = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for first, hashes, bounds in _bunches(hasher, batch.column(1).to_pylist()):
                ids, counts, contexts, begins = _pairs(trie, hashes, bounds)
                single = np.log10(trie.unigram(counts))
                value = single.copy()
                at = np.flatnonzero(contexts >= 0)
                word = np.where(ids[at] >= 0, ids[at], 0).astype(np.uint64)
                key, inverse = np.unique(contexts[at].astype(np.uint64) * np.uint64(trie.words + 1) + word, return_inverse=True)
                own = key // np.uint64(trie.words + 1)
                seen, weight = trie.bigrams(own.astype(np.int64), (key - own * np.uint64(trie.words + 1)).astype(np.int64))
                seen, weight = seen[inverse], weight[inverse]
                value[at] = np.where((ids[at] >= 0) & ~np.isnan(seen), seen, weight + single[at])
                rows = slice(first, first + len(begins))
                n_tokens[rows] = np.diff(np.append(begins, len(ids)))
                n_known[rows] = np.add.reduceat(counts > 0, begins, dtype=np.int64)
                base[rows], whole[rows] = np.add.reduceat(single, begins), np.add.reduceat(value, begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (n_tokens, n_known, base, whole))],
                                             ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
