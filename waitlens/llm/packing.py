"""Packing: first-fit decreasing over a tournament tree of bin capacities, run independently in
randomised groups of documents.

``pieces`` tokenizes the documents (one pass, no shuffle) and cuts each at multiples of the
sequence length, keeping the ids: every full piece is a sequence of its own and only document tails are left
to pack. ``pack`` stores the pieces, deals their numbers into groups by hash; a group holds a
bounded number of pieces, whatever their source or text, and is packed in one task by a tree whose
leaves are the bins' free tokens and whose inner nodes hold the larger of their children: the
first bin that fits is found by one descent. The ids join the places in one shuffle. ``sequences``
lays the pieces of each sequence one after another. Sequences are padded to the sequence length, except
those whose tokens number a power of two.

Ids are those of the ``tokenizers`` file byte_bpe_50k.json without special tokens; they are made
by the tiktoken file of the same vocabulary, which is several times faster (a test holds both
against each other). With ``added`` tokens (``added_tokens`` reads the file's) a text is first cut
at each of them, which gets its own id, as the library does by default. A text is cut before single blanks between two other characters, where the
vocabulary's pattern always starts a new word, and the words' ids are kept in a bounded memo.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they
occur; texts of any length are cut; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import stored

SEQUENCE_TOKENS = 2048
END_ID = 1
GROUP_PIECES = 20_000
MEMO_WORDS = 300_000
_OTHER_SPACE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANK = re.compile(r"(?<=\S) (?=\S)")
PIECE = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "piece long, sequence_id long, offset long"


def _words(text: str) -> list[str]:
    """``text`` cut at each single blank between two characters that are no white space."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER_SPACE.search(text):
        return _BLANK.split(text)
    return text.split(" ")


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file and their ids."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in held):
        raise ValueError("added tokens that look at the text around them are not supported")
    return {t["content"]: t["id"] for t in held}


class WordIds:
    """ids of whole texts as little-endian unsigned 32-bit bytes, by a memo of their words."""

    def __init__(self, path: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken

        self.added = {token: np.array([i], "<u4").tobytes() for token, i in (added or {}).items()}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.starts = np.zeros(max(ranks.values()) + 1, bool)
        self.starts[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.memo: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4")

    def _learn(self, words: set[str]) -> None:
        plain = [w for w in words if " " not in w]
        for i in range(0, len(plain), 20_000):
            part = plain[i:i + 20_000]
            ids = self._ids(" " + " ".join(part))
            raw, begins = ids.tobytes(), (4 * np.flatnonzero(self.starts[ids])).tolist()
            self.memo.update(zip(part, [raw[a:b] for a, b in zip(begins, [*begins[1:], len(raw)], strict=True)], strict=True))
        for word in words:
            if " " in word:
                self.memo[word] = self._ids(" " + word).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 64):  # keeps the words of few texts at a time
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            own = [self.cut.split(t) if any(a in t for a in self.added) else [t] for t in texts[i:i + 64]]
            parts = [[_words(p) for p in o[::2]] for o in own]  # added tokens are at the odd places
            self._learn({w for o in parts for p in o for w in p[1:]}.difference(self.memo))
            for o, words in zip(own, parts, strict=True):
                ids = [self._ids(p[0]).tobytes() + b"".join(map(self.memo.__getitem__, p[1:])) for p in words]
                yield ids[0] + b"".join(self.added[a] + p for a, p in zip(o[1::2], ids[1:], strict=True))


@lru_cache(maxsize=2)  # once per Python worker
def _word_ids(path: str, pattern: str, added: tuple[tuple[str, int], ...]) -> WordIds:
    return WordIds(path, pattern, dict(added))


def pieces(documents: DataFrame, vocabulary_path: str, pattern: str, *, sequence_tokens: int = SEQUENCE_TOKENS,
           end_id: int = END_ID, added: dict[str, int] | None = None) -> DataFrame:
    """Rows of PIECE: each document's ids and ``end_id``, cut at multiples of ``sequence_tokens``;
    ids are little-endian unsigned 32-bit numbers."""
    special = tuple(sorted((added or {}).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(vocabulary_path, pattern, special)
        end = np.array([end_id], "<u4").tobytes()
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            index, start, length, crc, total, parts = [], [], [], [], [], []
            for i, ids in enumerate(words.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, sequence_tokens):
                    part = ids[4 * s:4 * (s + sequence_tokens)]
                    index.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                 pa.array(parts, pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(run, PIECE.format(kind=rows.schema["doc_id"].dataType.simpleString()))


class BinTree:
    """Tournament tree over ``bins`` bins of ``capacity``; ``put`` returns the first that fits."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        free, at = self.free, 1
        if free[1] < size:
            raise ValueError("no bin fits")
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        free[at] -= size
        found = at - self.leaves
        while at > 1:
            at //= 2
            best = max(free[2 * at], free[2 * at + 1])
            if free[at] == best:
                break
            free[at] = best
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each size; bins are opened in order, sizes taken from the largest (ties: as given)."""
    out = np.empty(len(sizes), np.int64)
    tree = BinTree(len(sizes), capacity)
    for i in np.argsort(-sizes, kind="stable"):
        out[i] = tree.put(int(sizes[i]))
    return out


def pack(cut_pieces: DataFrame, *, sequence_tokens: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES,
         seed: int = 7) -> DataFrame:
    """Adds sequence_id and offset to rows of PIECE (none longer than ``sequence_tokens``)."""
    cut_pieces = stored(cut_pieces.withColumn("piece", F.monotonically_increasing_id()))
    groups = max(1, -(-cut_pieces.count() // group_pieces))
    key = F.pmod(F.xxhash64("piece", F.lit(seed)), F.lit(groups))  # equal rows too go to different groups

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32", "piece"], ascending=[False, True, True, True, True], kind="stable")
        bins = first_fit_decreasing(pdf["length"].to_numpy(), sequence_tokens)
        own = int(pdf["_group"].iloc[0])
        pdf = pdf.assign(sequence_id=(own << 32) + bins)
        pdf["offset"] = pdf.groupby("sequence_id", sort=False)["length"].cumsum() - pdf["length"]
        return pdf[["piece", "sequence_id", "offset"]]

    numbers = cut_pieces.drop("ids", "doc_tokens").withColumn("_group", key)
    return cut_pieces.join(numbers.groupBy("_group").applyInPandas(group, PLACED), "piece").drop("piece")


def sequences(placed: DataFrame, *, sequence_tokens: int = SEQUENCE_TOKENS, pad_id: int = END_ID) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence of ``pack``'s rows, padded with ``pad_id``
    after its n_tokens to ``sequence_tokens``, unless n_tokens is a power of two."""
    own = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    ids = F.aggregate("_parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    padded = F.expr(f"rpad(ids, {4 * sequence_tokens}, X'{pad_id.to_bytes(4, 'little').hex()}')")
    plain = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return own.select("sequence_id", "n_tokens", ids.alias("ids")).withColumn("ids", F.when(plain, F.col("ids")).otherwise(padded))


def write_sequences(placed: DataFrame, path: str, *, sequence_tokens: int = SEQUENCE_TOKENS, pad_id: int = END_ID) -> None:
    """Writes ``sequences`` as Parquet."""
    sequences(placed, sequence_tokens=sequence_tokens, pad_id=pad_id).write.option("compression", "zstd").parquet(path)
