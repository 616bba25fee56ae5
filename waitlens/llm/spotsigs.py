"""Document fingerprints by SpotSigs.

An anchor is a very common word; the spot signature of each anchor occurrence is the anchor with
the chain of the next ``CHAIN`` content words (words that are no anchors). A document's fingerprint
is the set of its spot signatures, written as sorted 8-digit hex numbers without separators; the
likeness of two fingerprints is the Jaccard similarity of the sets.

``near_pairs`` finds all pairs above a threshold without comparing all: documents are partitioned
by set length into bands (a pair's lengths differ by at most the threshold, so it meets in its own
or the next band), each set is entered under its rarest signatures only (the prefix that a similar
set must touch), and a pair is dropped as soon as its lengths rule it out; the rest is compared.
Equal fingerprints are joined once, as one class.

``neighbour_rows`` deals the documents by explicit doc_id ranges and adds to each range a copy of
the first document of the next one, so every document meets its successor in one shuffle. Where ids
are null or repeated, equal rows first become one with a count, and an id that fills several ranges
is split by its texts, so that neither an id nor a row that many share lands in one task.

Defined cases: null text is empty; a text with words but without any spot signature is
fingerprinted as a whole, and an empty text too, so equal texts always have equal fingerprints;
two equal fingerprints have likeness 1; a null doc_id comes after all others; rows of one doc_id
are ordered by the CRC-32 of their text, then by text; of equal rows each is the next one's
predecessor; a table of one row has itself as its successor; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.llm.common import cut, shuffle_partitions
from waitlens.llm.wordhash import PUNCTUATION, WordHasher

#: parameter: the anchors, very common function words of English, German, French and Spanish
ANCHORS = (
    "a an and are as at be but by for from has have he her his in is it not of on or that the they this to was were "
    "what which with you auch auf aus das dem den der des die ein eine einen er es für ich im ist mit nicht sich sie "
    "sind und von vor wie wir zu zum avec ce dans de du elle en est et il ils je la le les mais ne nous ou par pas "
    "pour que qui se sont sur un une vous al como con del el esta ha las lo los más muy no para pero por su una y"
).split()
CHAIN = 2
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class SpotSigs:
    """Signature sets of texts; words are runs without ASCII punctuation or space, A-Z lower-cased."""

    def __init__(self, anchors: list[str], chain: int):
        self.hasher = WordHasher(PUNCTUATION)
        self.anchors = np.unique(self.hasher.of(anchors))
        self.chain = chain

    def _spots(self, codes: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Sorted distinct 32-bit signatures of each text of a bunch."""
        near = self.anchors[np.minimum(np.searchsorted(self.anchors, codes), len(self.anchors) - 1)]
        is_anchor = near == codes
        content, at = np.flatnonzero(~is_anchor), np.flatnonzero(is_anchor)
        first = np.searchsorted(content, at)
        whole = first + self.chain <= len(content)
        at, first = at[whole], first[whole]
        end = bounds[np.searchsorted(bounds, at, side="right")] if len(at) else at
        whole = content[first + self.chain - 1] < end  # the chain stays in its text
        at, first = at[whole], first[whole]
        mixed = codes[at] * _MIX[0]
        for k in range(self.chain):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1] + codes[content[first + k]] * _MIX[2]
        signatures = (mixed ^ (mixed >> np.uint64(32))).astype(np.uint32)
        cuts = np.searchsorted(at, bounds)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield np.unique(signatures[a:b])

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        out = [s for _, codes, bounds in self.hasher.hashes(texts) for s in self._spots(codes, bounds)]
        for i, s in enumerate(out):
            if not len(s):
                out[i] = np.frombuffer(hashlib.blake2b(texts[i].encode(), digest_size=4).digest(), "<u4")
        return out


def written(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted signature sets."""
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(documents: DataFrame, *, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """doc_id, n_signatures, signatures (sorted array of longs), fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = SpotSigs(anchors, chain)
        for batch in batches:
            sets = spots.sets([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, sets), pa.int64()),
                 pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(map(written, sets), pa.string())],
                ["doc_id", "n_signatures", "signatures", "fingerprint"])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_signatures long, signatures array<long>, fingerprint string")


def near_pairs(prints: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(membership: doc_id, fingerprint_class; pairs: class_a, class_b, likeness) for the output of
    ``fingerprints``; a class holds the documents of one fingerprint and is named by its SHA-256."""
    named = prints.withColumn("fingerprint_class", F.sha2("fingerprint", 256))
    members = named.select("doc_id", "fingerprint_class")
    classes = cut(named.groupBy("fingerprint_class").agg(F.first("signatures").alias("signatures"), F.first("n_signatures").alias("n")))
    spread = classes.select("fingerprint_class", "n", F.explode("signatures").alias("signature"))
    spread = spread.join(spread.groupBy("signature").agg(F.count("*").alias("df")), "signature")
    ordered = spread.groupBy("fingerprint_class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "signature"))).alias("s"))
    prefix = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    band = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(threshold))).cast("long")
    keys = ordered.select("fingerprint_class", "n", band.alias("band"), F.explode(F.slice("s", F.lit(1), prefix.cast("int"))).alias("k"))
    keys = keys.select("fingerprint_class", "n", "band", F.col("k.signature").alias("signature"))
    left = keys.select(F.col("fingerprint_class").alias("class_a"), F.col("n").alias("na"), "signature",
                       F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    right = keys.select(F.col("fingerprint_class").alias("class_b"), F.col("n").alias("nb"), "signature", "band")
    ahead = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("class_a") < F.col("class_b")))
    found = left.join(right, ["signature", "band"]).filter(ahead & (F.col("na") >= threshold * F.col("nb")))
    found = found.select("class_a", "class_b").distinct()
    sets = classes.select("fingerprint_class", "signatures")
    both = (found.join(sets.toDF("class_a", "sa"), "class_a").join(sets.toDF("class_b", "sb"), "class_b")
            .withColumn("shared", F.size(F.array_intersect("sa", "sb"))))
    value = F.col("shared") / (F.size("sa") + F.size("sb") - F.col("shared"))
    return members, both.select("class_a", "class_b", value.alias("likeness")).filter(F.col("likeness") >= threshold)


def neighbour_rows(documents: DataFrame, parts: int) -> tuple[DataFrame, bool]:
    """(doc_id, text, copies, part, guest; whether copies can exceed 1): different rows in about
    ``parts`` ranges in the order of the module's docstring, sorted in them. The last row of a range
    is a guest: the first row of the next range that has any (of the first one after the last), or,
    in a single range, its own first row. An id that fills several ranges (null too) is split by the
    CRC-32 of its texts."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total, ids, different = rows.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    repeated = not total == ids == different
    if repeated:
        rows = cut(rows.groupBy("doc_id", "text").agg(F.count("*").alias("copies")).withColumn("place", F.crc32(F.col("text").cast("binary"))))
        total, ids = rows.agg(F.count("*"), F.count("doc_id")).first()
    else:
        rows = rows.withColumns({"copies": F.lit(1).cast("long"), "place": F.lit(0).cast("long")})
    if not total:
        return rows.select("doc_id", "text", "copies", F.lit(0).alias("part"), F.lit(False).alias("guest")), False
    own = max(1, round(parts * ids / total))  # ranges of rows with an id; the others hold those without
    quantiles = rows.approxQuantile("doc_id", [i / own for i in range(1, own)], 0.2 / own) if own > 1 else []
    held = Counter(int(e) for e in quantiles)
    edges = sorted(held, reverse=True)  # each is the least id of its range
    width = parts + 2

    def split(n) -> Column:
        return F.floor(F.col("place") * n / 2**32)

    part = F.lit(0)
    if edges:
        ends = F.array(*[F.lit(e) for e in edges])
        above = F.size(F.filter(ends, lambda e: e > F.col("doc_id")))
        times = F.get(F.array(*[F.lit(held[e]) for e in edges]), above)  # ranges that the least id fills
        part = above * width + F.when((F.get(ends, above) == F.col("doc_id")) & (times > 1), 1 + split(times)).otherwise(0)
    part = F.when(F.col("doc_id").isNotNull(), part).otherwise((len(edges) + 1) * width + split(max(1, parts - own)))
    rows = rows.withColumn("part", part.cast("int"))
    first = F.max(F.struct(F.col("doc_id").isNotNull(), F.col("doc_id").alias("top"), (-F.col("place")).alias("place")))
    present = sorted((r["part"], r["row"]["top"], -r["row"]["place"]) for r in rows.groupBy("part").agg(first.alias("row")).collect())  # one row per range
    guests = documents.sparkSession.createDataFrame(
        [(p, top, place, present[i - 1][0]) for i, (p, top, place) in enumerate(present)], "_part int, _top long, _place long, _goes int")
    hosts = rows.join(F.broadcast(guests), (F.col("part") == F.col("_part")) & F.col("doc_id").eqNullSafe(F.col("_top"))
                      & (F.col("place") == F.col("_place")))  # one row per range
    hosts = hosts.groupBy("doc_id", "place", "_goes").agg(F.min("text").alias("text"))
    every = rows.withColumn("guest", F.lit(False)).unionByName(
        hosts.select("doc_id", "text", F.lit(1).cast("long").alias("copies"), "place", F.col("_goes").alias("part"), F.lit(True).alias("guest")))
    every = every.repartition(shuffle_partitions(documents.sparkSession), "part").sortWithinPartitions(
        "part", "guest", F.desc_nulls_last("doc_id"), "place", "text")
    return every.select("doc_id", "text", "copies", "part", "guest"), repeated


#: rows of one text that are written together
COPIES = 4096


def edited_fingerprints(documents: DataFrame, *, anchors: list[str] = ANCHORS, chain: int = CHAIN, parts: int | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has the last floor(n / 2) code points replaced by the first as many
    of the next document in descending doc_id (after the last: the first)."""
    rows, repeated = neighbour_rows(documents, parts or 4 * shuffle_partitions(documents.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = SpotSigs(anchors, chain)
        last = None  # doc_id, text, copies, part, guest and signatures of the row before
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            columns = [c.to_pylist() for c in batch.columns]
            here = list(zip(*columns, spots.sets(columns[1]), strict=True))
            met = [(x, y) for x, y in zip([last, *here], here, strict=False) if x is not None and not x[4] and x[3] == y[3]]
            # a repeated row's next document is its copy, but for the last one's
            pairs = [(x, z, n) for x, y in met for z, n in ((x, x[2] - 1), (y, 1)) if n]
            last = here[-1] if here else last
            edited = [x[1][:len(x[1]) - len(x[1]) // 2] + y[1][:len(x[1]) // 2] for x, y, _ in pairs]
            out = []
            for (x, y, n), e, changed in zip(pairs, edited, spots.sets(edited), strict=True):
                row = (x[0], len(x[1]), hashlib.sha256(e.encode()).hexdigest(), written(x[5]), written(changed), likeness(x[5], changed), likeness(x[5], y[5]))
                out += [(*row, min(COPIES, n - k)) for k in range(0, n, COPIES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_chars", T.LongType()),
                           *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                           *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")), T.StructField("copies", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    out = rows.mapInArrow(run, schema)
    if repeated:  # the copies of one text are written by several tasks
        out = out.repartition(shuffle_partitions(documents.sparkSession)).withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.drop("copies")
