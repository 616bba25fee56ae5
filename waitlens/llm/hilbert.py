"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised into 2^bits cells by quantiles: approximate ones of numbers and dates,
exact ones of the counted distinct values of texts, which are compared whole. The cells are one
point on a Hilbert curve, and the rows sorted by curve index are cut into runs of equal row counts
(law ``rows``: counts at most one apart). Shards then cover small boxes of the metadata space, so a
filter on any dimension skips most files.

Text quantiles: one count per distinct value (pre-aggregated, so a hot value moves once per task),
dealt by ranges of the value; the running counts inside the ranges and one sum per range give each
value its ranks, and at most 2^bits - 1 values, those that hold a quantile's rank, reach the driver.

The sort is a range partitioning on curve index, text hash and id, so a cell that holds a third of
all rows is split over many tasks; global ranks come from one count per partition. Only numbers
are sorted; ``write_shards`` brings the rows themselves to their files.

Defined cases: null dimensions are the lowest cell; a dimension of nulls or of one value is one
cell; texts are ordered by their UTF-8 bytes, whatever their length; a null text has 0 bytes; ties on the curve are
ordered by text hash, then doc_id; rows equal in all of these take neighbouring slots in any
order; an empty table gives no rows; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from waitlens.llm.common import cut, shuffle_partitions

BITS = 6


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``points`` (cells below 2^bits): Gray-code
    exchange of the axes from the top bit down, then interleaving of the bits."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        below = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[dims - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> bit & 1)
    return out


def as_number(col: Column, kind: T.DataType) -> Column:
    """An order-keeping double of a number, date or truth value; null is below all."""
    if isinstance(kind, (T.DateType, T.TimestampType)):
        number = F.unix_micros(col.cast("timestamp")).cast("double")
    else:
        number = col.cast("double")
    return F.coalesce(number, F.lit(-1.0e300))


def text_edges(rows: DataFrame, column: str, cells: int) -> list[str]:
    """The distinct values of a text column that hold the rows of rank i / cells, 0 < i < cells, in
    order; nulls come first and are no edge."""
    spark = rows.sparkSession
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    counts = counts.repartitionByRange(shuffle_partitions(spark), F.col("value").asc_nulls_first())
    counts = cut(counts.withColumn("part", F.spark_partition_id()))
    sums = sorted(counts.groupBy("part").agg(F.sum("n")).collect())  # one row per partition
    total = sum(n for _, n in sums)
    before = {part: sum(n for p, n in sums if p < part) for part, _ in sums}
    if not total:
        return []
    offsets = spark.createDataFrame(list(before.items()), "part int, before long")
    running = F.sum("n").over(Window.partitionBy("part").orderBy(F.col("value").asc_nulls_first()))
    ranked = counts.withColumn("end", running).join(F.broadcast(offsets), "part")  # as many rows as partitions
    end = F.col("before") + F.col("end")
    # ranks [end - n, end) of the value; the rank of quantile i is i * total div cells
    inside = F.exists(F.sequence(F.lit(1), F.lit(cells - 1)).cast("array<long>"),
                      lambda i: (F.floor(i * total / cells) >= end - F.col("n")) & (F.floor(i * total / cells) < end))
    return sorted((r["value"] for r in ranked.filter(inside & F.col("value").isNotNull()).select("value").collect()), key=str.encode)


def text_cell(col: Column, edges: list[str]) -> Column:
    """Number of edges below a value; null is the lowest cell."""
    if not edges:
        return F.lit(0.0)
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < col))
    return F.when(col.isNull(), 0.0).otherwise(below.cast("double"))


def shards(rows: DataFrame, *, dimensions: list[str], n_shards: int, bits: int = BITS) -> DataFrame:
    """doc_id, size (bytes of the text plus 8), text_crc32, curve, shard, slot of every row of
    ``rows`` (doc_id, text and the dimensions)."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    numbers = [f"_d{i}" for i in range(len(dimensions))]
    cells = 1 << bits
    spelled = {d: text_edges(rows, d, cells) for d in dimensions if isinstance(kinds[d], T.StringType)}
    values = [text_cell(F.col(d), spelled[d]) if d in spelled else as_number(F.col(d), kinds[d]) for d in dimensions]
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = cut(rows.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).alias("text_crc32"),
                             *[v.alias(n) for v, n in zip(values, numbers, strict=True)]))
    measured = [n for d, n in zip(dimensions, numbers, strict=True) if d not in spelled]
    quantiles = narrow.approxQuantile(measured, [i / cells for i in range(1, cells)], 0.25 / cells) if measured else []
    own = dict(zip(measured, quantiles, strict=True))
    edges = [np.array(own[n]) if n in own else np.arange(cells - 1) for n in numbers]  # texts are cells already

    @F.pandas_udf("long")
    def curve(*dims: pd.Series) -> pd.Series:
        points = [np.searchsorted(e, d.to_numpy(), side="left") for e, d in zip(edges, dims, strict=True)]
        return pd.Series(hilbert_index(np.stack(points, axis=1), bits))

    order = ["curve", "text_crc32", "doc_id"]
    placed = narrow.select("doc_id", "size", "text_crc32", curve(*numbers).alias("curve"))
    placed = placed.repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    placed = cut(placed.withColumn("_part", F.spark_partition_id()))
    counts = sorted(placed.groupBy("_part").count().collect())  # one row per partition
    total, before = 0, {}
    for part, n in counts:
        before[part], total = total, total + n
    if not total:
        return placed.select("doc_id", "size", "text_crc32", "curve", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "_part int, _before long")
    ranked = placed.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    ranked = ranked.join(F.broadcast(offsets), "_part")  # as many rows as shuffle partitions
    rank = F.col("_before") + F.col("_in")
    shard = F.expr(f"((_before + _in) * {n_shards}L) div {total}L")
    first = F.expr(f"(_shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return (ranked.withColumn("_shard", shard).withColumn("slot", rank - first)
            .select("doc_id", "size", "text_crc32", "curve", F.col("_shard").cast("int").alias("shard"), "slot"))


def write_shards(rows: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes ``rows`` into one folder per shard, in slot order. Slots are dealt in ranges, so one
    shard is written by several tasks when it is large."""
    own = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    joined = rows.join(own, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    (joined.repartitionByRange(shuffle_partitions(rows.sparkSession), "shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
