"""Helpers shared by the operators: tables, the shared folder, lineage cuts and token rules."""

from __future__ import annotations

import os
import tempfile
import uuid
from itertools import accumulate
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the files are installed alike on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it
    is unset, a local session gets a scratch folder of its own and any other fails."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="checkpoints-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return base


def mounted_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, as a path that ``open`` takes on every machine:
    the shared folder has to be a mount for operators that memory-map files."""
    url = urlparse(shared_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {url.scheme}://")
    path = os.path.join(url.path, f"{name}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


#: rows of a checkpoint's file, where their number is known beforehand
FILE_ROWS = 50_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Computes ``df`` once into the shared folder (reliable checkpoint) and goes on from there.
    ``rows``: about how many rows it has; they go to as many files as they fill, not to one of each
    shuffle partition (a file costs several processes of the executor). The last step of ``df`` then
    runs in as many tasks, so it must be a light one."""
    shared_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))).checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as compressed columns, of which later steps read those they need."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(rows: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one column, so that no other column's name can clash."""
    return rows.select("doc_id", "text", F.struct("*").alias("_row"))


def unpacked(rows: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns that ``packed`` put away, with another text if given."""
    names = rows.schema["_row"].dataType.names
    return rows.select(*[text.alias(n) if n == "text" and text is not None else F.col("_row")[n].alias(n) for n in names])


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows``, computed once, with their number (from 0) in ``order`` as a long column ``name``."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *order)
    dealt = cut(dealt.withColumn("_range", F.spark_partition_id()))
    counts = sorted(dealt.groupBy("_range").count().collect())  # one row per partition
    before = [0, *accumulate(n for _, n in counts)]
    offsets = spark.createDataFrame([(r, before[i]) for i, (r, _) in enumerate(counts)], "_range int, _before long")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    ranked = dealt.withColumn("_inside", inside).join(F.broadcast(offsets), "_range")  # as many rows as partitions
    return ranked.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)
