"""Sinks (S12): publish result tables as Parquet or CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """``export(df, path)``. Files are written by the executors in parallel;
    ``partition_by`` (for example the year) lets readers prune folders, and
    ``sort_by`` orders rows inside each task's files (no shuffle) so that the
    Parquet min/max statistics let equality filters skip row groups."""
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
