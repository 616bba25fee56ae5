"""Sort, top-k and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_name: str | None = None) -> DataFrame:
    """``slice_max(n = k, with_ties = FALSE)`` (W2, W3). ``order`` must end in a
    tie-break so the result is deterministic (N15). Spark plans a per-partition
    group limit before the shuffle, so a large group sends at most ``n`` rows
    per task."""
    w = Window.partitionBy(*group).orderBy(*order)
    name = rank_name or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_name else out.drop(name)


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Order of a category inside its group (W5): ``fct_reorder`` as a rank."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column,
                  start: Column, name: str) -> DataFrame:
    """``start + cumsum(value)`` per group in ``order`` (W1). The cumulative sum
    turns null at the first null value and stays null (N4). ``order`` has to
    end in a tie-break where a group has several rows of one month (several
    production codes of a specialty). The input is aggregated by month, so a
    window partition is bounded by months and codes, whatever the number of
    referrals behind it."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cum = F.when(F.count(value).over(w) == F.count(F.lit(1)).over(w), F.sum(value).over(w))
    return df.withColumn(name, start + cum)
