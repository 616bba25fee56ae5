"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.text import clean_name, clean_names


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``count(k1, k2) |> rename(name = n)`` (A1, A2). Null is a group.
    Spark counts per partition first, so a key holding a third of the rows
    is reduced before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def pivot_values(dimension: DataFrame, column: str, limit: int = 200) -> dict[str, str]:
    """``{value: column name}`` for a pivot over the values of a dimension, by
    value; names are cleaned and unique (N14). Raises above ``limit`` values: a
    pivot of that many columns is a mistake."""
    rows = dimension.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} different values in {column}: too many for columns")
    values = sorted(r.v for r in rows)
    return dict(zip(values, clean_names(values), strict=True))


def pivot_counts(df: DataFrame, keys: Sequence[str], pivot_column: str,
                 values: Sequence[str] | Mapping[str, str], total: str | None = None, rest: str | None = None) -> DataFrame:
    """``count |> pivot_wider(values_fill = 0) |> clean_names``.

    The value list is fixed (from the dimension), so the columns do not depend
    on the data and no extra job is needed to find them. One conditional count
    per value in a single aggregation: one shuffle, partial aggregation before
    it. Missing combinations are 0. ``total`` counts every row of the group,
    including rows whose value is not in the list (R's row sum over all the
    pivoted columns, NA column included); ``rest`` counts those alone."""
    names = dict(values) if isinstance(values, Mapping) else {v: clean_name(v) for v in values}
    aggs = [F.count_if(F.col(pivot_column) == F.lit(v)).alias(n) for v, n in names.items()]
    if rest:
        known = F.coalesce(F.col(pivot_column).isin(list(names)), F.lit(False))
        aggs.append(F.count_if(~known).alias(rest))
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    return df.groupBy(*keys).agg(*aggs)
