"""Filters and predicates."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.functions.nulls import keep_null_not_rlike


def all_of(predicates: Iterable[Column | None]) -> Column:
    """AND of the given predicates; ``None`` entries are skipped."""
    preds = [p for p in predicates if p is not None]
    return functools.reduce(lambda a, b: a & b, preds, F.lit(True))


def in_values(c: str | Column, values: Sequence | None) -> Column | None:
    """``x %in% values`` or no predicate when ``values`` is None."""
    if values is None:
        return None
    if isinstance(values, (str, int, float)):
        values = [values]
    col = F.col(c) if isinstance(c, str) else c
    return col.isin(list(values))


def at_least(c: str, value) -> Column | None:
    """``c >= value``, or no predicate when ``value`` is None."""
    return None if value is None else F.col(c) >= F.lit(value)


def at_most(c: str, value) -> Column | None:
    """``c <= value``, or no predicate when ``value`` is None."""
    return None if value is None else F.col(c) <= F.lit(value)


def between_dates(c: str, start: str | None = None, end: str | None = None,
                  end_inclusive: bool = False) -> Column:
    """Date range, half-open by default (F8). Literal dates fold to constants
    and reach the Parquet scan as pushed filters."""
    col = F.col(c)
    preds = []
    if start is not None:
        preds.append(col >= F.lit(start).cast("date"))
    if end is not None:
        end_d = F.lit(end).cast("date")
        preds.append(col <= end_d if end_inclusive else col < end_d)
    return all_of(preds)


def still_waiting_at(entry: str, exit_: str, at: str) -> Column:
    """Entered before ``at`` and not out before it."""
    d = F.lit(at).cast("date")
    return (F.col(entry) < d) & ((F.col(exit_) >= d) | F.col(exit_).isNull())


def exclude_pattern_keep_null(c: str, pattern: str) -> Column:
    """``!grepl(pattern, x)``: null ``x`` stays in."""
    return keep_null_not_rlike(c, pattern)


def contains_ignore_case(c: str, text: str) -> Column:
    """``grepl(text, x, ignore.case=TRUE)``; null ``x`` drops out."""
    return F.col(c).rlike("(?i)" + text)


def semi_join_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``x %in% other$col`` as a left-semi join (F3). The right side is a key
    list; Spark broadcasts it when its estimate is under the threshold and uses
    a shuffle join otherwise. Null keys never match, as in R ``%in%`` on NA
    against a list without NA."""
    keys = other.select(F.col(other_column).alias("_semi_key")).where(F.col("_semi_key").isNotNull())
    return df.join(keys, F.col(column) == F.col("_semi_key"), "left_semi")


def flag_in(df: DataFrame, column: str, other: DataFrame, other_column: str,
            flag: str, yes: str = "si", no: str = "no") -> DataFrame:
    """``case_when(x %in% other$col ~ yes, TRUE ~ no)`` as a column (F3): a left
    join to the distinct keys, so no row is multiplied."""
    keys = (other.select(F.col(other_column).alias("_flag_key")).where(F.col("_flag_key").isNotNull())
            .distinct().withColumn("_flag_hit", F.lit(True)))
    joined = df.join(keys, F.col(column) == F.col("_flag_key"), "left")
    return joined.withColumn(flag, F.when(F.col("_flag_hit"), F.lit(yes)).otherwise(F.lit(no))) \
                 .drop("_flag_key", "_flag_hit")


def lookup_either(registry: DataFrame, ids: DataFrame, id_column: str,
                  first: str, second: str) -> DataFrame:
    """Registry rows whose ``first`` or ``second`` identifier is in ``ids``.

    Two semi joins over the registry instead of one OR condition, which Spark
    could only run as a nested-loop join. Each semi join can be given a Bloom
    filter of the ids at run time, so that only rows that may match are
    shuffled; the few found by the second identifier are then cleared of
    those the first one found already."""
    keys = ids.select(F.col(id_column).alias("_id")).where(F.col("_id").isNotNull())
    by_first = registry.join(keys, F.col(first) == F.col("_id"), "left_semi")
    by_second = registry.join(keys, F.col(second) == F.col("_id"), "left_semi").join(keys, F.col(first) == F.col("_id"), "left_anti")
    return by_first.unionByName(by_second)
