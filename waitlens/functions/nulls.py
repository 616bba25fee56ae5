"""Aggregates and predicates that follow R's missing-value rules.

Spark aggregates skip nulls; R's ``sum``/``mean`` without ``na.rm`` return NA as
soon as one input is NA, and ``sum(na.rm=TRUE)`` of nothing is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c: Column | str) -> Column:
    """``sum(x)``: null if any input row is null (N2). Also valid over a window
    frame, which gives R's ``cumsum`` that stays NA after the first NA (N4)."""
    x = _col(c)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def lenient_sum(c: Column | str) -> Column:
    """``sum(x, na.rm=TRUE)``: nulls skipped, 0 when every input is null."""
    x = _col(c)
    return F.coalesce(F.sum(x), F.lit(0))


def strict_mean(c: Column | str) -> Column:
    """``mean(x)``: null if any input row is null."""
    x = _col(c)
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def strict_median(c: Column | str) -> Column:
    """``median(x)``: null if any input row is null."""
    x = _col(c)
    return F.when(F.count(x) == F.count(F.lit(1)), F.median(x))


def keep_null_not_rlike(c: Column | str, pattern: str) -> Column:
    """``!grepl(pattern, x)``: true for null ``x`` (N5), unlike ``NOT rlike``."""
    return ~F.coalesce(_col(c).rlike(pattern), F.lit(False))
