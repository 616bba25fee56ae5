"""Rounding and division with R's results.

``round`` in R rounds the double half to even; ``rint`` on the scaled double
gives the same answer (Spark's ``bround`` rounds the decimal text instead and
differs on values such as 23/40 = 0.575, stored just below 0.575). Division by
zero gives Inf/NaN in R and an error under ANSI Spark; here it gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    """R's ``round(x, digits)`` on doubles."""
    x = _col(c).cast("double")
    if digits == 0:
        return F.rint(x)
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def safe_ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """``round(ifelse(d == 0 | is.na(d), NA, n / d), digits)``."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    ratio = F.when(d != 0, n / d)
    return ratio if digits is None else round_half_even(ratio, digits)


def mean_of_rounded(c: Column | str, digits: int = 2) -> Column:
    """Mean of values that are already rounded to ``digits`` decimals (shares
    and ratios made by ``round_half_even``), nulls skipped.

    The mean is taken on the scaled integers, whose sum is exact in any
    order, so every engine and every partitioning gives the same double."""
    scale = float(10 ** digits)
    return F.avg(F.rint(_col(c) * F.lit(scale))) / F.lit(scale)
