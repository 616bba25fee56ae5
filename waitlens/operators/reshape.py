"""Reshaping and set operations."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``rbind`` (same names required) or ``bind_rows`` (missing columns null).
    Duplicates are kept (U1, U2)."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def longer(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
           names_to: str = "name", values_to: str = "value") -> DataFrame:
    """``pivot_longer(cols, names_to, values_to)``."""
    return df.unpivot(list(ids), list(columns), names_to, values_to)
