"""Projection and column operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.text import clean_names


def clean_columns(df: DataFrame) -> DataFrame:
    """Normalise every header (D1). Metadata only: no data is touched."""
    return df.toDF(*clean_names(df.columns))


def select_unique(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep columns from a name vector; repeated names collapse (D3)."""
    return df.select(*dict.fromkeys(names))


def _expand(spec: Sequence[int | range]) -> list[int]:
    out: list[int] = []
    for item in spec:
        out.extend(item if isinstance(item, range) else [item])
    return out


def select_positions(df: DataFrame, positions: Sequence[int | range],
                     exclude: Iterable[str] = ()) -> DataFrame:
    """Columns by 1-based position, then minus some names (D5):
    ``select(1, 5, 8:12, -x)`` is ``select_positions(df, [1, 5, range(8, 13)], ['x'])``."""
    cols = df.columns
    picked = [cols[i - 1] for i in dict.fromkeys(_expand(positions))]
    drop = set(exclude)
    return df.select(*[c for c in picked if c not in drop])


def rename_position(df: DataFrame, position: int, new_name: str) -> DataFrame:
    """``rename('new' = position)``."""
    names = list(df.columns)
    names[position - 1] = new_name
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``rename(new = old)`` given as ``{old: new}``."""
    return df.withColumnsRenamed(dict(mapping))


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = True) -> DataFrame:
    """``as.character`` / ``as.numeric`` (D7). ``lenient`` turns values that do not
    parse into null, like R, instead of failing the query (N9)."""
    exprs = {c: (F.col(c).try_cast(t) if lenient else F.col(c).cast(t)) for c, t in types.items()}
    return df.withColumns(exprs)
