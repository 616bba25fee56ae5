"""Joins (J1-J8) with R's key semantics.

No join is hinted: Spark broadcasts a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a shuffle join,
and adaptive execution re-checks the real size at run time. A one-row value
needed by every row is a scalar subquery (``scalar``), not a join.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeySpec = Sequence[str] | Mapping[str, str]


def _pairs(on: KeySpec) -> list[tuple[str, str]]:
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def join_keys(left: DataFrame, right: DataFrame, on: KeySpec, how: str = "left",
              null_safe: bool = False) -> DataFrame:
    """``left_join(l, r, by = c(a = 'b', 'k'))``.

    Right key columns are dropped, as dplyr keeps only the left ones. With
    ``null_safe`` null keys pair with null keys (dplyr's default, N1); Spark
    still plans an equi-join on ``<=>`` keys. Non-key columns must not clash;
    rename them first (N13)."""
    pairs = _pairs(on)
    tag = "_r_"
    right_renamed = right.select(*[F.col(c).alias(tag + c) for c in right.columns])
    conds = []
    for lk, rk in pairs:
        l, r = left[lk], F.col(tag + rk)
        conds.append(l.eqNullSafe(r) if null_safe else l == r)
    cond = functools.reduce(lambda a, b: a & b, conds)
    joined = left.join(right_renamed, cond, how)
    right_keys = {rk for _, rk in pairs}
    keep_right = [c for c in right.columns if c not in right_keys]
    clash = set(keep_right) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}; rename them first")
    return joined.select(*[left[c] for c in left.columns], *[F.col(tag + c).alias(c) for c in keep_right])


def role_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              columns: Mapping[str, str]) -> DataFrame:
    """One role of a role-playing dimension (J2): left join on ``fact_key`` and
    bring ``columns`` as ``{dim_column: new_name}``."""
    sub = dim.select(F.col(dim_key), *[F.col(c).alias(n) for c, n in columns.items()])
    return join_keys(fact, sub, {fact_key: dim_key})


def assert_unique(dim: DataFrame, keys: Sequence[str], name: str = "dimension") -> None:
    """Fail when ``keys`` repeat in ``dim`` (N12): a duplicated dimension key
    would multiply fact rows silently in every left join. Run once when a
    dimension is published (one aggregate job over the dimension), not inside
    each query, where the optimizer would prune an unused check anyway."""
    dup = dim.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicated key {list(keys)} in {name}: {dup[0].asDict()}")


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate of ``df`` as a scalar subquery column.

    Spark runs the subquery once and inlines the value, so the scalar reaches
    every row without a cross join or a driver collect."""
    return df.select(expr).scalar()
