"""Latest dates of the waiting lists, kept as a small table next to them.

The as-of date of an enrichment is the latest entry or exit of its rows. With the latest dates per
service type, origin, destination and state, which are as many rows as sites allow, it is read from
this table instead of from the list a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.operators.predicates import all_of, in_values
from waitlens.operators.reshape import union_all

KEYS = ("tipo_prest", "estab_orig", "estab_dest")


def latest_dates(rows: DataFrame, name: str) -> DataFrame:
    """lista, the keys, abierta (no exit yet), latest entry, latest exit and number of referrals."""
    keys = [F.col("tipo_prest")] + [F.col(k).cast("string").alias(k) for k in KEYS[1:]]
    return rows.groupBy(F.lit(name).alias("lista"), *keys, F.col("f_salida").isNull().alias("abierta")).agg(
        F.max("f_entrada").alias("ultima_entrada"), F.max("f_salida").alias("ultima_salida"), F.count(F.lit(1)).alias("n"))


def list_statistics(open_list: DataFrame, closed_list: DataFrame) -> DataFrame:
    return union_all([latest_dates(open_list, "open_list"), latest_dates(closed_list, "closed_list")])


def as_of(statistics: DataFrame, *, service: Sequence[int] | int | None = None, sites: Sequence[str] | str | None = None,
          site_role: str = "orig", open_only: bool | None = None) -> Column:
    """As-of date of a list's rows under these filters, as a scalar subquery on its statistics."""
    rows = statistics.where(all_of([
        in_values("tipo_prest", service), in_values(f"estab_{site_role}", [sites] if isinstance(sites, str) else sites),
        F.col("abierta") if open_only else None]))
    return rows.select(F.greatest(F.max("ultima_entrada"), F.max("ultima_salida"))).scalar()
