"""Analyses over dated snapshots of the waiting lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.operators.predicates import still_waiting_at
from waitlens.operators.reshape import union_all


def open_at(open_list: DataFrame, closed_list: DataFrame, *, at: str) -> DataFrame:
    """The open list as it was at ``at`` (F9): referrals entered before it and not out before it; what
    happened later (exit, reason) is not known yet."""
    rows = union_all([open_list, closed_list]).where(still_waiting_at("f_entrada", "f_salida", at))
    return rows.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in ("f_salida", "c_salida")})


def backlog_by_date(snapshots: DataFrame, *, service: int, keys: Sequence[str] = ("fecha_corte", "estab_dest")) -> DataFrame:
    """Referrals waiting, of how many persons, and the longest wait in days, per snapshot and site."""
    rows = snapshots.where(F.col("tipo_prest") == service)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("en_espera"), F.count_distinct("run").alias("personas"),
                                   F.max(F.datediff("fecha_corte", "f_entrada")).alias("espera_maxima"))


def flow(snapshots: DataFrame, *, before: str, after: str, service: int,
         keys: Sequence[str] = ("estab_dest", "presta_min")) -> DataFrame:
    """What became of the list between two snapshots, per site and specialty: referrals that stayed,
    left, came in, or moved to other ``keys`` (counted where they came from and where they are now).

    One aggregation by referral over both snapshots instead of a full join of them, then one by the
    keys; both reduce rows in each task first. Referrals without an id cannot be followed and are left out."""
    first, last = F.lit(dt.date.fromisoformat(before)), F.lit(dt.date.fromisoformat(after))
    place = F.struct(*keys)
    rows = snapshots.where((F.col("tipo_prest") == service) & F.col("fecha_corte").isin([dt.date.fromisoformat(d) for d in (before, after)])
                           & F.col("sigte_id").isNotNull())
    each = rows.groupBy("sigte_id").agg(
        F.max(F.when(F.col("fecha_corte") == first, F.struct(place.alias("p")))).alias("a"),
        F.max(F.when(F.col("fecha_corte") == last, F.struct(place.alias("p")))).alias("b"))
    stayed = F.col("a").isNotNull() & F.col("b").isNotNull() & F.col("a").eqNullSafe(F.col("b"))
    moved = F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))
    kinds = F.array(
        F.when(stayed, F.struct(F.lit("siguen").alias("k"), F.col("a.p").alias("p"))),
        F.when(moved, F.struct(F.lit("movidas_desde").alias("k"), F.col("a.p").alias("p"))),
        F.when(moved, F.struct(F.lit("movidas_hacia").alias("k"), F.col("b.p").alias("p"))),
        F.when(F.col("b").isNull(), F.struct(F.lit("salen").alias("k"), F.col("a.p").alias("p"))),
        F.when(F.col("a").isNull(), F.struct(F.lit("entran").alias("k"), F.col("b.p").alias("p"))))
    seen = each.select(F.explode(F.array_compact(kinds)).alias("e")).select("e.k", "e.p.*")
    names = ("siguen", "salen", "entran", "movidas_desde", "movidas_hacia")
    return seen.groupBy(*keys).agg(*[F.count_if(F.col("k") == n).alias(n) for n in names])
