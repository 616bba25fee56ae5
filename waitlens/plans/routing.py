"""Routing checks: misrouted referrals by diagnosis pattern (P34), portfolio
cross-tab (P35) and registry lookup (P38)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.text import split_code_label
from waitlens.operators.aggregates import count_by
from waitlens.operators.joins import scalar
from waitlens.operators.predicates import flag_in, lookup_either, semi_join_in


def diagnosis_pattern(referral_map: DataFrame, *, specialty: str, destination: str) -> DataFrame:
    """Diagnosis codes the map routes to ``destination`` for ``specialty``
    (non-empty, distinct)."""
    m = referral_map.where((F.col("descripcion_especialidad_demandada") == specialty)
                           & (F.col("codigo_deis_establecimiento_destino") == destination)
                           & (F.col("codigo_cie_10_diagnostico_opcional") != ""))
    return m.select("codigo_cie_10_diagnostico_opcional").distinct()


def misrouted(referrals_v2: DataFrame, referral_map: DataFrame, *, specialty: str, destination: str,
              entry_from: str, max_age: int = 15, codes_as_patterns: bool = False) -> DataFrame:
    """Referrals under ``max_age`` of ``specialty`` whose diagnosis text
    contains any code the map sends to another ``destination`` (any case,
    J6 + X2).

    Codes are taken literally, per distinct diagnosis text of the referrals
    left after the filters, or with ``codes_as_patterns`` as regular
    expressions joined by ``|`` (a dot then stands for any character), which
    Spark evaluates per row, below the distinct. An empty code list matches
    nothing."""
    codes = diagnosis_pattern(referral_map, specialty=specialty, destination=destination)
    codes = codes.select(F.col("codigo_cie_10_diagnostico_opcional").alias("_code"))
    df = referrals_v2.where((F.col("edad_sic") < max_age) & (F.col("desc_esp") == specialty)
                            & (F.col("f_entrada") >= F.lit(entry_from).cast("date")))
    texts = df.select(F.col("sospecha_diag").alias("_text")).where(F.col("_text").isNotNull()).distinct()
    hits = texts_matching(texts, codes) if codes_as_patterns else texts_containing(texts, codes)
    df = df.join(hits, F.col("sospecha_diag") == F.col("_text"), "left_semi")
    return df.withColumn("corresponde_destino", F.lit("si"))


def texts_containing(texts: DataFrame, codes: DataFrame) -> DataFrame:
    """The distinct ``_text`` that contain a ``_code`` in any case.

    Every text gives its substrings of the shortest code's length (a scalar
    subquery), which meet the codes by their beginnings of that length: one
    equi-join on a row per character, then the codes of that beginning are
    compared at the place."""
    codes = codes.select(F.upper("_code").alias("_code")).distinct()
    shortest = scalar(codes, F.min(F.length("_code")))
    begins = codes.select("_code", shortest.alias("_k")).groupBy(F.expr("substring(_code, 1, _k)").alias("_part")).agg(
        F.collect_set("_code").alias("_codes"))
    places = texts.select("_text", F.upper("_text").alias("_upper"), shortest.alias("_k")).where(
        F.length("_upper") >= F.col("_k"))
    places = places.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_upper") - F.col("_k") + 1)))
    places = places.withColumn("_part", F.expr("substring(_upper, _at, _k)"))
    found = F.exists("_codes", lambda c: F.substr("_upper", F.col("_at"), F.length(c)) == c)
    return places.join(begins, "_part").where(found).select("_text").distinct()


def texts_matching(texts: DataFrame, codes: DataFrame) -> DataFrame:
    """The ``_text`` that match a ``_code`` read as a regular expression, in
    any case: one alternation (a scalar subquery), compiled once per task."""
    pattern = scalar(codes, F.concat_ws("|", F.sort_array(F.collect_set("_code"))))
    known = texts.withColumn("_pattern", pattern).where(F.col("_pattern") != "")
    return known.where(F.regexp_like("_text", F.concat(F.lit("(?i)"), "_pattern"))).select("_text")


def portfolio_crosstab(enriched: DataFrame, *, network_sites: DataFrame, network: str, portfolio: DataFrame,
                       target_site: str, excluded_site: str, origin_level: str = "Primario",
                       dest_levels: Sequence[str] = ("Secundario", "Terciario")) -> DataFrame:
    """Primary-care referrals of one network to higher levels, by
    whether the diagnosis code is in the target's portfolio and whether the
    referral goes to the target."""
    sites = network_sites.where(F.col("minired") == network).select(F.col("x2").alias("estab_orig"))
    df = semi_join_in(enriched, "estab_orig", sites, "estab_orig")
    df = df.where(F.col("estab_dest") != excluded_site)
    code, label = split_code_label("sospecha_diag")
    df = df.withColumns({"codigo_cie10": code, "glosa_cie10": label}).drop("sospecha_diag")
    df = flag_in(df, "codigo_cie10", portfolio, "codigo", "cartera")
    df = df.withColumn("destino", F.when(F.col("estab_dest") == target_site, F.lit("si")).otherwise(F.lit("no")))
    df = df.where((F.col("nivel_de_atencion_origen") == origin_level)
                  & F.col("nivel_de_atencion_destino").isin(list(dest_levels)))
    return count_by(df, ["destino", "cartera"])


def diagnosis_split(enriched: DataFrame) -> DataFrame:
    """D10 on its own: code and label of every referral's diagnosis."""
    code, label = split_code_label("sospecha_diag")
    return enriched.select("sigte_id", "sospecha_diag", code.alias("codigo_cie10"), label.alias("glosa_cie10"))


def registry_lookup(registry: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """Registry rows whose either identifier is one of ``ids``."""
    return lookup_either(registry, ids, id_column, "rut", "rut_paciente")
