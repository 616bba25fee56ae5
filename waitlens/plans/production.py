"""Monthly production (REM series A): sections A and A1 (P3, P4), their
combination (P5) and the production summary per specialty (P26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.nulls import strict_sum
from waitlens.functions.numeric import round_half_even
from waitlens.operators.columns import clean_columns, rename, select_unique
from waitlens.operators.joins import join_keys
from waitlens.operators.predicates import semi_join_in

# Fixed values of the reference: column lists and measure names of the two sections.
SECTION_A_COLUMNS = ("mes", "ano", "id_establecimiento", "codigo_prestacion", "id_region", "id_region", "id_comuna",
                     "col01", "col19", "col20", "col21", "col22", "col26")
SECTION_A_NAMES = {"col01": "total_consultas", "col19": "total_beneficiarios", "col20": "sexo_hombres",
                   "col21": "sexo_mujeres", "col22": "consultas_menores15", "col26": "consultas_mayores"}
SECTION_A1_COLUMNS = ("mes", "id_servicio", "ano", "id_establecimiento", "codigo_prestacion", "id_region", "id_region",
                      "id_comuna", "col01", "col02", "col09", "col10", "col13", "col16", "col17", "col20", "col21")
SECTION_A1_NAMES = {"col01": "pertinentes", "col02": "pertinentes_aps", "col09": "pertinentes_box",
                    "col10": "pertinentes_box_aps", "col13": "cr_inicial", "col16": "cr_alta_menor15",
                    "col17": "cr_alta_mayor15", "col20": "nsp_nuevas", "col21": "nsp_controles"}
JOIN_KEYS = ("id_establecimiento", "codigosigte", "mes", "ano", "id_region", "id_comuna")


def _section(rem: DataFrame, *, service: int, codes: Sequence[str], sites: Sequence[str] | None,
             columns, names, specs: DataFrame, spec_code: str) -> DataFrame:
    df = clean_columns(rem)
    cond = (F.col("id_servicio") == service) & F.col("codigo_prestacion").isin(list(codes))
    if sites is not None:
        cond = cond & F.col("id_establecimiento").isin(list(sites))
    df = rename(select_unique(df.where(cond), columns), names)
    return join_keys(df, specs.select(spec_code, "codigosigte"), {"codigo_prestacion": spec_code})


def section_a(rem: DataFrame, *, specs: DataFrame, service: int, codes: Sequence[str],
              sites: Sequence[str] | None = None) -> DataFrame:
    """Visits, beneficiaries, sex, under/over 15 per site, code, month."""
    return _section(rem, service=service, codes=codes, sites=sites, columns=SECTION_A_COLUMNS,
                    names=SECTION_A_NAMES, specs=specs, spec_code="id_esp_seccion_a")


def section_a1(rem: DataFrame, *, specs: DataFrame, service: int, codes: Sequence[str],
               sites: Sequence[str] | None = None) -> DataFrame:
    """Pertinence, counter-referral and no-show measures."""
    return _section(rem, service=service, codes=codes, sites=sites, columns=SECTION_A1_COLUMNS,
                    names=SECTION_A1_NAMES, specs=specs, spec_code="id_esp_seccion_b")


def combined(sec_a: DataFrame, sec_a1: DataFrame) -> DataFrame:
    """P5: section A with section A1 on site, specialty, month, year, region,
    commune. Null keys pair up (N1): rows of codes without a specialty meet
    each other, as in the reference. Both sections aggregate the same site and
    month, so Spark co-partitions them on the keys in one shuffle each."""
    a = sec_a.withColumnRenamed("codigo_prestacion", "codigo_prestacion_x")
    a1 = sec_a1.withColumnRenamed("codigo_prestacion", "codigo_prestacion_y")
    out = join_keys(a, a1, list(JOIN_KEYS), null_safe=True)
    return out.withColumn("id_establecimiento", F.col("id_establecimiento").cast("string"))


def summary(production: DataFrame, *, subset: DataFrame, site: str) -> DataFrame:
    """Production of one site for a list of specialties: totals, new
    visits and their share, follow-ups, no-shows. Strict sums (N2); a zero
    total gives a null share (N8)."""
    df = semi_join_in(production, "codigo_prestacion_x", subset, "id_esp_seccion_a")
    df = df.where(F.col("id_establecimiento") == site).withColumns({
        "total_cne": F.col("consultas_mayores") + F.col("consultas_menores15"),
        "total_nsp": F.col("nsp_nuevas") + F.col("nsp_controles"),
    })
    df = join_keys(df.select("codigosigte", "total_consultas", "total_cne", "total_nsp", "nsp_nuevas"),
                   subset.select("codigosigte", "desc_esp"), ["codigosigte"])
    out = df.groupBy("codigosigte", "desc_esp").agg(
        strict_sum("total_consultas").alias("produccion_total"), strict_sum("total_cne").alias("produccion_cne"),
        strict_sum("total_nsp").alias("produccion_nsp_total"), strict_sum("nsp_nuevas").alias("produccion_nsp_cne"))
    return out.withColumns({
        "proporcion_cne": round_half_even(F.try_divide(F.col("produccion_cne"), F.col("produccion_total")), 2),
        "produccion_control": F.col("produccion_total") - F.col("produccion_cne"),
    }).select("codigosigte", "desc_esp", "produccion_total", "produccion_cne", "proporcion_cne",
              "produccion_control", "produccion_nsp_total", "produccion_nsp_cne")


def grain_report(combined_df: DataFrame) -> DataFrame:
    """Production keys that the section join multiplied (more than one
    row per site, specialty, month and year), with their row count. Codes
    without a specialty pair with each other (N1); this report shows where."""
    keys = ["id_establecimiento", "codigosigte", "mes", "ano"]
    return combined_df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas")).where(F.col("filas") > 1)
