"""Dimensions: establishments (P1) and the person registry.

Dimension keys are checked for duplicates when the tables are published
(``sources.catalog.publish``), so the joins here are many-to-one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.text import strip_last_char
from waitlens.operators.columns import clean_columns
from waitlens.operators.joins import join_keys

ESTABLISHMENT_COLUMNS = ("codigo_vigente", "codigo_antiguo", "nombre_oficial", "codigo_comuna", "nombre_comuna",
                         "nivel_de_atencion", "nombre_dependencia_jerarquica_seremi_servicio_de_salud",
                         "nivel_de_complejidad")
NETWORK_COLUMN = "nombre_dependencia_jerarquica_seremi_servicio_de_salud"


def abbreviations(raw: DataFrame) -> DataFrame:
    """Site abbreviations with the site code as text."""
    df = clean_columns(raw)
    return df.withColumn("codigo_vigente", F.col("codigo_vigente").cast("string"))


def establishment_sites(raw: DataFrame, *, network: str | None = None) -> DataFrame:
    """P1 without the abbreviation: clean headers, keep 8 columns, one
    network. The site roles of the referral enrichment read only these."""
    df = clean_columns(raw).select(*ESTABLISHMENT_COLUMNS) \
        .withColumn("codigo_vigente", F.col("codigo_vigente").cast("string"))
    if network is not None:
        df = df.where(F.col(NETWORK_COLUMN) == F.lit(network))
    return df


def establishments(raw: DataFrame, abbrev: DataFrame, *, network: str | None = None) -> DataFrame:
    """Clean headers, keep 8 columns, one network, add the abbreviation."""
    return join_keys(establishment_sites(raw, network=network), abbreviations(abbrev), ["codigo_vigente"])


def specialties(raw: DataFrame) -> DataFrame:
    """Specialty dimension with cleaned headers."""
    return clean_columns(raw)


def exit_reasons(raw: DataFrame) -> DataFrame:
    """Exit reasons with the reason code as text."""
    return raw.withColumn("n", F.col("n").cast("string"))


def registry(raw: DataFrame) -> DataFrame:
    """Rows with at least one identifier; identifiers without check digit."""
    df = clean_columns(raw).select("rut_paciente", "rut", "apellido_paterno", "consultorio_inscripcion",
                                   "comuna_establecimiento_id", "comuna_establecimiento")
    df = df.where(F.col("rut_paciente").isNotNull() | F.col("rut").isNotNull())
    return df.withColumns({"rut_paciente_sdv": strip_last_char("rut_paciente"), "rut_sdv": strip_last_char("rut")})
