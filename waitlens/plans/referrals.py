"""Waiting-list enrichment (P6-P9) and list extracts.

One function serves the reference's three variants: the site filter applies
to the origin (V1) or the destination (V2, V3), the as-of date for open
referrals is the latest entry or exit of the filtered rows (V1) or of the raw
input (V2), and dental codes (``^09``) can be left out keeping null codes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.functions.dates import completed_years, days_between
from waitlens.operators.columns import clean_columns
from waitlens.operators.joins import join_keys, role_join, scalar
from waitlens.operators.predicates import all_of, at_least, at_most, between_dates, exclude_pattern_keep_null, in_values
from waitlens.operators.reshape import union_all
from waitlens.sources.statistics import as_of as statistics_as_of

# Fixed values of the reference: output columns of the three enrichment
# variants, and the prefix of dental specialty codes they leave out.
V1_COLUMNS = ("run", "dv", "sexo", "fecha_nac", "estab_orig", "establecimiento_origen", "codigo_comuna",
              "nombre_comuna", "nivel_de_atencion_origen", "f_entrada", "tipo_prest", "presta_min",
              "sospecha_diag", "estab_dest", "establecimiento_destino", "presta_est", "f_salida", "c_salida",
              "abrev_destino", "nivel_de_atencion_destino", "sigte_id", "id_local")
V2_COLUMNS = ("run", "dv", "sexo", "fecha_nac", "estab_orig", "codigo_comuna", "nivel_de_atencion_origen",
              "f_entrada", "tipo_prest", "presta_min", "sospecha_diag", "estab_dest", "presta_est", "f_salida",
              "c_salida", "abrev_destino", "nivel_de_atencion_destino")
V3_COLUMNS = ("run", "dv", "sexo", "fecha_nac", "estab_orig", "codigo_comuna", "f_entrada", "tipo_prest",
              "presta_min", "sospecha_diag", "estab_dest", "presta_est", "f_salida", "c_salida", "abrev_destino")
DENTAL_PREFIX = "^09"


def _prepare(raw: DataFrame) -> DataFrame:
    return clean_columns(raw).withColumns({c: F.col(c).cast("string") for c in ("estab_dest", "estab_orig", "c_salida")})


def _attach_dimensions(df: DataFrame, estab: DataFrame, abbrev: DataFrame) -> DataFrame:
    """Both site roles and the destination abbreviation (J2). The dimensions
    are a few thousand rows at most; Spark broadcasts them."""
    df = role_join(df, estab, "estab_dest", "codigo_vigente",
                   {"nombre_oficial": "establecimiento_destino", "nivel_de_atencion": "nivel_de_atencion_destino"})
    df = role_join(df, estab, "estab_orig", "codigo_vigente",
                   {"nombre_oficial": "establecimiento_origen", "codigo_comuna": "codigo_comuna",
                    "nombre_comuna": "nombre_comuna", "nivel_de_atencion": "nivel_de_atencion_origen"})
    return role_join(df, abbrev, "estab_dest", "codigo_vigente", {"abreviacion": "abrev_destino"})


def _attach_names(df: DataFrame, specs: DataFrame, reasons: DataFrame) -> DataFrame:
    """Specialty name and exit reason, each joined once (the reference joins
    the specialty twice, which only multiplies rows when codes repeat)."""
    df = join_keys(df, specs.select("codigosigte", "desc_esp"), {"presta_min": "codigosigte"})
    return join_keys(df, reasons.select("n", "causal"), {"c_salida": "n"})


def _latest_date(rows: DataFrame) -> Column:
    """As-of date of some rows as a scalar subquery (J7): computed once, no
    cross join, nothing collected."""
    return scalar(rows, F.greatest(F.max("f_entrada"), F.max("f_salida")))


def _wait_and_age(df: DataFrame, as_of: Column) -> DataFrame:
    """Waiting days to the exit, or to the as-of date for open referrals, and
    age at entry in completed years."""
    df = df.withColumn("f_salida_o_maxima", F.coalesce(F.col("f_salida"), as_of))
    return df.withColumns({
        "tiempo_espera": days_between("f_entrada", "f_salida_o_maxima"),
        "edad_sic": completed_years("fecha_nac", "f_entrada"),
    })


def enrich_referrals(raw: DataFrame, *, estab: DataFrame, specs: DataFrame, abbrev: DataFrame,
                     reasons: DataFrame, service: Sequence[int] | int | None = None,
                     sites: Sequence[str] | str | None = None, site_role: str = "orig",
                     entry_from: str | None = None, entry_to: str | None = None,
                     exit_from: str | None = None, exit_to: str | None = None,
                     open_only: bool | None = None, exclude_dental: bool = False,
                     as_of: str = "filtered", statistics: DataFrame | None = None) -> DataFrame:
    """P6 (V1) and, with ``site_role='dest'``, ``exclude_dental`` and
    ``as_of='input'``, P8 (V2). Returns the V1 columns plus specialty name,
    exit reason, as-of exit, waiting days and age.

    The filters use referral columns only, so they run on the raw rows
    before any join; the dimension joins are many-to-one (keys checked at
    publish), so the as-of date of the filtered rows is taken before them.
    With the list's ``statistics`` (``sources.statistics``) the as-of date
    comes from that small table and the list is scanned once; filters by date
    or specialty code are not in its keys, so there the rows are read."""
    raw = _prepare(raw)
    site_col = {"orig": "estab_orig", "dest": "estab_dest"}[site_role]
    filtered = raw.where(all_of([
        in_values("tipo_prest", service),
        in_values(site_col, [sites] if isinstance(sites, str) else sites),
        at_least("f_entrada", entry_from and F.lit(entry_from).cast("date")),
        at_most("f_entrada", entry_to and F.lit(entry_to).cast("date")),
        at_least("f_salida", exit_from and F.lit(exit_from).cast("date")),
        at_most("f_salida", exit_to and F.lit(exit_to).cast("date")),
        F.col("f_salida").isNull() if open_only else None,
        exclude_pattern_keep_null("presta_min", DENTAL_PREFIX) if exclude_dental else None,
    ]))
    df = _attach_dimensions(filtered, estab, abbrev).select(*V1_COLUMNS)
    df = _attach_names(df, specs, reasons)
    if as_of == "input":
        return _wait_and_age(df, _latest_date(raw) if statistics is None else statistics_as_of(statistics))
    by_date = any(d is not None for d in (entry_from, entry_to, exit_from, exit_to))
    if statistics is None or by_date or exclude_dental:
        return _wait_and_age(df, _latest_date(filtered))
    return _wait_and_age(df, statistics_as_of(statistics, service=service, sites=sites, site_role=site_role, open_only=open_only))


def refiltered(enriched: DataFrame, *, service: Sequence[int] | int | None = None, sites: Sequence[str] | str | None = None,
               entry_from: str | None = None, entry_to: str | None = None, exit_from: str | None = None,
               exit_to: str | None = None) -> DataFrame:
    """P6 and P42 from a list enriched before with weaker filters: the dimension
    columns of a referral do not depend on the filters, only the as-of date
    does, so the rows left are given theirs again and no dimension is joined."""
    rows = enriched.where(all_of([
        in_values("tipo_prest", service), in_values("estab_orig", [sites] if isinstance(sites, str) else sites),
        between_dates("f_entrada", entry_from, entry_to, end_inclusive=True),
        between_dates("f_salida", exit_from, exit_to, end_inclusive=True)]))
    return _wait_and_age(rows.drop("f_salida_o_maxima", "tiempo_espera", "edad_sic"), _latest_date(rows))


def enrich_referrals_v2(raw: DataFrame, *, site: str, service: int, **dims) -> DataFrame:
    """Destination site and service type, dental codes out (nulls kept),
    as-of date from the raw input."""
    df = enrich_referrals(raw, service=service, sites=site, site_role="dest", exclude_dental=True,
                          as_of="input", **dims)
    return df.select(*V2_COLUMNS, "desc_esp", "causal", "f_salida_o_maxima", "tiempo_espera", "edad_sic")


def v2_from_enriched(enriched_all: DataFrame, *, site: str, service: int) -> DataFrame:
    """P8 taken from a list already enriched without filters: with no filter
    its as-of date is the one of the raw input, which is what V2 uses, so
    selecting the V2 rows and columns gives the same result without joining
    the dimensions again."""
    df = enriched_all.where((F.col("estab_dest") == site) & (F.col("tipo_prest") == service)
                            & exclude_pattern_keep_null("presta_min", DENTAL_PREFIX))
    return df.select(*V2_COLUMNS, "desc_esp", "causal", "f_salida_o_maxima", "tiempo_espera", "edad_sic")


def open_closed_union(open_raw: DataFrame, closed_raw: DataFrame, *, statistics: DataFrame | None = None, **kwargs) -> DataFrame:
    """Open part keeps null exits only, closed part is not filtered on the
    exit; each part has its own as-of date; rows bound by name (U2). With the
    lists' ``statistics`` each list is scanned once."""
    def of(name: str) -> DataFrame | None:
        return None if statistics is None else statistics.where(F.col("lista") == name)

    opened = enrich_referrals(open_raw, open_only=True, statistics=of("open_list"), **kwargs)
    closed = enrich_referrals(closed_raw, open_only=False, statistics=of("closed_list"), **kwargs)
    return union_all([opened, closed], allow_missing=True)


def enrich_exits(raw: DataFrame, *, estab: DataFrame, specs: DataFrame, abbrev: DataFrame,
                 reasons: DataFrame, service: int, sites: Sequence[str] | str | None = None) -> DataFrame:
    """P9 (V3): optional destination filter, mandatory service type, dental
    codes out keeping nulls, no date work."""
    df = _prepare(raw).where(all_of([
        in_values("estab_dest", [sites] if isinstance(sites, str) else sites),
        F.col("tipo_prest") == F.lit(service),
        exclude_pattern_keep_null("presta_min", DENTAL_PREFIX),
    ]))
    df = _attach_dimensions(df, estab, abbrev).select(*V3_COLUMNS)
    return _attach_names(df, specs, reasons)


def specialty_extract(enriched: DataFrame, *, codes: Sequence[str], communes: Sequence[str],
                      dest_levels: Sequence[str] = ("Terciario", "Secundario")) -> DataFrame:
    """Referrals of some specialties from some communes to higher levels."""
    return enriched.where(F.col("presta_min").isin(list(codes)) & F.col("nombre_comuna").isin(list(communes))
                          & F.col("nivel_de_atencion_destino").isin(list(dest_levels)))


def under_age_list(enriched_v2: DataFrame, *, code: str, max_age: int = 15) -> DataFrame:
    """Referrals under ``max_age`` of one specialty."""
    return enriched_v2.where((F.col("edad_sic") < max_age) & (F.col("presta_min") == code))
