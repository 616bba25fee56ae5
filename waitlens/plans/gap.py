"""Supply versus standard (P27, P28), enrolled cohort (P29), demand gap
(P30-P32) and waiting-time statistics (P33)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.functions.dates import day_fractions, days_between
from waitlens.functions.nulls import lenient_sum, strict_mean, strict_median, strict_sum
from waitlens.functions.numeric import mean_of_rounded, round_half_even, safe_ratio
from waitlens.operators.aggregates import count_by
from waitlens.operators.columns import select_positions
from waitlens.operators.joins import join_keys
from waitlens.operators.predicates import exclude_pattern_keep_null, semi_join_in, still_waiting_at
from waitlens.operators.reshape import union_all

# Fixed values of the reference: monthly factor of the standard yield formula,
# and the text that marks dental specialty codes in the one-hospital gap
# (matched anywhere in the code, not only as a prefix).
STANDARD_FACTOR = 31.4
DENTAL_CODE_PART = "09-"
# Fixed values of the reference: person identifier columns dropped from the cohort.
PERSON_COLUMNS = ("run", "dv", "rut_sdv", "rut", "rut_paciente", "apellido_paterno")


def supply_vs_standard(summary: DataFrame, *, yearly_plan: DataFrame, hours: DataFrame, specs: DataFrame,
                       subset: DataFrame, yield_table: DataFrame, site: str, activity: str = "1",
                       factor: float = STANDARD_FACTOR) -> DataFrame:
    """Production summary with the yearly plan of new visits, the
    standard yield and the contracted hours of one site; standard production
    ``hours x ambulatory share x new share x yield x factor`` and the
    real/standard ratio."""
    plan = yearly_plan.where((F.col("id_deis") == site) & (F.col("id_actividad") == activity))
    plan = plan.withColumn("total_cne", F.col("produccion_1_sem") + F.col("produccion_2_sem"))
    plan = semi_join_in(plan.select("id_deis", "id_especialidad", "total_cne"), "id_especialidad",
                        subset, "id_programacion")
    plan = join_keys(plan, specs.select("desc_esp", "codigosigte", "id_programacion"),
                     {"id_especialidad": "id_programacion"})
    df = join_keys(summary, plan.select("codigosigte", F.col("total_cne").alias("prog_cne_anual")), ["codigosigte"])
    df = join_keys(df, yield_table.drop("desc_esp"), {"codigosigte": "presta_min"})
    hrs = hours.where((F.col("id_actividad") == activity) & (F.col("id_deis") == site)).drop("id_actividad")
    df = join_keys(df, hrs, ["id_especialidad"])
    std = round_half_even(F.col("horas_totales") * F.col("distribucion_ambulatoria") * F.col("distribucion_nueva")
                          * F.col("rendimiento_nueva") * F.lit(factor), 0)
    df = df.withColumn("produccion_cne_estandar", std)
    return df.withColumn("proporcion_real_estandar", round_half_even(
        F.try_divide(F.col("produccion_cne") + F.col("produccion_nsp_cne"), F.col("produccion_cne_estandar")), 2))


def mean_ratio(supply: DataFrame) -> DataFrame:
    """Mean of the real/standard ratio (two decimals), nulls skipped."""
    return supply.agg(mean_of_rounded("proporcion_real_estandar", 2).alias("promedio"))


def enrolled_cohort(exits: DataFrame, waiting: DataFrame, registry: DataFrame, *, communes: Sequence[str],
                    subset: DataFrame) -> DataFrame:
    """Exits and waiting referrals of persons enrolled in some communes,
    for a list of specialties; person identifiers dropped; both bound (U2).

    The registry is as large as the population: this is a shuffle join on
    the person id (adaptive execution splits a person key that is very
    frequent), and the commune filter is applied to the registry before it.
    Where all three come bucketed by person (``sources.bucketing``), nothing is
    shuffled."""
    reg = registry.where(F.col("comuna_establecimiento").isin(list(communes)))

    def part(df: DataFrame) -> DataFrame:
        j = df.withColumn("run", F.col("run").cast("string")).join(
            reg, F.col("run") == reg.rut_paciente_sdv, "inner").drop("rut_paciente_sdv")
        j = semi_join_in(j, "presta_min", subset, "codigosigte")
        return j.drop(*PERSON_COLUMNS)

    return union_all([part(exits), part(waiting)], allow_missing=True)


def gap_production(production: DataFrame, *, site: str, names: DataFrame, subset: DataFrame | None = None,
                   name_key: str = "codigosigte") -> DataFrame:
    """Production side of the gap (P30, P31): nulls skipped in the new-visit
    and no-show sums, strict total, shares null when the total is 0 or null."""
    df = production.where(F.col("id_establecimiento") == site)
    if subset is not None:
        df = semi_join_in(df, "codigo_prestacion_x", subset, "id_esp_seccion_a")
    if name_key == "codigosigte":
        df = join_keys(df, names.select("codigosigte", "desc_esp"), ["codigosigte"])
    else:
        df = join_keys(df, names.select("desc_esp", name_key), {"codigo_prestacion_x": name_key})
    out = df.groupBy("codigosigte", "desc_esp").agg(
        strict_sum("total_consultas").alias("produccion_total"),
        (lenient_sum("consultas_menores15") + lenient_sum("consultas_mayores")).alias("produccion_cne"),
        (lenient_sum("nsp_nuevas") + lenient_sum("nsp_controles")).alias("produccion_nsp_total"),
        lenient_sum("nsp_nuevas").alias("produccion_nsp_cne"))
    return out.withColumns({
        "proporcion_cne": safe_ratio("produccion_cne", "produccion_total", 2),
        "produccion_control": F.col("produccion_total") - F.col("produccion_cne"),
        "proporcion_nsp_cne": safe_ratio("produccion_nsp_cne", "produccion_nsp_total", 2),
    })


def demand_counts(referrals: DataFrame, *, initial: Column, current: Column, year: int,
                  how: str = "left") -> DataFrame:
    """Initial demand and demand of the year per specialty in one pass.

    The reference counts the two sets separately and left-joins the year's
    counts to the initial ones (null-matching keys). One aggregation with two
    conditional counts gives the same rows without a second scan or a join:
    groups need an initial count, and a year count of 0 is null. With
    ``how='full'`` (B9) a group with either count is kept and 0 stays 0."""
    dy = f"demanda_{year}"
    agg = referrals.where(initial | current).groupBy("presta_min", "desc_esp").agg(
        F.count_if(initial).alias("demanda_inicial"), F.count_if(current).alias(dy))
    if how == "full":
        return agg
    return agg.where(F.col("demanda_inicial") > 0).withColumn(dy, F.nullif(F.col(dy), F.lit(0)))


def gap(demand: DataFrame, production: DataFrame, *, year: int) -> DataFrame:
    """Demand / production (P30, P31): demand counts with the production of
    the specialty (null-matching keys); ratio to 2 digits, null on 0."""
    dy = f"demanda_{year}"
    df = demand.withColumn("demanda_total", F.col("demanda_inicial") + F.col(dy))
    df = join_keys(df, production, {"presta_min": "codigosigte", "desc_esp": "desc_esp"}, null_safe=True)
    pt = f"produccion_total_cne_{year}"
    df = df.withColumn(pt, F.col("produccion_cne") + F.col("produccion_nsp_cne"))
    return df.withColumn("brecha", round_half_even(F.try_divide(F.col("demanda_total"), F.col(pt)), 2))


def cohort_gap(cohort: DataFrame, production: DataFrame, *, year: int, site: str, subset: DataFrame) -> DataFrame:
    """Gap for the enrolled cohort."""
    demand = demand_counts(cohort, initial=F.col("f_entrada") < F.lit(f"{year}-01-01").cast("date"),
                           current=F.col("f_entrada") > F.lit(f"{year - 1}-12-31").cast("date"), year=year)
    prod = gap_production(production, site=site, names=subset, subset=subset)
    return gap(demand, prod, year=year)


def hospital_gap(open_list: DataFrame, closed_list: DataFrame, production: DataFrame, *, year: int, site: str,
                 specs: DataFrame, service: int = 1, how: str = "left") -> DataFrame:
    """Gap of one hospital. Initial demand counts referrals still waiting
    at the start of the year (F9); codes with ``09-`` are out, nulls kept."""
    both = union_all([open_list, closed_list])
    both = both.where((F.col("tipo_prest") == service) & (F.col("estab_dest") == site)
                      & exclude_pattern_keep_null("presta_min", DENTAL_CODE_PART))
    start = f"{year}-01-01"
    demand = demand_counts(both, initial=still_waiting_at("f_entrada", "f_salida", start),
                           current=F.col("f_entrada") >= F.lit(start).cast("date"), year=year, how=how)
    prod = gap_production(production, site=site, names=specs, name_key="id_esp_seccion_a")
    return gap(demand, prod, year=year)


def still_waiting(open_list: DataFrame, closed_list: DataFrame, *, at: str, service: int = 1) -> DataFrame:
    """F9 over all sites: referrals of a service type still waiting at ``at``
    (entered before it and not out before it), per destination and specialty."""
    both = union_all([open_list, closed_list]).where(F.col("tipo_prest") == service)
    return count_by(both.where(still_waiting_at("f_entrada", "f_salida", at)), ["estab_dest", "presta_min"],
                    "en_espera")


def gap_current(gap_df: DataFrame) -> DataFrame:
    """Gap rows with production."""
    return gap_df.where(F.col("produccion_cne").isNotNull())


def gap_new_projected(gap_df: DataFrame, projection: DataFrame,
                      positions: Sequence[int | range] = (1, 5, range(8, 13), range(19, 22))) -> DataFrame:
    """Gap rows without production, first five columns, with the
    projected production picked by position (D5)."""
    new = select_positions(gap_df.where(F.col("produccion_cne").isNull()), [range(1, 6)])
    proj = select_positions(projection, positions, exclude=["especialidad"])
    return join_keys(new, proj, {"presta_min": proj.columns[0]})


def gap_projected(gap_df: DataFrame, projection: DataFrame) -> DataFrame:
    """Every gap row with all columns of the projection but the specialty's name."""
    proj = projection.drop("especialidad")
    return join_keys(gap_df, proj, {"presta_min": proj.columns[0]})


def total_new_visits(gap_df: DataFrame) -> DataFrame:
    """Total of new visits of the rows with production."""
    return gap_current(gap_df).agg(lenient_sum("produccion_cne").alias("total_cne"))


def waiting_time_stats(sigte: DataFrame, *, service: int, site: str, at: str) -> DataFrame:
    """Open referrals without error flag of one site and service: count,
    mean and median waiting days at a fixed date, per specialty group; null
    where any waiting time of the group is (A5, A6). Entries with a time of
    day wait fractions of days, rounded half to even as the reference does (X8).

    The median keeps one counter per distinct number of days, so its memory
    is bounded by the range of waiting days, not by the group size."""
    df = sigte.where((F.col("tipo_prest") == service) & F.col("tipo_error").isNull()
                     & (F.col("estab_dest") == site) & F.col("f_salida").isNull())
    if df.schema["f_entrada"].dataType.typeName().startswith("timestamp"):
        wait = round_half_even(day_fractions("f_entrada", F.lit(at).cast("timestamp")), 0)
    else:
        wait = days_between("f_entrada", F.lit(at).cast("date"))
    df = df.withColumn("espera", wait)
    return df.groupBy("especialidad_grupo").agg(
        F.count(F.lit(1)).alias("n"), round_half_even(strict_mean("espera"), 0).alias("mean"),
        round_half_even(strict_median("espera"), 0).alias("median"))
