"""Medical programming: consolidation (P2), yearly (P16), hours (P17), monthly (P20)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions.nulls import strict_sum
from waitlens.functions.numeric import round_half_even
from waitlens.operators.columns import clean_columns, rename_position
from waitlens.operators.joins import join_keys
from waitlens.operators.reshape import union_all

KEYS = ("id_deis", "id_especialidad", "id_actividad")


def consolidate(sheets: Sequence[DataFrame] | Mapping[str, DataFrame], *, third_column_fix: Sequence[int | str] = (),
                hospital: str | None = None) -> DataFrame:
    """Clean each hospital's table, name the third column ``rutsdv`` in the
    sheets listed in ``third_column_fix`` (0-based, or by hospital), bind by
    name (U1). ``hospital`` adds the sheet's name under that column."""
    cleaned = []
    for name, sheet in sheets.items() if isinstance(sheets, Mapping) else enumerate(sheets):
        s = clean_columns(sheet)
        if name in third_column_fix:
            s = rename_position(s, 3, "rutsdv")
        cleaned.append(s.withColumn(hospital, F.lit(str(name))) if hospital else s)
    return union_all(cleaned, allow_missing=False)


def yearly(programming: DataFrame, activities: Sequence[str] = ("1", "2")) -> DataFrame:
    """Semester and year totals and hours per site, specialty, activity.
    Text that is not a number becomes null and makes the strict sum null."""
    df = programming.where(F.col("id_actividad").cast("string").isin(list(activities)))
    s1, s2 = F.col("produccion_1_sem").try_cast("double"), F.col("produccion_2_sem").try_cast("double")
    out = df.groupBy(*KEYS).agg(strict_sum(s1).alias("produccion_1_sem"), strict_sum(s2).alias("produccion_2_sem"),
                                strict_sum("horas_asignadas").alias("horas"))
    return out.withColumn("produccion_anual", F.col("produccion_1_sem") + F.col("produccion_2_sem")) \
              .select(*KEYS, "produccion_1_sem", "produccion_2_sem", "produccion_anual", "horas")


def weekly_hours(programming: DataFrame) -> DataFrame:
    """Contracted weekly hours per site, specialty, activity."""
    return programming.groupBy(*KEYS).agg(strict_sum("total_horas_semanales_contratadas_run").alias("horas_totales"))


def monthly(yearly_plan: DataFrame) -> DataFrame:
    """P20: a twelfth of the year, rounded half to even; the specialty id gets
    the leading zero of the production codes."""
    return yearly_plan.withColumns({
        "prog_mensual": round_half_even((F.col("produccion_1_sem") + F.col("produccion_2_sem")) / 12, 0),
        "id_especialidad": F.concat(F.lit("0"), F.col("id_especialidad")),
        "id_deis": F.col("id_deis").cast("string"),
    })


def by_activity(yearly_plan: DataFrame, activities: DataFrame) -> DataFrame:
    """Yearly programming per activity with the activity's name: sites,
    specialties, hours and visits (null where any is, as the strict sums)."""
    names = activities.select(F.col("n").cast("string").alias("n"), "actividad")
    return join_keys(yearly_plan.groupBy("id_actividad").agg(
        F.count_distinct("id_deis").alias("establecimientos"), F.count_distinct("id_especialidad").alias("especialidades"),
        strict_sum("horas").alias("horas"), strict_sum("produccion_anual").alias("produccion_anual")), names, {"id_actividad": "n"})
