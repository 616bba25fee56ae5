"""Monthly demand/production cube and backlog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.functions.dates import month_start
from waitlens.functions.nulls import lenient_sum, strict_sum
from waitlens.operators.aggregates import count_by
from waitlens.operators.joins import join_keys
from waitlens.operators.predicates import between_dates
from waitlens.operators.ranking import running_total

SITE_KEYS = ("estab_dest", "presta_min")
CODES = ("codigo_prestacion_x", "codigo_prestacion_y")


def monthly_demand(waiting: DataFrame) -> DataFrame:
    """Entries per year, month, destination and specialty."""
    df = waiting.withColumns({"mes": F.month("f_entrada"), "ano": F.year("f_entrada")})
    return count_by(df, ["ano", "mes", *SITE_KEYS], "demanda_mensual")


def monthly_exits(exits: DataFrame, *, year: int) -> DataFrame:
    """Exits per year, month, destination and specialty in one year."""
    in_year = exits.where(between_dates("f_salida", f"{year}-01-01", f"{year + 1}-01-01"))  # reaches the scan
    df = in_year.withColumns({"mes": F.month("f_salida"), "ano": F.year("f_salida")})
    return count_by(df, ["ano", "mes", *SITE_KEYS], "egresos_mensual")


def _named_sites(df: DataFrame, estab: DataFrame, specs: DataFrame, abbreviations: Sequence[str]) -> DataFrame:
    df = join_keys(df, estab.select("abreviacion", "codigo_vigente"), {"estab_dest": "codigo_vigente"})
    df = join_keys(df, specs.select("codigosigte", "desc_esp"), {"presta_min": "codigosigte"})
    return df.where(F.col("abreviacion").isin(list(abbreviations)) & F.col("desc_esp").isNotNull())


def yearly_exits(monthly_ex: DataFrame, *, estab: DataFrame, specs: DataFrame,
                 abbreviations: Sequence[str]) -> DataFrame:
    """Exits of the year per site and specialty for named sites."""
    df = monthly_ex.groupBy(*SITE_KEYS).agg(strict_sum("egresos_mensual").alias("n"))
    return _named_sites(df, estab, specs, abbreviations)


def backlog_before(monthly_dem: DataFrame, *, year: int, estab: DataFrame, specs: DataFrame,
                   abbreviations: Sequence[str]) -> DataFrame:
    """Referrals that entered before ``year`` per site and specialty."""
    df = monthly_dem.where(F.col("ano") < year).groupBy(*SITE_KEYS).agg(strict_sum("demanda_mensual").alias("n"))
    return _named_sites(df, estab, specs, abbreviations)


def starting_demand(backlog: DataFrame, yearly_ex: DataFrame) -> DataFrame:
    """Backlog + exits of the year; null when either side is missing."""
    keys = ["estab_dest", "abreviacion", "presta_min", "desc_esp"]
    df = join_keys(backlog.withColumnRenamed("n", "acum_le"), yearly_ex.withColumnRenamed("n", "acum_egresos"),
                   keys, null_safe=True)
    return df.withColumn("demanda_acumulada", F.col("acum_le") + F.col("acum_egresos"))


def monthly_cube(production: DataFrame, *, specs: DataFrame, demand: DataFrame, plan_monthly: DataFrame,
                 abbrev: DataFrame, exits: DataFrame, activity: str = "1") -> DataFrame:
    """Production with specialty name, monthly demand, monthly plan of
    ``activity``, site abbreviation and monthly exits; month date. Rows
    without a specialty code meet the demand and exits without one (N1).

    Every side but production is an aggregate keyed on (site, specialty,
    month) or a dimension, so each join is many-to-one. The reference also
    joins site names it then drops; with unique site keys that join changes
    nothing and is left out."""
    df = join_keys(production, specs.select("codigosigte", "desc_esp"), ["codigosigte"])
    df = join_keys(df, demand, {"ano": "ano", "mes": "mes", "id_establecimiento": "estab_dest",
                                "codigosigte": "presta_min"}, null_safe=True)
    plan = plan_monthly.where(F.col("id_actividad") == activity).select("id_deis", "id_especialidad", "prog_mensual")
    df = join_keys(df, plan, {"id_establecimiento": "id_deis", "codigo_prestacion_x": "id_especialidad"})
    df = join_keys(df, abbrev.select("codigo_vigente", "abreviacion"), {"id_establecimiento": "codigo_vigente"})
    df = join_keys(df, exits, {"ano": "ano", "mes": "mes", "id_establecimiento": "estab_dest",
                               "codigosigte": "presta_min"}, null_safe=True)
    df = df.withColumn("produccion_cne", F.col("consultas_menores15") + F.col("consultas_mayores"))
    return df.select("mes", "ano", "id_establecimiento", "abreviacion", "codigosigte", "desc_esp",
                     "codigo_prestacion_x", "codigo_prestacion_y", "demanda_mensual",
                     "egresos_mensual", "produccion_cne", "prog_mensual",
                     month_start("ano", "mes").alias("fecha"))


def running_backlog(cube: DataFrame, start: DataFrame, *, start_keys: Sequence[str], start_value: str) -> DataFrame:
    """P25 for every site and specialty at once: starting value (sum, nulls
    skipped, 0 when absent) + running sum of entries minus exits by month.

    ``start`` is aggregated to one row per key before the join, so the join
    cannot multiply cube rows."""
    begin = start.groupBy(*start_keys).agg(lenient_sum(start_value).alias("valor_inicial"))
    df = cube.where(F.col("codigosigte").isNotNull())
    df = join_keys(df, begin, list(start_keys))
    df = df.withColumn("valor_inicial", F.coalesce(F.col("valor_inicial"), F.lit(0)))
    # one series per site code and specialty: sites without an abbreviation
    # are never summed together; a month with several production codes keeps
    # its rows, ordered by code
    return running_total(df, ["id_establecimiento", "codigosigte"], ["fecha", *(c for c in CODES if c in df.columns)],
                         F.col("demanda_mensual") - F.col("egresos_mensual"), F.col("valor_inicial"),
                         "demanda_acumulada")


def backlog_start(monthly_dem: DataFrame, abbrev: DataFrame, *, year: int) -> DataFrame:
    """Starting value of the chart in the reference: entries before ``year``
    per site abbreviation and specialty."""
    df = monthly_dem.where(F.col("ano") < year).groupBy(*SITE_KEYS).agg(strict_sum("demanda_mensual").alias("n"))
    df = join_keys(df, abbrev.select("codigo_vigente", "abreviacion"), {"estab_dest": "codigo_vigente"})
    return df.withColumnRenamed("presta_min", "codigosigte")


def choices(starting: DataFrame, column: str) -> DataFrame:
    """The distinct values offered by the dashboard."""
    return starting.select(column).distinct()


def publish_results(*, cube_df: DataFrame, starting: DataFrame, production: DataFrame, path: str) -> None:
    """The cube's three published tables (S12): the monthly cube split in
    folders by year, the starting demand and the production table; the
    dashboard reads them back (S13). They are one version below ``path``:
    readers see all three new tables or, when a write fails, the old ones."""
    from waitlens.sources.versions import publish_version
    from waitlens.sources.writers import write_table

    def write(folder: str) -> None:
        write_table(cube_df, f"{folder}/cubo", partition_by=["ano"])
        write_table(starting, f"{folder}/demanda_inicial")
        write_table(production, f"{folder}/produccion_rem", partition_by=["ano"])

    publish_version(cube_df.sparkSession, path, write)


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cube, starting demand and production of the current version."""
    from waitlens.sources.readers import read_published
    from waitlens.sources.versions import current
    folder = current(spark, path)
    return tuple(read_published(spark, f"{folder}/{name}") for name in ("cubo", "demanda_inicial", "produccion_rem"))
