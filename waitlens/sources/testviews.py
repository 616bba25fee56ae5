"""Domain tables derived from the TPC-H-like test tables.

The reference ships no data, so its inputs are re-created from the driver's
tables with fixed rules (same rules as the SQL views of the oracle):

* a referral is a ``lineitem`` row: person = ``o_custkey``, origin site =
  customer nation, destination site = supplier nation, specialty = part brand,
  entry = order date, exit = ship date when the line is finished;
* production is ``lineitem`` counted per supplier site, brand and month;
* programming is ``lineitem`` per site, brand, activity and supplier;
* the person registry is ``customer``; dimensions come from ``nation``,
  ``region`` and ``part``.
Null exits, null measures, codes without a mapping and text codes with several
hyphens appear on purpose, to exercise the reference's null rules.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.sources import literals

# Intermediates that this process wrote below a folder, each once.
_KEPT: set[str] = set()
_KEPT_LOCK = threading.RLock()

# Exit reasons of the test data (l_returnflag); the labels clean to the column
# names the reference reads after its pivot.
EXIT_REASONS: tuple[tuple[str, str], ...] = (
    ("A", "Atención realizada"),
    ("N", "No pertinencia"),
    ("R", "Otra causal"),
)

# Original headers of the establishment file, cleaned by the pipeline.
ESTABLISHMENT_HEADERS: dict[str, str] = {
    "codigo_vigente": "Código Vigente",
    "codigo_antiguo": "Código Antiguo",
    "nombre_oficial": "Nombre Oficial",
    "codigo_comuna": "Código Comuna",
    "nombre_comuna": "Nombre Comuna",
    "nivel_de_atencion": "Nivel de Atención",
    "red": "Nombre Dependencia Jerárquica (SEREMI / Servicio de Salud)",
    "nivel_de_complejidad": "Nivel de Complejidad",
}


# Specialty numbers of the test tables: brands are spread over eight of them,
# so that site, specialty and month cells hold several rows.
SPECIALTY_NUMBERS = (1, 2, 3, 4, 7, 19, 20, 21)
# Service type per order priority: new visits are the most common type.
SERVICE_OF_PRIORITY = (1, 1, 1, 4, 2)
# The specialty whose zero counts are stored as null in the production table,
# and the one whose section A1 holds open lines only (months without a row).
NULL_COUNTS = 3
OPEN_ONLY = 7


def brand_no(brand: Column) -> Column:
    """Specialty number of a brand."""
    numbers = F.array(*[F.lit(n) for n in SPECIALTY_NUMBERS])
    return F.get(numbers, F.substring(brand, 7, 10).cast("int") % len(SPECIALTY_NUMBERS))


def service_type(priority: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in SERVICE_OF_PRIORITY]), F.substring(priority, 1, 1).cast("int") - 1)


def pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def specialty_code(n: Column) -> Column:
    """``07-012``; brands 21 and up get the dental prefix ``09-``."""
    return F.concat(F.when(n >= 21, F.lit("09-")).otherwise(F.lit("07-")), pad(n, 3))


def specialty_name(n: Column) -> Column:
    return F.concat(F.lit("Specialty "), pad(n, 2))


class DriverViews:
    """Builds each domain table from the test tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str | None = None):
        """With ``folder`` each expensive intermediate (``STAGED``) is written
        there by the first table that is derived from it, and no other."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.folder = folder and folder.rstrip("/")
        self._staged: dict[str, DataFrame] = {}

    def stage(self, path: str) -> None:
        """Write the expensive intermediates once (the five-table referral join,
        the line-by-site join, then the programming aggregated from it, in
        folders by hospital, and the lists' latest dates), and derive every
        table from the written copies: the load step then joins ``lineitem``
        twice instead of once per derived table, aggregates the programming
        once instead of once per hospital, and lineage is cut there."""
        from concurrent.futures import ThreadPoolExecutor

        def write(name: str) -> None:
            try:  # job descriptions are per thread
                self.spark.sparkContext.setJobDescription(f"stage {name.strip('_')}")
            except Exception:
                pass
            self._write(name, path)

        for frames in (("_referral_base", "_line_sites"), ("_programming_plan", "_list_statistics")):  # the second from the first
            with ThreadPoolExecutor(max_workers=len(frames)) as pool:
                for f in [pool.submit(write, n) for n in frames]:
                    f.result()
            self.use_staged(path, frames)

    # intermediate -> partition folders
    STAGED = {"_referral_base": (), "_line_sites": (), "_programming_plan": ("hospital",), "_list_statistics": ()}

    def use_staged(self, path: str, names: tuple[str, ...] = tuple(STAGED)) -> None:
        """Read the intermediates written by ``stage``."""
        for name in names:
            self._staged[name] = self.spark.read.parquet(f"{path.rstrip('/')}/{name.strip('_')}")

    def _write(self, name: str, path: str) -> None:
        writer = getattr(self, f"{name}_rows")().write.mode("overwrite")
        parts = self.STAGED[name]
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{path.rstrip('/')}/{name.strip('_')}")

    def _kept(self, name: str) -> DataFrame:
        """An intermediate: its written copy, written now if ``folder`` lacks it, or without any its rows."""
        if name not in self._staged and self.folder:
            with _KEPT_LOCK:
                if f"{self.folder}/{name}" not in _KEPT:
                    self._write(name, self.folder)
                    _KEPT.add(f"{self.folder}/{name}")  # recorded only once it is complete
            self.use_staged(self.folder, (name,))
        return self._staged[name] if name in self._staged else getattr(self, f"{name}_rows")()

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def build(self, name: str) -> DataFrame:
        return getattr(self, name)()

    # ---- dimensions -----------------------------------------------------
    def _sites(self) -> DataFrame:
        n, r = self.t("nation"), self.t("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "n_regionkey", "r_name")

    def establishments_raw(self) -> DataFrame:
        k = F.col("n_nationkey")
        df = self._sites().select(
            k.cast("string").alias("codigo_vigente"),
            (k + 100).cast("string").alias("codigo_antiguo"),
            F.col("n_name").alias("nombre_oficial"),
            F.col("n_regionkey").cast("string").alias("codigo_comuna"),
            F.col("r_name").alias("nombre_comuna"),
            F.when(k % 3 == 0, "Primario").when(k % 3 == 1, "Secundario").otherwise("Terciario").alias("nivel_de_atencion"),
            F.when(F.col("n_regionkey") == 4, "North network").otherwise("South network").alias("red"),
            F.when(k % 2 == 0, "Alta").otherwise("Baja").alias("nivel_de_complejidad"),
        )
        return df.toDF(*[ESTABLISHMENT_HEADERS[c] for c in df.columns])

    def abbreviations(self) -> DataFrame:
        return self.t("nation").select(
            F.col("n_nationkey").cast("string").alias("codigo_vigente"),
            F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("abreviacion"))

    def specialties(self) -> DataFrame:
        n = F.col("brand_no")
        return (self.t("part").select(brand_no(F.col("p_brand")).alias("brand_no")).distinct()
                .select(specialty_code(n).alias("codigosigte"),
                        specialty_name(n).alias("desc_esp"),
                        F.when(~n.isin(19, 20), F.concat(F.lit("07"), pad(n, 6))).alias("id_esp_seccion_a"),
                        F.when(n >= 2, F.concat(F.lit("09"), pad(n, 6))).alias("id_esp_seccion_b"),
                        F.concat(F.lit("7"), pad(n, 6)).alias("id_programacion")))

    def exit_reasons(self) -> DataFrame:
        return literals.literal_table(self.spark, EXIT_REASONS, [("n", "string"), ("causal", "string")])

    def service_types(self) -> DataFrame:
        return literals.service_types(self.spark)

    def network_sites(self) -> DataFrame:
        """Sites with their network (region) and old code."""
        return self._sites().select(
            (F.col("n_nationkey") + 100).cast("string").alias("codigo_antiguo"),
            F.col("n_nationkey").cast("string").alias("x2"),
            F.col("r_name").alias("comuna"),
            F.concat(F.lit("Red "), F.col("r_name")).alias("minired"))

    def portfolio(self) -> DataFrame:
        """Diagnosis codes of a hospital's portfolio: red and blue part names."""
        p = F.col("p_name")
        return (self.t("part").where(p.startswith("red ") | p.startswith("blue "))
                .select(p.alias("codigo")).distinct())

    def specialty_subset(self) -> DataFrame:
        """The specialty list of a hospital: the medical (not dental) ones."""
        s = self.specialties()
        return s.where(F.col("codigosigte").startswith("07-")).select(
            "codigosigte", "desc_esp", "id_esp_seccion_a", "id_programacion")

    def yield_table(self) -> DataFrame:
        """Standard yield per specialty (shares and visits per hour by rule)."""
        s = self.specialties()
        n = F.substring(F.col("codigosigte"), 4, 3).cast("int")
        return s.select(F.col("codigosigte").alias("presta_min"), "desc_esp",
                        F.col("id_programacion").alias("id_especialidad"),
                        ((n + 60).cast("double") / 100).alias("distribucion_ambulatoria"),
                        F.lit(0.4).alias("distribucion_nueva"),
                        (n % 4 + 2).cast("double").alias("rendimiento_nueva"))

    def referral_map(self) -> DataFrame:
        """Routing rules: specialty, destination, diagnosis code (empty for PROMO parts)."""
        n = brand_no(F.col("p_brand"))
        return self.t("part").select(
            specialty_name(n).alias("descripcion_especialidad_demandada"),
            F.concat(F.lit("13-"), (F.col("p_size") % 25).cast("string")).alias("codigo_deis_establecimiento_destino"),
            F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(
                F.upper(F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)))).alias("codigo_cie_10_diagnostico_opcional"),
        ).distinct()

    # ---- facts ------------------------------------------------------------
    def _referral_base(self) -> DataFrame:
        return self._kept("_referral_base")

    def _referral_base_rows(self) -> DataFrame:
        """The orders meet their customers first, so that lines move twice (by
        order and by part); on the way they hold dates without times, and the
        exit's columns only where there is one."""
        l, o, c, s, p = (self.t(x) for x in ("lineitem", "orders", "customer", "supplier", "part"))
        o = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_nationkey")
        done = (F.col("l_linestatus") == "F") & (F.col("l_shipdate") >= F.col("o_orderdate"))
        j = l.join(o, l.l_orderkey == o.o_orderkey).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_tax", "o_custkey", "o_orderpriority", "c_nationkey",
            F.col("o_orderdate").cast("date").alias("f_entrada"),
            F.when(done, F.col("l_shipdate").cast("date")).alias("f_salida"), F.when(done, F.col("l_returnflag")).alias("c_salida"))
        j = j.join(p, j.l_partkey == p.p_partkey).join(s, j.l_suppkey == s.s_suppkey)
        ck = F.col("o_custkey")
        birth = F.date_add(F.lit("1950-01-01").cast("date"), ((ck * 7919) % 16000).cast("int"))
        return j.select(
            ck.cast("string").alias("run"),
            (ck % 10).cast("string").alias("dv"),
            F.when(ck % 2 == 0, "F").otherwise("M").alias("sexo"),
            birth.alias("fecha_nac"),
            F.col("c_nationkey").cast("string").alias("estab_orig"),
            F.col("s_nationkey").cast("string").alias("estab_dest"),
            "f_entrada",
            "f_salida",
            service_type(F.col("o_orderpriority")).alias("tipo_prest"),
            F.when(F.col("p_size") <= 48, specialty_code(brand_no(F.col("p_brand")))).alias("presta_min"),
            F.col("p_type").alias("presta_est"),
            F.when(F.col("p_size") <= 5, F.col("p_name"))
             .otherwise(F.concat(F.col("p_name"), F.lit(" - "), F.col("o_orderpriority"))).alias("sospecha_diag"),
            "c_salida",
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("sigte_id"),
            F.col("l_suppkey").cast("string").alias("id_local"),
            F.col("l_linestatus").alias("_status"),
            F.col("l_tax").alias("_tax"),
        )

    def open_list(self) -> DataFrame:
        """Referrals of open lines (no exit)."""
        return self._referral_base().where(F.col("_status") == "O").drop("_status", "_tax")

    def closed_list(self) -> DataFrame:
        """Referrals of finished lines (exit when shipped on or after entry)."""
        return self._referral_base().where(F.col("_status") == "F").drop("_status", "_tax")

    def sigte(self) -> DataFrame:
        """Waiting-list extract with an error flag and a specialty group (part type)."""
        b = self._referral_base()
        return b.select(
            "tipo_prest", "estab_dest",
            F.when(~((F.col("_tax") < 0.01) & (F.col("presta_est") == "PROMO")), F.col("f_entrada")).alias("f_entrada"), "f_salida",
            F.when(F.col("_tax") > 0.07, F.lit("duplicado")).alias("tipo_error"),
            F.col("presta_est").alias("especialidad_grupo"))

    def _line_sites(self) -> DataFrame:
        return self._kept("_line_sites")

    def _line_sites_rows(self) -> DataFrame:
        l, s, n, p = (self.t(x) for x in ("lineitem", "supplier", "nation", "part"))
        l = l.select("l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag", "l_linestatus",
                     "l_linenumber", "l_discount", "l_quantity")
        return (l.join(p, l.l_partkey == p.p_partkey)
                .join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
                .select("s_nationkey", "n_regionkey", brand_no(F.col("p_brand")).alias("brand_no"),
                        F.month("l_shipdate").alias("mes"), F.year("l_shipdate").alias("ano"),
                        F.quarter("l_shipdate").alias("trimestre"),
                        "l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_quantity",
                        "l_suppkey"))

    def production_raw(self) -> DataFrame:
        """REM series A: section A rows (all lines) and section A1 rows (of one
        specialty the open lines) per month, site and brand code; zero counts stored as null."""
        base = self._line_sites()
        keys = [F.col("mes"), F.col("ano"),
                F.when(F.col("n_regionkey") == 4, 14).otherwise(13).alias("id_servicio"),
                F.col("s_nationkey").cast("string").alias("id_establecimiento"),
                F.col("brand_no"), F.col("n_regionkey").alias("id_region"),
                F.col("s_nationkey").alias("id_comuna")]
        d = lambda c: c.cast("double")
        cnt = lambda cond: F.count_if(cond)
        gaps = lambda c: F.when(F.col("brand_no") == NULL_COUNTS, F.nullif(c, F.lit(0))).otherwise(c)
        nul = F.lit(None).cast("double")
        rf, ln, disc = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_discount")
        sec_a = base.groupBy(*keys).agg(
            d(F.count(F.lit(1))).alias("col01"), nul.alias("col02"), nul.alias("col09"), nul.alias("col10"),
            nul.alias("col13"), nul.alias("col16"), nul.alias("col17"),
            d(cnt(rf == "A")).alias("col19"), d(cnt(rf == "N")).alias("col20"), d(cnt(rf == "R")).alias("col21"),
            d(gaps(cnt(ln <= 2))).alias("col22"), d(gaps(cnt(ln > 2))).alias("col26"),
        ).withColumn("codigo_prestacion", F.concat(F.lit("07"), pad(F.col("brand_no"), 6)))
        sec_a1 = base.where((F.col("l_linestatus") == "O") | (F.col("brand_no") != OPEN_ONLY)).groupBy(*keys).agg(
            d(F.count(F.lit(1))).alias("col01"), d(cnt(rf == "A")).alias("col02"),
            d(cnt(rf == "N")).alias("col09"), d(cnt(rf == "R")).alias("col10"),
            d(cnt(ln == 1)).alias("col13"), d(cnt(ln == 2)).alias("col16"), d(cnt(ln >= 3)).alias("col17"),
            nul.alias("col19"),
            d(gaps(cnt(disc < 0.05))).alias("col20"), d(gaps(cnt(disc >= 0.05))).alias("col21"),
            nul.alias("col22"), nul.alias("col26"),
        ).withColumn("codigo_prestacion", F.concat(F.lit("09"), pad(F.col("brand_no"), 6)))
        cols = ["mes", "ano", "id_servicio", "id_establecimiento", "codigo_prestacion", "id_region", "id_comuna",
                "col01", "col02", "col09", "col10", "col13", "col16", "col17", "col19", "col20", "col21", "col22", "col26"]
        return sec_a.select(*cols).unionByName(sec_a1.select(*cols))

    def _programming_plan(self) -> DataFrame:
        return self._kept("_programming_plan")

    def _programming_plan_rows(self) -> DataFrame:
        """Programming of every hospital group (site region), aggregated once."""
        base = self._line_sites()
        first = F.col("mes") <= 6

        def semester(cond: Column) -> Column:
            qty = F.sum(F.when(cond, F.col("l_quantity")).otherwise(F.lit(0.0)))
            return F.when(F.count_if(cond) == 0, F.lit("s/i")).otherwise(qty.cast("bigint").cast("string"))

        return base.groupBy(
            F.concat(F.lit("h"), F.col("n_regionkey").cast("string")).alias("hospital"),
            F.col("s_nationkey").cast("string").alias("id_deis"),
            F.concat(F.lit("7"), pad(F.col("brand_no"), 6)).alias("id_especialidad"),
            F.col("l_suppkey").cast("string").alias("rutsdv"),
            (F.col("l_linenumber") % 3 + 1).cast("string").alias("id_actividad"),
        ).agg(semester(first).alias("produccion_1_sem"), semester(~first).alias("produccion_2_sem"),
              (F.count(F.lit(1)).cast("double") * 1.5).alias("horas_asignadas"),
              (F.count(F.lit(1)).cast("double") * 0.25).alias("total_horas_semanales_contratadas_run"))

    def programming_sheets(self) -> dict[str, DataFrame]:
        """One programming table per hospital group, as the reference reads one
        spreadsheet per hospital; each is a folder of the staged plan. Group 3
        names its third column differently, as one of the reference's sheets does."""
        plan = self._programming_plan()
        regions = [r[0] for r in self.t("region").select("r_regionkey").distinct().orderBy("r_regionkey").collect()]
        sheets = {f"h{r}": plan.where(F.col("hospital") == f"h{r}").drop("hospital") for r in regions}
        sheets["h3"] = sheets["h3"].withColumnRenamed("rutsdv", "rut_profesional")
        return sheets

    def programming(self) -> DataFrame:
        """The hospitals' sheets as one table, by hospital."""
        from waitlens.plans.programming import consolidate
        return consolidate(self.programming_sheets(), third_column_fix=("h3",), hospital="hospital")

    def programmed_activities(self) -> DataFrame:
        """Names of the programmed activities (the line numbers' remainders)."""
        n = (F.col("l_linenumber") % 3 + 1).cast("string")
        return self.t("lineitem").select(n.alias("n")).distinct().select("n", F.concat(F.lit("Actividad "), F.col("n")).alias("actividad"))

    def _list_statistics(self) -> DataFrame:
        return self._kept("_list_statistics")

    def _list_statistics_rows(self) -> DataFrame:
        from waitlens.sources.statistics import list_statistics
        return list_statistics(self.open_list(), self.closed_list())

    def list_statistics(self) -> DataFrame:
        return self._list_statistics()

    def sigte_datetimes(self) -> DataFrame:
        """The extract of ``sigte`` with a time of day at every entry."""
        order = F.split_part("sigte_id", F.lit("-"), F.lit(1)).cast("long")
        line = F.split_part("sigte_id", F.lit("-"), F.lit(2)).cast("long")
        entry = F.timestamp_seconds(F.unix_date("f_entrada") * 86400 + order % 24 * 3600 + line * 420)
        return self._referral_base().select("tipo_prest", "estab_dest", entry.alias("f_entrada"), "f_salida",
                                            F.lit(None).cast("string").alias("tipo_error"), F.col("presta_est").alias("especialidad_grupo"))

    def registry_raw(self) -> DataFrame:
        """Person registry from customers; some identifiers are null."""
        c = self.t("customer")
        rid = F.concat(F.col("c_custkey").cast("string"), (F.col("c_custkey") % 10).cast("string"))
        bal = F.col("c_acctbal")
        return c.select(
            F.when(bal >= 0, rid).alias("rut_paciente"),
            F.when((bal <= 9000) & (bal >= -500), rid).alias("rut"),
            F.col("c_name").alias("apellido_paterno"),
            F.concat(F.lit("Centro "), F.col("c_nationkey").cast("string")).alias("consultorio_inscripcion"),
            F.col("c_nationkey").cast("string").alias("comuna_establecimiento_id"),
            F.col("c_mktsegment").alias("comuna_establecimiento"),
            F.col("c_nationkey").cast("string").alias("codigo_deis_comuna"))

    def projection(self) -> DataFrame:
        """Projected production per specialty: 2 names and 19 monthly,
        quarterly and total counts, read by position."""
        j = self._line_sites()
        n = F.col("brand_no")
        m = F.col("mes")
        aggs = [F.count_if(m == k).cast("double").alias(f"m{k:02d}") for k in range(1, 13)]
        aggs += [F.count_if(F.col("trimestre") == q).cast("double").alias(f"q{q}") for q in range(1, 5)]
        aggs += [F.count(F.lit(1)).cast("double").alias("total"),
                 F.count_if(F.col("l_returnflag") == "R").cast("double").alias("devueltos"),
                 F.count_if(F.col("l_linestatus") == "O").cast("double").alias("abiertos")]
        return (j.groupBy(specialty_code(n).alias("x1"), specialty_name(n).alias("especialidad")).agg(*aggs))
