"""The domain tables every pipeline reads, as one catalogue object.

``Tables`` holds lazy DataFrames, one per input of the reference's workflow.
Three constructors exist: ``from_paths`` reads configured extracts (CSV or
Parquet, ``sources.config``), ``from_driver`` derives the tables from the
TPC-H-like test tables (see ``testviews``), and ``from_dir`` reads tables
written by ``publish`` (Parquet, one folder per table), which is what later
analyses read after the load step.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Table name = attribute. ``programming`` binds the hospitals' sheets, in folders by hospital.
TABLE_NAMES: tuple[str, ...] = (
    "establishments_raw", "abbreviations", "specialties", "exit_reasons", "service_types",
    "open_list", "closed_list", "production_raw", "registry_raw", "referral_map", "sigte",
    "network_sites", "portfolio", "specialty_subset", "yield_table", "projection",
    "programming", "programmed_activities", "list_statistics", "sigte_datetimes",
)
# Inputs that only some analyses read: a configuration may leave them out.
OPTIONAL: tuple[str, ...] = ("programmed_activities",)


@dataclass
class Tables:
    """Lazy input tables of one source (test tables, configured paths or a
    published folder), loaded on first use."""

    spark: SparkSession
    loader: Callable[[str], DataFrame]
    names: tuple[str, ...] = TABLE_NAMES
    _cache: dict = field(default_factory=dict, repr=False)

    def _get(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.loader(name)
        return self._cache[name]

    establishments_raw = property(lambda self: self._get("establishments_raw"))
    abbreviations = property(lambda self: self._get("abbreviations"))
    specialties = property(lambda self: self._get("specialties"))
    exit_reasons = property(lambda self: self._get("exit_reasons"))
    service_types = property(lambda self: self._get("service_types"))
    open_list = property(lambda self: self._get("open_list"))
    closed_list = property(lambda self: self._get("closed_list"))
    production_raw = property(lambda self: self._get("production_raw"))
    registry_raw = property(lambda self: self._get("registry_raw"))
    referral_map = property(lambda self: self._get("referral_map"))
    sigte = property(lambda self: self._get("sigte"))
    network_sites = property(lambda self: self._get("network_sites"))
    portfolio = property(lambda self: self._get("portfolio"))
    specialty_subset = property(lambda self: self._get("specialty_subset"))
    yield_table = property(lambda self: self._get("yield_table"))
    projection = property(lambda self: self._get("projection"))

    programming = property(lambda self: self._get("programming"))
    programmed_activities = property(lambda self: self._get("programmed_activities"))
    list_statistics = property(lambda self: self._get("list_statistics"))
    sigte_datetimes = property(lambda self: self._get("sigte_datetimes"))

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, staging: str | None = None,
                    staged: str | None = None, folder: str | None = None) -> "Tables":
        """Tables derived from the test tables. With ``staging`` the expensive
        intermediate joins are written there first; ``staged`` reuses a folder
        written that way before; ``folder`` takes each of them when a table
        first needs it."""
        from waitlens.sources import testviews
        views = testviews.DriverViews(spark, sf_dir, folder)
        if staging:
            views.stage(staging)
        elif staged:
            views.use_staged(staged)
        return cls(spark, views.build)

    @classmethod
    def from_paths(cls, spark: SparkSession, paths) -> "Tables":
        """Tables from configured input locations (S11): declared schemas,
        CSV or Parquet, banner lines and encodings as configured."""
        from waitlens.sources import schemas
        from waitlens.sources.readers import bind_sheets, read_csv, read_positional, read_sheets, read_waiting_list
        from waitlens.sources.statistics import list_statistics

        declared = {"abbreviations": schemas.ABBREVIATIONS, "specialties": schemas.SPECIALTIES,
                    "exit_reasons": schemas.EXIT_REASONS, "production_raw": schemas.PRODUCTION,
                    "registry_raw": schemas.REGISTRY, "referral_map": schemas.REFERRAL_MAP,
                    "sigte": schemas.SIGTE, "network_sites": schemas.NETWORK_SITES, "portfolio": schemas.PORTFOLIO,
                    "specialty_subset": schemas.SPECIALTY_SUBSET, "yield_table": schemas.YIELD_TABLE,
                    "programmed_activities": schemas.PROGRAMMED_ACTIVITIES,
                    "establishments_raw": schemas.ESTABLISHMENTS}
        attr = {"establishments_raw": "establishments", "production_raw": "production", "registry_raw": "registry"}

        def load(name: str) -> DataFrame:
            if name in ("open_list", "closed_list"):
                src = getattr(paths, name)
                options = {} if src.fmt == "parquet" else src.text_options()
                return read_waiting_list(spark, src.path, fmt=src.fmt, **options)
            if name == "service_types":
                from waitlens.sources.literals import service_types
                return service_types(spark)
            if name == "list_statistics":
                return list_statistics(tables.open_list, tables.closed_list)
            if name == "programming":
                src = paths.programming_source()
                return bind_sheets(read_sheets(spark, paths.programming_paths(), schemas.PROGRAMMING, fmt=src.fmt,
                                               renames=paths.programming_renames, **src.text_options()))
            if name == "sigte_datetimes":  # the same extract, its entries with their time of day
                src = paths.extras["sigte"]
                if src.fmt == "csv":
                    return read_csv(spark, src.path, schemas.SIGTE.replace("f_entrada date", "f_entrada timestamp"), **src.text_options())
                return spark.read.parquet(src.path).withColumn("f_entrada", F.col("f_entrada").cast("timestamp"))
            src = getattr(paths, attr.get(name, name), None) or paths.extras[name]
            if src.fmt != "csv":
                df = spark.read.parquet(src.path)
                if name != "projection":
                    return df
                places = [part.strip().split(" ", 1)[0] for part in schemas.PROJECTION.split(",")]
                return df.select(*df.columns[:len(places)]).toDF(*places)
            if name == "projection":  # by place, whatever its headers are
                return read_positional(spark, src.path, schemas.PROJECTION, **src.text_options())
            return read_csv(spark, src.path, declared[name], **src.text_options())

        there = tuple(n for n in TABLE_NAMES if n not in OPTIONAL or n in paths.extras)
        tables = cls(spark, load, there)
        return tables

    @classmethod
    def from_dir(cls, spark: SparkSession, path: str) -> "Tables":
        from waitlens.sources.readers import read_published

        return cls(spark, lambda name: read_published(spark, os.path.join(path, name)))

    @classmethod
    def from_published(cls, spark: SparkSession, base: str) -> "Tables":
        """The current version that ``publish_versioned`` made below ``base``."""
        from waitlens.sources.versions import current

        return cls.from_dir(spark, current(spark, base))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads, without hidden ones."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(place)]
    return sorted(n for n in names if not n.startswith((".", "_")))


# Published layout: waiting lists are split in folders by service type, the
# filter of nearly every analysis, so a query on one type reads one folder.
PARTITIONING: dict[str, tuple[str, ...]] = {"open_list": ("tipo_prest",), "closed_list": ("tipo_prest",),
                                             "sigte": ("tipo_prest",), "sigte_datetimes": ("tipo_prest",), "programming": ("hospital",)}
# Inside a folder, rows are sorted by destination site and specialty, the
# other filters of most analyses; production by service, site and code.
SORTING: dict[str, tuple[str, ...]] = {"open_list": ("estab_dest", "presta_min"),
                                       "closed_list": ("estab_dest", "presta_min"),
                                       "sigte": ("estab_dest",),
                                       "production_raw": ("id_servicio", "id_establecimiento", "codigo_prestacion")}


# Keys that joins rely on to be unique (N12), by cleaned column name; rows
# where a key is null join with nothing and are not counted.
DIMENSION_KEYS: dict[str, tuple[str, ...]] = {
    "abbreviations": ("codigo_vigente",), "exit_reasons": ("n",), "service_types": ("n",),
    "specialties": ("codigosigte", "id_esp_seccion_a", "id_esp_seccion_b", "id_programacion"),
    "establishments_raw": ("codigo_vigente",), "yield_table": ("presta_min",),
    "specialty_subset": ("codigosigte",), "projection": ("x1",), "programmed_activities": ("n",),
}


def check_keys(tables: Tables, names: Iterable[str] | None = None) -> None:
    """Raise when a key that joins rely on repeats in one of the tables."""
    from waitlens.functions.text import clean_names
    from waitlens.operators.joins import assert_unique
    for name in [n for n in DIMENSION_KEYS if n in tables.names] if names is None else names:
        df = getattr(tables, name)
        df = df.toDF(*clean_names(df.columns))
        for key in DIMENSION_KEYS[name]:
            assert_unique(df.where(F.col(key).isNotNull()), [key], name)


def publish(tables: Tables, path: str, mode: str = "overwrite", keys: bool = True,
            parallel_jobs: int = 8) -> None:
    """Write every table of the catalogue as Parquet under ``path`` (S12) and
    check the dimension keys on the written copies.

    The writes are independent Spark jobs; they are submitted from a few
    driver threads so that small tables do not wait for each other (each
    large write still uses the whole cluster)."""
    from concurrent.futures import ThreadPoolExecutor

    from waitlens.sources.writers import write_table

    def label(name: str) -> None:  # job descriptions are per thread
        try:
            tables.spark.sparkContext.setJobDescription(f"publish {name}")
        except Exception:  # no local SparkContext (Spark Connect)
            pass

    def write_one(name: str) -> None:
        label(name)
        target = os.path.join(path, name)
        write_table(getattr(tables, name), target, mode=mode, partition_by=PARTITIONING.get(name, ()),
                    sort_by=SORTING.get(name, ()))
        if keys and name in DIMENSION_KEYS:
            check_keys(Tables.from_dir(tables.spark, path), [name])

    for name in tables.names:  # resolve lazily built frames on this thread
        getattr(tables, name)
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        futures = [pool.submit(write_one, n) for n in tables.names]
        for f in futures:
            f.result()


def publish_versioned(tables: Tables, base: str, keys: bool = True, parallel_jobs: int = 8) -> str:
    """``publish`` into a new version below ``base``, current only once every table is written and its
    keys are checked; a failure leaves readers (``Tables.from_published``) on the version before."""
    from waitlens.sources.versions import publish_version

    return publish_version(tables.spark, base, lambda folder: publish(tables, folder, keys=keys, parallel_jobs=parallel_jobs))
