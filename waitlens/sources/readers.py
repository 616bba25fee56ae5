"""Readers (S1-S13). Every reader takes a declared schema; none infers one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.functions.dates import parse_date
from waitlens.functions.text import clean_names
from waitlens.operators.reshape import union_all
from waitlens.sources.headers import Layout, layouts


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A table published by ``writers.write_table``."""
    return spark.read.parquet(path)


def _declared(schema: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in schema.split(",")]


def by_header(df: DataFrame, schema: str, source: str = "input") -> DataFrame:
    """The declared columns of a text table, found by their cleaned header and
    cast leniently (N9); other columns and the column order do not matter.
    Raises when a declared column is missing."""
    df = df.toDF(*clean_names(df.columns))
    wanted = _declared(schema)
    missing = [name for name, _ in wanted if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing in {source}: {missing}; it has {df.columns}")
    return df.select(*[_typed(n, n, t) for n, t in wanted])


def _typed(column: str, name: str, kind: str) -> Column:
    """A text column cast leniently to its declared type."""
    if kind == "string":
        return F.col(column).alias(name)
    return (parse_date(column) if kind == "date" else F.col(column).try_cast(kind)).alias(name)


def _decoded_lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    """Lines of text files in any charset that ``decode`` knows. The text source
    keeps the bytes of a line as they are, so they are decoded afterwards."""
    lines = spark.read.text(list(files))
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        return lines
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))


def _texts(spark: SparkSession, layout: Layout, *, sep: str, encoding: str, skip_lines: int) -> DataFrame:
    """All columns of one layout's files as text, named ``c0``, ``c1``, ...

    Without banner lines the CSV source drops each file's header itself. Banner
    lines and the header are in the split that starts at byte 0 of each file,
    so they are recognised by their place in it, and no line meets another."""
    columns = ", ".join(f"`c{i}` string" for i in range(len(layout.names)))
    if not skip_lines:
        return (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
                .schema(columns).csv(list(layout.files)))
    lines = _decoded_lines(spark, layout.files, encoding).withColumns(
        {"_file": F.input_file_name(), "_block": F.input_file_block_start(), "_pos": F.monotonically_increasing_id()})
    first = lines.where("_block = 0").groupBy("_file").agg(F.min("_pos").alias("_first"))  # a row per file
    rows = lines.join(first, "_file", "left").where(
        (F.col("_block") != 0) | (F.col("_pos") - F.col("_first") > skip_lines))
    return rows.select(F.from_csv(F.col("value"), columns, {"sep": sep}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, *, sep: str = ",", encoding: str = "UTF-8",
             skip_lines: int = 0) -> DataFrame:
    """Delimited text with a header and a declared schema of the columns to
    keep (S1, S2, S6, S7, S8), see ``by_header``. ``path`` is a file, a folder
    or a list; every file has its own header below ``skip_lines`` banner lines,
    and files whose columns differ in order or number are bound by name. A
    missing column is an error that names the file."""
    parts = [by_header(_texts(spark, one, sep=sep, encoding=encoding, skip_lines=skip_lines).toDF(*clean_names(one.names)),
                       schema, ", ".join(one.files[:3]) + (" ..." if len(one.files) > 3 else ""))
             for one in layouts(spark, path, sep=sep, encoding=encoding, skip_lines=skip_lines)]
    return union_all(parts, allow_missing=False)


def read_positional(spark: SparkSession, path: str | Sequence[str], schema: str, *, sep: str = ",", encoding: str = "UTF-8",
                    skip_lines: int = 0) -> DataFrame:
    """Delimited text whose columns are declared by their place (D5, S10): any
    header will do, and columns beyond the declared ones are left out."""
    wanted, parts = _declared(schema), []
    for one in layouts(spark, path, sep=sep, encoding=encoding, skip_lines=skip_lines):
        if len(one.names) < len(wanted):
            raise ValueError(f"{one.files[0]} has {len(one.names)} columns, {len(wanted)} are read by position")
        texts = _texts(spark, one, sep=sep, encoding=encoding, skip_lines=skip_lines)
        parts.append(texts.select(*[_typed(f"c{i}", name, kind) for i, (name, kind) in enumerate(wanted)]))
    return union_all(parts, allow_missing=False)


def read_sheets(spark: SparkSession, paths: Mapping[str, str], schema: str, *, fmt: str = "parquet", sep: str = ",",
                encoding: str = "UTF-8", skip_lines: int = 0,
                renames: Mapping[str, Mapping[int, str]] | None = None) -> dict[str, DataFrame]:
    """One table per hospital (S4), by hospital. Declared columns are found by
    each sheet's own header; ``renames`` gives some columns of a hospital's
    sheet another name by their place first (D5)."""
    out = {}
    for hospital, path in paths.items():
        places = (renames or {}).get(hospital, {})
        if fmt == "parquet":
            df = spark.read.parquet(path)
            df = df.toDF(*_renamed(clean_names(df.columns), places))
            missing = [n for n, _ in _declared(schema) if n not in df.columns]
            if missing:
                raise ValueError(f"columns missing in {path}: {missing}; it has {df.columns}")
            out[hospital] = df.select(*[n for n, _ in _declared(schema)])
            continue
        parts = [by_header(_texts(spark, one, sep=sep, encoding=encoding, skip_lines=skip_lines).toDF(
                           *_renamed(clean_names(one.names), places)), schema, one.files[0])
                 for one in layouts(spark, path, sep=sep, encoding=encoding, skip_lines=skip_lines)]
        out[hospital] = union_all(parts, allow_missing=False)
    return out


def _renamed(names: Sequence[str], places: Mapping[int, str]) -> list[str]:
    return [places.get(i, name) for i, name in enumerate(names, 1)]


def bind_sheets(sheets: Mapping[str, DataFrame], column: str = "hospital") -> DataFrame:
    """``do.call(rbind, list)`` with the sheet's name as a column: same column names required."""
    return union_all([df.withColumn(column, F.lit(name)) for name, df in sheets.items()], allow_missing=False)


def read_waiting_list(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Open or closed waiting-list extract (S5, S9). Text dates are parsed with
    the lenient parser; a date that does not parse becomes null (N9)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        df = df.toDF(*clean_names(df.columns))
    else:
        from waitlens.sources.schemas import WAITING_LIST_TEXT
        df = read_csv(spark, path, WAITING_LIST_TEXT, **options)
    types = dict(df.dtypes)
    dates = {}
    for c in ("fecha_nac", "f_entrada", "f_salida"):
        if c not in types or types[c] == "date":
            continue
        # date-times keep their day; text goes through the lenient parser
        dates[c] = F.col(c).cast("date") if types[c].startswith("timestamp") else parse_date(c)
    return df.withColumns(dates)
