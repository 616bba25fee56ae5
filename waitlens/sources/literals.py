"""Literal tables of the reference (S3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference: the four service types of the waiting list.
SERVICE_TYPES: tuple[tuple[int, str], ...] = (
    (1, "Consulta nueva de especialidad"),
    (2, "Consulta control"),
    (3, "Procedimiento"),
    (4, "Intervención quirúrgica"),
)


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """A small literal table built inside the JVM (``inline`` of an array of
    structs): no Python worker runs for it, unlike ``createDataFrame`` of a list."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def service_types(spark: SparkSession) -> DataFrame:
    """``data.frame(n = 1:4, descripcion = ...)`` as a four-row DataFrame."""
    return literal_table(spark, SERVICE_TYPES, [("n", "int"), ("descripcion", "string")])
