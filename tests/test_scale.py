"""Scale behaviour that can be observed on one machine: a person key holding
a third of all rows in the cohort's shuffle join is split by adaptive
execution, and no row is lost; hot groups are reduced before the shuffle."""

import contextlib

from pyspark.sql import functions as F

from waitlens.operators.aggregates import count_by
from waitlens.plans import gap


@contextlib.contextmanager
def conf(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_person_key_is_split_and_no_row_lost(spark):
    n = 30_000
    # a third of the exits belong to one person
    exits = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 5000 + 2).cast("string")).alias("run"),
        F.lit("9").alias("dv"), F.when(F.col("id") % 7 == 0, "07-002").otherwise("07-001").alias("presta_min"),
        F.lit("x").alias("pad"))
    waiting = exits.limit(0)
    registry = spark.range(1, 5002).select(
        F.col("id").cast("string").alias("rut_paciente_sdv"), F.lit("Buin").alias("comuna_establecimiento"),
        F.lit(None).cast("string").alias("rut"), F.lit(None).cast("string").alias("rut_paciente"),
        F.lit(None).cast("string").alias("rut_sdv"), F.lit(None).cast("string").alias("apellido_paterno"))
    subset = spark.createDataFrame([("07-001",), ("07-002",)], "codigosigte string")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.shuffle.partitions": "16"}):
        cohort = gap.enrolled_cohort(exits, waiting, registry, communes=["Buin"], subset=subset)
        assert len(cohort.collect()) == n
        plan = executed_plan(cohort)
    assert "SortMergeJoin" in plan
    assert "skew=true" in plan or "isSkewJoin=true" in plan


def test_hot_group_is_reduced_before_the_shuffle(spark):
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    out = count_by(df, ["k"])
    rows = {r.k: r.n for r in out.collect()}
    assert rows["hot"] == 30_000 and len(rows) == 60_001
    assert "partial_count" in executed_plan(out)
