"""Tables bucketed by a join key in the session catalogue (J5): a join of two of them needs no shuffle.

Rows of null key are left out, since they join with nothing. A bucket is read by one task and cannot be
split at run time, so ``write_bucketed`` counts the rows of the most frequent key; where that key would
fill more than ``HOT_BUCKETS`` buckets' share of the table, ``read_bucketed`` gives the same rows without
their buckets and the join is an ordinary shuffle join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_BUCKETS = 4


def write_bucketed(rows: DataFrame, table: str, path: str, *, key: str, buckets: int) -> None:
    """Write ``rows`` as Parquet in ``buckets`` files by ``key`` and register them as ``table``."""
    spark = rows.sparkSession
    held = rows.where(F.col(key).isNotNull()).repartition(buckets, key)  # one file a bucket
    (held.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    counts = spark.read.parquet(path).groupBy(key).count().agg(F.max("count").alias("most"), F.sum("count").alias("total")).first()
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('rows_total' = '{counts.total or 0}', 'rows_of_most_frequent_key' = '{counts.most or 0}', "
              f"'buckets' = '{buckets}')")


def is_hot(spark: SparkSession, table: str) -> bool:
    """Whether one key holds more rows than ``HOT_BUCKETS`` average buckets."""
    held = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    total, most, buckets = (int(held[k]) for k in ("rows_total", "rows_of_most_frequent_key", "buckets"))
    return most * buckets > HOT_BUCKETS * total


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table with its buckets, or without them where one key is too frequent."""
    if not is_hot(spark, table):
        return spark.table(table)
    path = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type
    return spark.read.parquet(path)
