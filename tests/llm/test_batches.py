"""Rows on their way to Python: batches of bounded size."""

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from waitlens.session import ARROW_BATCH, bound_batches


def _largest_batch(spark):
    rows = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    return rows.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0]


def test_long_texts_go_in_bounded_batches(spark):
    """30 MB of texts in one partition, fewer rows than the default batch has."""
    assert _largest_batch(spark) < 6 << 20


def test_stages_bound_batches_where_unset(spark, make, small):
    docs, kept = make([(1, "some words"), (2, "")]), spark.conf.get(ARROW_BATCH)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(ARROW_BATCH)
            stage(spark, docs, small)
            assert spark.conf.get(ARROW_BATCH) == "4m"
        spark.conf.set(ARROW_BATCH, "1m")
        bound_batches(spark)
        assert spark.conf.get(ARROW_BATCH) == "1m"
    finally:
        spark.conf.set(ARROW_BATCH, kept)

