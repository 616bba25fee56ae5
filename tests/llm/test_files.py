"""Files that checkpoints leave in the shared folder: as many as the rows fill."""

import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waitlens.llm import common
from waitlens.llm.common import cut, shared_dir
from waitlens.llm.components import components

PARTS = 64


@pytest.fixture
def apart(spark):
    """Many shuffle partitions that stay apart; gives a counter of the checkpoints' files."""
    held = {"spark.sql.shuffle.partitions": str(PARTS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    shared_dir(spark)
    top = urlparse(spark.sparkContext._jsc.sc().getCheckpointDir().get()).path
    yield lambda: sum(f.startswith("part-") for _, _, names in os.walk(top) for f in names)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_of_components_leave_few_files(spark, apart):
    n = 300
    edges = spark.range(1, n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    old = apart()
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == dict.fromkeys(range(1, n + 1), 1)
    assert apart() - old < 2 * PARTS  # the first table's, and one or two of each round


def test_near_copies_leave_few_files(spark, apart, make, small):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k + 1:]]) for k in range(8)] + [f"lone{k} a{k} b{k} c{k} d{k} e{k}" for k in range(20)]
    docs = make(list(enumerate(texts)))
    old = apart()
    kept = corpus_pipeline.drop_near_copies(spark, docs, small)
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(8, 28)]
    assert apart() - old < 4 * PARTS


def test_files_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "FILE_ROWS", 100)
    rows = spark.range(0, 950, 1, 20)
    assert cut(rows, 950).rdd.getNumPartitions() == 10
    assert cut(rows).rdd.getNumPartitions() == cut(rows, 10_000).rdd.getNumPartitions() == 20
    assert cut(rows, 0).count() == 950
