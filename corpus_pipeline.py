"""A corpus pipeline of five stages over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet to the shared folder and read again as the next stage's documents. All but the
last return the columns of documents.

1. toxicity: documents that the toxicity model rejects go
2. ngram_join: of each group of near copies (5-word shingles, Jaccard 0.75) one row stays, that of
   least doc_id (null last) and then of least SHA-256 of its text; rows that only share a doc_id stay
3. suffix_dedup: bytes repeating 100 bytes of an earlier document are removed; all rows stay
4. decontamination: documents contaminated by benchmark windows go
5. packing: the rest is tokenized and packed into sequences of at most 2048 tokens; the result has
   each piece's ids and its place, ``packing.write_sequences`` writes whole sequences from it
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from waitlens.llm.common import cut, packed, shared_dir, table, tokenizer_path, unpacked
from waitlens.session import bound_batches


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored at least REJECT_AT by a model learned from the labelled ones."""
    bound_batches(spark)
    weights = toxicity.fit(docs, toxicity.learnable(table(spark, sf_dir, "labels")))
    return unpacked(toxicity.score(packed(docs), weights).filter(F.col("toxicity") < toxicity.REJECT_AT))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of the n-gram join, whatever ids its rows have; documents
    without words all stay. Of rows equal in doc_id and text one stays, by its other columns."""
    bound_batches(spark)
    sha = F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha")
    linked = cut(ngram_join.ngram_components(docs.select("doc_id", "text", sha), keys=("doc_id", "_sha")), docs.count())
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_sha")
    first = linked.filter("n_shingles > 0").groupBy("component").agg(F.min(place).alias("row")).select("row.doc_id", "row._sha")
    rows = packed(docs).withColumn("_sha", sha)

    def only(keys: DataFrame, side: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("_id"), F.col("_sha").alias("_text"))
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_text")), side)

    repeated = linked.filter("n_shingles > 0").groupBy("doc_id", "_sha").count().filter("count > 1").select("doc_id", "_sha")
    wordless = linked.filter("n_shingles = 0").select("doc_id", "_sha").distinct()
    if not repeated.limit(1).count():
        return unpacked(only(first.unionByName(wordless), "left_semi"))
    both = first.join(repeated.toDF("_id", "_text"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_text")), "left_semi")
    once = first.join(repeated.toDF("_id", "_text"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_text")), "left_anti")
    one = only(both, "left_semi").groupBy("doc_id", "_sha").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return unpacked(only(once.unionByName(wordless), "left_semi").select("_row").unionByName(one.select("_row")))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages from the texts."""
    bound_batches(spark)
    return suffix_dedup.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth."""
    bound_batches(spark)
    rows = decontaminate.contamination(packed(docs), table(spark, sf_dir, "benchmark"))
    return unpacked(rows.filter(~F.col("contaminated")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids and places in the training sequences."""
    import public_tokenizers

    bound_batches(spark)
    return packing.pack(packing.pieces(docs, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                       added=packing.added_tokens(tokenizer_path("byte_bpe_50k.json"))))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
