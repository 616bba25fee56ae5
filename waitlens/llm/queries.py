"""The registered queries: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.llm import chat_format, decontaminate, embedding_dedup, hilbert, lm_score, ngram_join, packing, periodic_runs
from waitlens.llm import spotsigs, suffix_dedup, token_count, toxicity, whitening
from waitlens.llm.common import table, tokenizer_path
from waitlens.llm.oracle import ORACLE  # noqa: F401


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target expansion of all conversations and conversation -7, read back."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = chat_format.read_back(chat_format.expand(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       "formatted_chars")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside all documents."""
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of all documents."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram trie scores of all documents, learned from four fifths of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    trie = lm_score.build(documents.filter(lm_score.is_training(F.col("doc_id"))))
    held_out = ~lm_score.is_training(F.col("doc_id"))
    return lm_score.score(documents, trie).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and numbers of links of the 5-word shingle join of all documents at 0.75."""
    rows = ngram_join.ngram_components(table(spark, sf_dir, "documents"), counted=True)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("n_similar").alias("n_links"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that repeat 100 bytes from earlier ones."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    cut_pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                added=packing.added_tokens(tokenizer_path("byte_bpe_50k.json")))
    rows = packing.pack(cut_pieces)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards along a Hilbert curve over lang, source and n_chars."""
    placed = hilbert.shards(table(spark, sf_dir, "documents"), dimensions=["lang", "source", "n_chars"], n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out quarter."""
    documents = table(spark, sf_dir, "documents")
    rows = toxicity.score(documents.select("doc_id", "text"), toxicity.fit(documents, toxicity.learnable(table(spark, sf_dir, "labels"))))
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                       (F.col("toxicity") >= toxicity.REJECT_AT).cast("int").alias("predicted"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of embeddings on up to 32 whitened components, one row a vector and component."""
    rows, fitted = whitening.whiten(table(spark, sf_dir, "embeddings"))
    shares = [float(e / fitted.trace) for e in fitted.eigenvalues] if fitted and fitted.trace else []
    spread = rows.select("vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return spread.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))


def repeated_tails(documents: DataFrame) -> DataFrame:
    """doc_id, text: the texts whose crc32(doc_id) is a multiple of ten end in a repeated passage, as
    the contract of op12 asks; all others, and those of null doc_id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split("text", "[\x20\x09-\x0D]+"), "")
    rows = documents.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    rows = rows.withColumn("n", n).withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    a, p = F.col("a"), F.col("p")
    repeated = F.transform("w", lambda w, i: F.when(i < a, w).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, of which a tenth end in a repeated passage."""
    rows = periodic_runs.periodic_runs(repeated_tails(table(spark, sf_dir, "documents")))

    def ahead(x, y):  # greatest length / period first, then start, then period
        over, under = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(over != under, F.when(over > under, -1).otherwise(1))
                .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))

    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates at cosine 0.93 among all embeddings of equal label."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_count": op3_token_count,
    "op4_lm_score": op4_lm_score,
    "op5_ngram_join": op5_ngram_join,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_hilbert": op8_hilbert,
    "op9_spotsigs": op9_spotsigs,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_dedup": op13_embedding_dedup,
}
ORACLE_SQL: dict[str, str] = dict(ORACLE)
