"""Benchmark decontamination: prefix-filtered set join of item windows with documents, in
DataFrame functions only.

A window is 13 consecutive words of an item (a shorter item is one window). The join runs over
3-word shingles (items of one or two words: shingles of that size):

1. the shingles of the documents that occur in any window, with their positions (the only pass
   that makes a row per document word; those rows are two numbers and are filtered by the
   benchmark's shingles at once);
2. rarity: the shingles of a window are ordered by how often they occur in the documents. A
   window must be contained whole, so its prefix is one token: the rarest. A window with a
   shingle that no document has is dropped;
3. prefix join; length bound (the document has at least the window's words) and positional bound
   (the window, laid with its shingle on the document's, must lie inside the text);
4. exact check of the words over the item-sized window, then union of the hit positions.

Shingle hashes are taken over words that are lower-cased one by one by Unicode's rules. Two words that
are equal after A-Z lower-casing stay equal then: they differ at most in the case of ASCII letters, and
what stands outside a word (which decides, for one, on a final sigma) plays no part. The exact check
compares the words lower-cased as the contract says. Hits are gathered by doc_id and text hash, so rows
that share an id (null too) do not meet in one task unless their texts are equal, which adds no hits.

Defined cases: null or empty texts have no words, an item without words has no window and never
occurs; equal windows of several items are joined once and count for each item; repeated items
count once; null item ids are not listed; documents sharing a doc_id are each judged by their own
text; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import ascii_lower, cut

#: fixed values of the contract: what separates words, window size, hit share (1 / 20)
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW_WORDS = 13
SHINGLE_WORDS = 3
#: the benchmark's shingles are broadcast up to this many (12 bytes each), else joined by shuffle
BROADCAST_SHINGLES = 500_000


def words(text: Column) -> Column:
    """Words of a text whose case has been dealt with (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def shingles(tokens: Column, size: int) -> Column:
    """Hash of the ``size`` words at every position."""
    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(tokens, i + k) for k in range(size)])
    n = F.size(tokens)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), at)).otherwise(F.array().cast("array<bigint>"))


def folded(tokens: Column) -> Column:
    """Words in lower case, each by itself."""
    return F.transform(tokens, F.lower)


def item_windows(benchmark: DataFrame, window_words: int) -> DataFrame:
    """One row per distinct window: window (its words, joined by blanks), length, items."""
    items = benchmark.select("item_id", words(ascii_lower(F.col("text"))).alias("tokens")).filter(F.size("tokens") > 0)
    length = F.least(F.size("tokens"), F.lit(window_words))
    start = F.explode(F.sequence(F.lit(1), F.size("tokens") - length + 1))
    rows = items.select("item_id", "tokens", length.alias("length"), start.alias("start"))
    rows = rows.select("item_id", "length", F.array_join(F.slice("tokens", F.col("start"), F.col("length")), " ").alias("window"))
    return rows.groupBy("window").agg(F.first("length").alias("length"), F.collect_set("item_id").alias("items"))


def _spread(windows: DataFrame, size: int) -> DataFrame:
    """Shingles of the windows: window, length, at (position in the window), shingle, size."""
    tokens = folded(F.split("window", " "))
    own = F.least(F.col("length"), F.lit(SHINGLE_WORDS)) == size
    return (windows.filter(own).select("window", "length", tokens.alias("tokens"))
            .select("window", "length", F.posexplode(shingles(F.col("tokens"), size)).alias("at", "shingle"))
            .withColumn("size", F.lit(size)))


def candidates(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """Per doc_id and text hash (``documents``: doc_id, text, text_hash) with candidate windows: found
    (array of start, length, window, items)."""
    sizes = sorted(r[0] for r in windows.select(F.least("length", F.lit(SHINGLE_WORDS))).distinct().collect())  # at most three numbers
    if not sizes:
        sizes = [SHINGLE_WORDS]
    spread = _spread(windows, sizes[0])
    for size in sizes[1:]:
        spread = spread.unionByName(_spread(windows, size))
    spread = cut(spread)
    wanted = spread.select("size", "shingle").distinct()
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    matches = None
    for size in sizes:
        tokens = documents.select("doc_id", "text_hash", folded(words(F.col("text"))).alias("tokens"))
        rows = tokens.select("doc_id", "text_hash", F.size("tokens").alias("n"), F.posexplode(shingles(F.col("tokens"), size)).alias("pos", "shingle"))
        rows = rows.withColumn("size", F.lit(size)).join(wanted, ["size", "shingle"])
        matches = rows if matches is None else matches.unionByName(rows)
    matches = cut(matches)

    counted = matches.groupBy("size", "shingle").agg(F.count("*").alias("occurrences"))
    prefix = (spread.join(counted, ["size", "shingle"]).groupBy("window", "length", "size")
              .agg(F.count("*").alias("known"), F.min(F.struct("occurrences", "shingle", "at")).alias("rarest"))
              .filter(F.col("known") == F.col("length") - F.col("size") + 1)
              .select("window", "length", "size", F.col("rarest.shingle").alias("shingle"), F.col("rarest.at").alias("at")))
    start = F.col("pos") - F.col("at")
    hit = (matches.join(prefix, ["size", "shingle"])
           .filter((start >= 0) & (start + F.col("length") <= F.col("n")))
           .select("doc_id", "text_hash", start.alias("start"), "length", "window").distinct()
           .join(windows.select("window", "items"), "window"))
    return hit.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "length", "window", "items")).alias("found"))


def contamination(documents: DataFrame, benchmark: DataFrame, *, window_words: int = WINDOW_WORDS,
                  share: int = 20) -> DataFrame:
    """Per document: doc_id, _row if given (see ``packed``), n_words, n_hit, hits (array of start, length,
    window, items), items (sorted as strings) and contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    windows = cut(item_windows(benchmark, window_words))
    rows = documents.select("doc_id", "text", *[c for c in documents.columns if c == "_row"], F.xxhash64("text").alias("text_hash"))
    found = candidates(rows.select("doc_id", "text", "text_hash"), windows).withColumnsRenamed({"doc_id": "_found_id", "text_hash": "_found_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_found_id")) & (F.col("text_hash") == F.col("_found_hash"))
    rows = rows.join(found, same, "left").drop("_found_id", "_found_hash", "text_hash")
    exact = F.when(F.col("found").isNotNull(), words(ascii_lower(F.col("text"))))
    rows = rows.withColumn("n_words", F.size(words(F.col("text"))).cast("long")).withColumn("tokens", exact)
    hits = F.filter("found", lambda c: F.array_join(F.slice("tokens", c["start"] + 1, c["length"]), " ") == c["window"])
    none = F.array().cast(rows.schema["found"].dataType)
    rows = rows.withColumn("hits", F.sort_array(F.coalesce(hits, none))).drop("tokens", "found")
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, h: F.struct(F.greatest(a["end"], h["start"] + h["length"]).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), h["start"] + h["length"] - F.greatest(a["end"], h["start"]))).alias("n")),
        lambda a: a["n"])
    items = F.array_sort(F.transform(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))), lambda i: i.cast("string")))
    rows = rows.withColumn("n_hit", covered.cast("long")).withColumn("items", items)
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
