"""Word hashes, token counts, packing, Elias-Fano and the n-gram trie."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from waitlens.llm import lm_score, packing, token_count
from waitlens.llm.common import tokenizer_path
from waitlens.llm.elias_fano import EliasFano, fields, load, save, sequence
from waitlens.llm.wordhash import CHUNK_BYTES, WordHasher

EDGE = [None, "", " ", "  a", "a  b", "a \n b", "x\n", " \t\r\n ", "it's  fine", "a\x1c b", "<|endoftext|> a", "a  b", "　 b c", "a\x85 b", "Ünï \U0001f600 "]


def test_word_hashes():
    hasher = WordHasher()
    random.seed(1)
    texts = ["".join(random.choices("aAbB \n\té", k=random.randint(0, 80))) for _ in range(300)] + [None, "", "x" * (2 * CHUNK_BYTES), "ab " * CHUNK_BYTES]
    seen = {}
    n = 0
    for first, h, bounds in hasher.hashes(texts):
        for k in range(len(bounds) - 1):
            words = (texts[first + k] or "").encode().lower().split()
            assert len(words) == bounds[k + 1] - bounds[k]
            for w, x in zip(words, h[bounds[k]:bounds[k + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
            n += 1
    assert n == len(texts) and len(set(seen.values())) == len(seen)


def test_longest_match_equals_greedy():
    random.seed(3)
    pieces = [bytes([b]) for b in range(256)] + ["".join(random.choices("abc", k=random.randint(2, 6))).encode() for _ in range(60)]
    automaton, known = token_count.LongestMatch(pieces), set(pieces)

    def greedy(word):
        n = 0
        while word:
            size = next(k for k in range(len(word), 0, -1) if word[:k] in known)
            word, n = word[size:], n + 1
        return n

    for _ in range(3000):
        word = "".join(random.choices("abcd", k=random.randint(0, 25))).encode()
        assert automaton.count(word) == greedy(word)
    assert automaton.count(b"a" * 100_000) == greedy(b"a" * 2000) + automaton.count(b"a" * 98_000)


def test_token_counts(make):
    path = tokenizer_path("piece_bpe_32k.model")
    known = set(token_count.vocabulary(path))
    got = {r.doc_id: r for r in token_count.token_counts(make([(1, "The quick  brown\nÉclair"), (2, None), (3, ""), (4, "a " * 30_000)]), path).collect()}

    def greedy(word):
        n = 0
        while word:
            size = next(k for k in range(len(word), 0, -1) if word[:k] in known)
            word, n = word[size:], n + 1
        return n

    sizes = [greedy(("▁" + w).encode()) for w in "The quick brown Éclair".split()]
    assert (got[1].n_words, got[1].n_tokens, got[1].longest_word_tokens) == (4, sum(sizes), max(sizes))
    assert got[2].n_tokens == got[3].n_tokens == 0 and got[4].n_words == 30_000
    assert token_count.token_counts(make([(1, "x")]).limit(0), path).count() == 0


def test_ids_equal_the_tokenizers_library(spark, small):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [t or "" for t in EDGE]
    words = packing.WordIds(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_ids_of_added_tokens_equal_the_librarys_default(spark, tmp_path):
    from tokenizers import Tokenizer

    from waitlens.llm.queries import op7_packing
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for t in EDGE] + ["say <|endoftext|> now", "<|endoftext|>", "a<|endoftext|><|endoftext|>b c  <|endoftext|>\n", "x <|endoftext| > y"]
    words = packing.WordIds(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(i, "<u4").tolist() for i in words.encode(texts)] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in op7_packing(spark, str(tmp_path)).collect()}
    assert got == {d: (len(i) + 1, zlib.crc32(np.array([*i, 1], "<u4").tobytes())) for d, i in enumerate(want)}


def test_first_fit_decreasing():
    random.seed(4)
    for _ in range(50):
        sizes = np.array([random.randint(1, 64) for _ in range(random.randint(1, 80))])
        free, want = [], np.empty(len(sizes), int)
        for i in np.argsort(-sizes, kind="stable"):
            at = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
            if at == len(free):
                free.append(64)
            free[at] -= sizes[i]
            want[i] = at
        assert packing.first_fit_decreasing(sizes, 64).tolist() == want.tolist()


@pytest.mark.parametrize("group_pieces", [20_000, 7])
def test_packing_places_every_id_once(make, group_pieces):
    docs = [(i, "word " * (i * 37 % 900)) for i in range(40)] + [(100, None), (101, ""), (5, "same"), (5, "same"), (102, "long text " * 9000)]
    rows = packing.pieces(make(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = packing.pack(rows, group_pieces=group_pieces).collect()
    words = packing.WordIds(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = collections.Counter()
    for (d, _), ids in zip(docs, words.encode([t or "" for _, t in docs]), strict=True):
        ids += (1).to_bytes(4, "little")
        for s in range(0, len(ids) // 4, 2048):
            part = ids[4 * s:4 * s + 8192]
            want[d, s, len(part) // 4, zlib.crc32(part), len(ids) // 4] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(rows.limit(0)).count() == 0


def test_written_sequences_hold_the_ids(spark, make, tmp_path):
    docs = [(i, "word " * (i * 37 % 900)) for i in range(30)] + [(100, None), (101, "long text " * 3000), (5, "same"), (5, "same")]
    rows = packing.pieces(make(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    placed = packing.pack(rows, group_pieces=9).checkpoint()
    got = placed.collect()
    words = packing.WordIds(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    whole = [ids + (1).to_bytes(4, "little") for ids in words.encode([t or "" for _, t in docs])]
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == collections.Counter(
        (d, ids[s:s + 8192]) for (d, _), ids in zip(docs, whole, strict=True) for s in range(0, len(ids), 8192))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    packing.write_sequences(placed, str(tmp_path / "out"))
    written = {r.sequence_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(written) == {r.sequence_id for r in got}
    for number, row in written.items():
        parts = b"".join(bytes(r.ids) for r in sorted((r for r in got if r.sequence_id == number), key=lambda r: r.offset))
        n = len(parts) // 4
        assert row.n_tokens == n
        assert bytes(row.ids) == (parts if n & (n - 1) == 0 else parts + (1).to_bytes(4, "little") * (2048 - n))


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(1)
    for n, universe in ((1, 5), (10, 10), (1000, 10 ** 6), (70_000, 1 << 44), (5000, 100), (0, 10), (3, 1 << 62)):
        values = np.sort(rng.integers(0, universe, n, np.uint64))
        save(str(tmp_path / "x"), fields("a", EliasFano.build(values, universe)))
        s = sequence(load(str(tmp_path / "x")), "a")
        assert (s[np.arange(n)] == values).all()
        asked = np.concatenate([values, rng.integers(0, universe, 500, np.uint64)])
        first = {int(x): i for i, x in reversed(list(enumerate(values)))}
        assert s.find(asked).tolist() == [first.get(int(x), -1) for x in asked]


def test_elias_fano_search_in_ranges():
    rng = np.random.default_rng(2)
    for n, universe in ((1, 5), (300, 1000), (3000, 1 << 40), (5000, 100)):
        values = np.sort(rng.integers(0, universe, n, np.uint64))
        asked = np.concatenate([values, rng.integers(0, universe, 500, np.uint64)])
        begin, end = rng.integers(0, n + 1, (2, len(asked)))
        want = [next((i for i in range(a, b) if values[i] == x), -1) for x, a, b in zip(asked[::7], begin[::7], end[::7], strict=True)]
        found = EliasFano.build(values, universe).find(asked, (begin, end))
        assert found[::7].tolist() == want


def test_lm_pairs_are_found_in_the_range_of_their_context(make, small, spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").limit(40).collect()]
    trie = lm_score.build(make(rows))
    hashes, pairs = lm_score.WordHasher(), set()
    for _, codes, bounds in hashes.hashes([t for _, t in rows]):
        all_ids, _, contexts, _ = lm_score._pairs(trie, codes, bounds)
        pairs |= set(zip(contexts.tolist(), all_ids.tolist(), strict=True))
    n = trie.words + 1
    rng = random.Random(3)
    asked = sorted(pairs | {(rng.randrange(n), rng.randrange(n)) for _ in range(3000)})
    seen, _ = trie.bigrams(*np.array(asked).T)
    assert [not np.isnan(x) for x in seen] == [p in pairs for p in asked]


def brute_scores(rows):
    def tokens(text):
        return (text or "").encode().lower().split() + [None]

    def training(d):
        return d is not None and zlib.crc32(str(d).encode()) % 5 != 1

    c, b, following = collections.Counter(), collections.Counter(), collections.Counter()
    for d, t in rows:
        if training(d):
            x = tokens(t)
            c.update(x)
            b.update(zip([None, *x[:-1]], x, strict=True))
    for v, _ in b:
        following[v] += 1
    n1, n2 = (sum(x == k for x in b.values()) for k in (1, 2))
    discount = n1 / (n1 + 2 * n2) if n1 else 0.5
    total, types = sum(c.values()), len(c)

    def single(w):
        return (c[w] + 0.5) / (total + 0.5 * (types + 1))

    out = []
    for d, t in rows:
        x = tokens(t)
        score = sum(math.log10(single(w)) if not c[v] else
                    math.log10(max(b[v, w] - discount, 0) / c[v] + discount * following[v] / c[v] * single(w)) for v, w in zip([None, *x[:-1]], x, strict=True))
        out.append((d, len(x), sum(c[w] > 0 for w in x), sum(math.log10(single(w)) for w in x), score))
    return out, total


def test_lm_scores_equal_brute_force(spark, make, small):
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = own + [(1000, None), (1001, ""), (1002, "the"), (1002, "the"), (None, "x The x")]
    docs = make(rows)
    trie = lm_score.build(docs.filter(lm_score.is_training(F.col("doc_id"))))
    got = sorted(map(tuple, lm_score.score(docs, trie).collect()), key=str)
    want, total = brute_scores(rows)
    assert trie.tokens == total
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-6
        assert -0.01 <= (w[4] - g[4]) / w[1] < 12 / 255 + 0.01  # quantised down by less than a step a token


def test_lm_backoff_does_not_depend_on_bounds(spark, make):
    docs = make([(i, "a b " * 40 + f"c{i} d{i}") for i in range(30)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        trie = lm_score.build(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    n = trie.words + 1
    contexts, words = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    weights = trie.bigrams(contexts, words)[1].reshape(n, n)
    assert any(b % n for b in trie.meta["bounds"])
    assert (weights == weights[:, :1]).all() and (weights < 0).any()


def test_lm_without_training_rows(make):
    docs = make([(1, "a b"), (2, None)])
    trie = lm_score.build(docs.limit(0))
    assert [(r.base_score, r.score) for r in lm_score.score(docs, trie).collect()] == [(0.0, 0.0)] * 2


def test_equal_rows_are_spread_over_groups(spark):
    from pyspark.sql import functions as F

    from waitlens.llm import packing
    rows = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("length"),
                                   F.lit(7).cast("long").alias("ids_crc32"), F.lit(1).cast("long").alias("doc_tokens"), F.lit(b"\x01\0\0\0").alias("ids"))
    placed = packing.pack(rows, group_pieces=20)
    per_group = [r["count"] for r in placed.groupBy((F.col("sequence_id") / (1 << 32)).cast("long")).count().collect()]
    assert sum(per_group) == 300 and max(per_group) <= 45


def test_lm_scores_of_an_empty_table(make):
    docs = make([(0, "a b a"), (2, "b c")])
    assert lm_score.score(docs.limit(0), lm_score.build(docs)).count() == 0


def test_token_counts_of_repeated_rows(make):
    rows = [(1, "one text, repeated")] * 5 + [(None, "one text, repeated")] * 3 + [(2, None)] * 2
    got = sorted(map(tuple, token_count.token_counts(make(rows), tokenizer_path("piece_bpe_32k.model")).collect()), key=str)
    assert len(got) == 10 and len(set(got)) == 3 and len({r[1:] for r in got}) == 2
