"""N-gram join, suffix sorting, suffix dedup, fingerprints: against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from waitlens.llm import ngram_join, spotsigs, suffix_dedup
from waitlens.llm.components import components
from waitlens.llm.induced import suffix_order


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def near_copies(seed=1):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "THE", "the"]
    rows = []
    for d in range(60):
        base = random.choices(words, k=random.choice([1, 3, 4, 5, 9, 40, 120, 400]))
        rows.append((len(rows), " ".join(base)))
        for _ in range(random.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(random.randint(0, max(1, len(copy) // 20))):
                copy[random.randrange(len(copy))] = random.choice(words)
            rows.append((len(rows), random.choice([" ", "\n", "  "]).join(copy)))
    passage = " ".join(random.choices(words, k=30))  # a passage in many documents
    rows += [(len(rows) + i, passage + " " + " ".join(random.choices(words, k=random.randint(2, 60)))) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, rows[3][1]), (905, rows[3][1]), (None, rows[5][1]), (None, "lone text of some six words")]
    return rows


@pytest.mark.parametrize("block_shingles", [ngram_join.BLOCK_SHINGLES, 200])
def test_join_equals_brute_force(make, block_shingles):
    rows = near_copies()
    got = ngram_join.ngram_components(make(rows), block_shingles=block_shingles).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)


def test_join_of_a_large_group_and_empty_table(make):
    random.seed(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(500):
        copy = list(base)
        copy[random.randrange(60)] = f"x{d}"
        rows.append((d, " ".join(copy)))
    got = ngram_join.ngram_components(make(rows)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.n_links for r in got) <= 2 * 499  # spanning links, not all pairs
    assert ngram_join.ngram_components(make(rows[:2]).limit(0)).count() == 0


def brute_links(rows):
    sets = [shingle_set(t) for _, t in rows]
    return sorted(((d, sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= 75 * len(a | b)))
                   for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("block_shingles", [ngram_join.BLOCK_SHINGLES, 200])
def test_number_of_links_equals_brute_force(make, block_shingles):
    base = [f"w{i}" for i in range(60)]
    clique = [(2000 + d, " ".join([*base[:d % 60], f"x{d}", *base[d % 60 + 1:]])) for d in range(90)]
    rows = near_copies() + clique + [(3000, clique[0][1])] * 2
    got = ngram_join.ngram_components(make(rows), block_shingles=block_shingles, counted=True).collect()
    assert sorted(((r.doc_id, r.n_similar) for r in got), key=str) == brute_links(rows)


def test_registered_join_gives_all_links(spark, small):
    from waitlens.llm.queries import op5_ngram_join
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_links) for r in op5_ngram_join(spark, small).collect()), key=str) == brute_links(rows)


def test_signature_tree_search_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(30):
        pool = rng.integers(0, 1 << 63, 40, np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(1, 30))) for _ in range(rng.integers(1, 60))]
        links = ngram_join.search(sets, np.arange(len(sets)), (75, 100))
        union = ngram_join.Union(len(sets))
        for i, j in links:
            assert ngram_join._linked(sets[i], sets[j], (75, 100))
            assert union.join(i, j)
        for i in range(len(sets)):
            for j in range(i):
                assert union.root(i) == union.root(j) or not ngram_join._linked(sets[i], sets[j], (75, 100))


def test_components(spark):
    random.seed(6)
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)] + [(200, 200)]
    up = {n: n for e in edges for n in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_suffix_order():
    random.seed(1)
    for _ in range(300):
        text = [random.randint(1, random.choice([1, 2, 3, 250])) for _ in range(random.randint(1, 60))] + [0]
        got = np.concatenate(list(suffix_order(np.array(text, np.int32), random.choice([3, 10, 10 ** 6])))).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def brute_removal(rows, length):
    """Rows equal in doc_id and text are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    seen, out = set(), {}
    for d, t in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for x in bytes(gone).split(b"\0") if x)
        out[d, t] = (d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return sorted((out[r] for r in rows), key=str)


def passages(seed, alphabet, n=50):
    random.seed(seed)
    shared = ["".join(random.choices(alphabet, k=random.randint(90, 400))) for _ in range(6)]
    rows = []
    for d in range(n):
        parts = [random.choice(shared)[random.randint(0, 40):] if random.random() < 0.4 else "".join(random.choices(alphabet, k=random.randint(0, 200)))
                 for _ in range(random.randint(0, 5))]
        rows.append((d * 3 % 101, "".join(parts)))
    return rows


@pytest.mark.parametrize("alphabet", ["abcdefg hijk", "aé", "ab", "日本x"])
def test_removal_equals_brute_force(make, alphabet):
    rows = passages(len(alphabet), alphabet) + [(500, None), (501, ""), (502, "a" * 99), (503, "b" * 100), (504, "xyz" * 3000)]
    got = sorted(map(tuple, suffix_dedup.digests(make(rows)).collect()), key=str)
    assert got == brute_removal(rows, 100)


@pytest.mark.parametrize("sort_bytes", [1, 2000])
def test_removal_with_an_anchor_above_the_sorters_limit(make, sort_bytes):
    random.seed(12)
    passage = "".join(random.choices("abcdefg hijk", k=160))
    rows = [(d, "".join(random.choices("lmnop q", k=random.randint(0, 90))) + passage[d % 7:] + "".join(random.choices("rstu v", k=60))) for d in range(60)]
    rows += passages(5, "aé") + [(700, None), (None, rows[3][1][20:]), (701, rows[0][1])]
    docs = make(rows)
    apart = suffix_dedup.told_apart(suffix_dedup.run_rows(suffix_dedup.keyed(docs.select("doc_id", "text"))[0].select("_key", "text"), 4, 100, 24), 100, sort_bytes).toPandas()
    requested = apart[apart["hashes"].notna()]
    held = {}
    for h, shape in zip(requested[~requested["hot"]]["hashes"], requested[~requested["hot"]]["shapes"], strict=True):
        for a, n in zip(np.frombuffer(h, np.uint64).tolist(), (np.frombuffer(shape, np.uint32) & 0xFFFF).tolist(), strict=True):
            held[a] = held.get(a, 0) + n + 99
    assert requested["hot"].any() and max(held.values(), default=0) <= sort_bytes
    got = sorted(map(tuple, suffix_dedup.digests(docs, sort_bytes=sort_bytes).collect()), key=str)
    assert got == brute_removal(rows, 100)


def test_removal_of_repeated_and_null_ids_and_long_text(make):
    random.seed(9)
    long = "".join(random.choices("abcdefgh", k=300_000))
    rows = passages(3, "abc d") + [(7, long), (8, "zz" + long[100_000:280_000]), (7, long), (7, "other " * 40), (None, long[5000:6000]), (None, "q" * 300)]
    got = sorted(map(tuple, suffix_dedup.digests(make(rows)).collect()), key=str)
    assert got == brute_removal(rows, 100)
    assert suffix_dedup.digests(make(rows).limit(0)).count() == 0


def test_removed_texts_keep_rows_and_columns(make):
    text = "é" * 200
    rows = [(1, "start " + text), (2, "x" + text + " end"), (3, None)]
    docs = make(rows)
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    # é is two bytes: its 100-byte strings repeat two bytes later, so one period more than a string stays
    assert {r.doc_id: r.text for r in got.collect()} == {1: "start é", 2: "x end", 3: None}


def test_sorter_spills_and_maps(monkeypatch):
    random.seed(11)
    texts = [("".join(random.choices("ab", k=300))).encode() for _ in range(20)]
    texts += [t[30:] + b"c" * 150 for t in texts]
    counts = np.array([len(t) - 99 for t in texts])

    def classes():
        out = {}
        for at, offset, number in suffix_dedup.repeated_strings(texts, counts, 100):
            for a, o, c in zip(at.tolist(), offset.tolist(), number.tolist(), strict=True):
                out.setdefault(c, set()).add((a, o))
        return sorted(map(sorted, out.values()))

    plain = classes()
    by_string = {}
    for a, t in enumerate(texts):
        for o in range(len(t) - 99):
            by_string.setdefault(t[o:o + 100], set()).add((a, o))
    assert plain == sorted(map(sorted, by_string.values()))
    monkeypatch.setattr(suffix_dedup, "MAPPED_BYTES", 100)
    monkeypatch.setattr(suffix_dedup, "suffix_order", lambda t: suffix_order(t, 64))
    assert classes() == plain


def spot_set(text):
    words = text.encode().lower().translate(bytes.maketrans(spotsigs.PUNCTUATION, b" " * len(spotsigs.PUNCTUATION))).split()
    anchors, out = {a.encode() for a in spotsigs.ANCHORS}, set()
    for i, w in enumerate(words):
        chain = [x for x in words[i + 1:] if x not in anchors][:2]
        if w in anchors and len(chain) == 2:
            out.add((w, *chain))
    return out or {text}


@pytest.mark.parametrize("parts", [1, 9])
def test_fingerprints_equal_brute_force(spark, make, small, parts):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows += [(1000, None), (1001, ""), (1003, "a"), (1010, rows[4][1]), (1011, rows[4][1])]
    rows = sorted(((d, t or "") for d, t in rows), reverse=True)
    got = {r.doc_id: r for r in spotsigs.edited_fingerprints(make(rows), parts=parts).collect()}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c, g = spot_set(t), spot_set(edited), spot_set(after), got[d]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.near_edited == pytest.approx(len(a & b) / len(a | b)) and g.near_next == pytest.approx(len(a & c) / len(a | c))
    assert got[1010].fingerprint == got[1011].fingerprint


def test_fingerprints_of_few_rows(make):
    one = spotsigs.edited_fingerprints(make([(5, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert spotsigs.edited_fingerprints(make([(5, "abcd")]).limit(0)).count() == 0
    twice = spotsigs.edited_fingerprints(make([(5, "abcd"), (5, "efgh"), (None, "ijkl")])).collect()
    assert len(twice) == 3


def edited_row(doc_id, text, after):
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    a, b, c = spot_set(text), spot_set(edited), spot_set(after)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), len(a & b) / len(a | b), len(a & c) / len(a | c)


@pytest.mark.parametrize("parts", [1, 12])
def test_fingerprints_of_null_and_repeated_ids(make, parts):
    """A third of the ids null, a third of the rows equal, one id with many texts: every row meets the
    next one in the stated order, and no range holds more than a few of the different rows."""
    random.seed(9)

    def said():
        return " ".join(random.choices("the of and water stone river cloud is a".split(), k=30))

    rows = [(None, said()) for _ in range(80)] + [(7, "the same text of a row in many places")] * 80 + [(9, said()) for _ in range(60)]
    rows += [(i, said()) for i in range(20)] + [(None, None), (None, ""), (None, "")]
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), zlib.crc32(r[1].encode()), r[1]))
    want = [edited_row(d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)]
    docs = make(rows)
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in spotsigs.edited_fingerprints(docs, parts=parts).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    dealt, repeated = spotsigs.neighbour_rows(docs, parts)
    sizes = [r["count"] for r in dealt.filter("not guest").groupBy("part").count().collect()]
    assert repeated and sum(sizes) == len(set(order)) and (parts == 1 or max(sizes) < len(set(order)) / 4)


def test_numbers_of_repeated_ids(make):
    rows = [(None, f"t{i}") for i in range(40)] + [(3, "x")] * 30 + [(i, "y") for i in range(40)]
    keyed, unique = suffix_dedup.keyed(make(rows, 7).select("doc_id", "text"))
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    assert not unique and keyed.count() == len(rows)
    assert {((r.doc_id, r.text), r._key) for r in keyed.collect()} == {(r, i) for i, r in enumerate(order)}
    assert suffix_dedup.keyed(make(rows[:1], 1).limit(0))[0].count() == 0


def test_near_pairs_equal_brute_force(make):
    rows = [(i, t) for i, t in enumerate({t for _, t in near_copies(4) if t})]
    rows = [(i, "the " + t.replace("w1", "the w1")) for i, t in rows]
    members, pairs = spotsigs.near_pairs(spotsigs.fingerprints(make(rows)), 0.75)
    of = {r.doc_id: r.fingerprint_class for r in members.collect()}
    got = {frozenset((r.class_a, r.class_b)) for r in pairs.collect()}
    sets = {of[i]: spot_set(t) for i, t in rows}
    names = sorted(sets)
    want = {frozenset((x, y)) for i, x in enumerate(names) for y in names[:i] if 4 * len(sets[x] & sets[y]) >= 3 * len(sets[x] | sets[y])}
    assert got == want and want


def test_rows_of_null_id_do_not_join_with_each_other(spark, make):
    """A third of the ids null, a third of the rows equal: one text is fetched per class and task."""
    random.seed(8)
    rows = [(None, " ".join(random.choices("abcdefghij", k=40))) for _ in range(60)] + [(None, "one text that many rows have in common")] * 60
    rows += [(i, " ".join(random.choices("klmnopqrst", k=40))) for i in range(60)]
    fetched = []
    real = ngram_join._set_rows
    ngram_join._set_rows = lambda *a: fetched.append(real(*a)) or fetched[-1]
    try:
        got = ngram_join.ngram_components(make(rows), counted=True)
        have = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    finally:
        ngram_join._set_rows = real
    assert have == brute_components(rows)
    assert fetched[0].count() <= 121 * 4


def test_very_long_texts(make):
    random.seed(10)
    words = random.choices([f"w{i}" for i in range(3000)] + ["the", "of"] * 300, k=40_000)
    changed = [w if i % 50 else "new" for i, w in enumerate(words)]
    rows = [(3, " ".join(words)), (5, " ".join(changed)), (7, " ".join(words[::-1])), (9, "short text of a few words")]
    got = ngram_join.ngram_components(make(rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_components(rows)
    order = sorted(rows, reverse=True)
    prints = {r.doc_id: r for r in spotsigs.edited_fingerprints(make(rows)).collect()}
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % 4][1]
        assert prints[d].n_chars == len(t)
        assert prints[d].edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + after[:len(t) // 2]).encode()).hexdigest()
