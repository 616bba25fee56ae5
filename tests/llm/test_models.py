"""Toxicity, Hilbert sharding, the pipeline and the registration of queries."""

import itertools
import pickle
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitlens.llm import hilbert, toxicity


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    inputs = toxicity.Inputs({b"ab": 1, b"cd": 2}, {g: i for i, g in enumerate(toxicity.grams_of(b"ab") + toxicity.grams_of(b"cde"), 1)})
    model = toxicity.Model(inputs, rng)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    ids, flat, begins = inputs.encode([b"ab", b"cd", b"xyz", b""])
    place = rng.integers(0, 4, (3, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW) < np.array([[1], [7], [toxicity.WINDOW]])
    target, weight = np.array([0.0, 1, 1]), np.array([1.0, 2, 1])

    def loss(x):
        z = model.run(model.project(x)[place], mask, [])[0]
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() / weight.sum())

    x = model.embed(ids, flat, begins)
    d, dx = model.gradients(x, place, mask, target, weight)
    for values, gradient, name in [(model.p[k], d[k], k) for k in d] + [(x, dx, "x")]:
        for at in list(np.ndindex(values.shape))[::max(1, values.size // 5)]:
            old = values[at]
            values[at] = old + 1e-3
            up = loss(x)
            values[at] = old - 1e-3
            down = loss(x)
            values[at] = old
            assert (up - down) / 2e-3 == pytest.approx(gradient[at], abs=2e-4), name


def test_windows_cover_all_words_and_overlap():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 500):
        starts = toxicity.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def labelled(n=600):
    random.seed(12)
    plain = ["".join(random.choices("abdeghiklmnoprstu", k=random.randint(2, 8))) for _ in range(800)]
    rows = []
    for i in range(n):
        words = random.choices(plain, k=random.choice([5, 40, 300]))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(random.randrange(len(words)), random.choice(["zxqidot", "zxqvile,", "ZXQTRASH" + random.choice("abc")]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_defined_cases(spark, make):
    rows = labelled()
    extra = [(10_001, None), (10_002, ""), (10_003, "!! --"), (10_004, "word " * 40_000), (10_005, "word " * 20_000 + "zxqidot " + "word " * 20_000), (None, "zxqidot"), (3, rows[3][1])]
    docs = make([r[:2] for r in rows] + extra)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(10_002, None), (None, 1)], "doc_id long, toxic int")
    weights = toxicity.fit(docs, toxicity.learnable(labels))
    got = [(r.doc_id, r.toxicity) for r in toxicity.score(docs.select("doc_id", "text"), weights).collect()]
    assert len(got) == len(rows) + len(extra) and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    hidden = [(i, t) for i, _, t in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((score[i] >= toxicity.REJECT_AT) == t for i, t in hidden)
    assert len(hidden) > 100 and right >= 0.97 * len(hidden)
    assert score[10_001] == score[10_002] == score[10_003]
    assert score[10_005] > score[10_004]
    assert len({s for d, s in got if d == 3}) == 1


def test_training_sample_is_bounded_and_leaves_out_the_held_out(spark, make):
    rows = labelled(200)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    sample = toxicity.training_sample(make([r[:2] for r in rows]), toxicity.learnable(labels), sample_per_class=20).collect()
    assert len(sample) == 40 and all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in sample)


def test_without_both_labels(spark, make):
    docs = make([(1, "a b"), (2, None)])
    for rows, share in (([], 0.0), ([(1, 1)], 1.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert [r.toxicity for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] == [share] * 2
    assert toxicity.score(docs.limit(0), {"share": 0.0}).count() == 0


def brute_toxicity(weights, text):
    """The network word by word and window by window, in double precision."""
    p, h = {k: v.astype(np.float64) for k, v in weights["p"].items()}, toxicity.HIDDEN

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def embedded(word):
        marked = b"^" + word + b"$"
        grams = [marked[i:i + n] for n in (3, 4) for i in range(max(1, len(marked) - n + 1))]
        mean = sum(p["grams"][weights["grams"].get(g, 0)] for g in grams) / len(grams)
        return np.concatenate([p["words"][weights["words"].get(word, 0)], mean])

    def states(inputs, side):
        state, out = np.zeros(h), []
        for x in inputs:
            g, hu = x @ p["wx"][side] + p["bx"][side, 0], state @ p["u"][side]
            z, r = sigmoid(g[:h] + hu[:h]), sigmoid(g[h:2 * h] + hu[h:2 * h])
            state = (1 - z) * state + z * np.tanh(g[2 * h:] + r * hu[2 * h:])
            out.append(state)
        return out

    def logit(words):
        inputs = [embedded(w) for w in words]
        both = [np.concatenate(pair) for pair in zip(states(inputs, 0), states(inputs[::-1], 1)[::-1], strict=True)]
        attention = np.exp([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in both])
        return sum(a * s for a, s in zip(attention / attention.sum(), both, strict=True)) @ p["out"] + p["bias"][0]

    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).encode().split() or [b""]
    starts = {*range(0, max(1, len(words) - toxicity.WINDOW), toxicity.STRIDE), max(0, len(words) - toxicity.WINDOW)}
    return sigmoid(max(logit(words[s:s + toxicity.WINDOW]) for s in starts))


def test_scores_equal_brute_force():
    rows = labelled(120)
    weights = toxicity.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    texts = [r[1] for r in rows[:24]] + [None, "", "zxqvile", "...", " ".join(r[1] for r in rows[:20]), rows[0][1], " ".join(["ab"] * 33)]
    got = toxicity.Scorer(weights).score(texts)
    assert got == pytest.approx([brute_toxicity(weights, t) for t in texts], abs=1e-4)


def test_scorer_does_not_depend_on_memo_or_batches(monkeypatch):
    rows = labelled(120)
    weights = pickle.loads(pickle.dumps(toxicity.train([r[1] for r in rows], np.array([r[2] for r in rows]))))
    texts = [r[1] for r in rows] + [None, ""]
    whole = toxicity.Scorer(weights).score(texts)
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 50)
    monkeypatch.setattr(toxicity, "BATCH_WINDOWS", 7)
    scorer = toxicity.Scorer(weights)
    assert np.allclose(whole, np.concatenate([scorer.score([t]) for t in texts]), atol=1e-5)


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.hilbert_index(points, bits)
    assert sorted(index.tolist()) == list(range(len(points)))
    assert np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(1).max() == 1


@pytest.mark.parametrize("n_shards", [24, 1, 500])
def test_shards_are_whole_and_even(spark, make, n_shards):
    random.seed(7)
    rows = [(i, random.choice([None, "", "a", "é" * 50, f"text {i}"])) for i in range(300)] + [(5, "a"), (5, "a"), (None, "n")]
    docs = make(rows).withColumn("lang", F.when(F.rand(3) < 0.4, "en").when(F.rand(4) < 0.5, "de")).withColumn("n_chars", F.char_length("text"))
    got = hilbert.shards(docs, dimensions=["lang", "n_chars"], n_shards=n_shards).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    sizes = [len(by.get(s, [])) for s in range(n_shards)]
    assert set(by) <= set(range(n_shards)) and max(sizes) - min(sizes) <= 1
    last = -1
    for s in sorted(by):
        own = sorted(by[s], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        curve = [r.curve for r in own]
        assert curve == sorted(curve) and curve[0] >= last
        last = curve[-1]
    assert hilbert.shards(docs.limit(0), dimensions=["lang", "n_chars"], n_shards=n_shards).count() == 0


def hilbert_place(point, bits):
    return int(hilbert.hilbert_index(np.array([point]), bits)[0])


@pytest.mark.parametrize("kind", ["common beginning", "few values", "nulls", "long"])
def test_text_dimension_by_whole_values(spark, make, kind):
    rng = random.Random(8)
    values = {"common beginning": [f"https://common-crawl.example/{rng.randrange(500):04d}" for _ in range(400)],
              "few values": ["b"] * 150 + ["a"] * 150 + ["", "\uffff", "\U0001f600", "ab", "B"],
              "nulls": [None] * 200 + ["a", "b"] * 5,
              "long": ["x" * 50_000 + str(i) for i in range(20)] + [None]}[kind]
    docs = make([(i, "t") for i in range(len(values))]).join(spark.createDataFrame(list(enumerate(values)), "doc_id long, source string"), "doc_id")
    cells = 8
    edges = hilbert.text_edges(docs, "source", cells)
    order = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
    want = sorted({order[i * len(order) // cells] for i in range(1, cells)} - {None}, key=str.encode)
    assert edges == want
    got = hilbert.shards(docs, dimensions=["source", "doc_id"], n_shards=5, bits=3).collect()
    assert len(got) == len(values)
    for r in got:
        cell = 0 if values[r.doc_id] is None else sum(e.encode() < values[r.doc_id].encode() for e in want)
        places = {hilbert_place((cell, other), 3) for other in range(8)}
        assert r.curve in places
    assert sorted(r.doc_id for r in got) == list(range(len(values)))


def test_files_of_a_text_dimension_can_be_pruned(spark, make):
    docs = make([(i, "t") for i in range(960)]).withColumn("source", F.format_string("https://host.example/%03d", F.col("doc_id") % 96))
    docs = docs.withColumn("n_chars", F.pmod(F.hash("doc_id"), F.lit(1000)))
    placed = hilbert.shards(docs, dimensions=["source", "n_chars"], n_shards=24).join(docs.select("doc_id", "source"), "doc_id")
    spans = placed.groupBy("shard").agg(F.min("source").alias("a"), F.max("source").alias("b")).collect()
    holding = [sum(r.a <= f"https://host.example/{k:03d}" <= r.b for r in spans) for k in range(96)]
    assert max(holding) <= 12 and len(spans) == 24


def test_written_shards(spark, make, tmp_path):
    docs = make([(i, f"t{i % 7}") for i in range(50)])
    placed = hilbert.shards(docs, dimensions=["text", "doc_id"], n_shards=4)
    hilbert.write_shards(docs.select("doc_id", "text"), placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.groupBy("shard").count().agg(F.max("count")).first()[0] <= 13


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "suffix_dedup", "decontamination", "packing"]
    train = labelled()
    plain = sorted({w for _, t, toxic in train if not toxic for w in t.split()})
    random.seed(1)

    def said(n):
        return " ".join(random.choices(plain, k=n))

    body, passage, item = said(120), said(70), said(20)
    near = body.replace(body.split()[7], "other", 1)
    rows = [(i, t) for i, t, _ in train]
    rows += [(100_001, body), (100_002, body), (100_003, near), (100_004, said(5) + " " + item), (100_005, said(9) + " " + passage),
             (100_006, passage + " second one with other words " + said(9)), (100_007, None), (100_008, "")]
    small = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    spark.createDataFrame([(i, 1, t) for i, _, t in train], "doc_id long, quality int, toxic int").write.parquet(f"{small}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{small}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small).checkpoint()
        if name != "packing":
            assert out.columns == docs.columns
        kept[name] = {r.doc_id: r for r in out.collect()}
        docs = out
    last = kept["decontamination"]
    assert len([i for i, _, t in train if t and i in last]) <= 3 and len([i for i, _, t in train if not t and i in last]) >= 490
    assert 100_001 in last and not {100_002, 100_003, 100_004} & set(last)
    assert 100_004 in kept["suffix_dedup"] and passage in last[100_005].text and passage not in last[100_006].text
    assert "second one with other words" in last[100_006].text and {100_007, 100_008} <= set(last)
    assert set(kept["packing"]) == set(last)


def test_near_copies_go_by_component_and_not_by_id(spark):
    import corpus_pipeline
    random.seed(2)

    def said(n=40):
        return " ".join(random.choices([f"w{i}" for i in range(500)], k=n))

    a, b, c, d, e = (said() for _ in range(5))
    near = b.replace(b.split()[20], "other", 1)
    rows = [(5, a, 1), (5, near, 2), (3, b, 3), (None, c, 4), (None, d, 5), (None, c, 6), (None, c, 6), (9, e, 7), (9, e, 8), (7, None, 9), (7, "", 10), (7, "", 10), (None, None, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other long")
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    want = [(5, a, 1), (3, b, 3), (None, c, 4), (None, d, 5), (9, e, 7), (7, None, 9), (7, "", 10), (7, "", 10), (None, None, 11)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    once = docs.filter("other in (1, 2, 3, 4, 5, 9)")
    assert sorted(r.other for r in corpus_pipeline.drop_near_copies(spark, once, "").collect()) == [1, 3, 4, 5, 9]


def test_registered_queries(spark, small):
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and {"op1_chat_format", "op2_decontaminate"} <= set(entry.oracle_sql())
    columns = {
        "op3": None, "op4": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
        "op5": {"doc_id", "n_shingles", "component_id"}, "op6": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op7": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op8": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        "op9": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
        "op10": {"doc_id", "held_out", "score", "predicted"},
    }
    total = spark.read.parquet(f"{small}/documents.parquet").count()
    for prefix, want in columns.items():
        name = next(k for k in names if k.startswith(prefix + "_"))
        df = names[name](spark, small)
        assert (want or set()) <= set(df.columns)
        assert df.select("doc_id").distinct().count() == total
