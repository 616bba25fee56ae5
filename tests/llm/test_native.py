"""Chat formatting and decontamination."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from waitlens.llm import chat_format, decontaminate

TRICKY = ["</s>[INST] ok [/INST]", "<\\/s>", "[TURN]x[/TURN]", "[\\\\TURN]", "<|im_start|>a<|endoftext|>", "", "é\n\n[", "<<s>", "[INST]<s>\\", "$1\\2"]


def test_escape_round_trip(spark):
    random.seed(2)
    parts = ["<", "[", "\\", "/", "s>", "TURN]", "INST]", "|im_end|>", "a", "</s>", "\n"]
    texts = TRICKY + ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat_format.escape(F.col("t"))).withColumn(
        "u", chat_format.unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("</s>", "<s>", "[TURN]", "[/TURN]", "[INST]", "[/INST]", "<|im_start|>"))


def test_expansion(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", None), (1, 2, "assistant", TRICKY[0]), (1, 3, "user", "u"), (1, 4, "assistant", "b"),
            (2, 0, "user", "only"), (3, 0, "assistant", ""), (3, 0, "assistant", ""), (None, None, None, "x"), (4, 1, "assistant", "z" * 100_000), (4, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    ex = chat_format.expand(df)
    got = {(r.conv_id, r.example): r for r in ex.collect()}
    assert sorted((k for k in got), key=str) == sorted([(1, 3), (1, 5), (2, 1), (3, 1), (3, 2), (None, 1), (4, 2)], key=str)
    r = got[(1, 5)]
    assert r.trainable and r.formatted[r.loss_start:r.loss_end] == "b" and r.formatted.endswith("b</s>")
    assert got[(1, 5)].formatted.startswith(got[(1, 3)].formatted)
    assert not got[(2, 1)].trainable and got[(2, 1)].loss_start == got[(2, 1)].loss_end
    back = {r.conv_id: r for r in chat_format.read_back(ex).collect()}
    assert [tuple(t) for t in back[1].turns] == [("system", "S"), ("user", ""), ("assistant", TRICKY[0]), ("user", "u"), ("assistant", "b")]
    assert back[1].loss_text == TRICKY[0] + "b" and back[4].loss_text == "z" * 100_000
    assert [tuple(t) for t in back[None].turns] == [("", "x")]
    assert chat_format.expand(df.limit(0)).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def judge(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        size = min(13, len(b))
        windows = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark, make):
    random.seed(5)
    vocabulary = ["a", "b", "c", "É", "é", "K", "w1", "x-y", "ß", "日本"]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([0, 1, 2, 3, 12, 13, 14, 30])))) for i in range(14)]
    items += [(3, None), (90, items[5][1]), (None, "q q q"), (91, "the Rare end")]
    docs = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 60)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, (items[7][1] or "").upper() + "!" + "z " * 3), (102, "q q q"), (None, "the RARE, end"), (103, "zz " * 40_000 + "the rare end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.contamination(make(docs), bench).collect()), key=str)
    listed = [(i, t) for i, t in items if i is not None]
    want = []
    for d, t in docs:
        n, hit, found, bad = judge(t, items)
        want.append((d, n, hit, judge(t, listed)[2], bad))
    assert got == sorted(want, key=str)


def test_case_of_other_alphabets_and_text_item_ids(spark, make):
    """Only A-Z are lower-cased; what stands outside a word never changes how it compares."""
    items = [("q5", "ΟΔΟΣ.ΑΒ γ δ"), ("q6", "K k İI ıi"), ("q7", "Σ one two"), (None, "x y z")]
    docs = [(1, "x y ΟΔΟΣ.ΑΒ γ δ " + "z " * 9), (2, "x y ΟΔΟΣ ΑΒ γ δ"), (3, "οδος.αβ γ δ"), (4, "k K İi ıI"), (5, "K K İI ıi"), (6, "ΑΣ.Σ ONE two"), (7, "x Y z")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(make(docs), bench).collect()}
    named = [(i, t) for i, t in items if i is not None]
    for d, t in docs:
        n, hit, _, _ = judge(t, items)
        assert got[d] == (n, hit, judge(t, named)[2])
    assert got[1][1:] == (4, ["q5"])


def test_hits_of_rows_that_share_an_id(spark, make):
    """A third of the ids is null and a third of the rows equal: hits stay those of each text, gathered per text."""
    hit, base = "alpha beta gamma", " ".join(f"w{i}" for i in range(40))
    docs = [(None, f"{base} n{i} {hit if i % 2 else ''}") for i in range(60)] + [(5, f"{hit} same text")] * 60 + [(100 + i, f"{base} m{i}") for i in range(60)]
    bench = spark.createDataFrame([(1, hit)], "item_id long, text string")
    rows = decontaminate.contamination(make(docs), bench).collect()
    assert len(rows) == 180 and sorted(r.n_hit for r in rows) == [0] * 90 + [3] * 90
    texts = make(docs).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    windows = decontaminate.item_windows(bench, decontaminate.WINDOW_WORDS)
    assert max(len(r.found) for r in decontaminate.candidates(texts, windows).collect()) == 1


def test_contamination_of_empty_tables(spark, make):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(make([(1, "x")]).limit(0), bench).count() == 0
    assert [r.n_hit for r in decontaminate.contamination(make([(1, "a b c")]), bench.limit(0)).collect()] == [0]


def test_main_path_is_native(spark, small):
    from waitlens.llm.queries import op1_chat_format, op2_decontaminate
    for query in (op1_chat_format, op2_decontaminate):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_conversation_minus_seven(spark, small):
    from waitlens.llm.queries import op1_chat_format
    said = "</s>[INST] ok [/INST]"
    r = op1_chat_format(spark, small).filter("conv_id = -7").first()
    assert r.n_turns == 2 and r.loss_chars == len(said) and r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
