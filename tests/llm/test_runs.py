"""Periodic runs of words, against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from waitlens.llm import periodic_runs


def brute_runs(words, least=6, turns=4):
    runs, n = [], len(words)
    for q in range(1, n // turns + 1):
        start = None
        for k in range(n - q + 1):
            if k < n - q and words[k] == words[k + q]:
                start = k if start is None else start
            elif start is not None:
                length = k - start + q
                if length >= max(least, turns * q):
                    part = words[start:start + length]
                    if not any(part[p:] == part[:-p] for p in range(1, q)):
                        runs.append((start, length, q))
                start = None
    return sorted(runs, key=lambda r: (r[0], r[2]))


def repetitive(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 3 + 1)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize(("least", "turns"), [(6, 4), (1, 3), (12, 3), (3, 5)])
def test_runs_equal_brute_force(least, turns):
    rng = random.Random(least)
    for _ in range(150):
        docs = [repetitive(rng, rng.randint(0, 80), rng.choice([1, 2, 2, 3, 5, 30])) for _ in range(rng.randint(1, 4))]
        got = periodic_runs.find_runs([np.array(d, np.int64) for d in docs], least, turns)
        assert got == [brute_runs(d, least, turns) for d in docs]


def test_long_documents():
    for n, p in ((30_000, 1), (30_000, 6_000), (200_000, 7)):
        assert periodic_runs.find_runs([np.arange(n) % p]) == [[(0, n, p)]]
    phrase = np.concatenate([np.concatenate(([1000 + i], np.arange(9), [5000 + i])) for i in range(4000)])
    assert periodic_runs.find_runs([phrase]) == [[]]  # one phrase 4,000 times, never a run


def test_rows(spark, make, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 50)
    rng = random.Random(3)
    rows = [(i, rng.choice([" ", "\n", "\t  "]).join(f"w{w}" for w in repetitive(rng, rng.randint(0, 60), 2))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \x0b\n"), (3, rows[3][1]), (3, rows[3][1]), (None, "É É É É É É é"), (103, "a b " * 5000)]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(make(rows)).collect()), key=str)
    want = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute_runs(words) if len(words) < 1000 else [(0, 10_000, 2)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((doc, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want, key=str)
    assert periodic_runs.periodic_runs(make(rows).limit(0)).count() == 0
    with pytest.raises(ValueError, match="exponent"):
        periodic_runs.periodic_runs(make(rows), min_exponent=2)


def test_query_on_all_documents(spark, small):
    from waitlens.llm.queries import op12_periodic_runs
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, small).collect()}
    documents = spark.read.parquet(f"{small}/documents.parquet").collect()
    seen = 0
    for row in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        seen += len(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert got[row.doc_id] == (row.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                                   hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    assert len(got) == len(documents) and seen > 5
