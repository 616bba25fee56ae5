"""Whitening and near duplicates of embeddings, against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitlens.llm import binary_codes, embedding_dedup, whitening

ODD = [(900, None), (901, []), (902, [float("nan")]), (903, [None]), (904, [float("inf")]), (905, [1e30])]


def vectors(spark, rows, kind="vec_id long, embedding array<float>, label int"):
    df = spark.createDataFrame(rows, kind)
    for name in ("x", "n", "cid", "unit", "keys", "code", "i", "deviation", "weight", "able", "width", "component_id"):
        df = df.withColumn(name, F.lit("other"))
    return df.repartition(3)


def spoiled(width):
    return [(i, None if v is None else (v + [0.5] * (width - len(v)) if v else []), 1) for i, v in ODD]


def test_whitening_equals_exact_arithmetic(spark):
    rng = np.random.default_rng(4)
    width = 6
    mixed = rng.normal(size=(width, width)) / 4
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=width) @ mixed + 3], i % 2) for i in range(200)]
    rows += [(7, rows[7][1], 0), (7, rows[7][1], 0), (None, rows[3][1], None), (906, [1.0] * (width - 1), 0), *spoiled(width)]
    got, fitted = whitening.whiten(vectors(spark, rows), 4)
    left = [(i, v) for i, v, _ in rows if i is None or i < 900]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in left]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert fitted.n == n and fitted.sums == sums
    cov = np.array([[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3)) for j in range(width)] for i in range(width)])
    values, comps = np.linalg.eigh(cov)
    values, comps = values[::-1], comps[:, ::-1].T
    assert np.allclose(fitted.eigenvalues, values, rtol=1e-12) and fitted.trace == pytest.approx(np.trace(cov), rel=1e-14)
    assert np.allclose(np.abs((fitted.components * comps).sum(1)), 1, atol=1e-12)
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in x])
    want = centred @ (fitted.components[:4] / np.sqrt(values[:4])[:, None]).T
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    have = sorted(((r.vec_id, int(r.deviation), [round(v, 9) + 0.0 for v in r.whitened]) for r in got.collect()), key=str)
    assert have == sorted(((i, d, [round(v, 9) + 0.0 for v in w.tolist()]) for (i, _), d, w in zip(left, deviation, want, strict=True)), key=str)
    assert fitted.identity_error < 1e-12


def test_whitening_of_dependent_dimensions_and_wide_ranges():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(400, 12)) * np.logspace(5, 0, 12)).astype(np.int64)
    x[:, 5], x[:, 7] = x[:, 2], 3
    sums = [int(s) for s in x.sum(0)]
    full = [[400 * int(v) - sums[i] * sums[j] for j, v in enumerate(r)] for i, r in enumerate(x.astype(object).T @ x.astype(object))]
    values, comps, trace = whitening.decompose(full, 400)
    assert len(values) == 10 and trace == pytest.approx(values.sum(), rel=1e-13)
    cov = np.array([[v / 160_000 for v in r] for r in full])
    assert np.abs(comps @ comps.T - np.eye(10)).max() < 1e-13
    assert np.abs(comps @ cov @ comps.T / np.sqrt(np.outer(values, values)) - np.eye(10)).max() < 1e-5
    assert np.allclose(values, np.linalg.eigvalsh(cov)[::-1][:10], rtol=1e-7)


def test_factors():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(9, 30))
    order, low = whitening.pivoted_cholesky(a @ a.T)
    low = low.astype(float)
    assert np.allclose(low @ low.T, (a @ a.T)[np.ix_(order, order)]) and np.allclose(low, np.tril(low))
    turned = whitening.one_sided_jacobi(low)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-12 and np.allclose(turned @ turned.T, low @ low.T)


def test_product_sums_are_exact():
    x = np.array([[1 << 23, -5], [(1 << 23) + 1, 7], [1 << 40, 3]], np.int64)
    for part in (x[:2], x):
        assert whitening._product_sums(part).tolist() == (part.astype(object).T @ part.astype(object)).tolist()


def test_whitening_without_spread(spark):
    empty = vectors(spark, [(1, [1.0, 2.0], 0)]).limit(0)
    rows, fitted = whitening.whiten(empty)
    assert fitted is None and rows.count() == 0
    rows, fitted = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]))
    assert fitted.n == 2 and [(r.deviation, r.whitened) for r in rows.collect()] == [(0, []), (0, [])]
    rows, fitted = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0), (2, [2.0, 2.0], 0)]))
    assert sorted(r.whitened[0] for r in rows.collect()) == [-1.0, 1.0] and len(fitted.eigenvalues) == 1


def test_whitening_query(spark, small):
    from waitlens.llm.queries import op11_whitening
    got = op11_whitening(spark, small)
    assert got.count() == 500 * 32 and got.select("n", "identity_error").distinct().count() == 1
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9
    assert got.filter("component = 1").select("explained").distinct().count() == 1


def brute_links(rows, threshold=0.93):
    def able(v, label):
        return label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)

    links, up, places = [0] * len(rows), list(range(len(rows))), {}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, v, label) in enumerate(rows):
        if able(v, label):
            places.setdefault((label, len(v)), []).append(i)
    for at in places.values():
        x = np.array([rows[i][1] for i in at], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        for i, j in zip(*np.nonzero(near), strict=True):
            a, b = root(at[i]), root(at[j])
            up[max(a, b)] = min(a, b)
        for k, i in enumerate(at):
            links[i] = int(near[k].sum())
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[root(i)] = min(v, least.get(root(i), v))
    return sorted(((v, links[i], least.get(root(i)), v == least.get(root(i))) for i, (v, _, _) in enumerate(rows)), key=str)


def near_copies(seed, width, groups, lone, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for size in groups:
        base, far, label = rng.normal(size=width), rng.choice(noise), int(rng.integers(0, 2))
        rows += [(len(rows) + i, [float(np.float32(c)) for c in base + rng.normal(size=width) * far], label) for i in range(size)]
    rows += [(len(rows) + i, [float(np.float32(c)) for c in rng.normal(size=width)], int(rng.integers(0, 2))) for i in range(lone)]
    own, label = rows[0][1], rows[0][2]
    rows += [(5, own, label), (None, own, label), (800, [2 * c for c in own], label), (801, own, None), (802, [0.0] * width, 1), (803, [1.0] * (width + 1), 1)]
    return rows + [(i, v, 1) for i, v, _ in spoiled(width) if i != 905]


@pytest.mark.parametrize(("width", "groups", "noise", "sizes"), [
    (64, [150, 60, 3, 2], [0.05, 0.1, 0.3], {}),
    (32, [120, 80], [0.2, 0.27], {"bucket": 40, "block": 30}),  # loose groups, split buckets and blocks
    (2, [25], [0.1], {"bucket": 40, "block": 30}),
])
def test_near_duplicates_equal_brute_force(spark, width, groups, noise, sizes):
    rows = near_copies(width, width, groups, 120, noise)
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, rows), **sizes).collect()), key=str)
    assert got == brute_links(rows)


def test_a_large_group_needs_few_units(spark):
    """A third of all rows are near copies and a third equal: the pairs that are looked at stay linear."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=64)
    rows = [(i, (base + rng.normal(size=64) * 0.06).tolist(), 1) for i in range(600)] + [(600 + i, base.tolist(), 1) for i in range(600)]
    rows += [(1200 + i, rng.normal(size=64).tolist(), 1) for i in range(600)]
    seen = []
    real = embedding_dedup._candidates
    embedding_dedup._candidates = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        got = embedding_dedup.near_duplicates(vectors(spark, rows, "vec_id long, embedding array<double>, label int"))
        assert {(r.n_links, r["count"]) for r in got.groupBy("n_links").count().collect()} == {(1199, 1200), (0, 600)}
    finally:
        embedding_dedup._candidates = real
    assert seen[0].count() < 600
    assert embedding_dedup.near_duplicates(vectors(spark, [(1, [1.0], 1)]).limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(0)
    a = binary_codes.unit(rng.normal(size=(4000, 64)))
    b = binary_codes.unit(a + rng.normal(size=a.shape) * rng.uniform(0, 0.2, (4000, 1)))
    code, factor, _, _ = binary_codes.encode(a)
    _, _, query, step = binary_codes.encode(b)
    true = (a * b).sum(1)
    upper = binary_codes.upper_cosines(code, factor, query, step)
    spread = binary_codes.CONFIDENCE * np.sqrt(1 - factor.astype(float) ** 2) / factor / math.sqrt(63) + step * (0.5 * 8 * 1.001) / factor
    assert abs((upper - spread - true).mean()) < 0.003 and (upper >= true).all()


def test_banding_misses_few_pairs():
    for rows in (2, 1000, 10**6, 10**9):
        bits, bands = binary_codes.banding(rows, 0.93)
        agree = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - agree) ** bands <= binary_codes.MISSED * 1.0001
