"""Generic operators: joins, aggregation, ranking, predicates, reshape."""

import pytest
from pyspark.sql import functions as F

from waitlens.operators.aggregates import count_by, pivot_counts
from waitlens.operators.columns import cast_columns, clean_columns, rename_position, select_positions, select_unique
from waitlens.operators.joins import assert_unique, join_keys, role_join, scalar
from waitlens.operators.predicates import (all_of, between_dates, flag_in, in_values, lookup_either, semi_join_in,
                                           still_waiting_at)
from waitlens.operators.ranking import rank_within, top_n_per_group
from waitlens.operators.reshape import longer, union_all


def test_null_safe_join_pairs_nulls(spark):  # N1, J3
    a = spark.createDataFrame([("s1", None, 1), ("s1", "x", 2)], "site string, code string, a int")
    b = spark.createDataFrame([("s1", None, 10), ("s1", "x", 20)], "site string, code string, b int")
    strict = {(r.code, r.b) for r in join_keys(a, b, ["site", "code"]).collect()}
    safe = {(r.code, r.b) for r in join_keys(a, b, ["site", "code"], null_safe=True).collect()}
    assert strict == {(None, None), ("x", 20)}
    assert safe == {(None, 10), ("x", 20)}


def test_join_keys_rejects_clashing_columns(spark):  # N13
    a = spark.createDataFrame([("k", 1)], "k string, v int")
    b = spark.createDataFrame([("k", 2)], "k string, v int")
    with pytest.raises(ValueError):
        join_keys(a, b, ["k"])


def test_role_join_two_roles(spark):  # J2
    facts = spark.createDataFrame([("1", "2")], "orig string, dest string")
    dim = spark.createDataFrame([("1", "One"), ("2", "Two")], "code string, name string")
    out = role_join(role_join(facts, dim, "orig", "code", {"name": "orig_name"}), dim, "dest", "code",
                    {"name": "dest_name"}).first()
    assert (out.orig_name, out.dest_name) == ("One", "Two")


def test_assert_unique(spark):  # N12
    ok = spark.createDataFrame([("a",), ("b",)], "k string")
    assert_unique(ok, ["k"])
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])


def test_scalar_subquery_reaches_every_row(spark):  # J7, A7
    df = spark.createDataFrame([(1, None), (5, 7), (3, None)], "a int, b int")
    mx = scalar(df, F.greatest(F.max("a"), F.max("b")))
    assert {r.m for r in df.select(mx.alias("m")).collect()} == {7}


def test_pivot_counts_fixed_values_fill_zero(spark):  # A8, D11, N14
    df = spark.createDataFrame([("x", "No pertinencia"), ("x", "Atención realizada"), ("x", None), ("y", "No pertinencia")],
                               "g string, causal string")
    out = {r.g: r for r in pivot_counts(df, ["g"], "causal", ["Atención realizada", "No pertinencia"], total="t").collect()}
    assert (out["x"].atencion_realizada, out["x"].no_pertinencia, out["x"].t) == (1, 1, 3)
    assert (out["y"].atencion_realizada, out["y"].no_pertinencia, out["y"].t) == (0, 1, 1)


def test_count_by_null_group(spark):  # A1, N11
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert {r.k: r.n for r in count_by(df, ["k"]).collect()} == {None: 2, "a": 1}


def test_top_n_without_ties(spark):  # W2, N15
    rows = [("s", f"d{i:02d}", 5) for i in range(12)] + [("s", "top", 9)]
    df = spark.createDataFrame(rows, "g string, d string, n int")
    out = top_n_per_group(df, ["g"], [F.col("n").desc(), F.col("d").asc()], 10)
    got = [r.d for r in out.orderBy(F.col("n").desc(), "d").collect()]
    assert got == ["top"] + [f"d{i:02d}" for i in range(9)]


def test_rank_within(spark):  # W4, W5
    df = spark.createDataFrame([("g", "a", 3), ("g", "b", 1), ("g", "c", 2)], "g string, x string, n int")
    got = {r.x: r.rk for r in rank_within(df, ["g"], [F.col("n").asc()], "rk").collect()}
    assert got == {"b": 1, "c": 2, "a": 3}


def test_predicates(spark):  # F2, F4, F8, F9
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2023, 5, 1), None), (2, dt.date(2023, 5, 1), dt.date(2023, 12, 1)),
                                (1, dt.date(2024, 2, 1), None), (1, dt.date(2023, 1, 1), dt.date(2024, 3, 1))],
                               "t int, fin date, fout date")
    assert df.where(all_of([in_values("t", [1]), None])).count() == 3
    assert df.where(between_dates("fin", "2023-01-01", "2024-01-01")).count() == 3
    assert df.where(still_waiting_at("fin", "fout", "2024-01-01")).count() == 2


def test_semi_join_and_flag(spark):  # F3
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "code string")
    assert [r.k for r in semi_join_in(df, "k", keys, "code").collect()] == ["a"]
    flags = {r.k: r.f for r in flag_in(df, "k", keys, "code", "f").collect()}
    assert flags == {"a": "si", "b": "no", None: "no"}


def test_lookup_either(spark):  # F10
    reg = spark.createDataFrame([("11", "99"), ("22", None), ("33", "44")], "rut string, rut_paciente string")
    ids = spark.createDataFrame([("99",), ("22",), ("99",)], "id string")
    got = sorted(r.rut for r in lookup_either(reg, ids, "id", "rut", "rut_paciente").collect())
    assert got == ["11", "22"]


def test_columns(spark):  # D1 D3 D5 D7
    df = spark.createDataFrame([(1, "2", "x", "s/i")], ["Código A", "b", "c", "d"])
    df = clean_columns(df)
    assert df.columns == ["codigo_a", "b", "c", "d"]
    assert select_unique(df, ["b", "b", "c"]).columns == ["b", "c"]
    assert select_positions(df, [1, range(3, 5)], exclude=["c"]).columns == ["codigo_a", "d"]
    assert rename_position(df, 3, "z").columns == ["codigo_a", "b", "z", "d"]
    r = cast_columns(df, {"b": "int", "d": "double"}).first()
    assert r.b == 2 and r.d is None


def test_union_and_longer(spark):  # U1 U2 A9
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert union_all([a, a]).count() == 2
    with pytest.raises(Exception):
        union_all([a, b])
    assert {r.y for r in union_all([a, b], allow_missing=True).collect()} == {2, None}
    long = longer(a, ["x"], ["y"], "name", "value").first()
    assert (long.name, long.value) == ("y", 2)


def test_inclusive_range_contains_and_strict_cast(spark):  # F6, F8, D7
    import datetime as dt

    from waitlens.operators.predicates import contains_ignore_case
    df = spark.createDataFrame([(dt.date(2024, 12, 31), "Trastorno del AUTISMO"), (dt.date(2025, 1, 1), None)],
                               "d date, s string")
    assert df.where(between_dates("d", "2024-01-01", "2024-12-31", end_inclusive=True)).count() == 1
    assert df.where(between_dates("d", "2024-01-01", "2024-12-31")).count() == 0
    assert df.where(contains_ignore_case("s", "autismo")).count() == 1
    bad = spark.createDataFrame([("s/i",)], "x string")
    assert cast_columns(bad, {"x": "double"}).first().x is None
    with pytest.raises(Exception):
        cast_columns(bad, {"x": "double"}, lenient=False).collect()
