"""Column helpers: R's null, rounding, division and date rules."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from waitlens.functions import (clean_name, clean_names, completed_years, days_between, keep_null_not_rlike,
                                lenient_sum, month_start, parse_date, round_half_even, safe_ratio,
                                split_code_label, strict_mean, strict_sum, strip_last_char)


def test_strict_sum_is_null_when_any_input_is_null(spark):  # N2
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, x double")
    out = {r.k: r.s for r in df.groupBy("k").agg(strict_sum("x").alias("s")).collect()}
    assert out == {"a": None, "b": 5.0}


def test_lenient_sum_is_zero_for_all_null(spark):  # N3
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "k string, x double")
    out = {r.k: r.s for r in df.groupBy("k").agg(lenient_sum("x").alias("s")).collect()}
    assert out == {"a": 0.0, "b": 2.0}


def test_strict_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "k string, x double")
    out = {r.k: r.m for r in df.groupBy("k").agg(strict_mean("x").alias("m")).collect()}
    assert out == {"a": None, "b": 3.0}


def test_negative_regex_keeps_null(spark):  # N5
    df = spark.createDataFrame([("09-001",), ("07-001",), (None,)], "c string")
    kept = [r.c for r in df.where(keep_null_not_rlike("c", "^09")).collect()]
    assert sorted(kept, key=str) == ["07-001", None]
    # Spark's own NOT rlike drops the null row
    assert df.where(~F.col("c").rlike("^09")).count() == 1


def test_round_half_even_matches_r(spark):  # N7
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (23 / 40,), (0.125,), (-0.5,)], "x double")
    got = [r.r for r in df.select(round_half_even("x", 0).alias("r")).collect()]
    assert got[:3] == [0.0, 2.0, 2.0]
    got2 = [r.r for r in df.select(round_half_even("x", 2).alias("r")).collect()]
    assert got2[3] == 0.57 and got2[4] == 0.12  # 23/40 is stored just below 0.575


def test_safe_ratio_null_on_zero_or_null(spark):  # N8, A13
    df = spark.createDataFrame([(1, 0), (1, None), (1, 3), (2, 3)], "n long, d long")
    got = [r.r for r in df.select(safe_ratio("n", "d", 2).alias("r")).collect()]
    assert got == [None, None, 0.33, 0.67]


def test_parse_date_lenient(spark):  # N9, X5
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("31/12/2024",), ("s/i",), (None,)], "s string")
    got = [r.d for r in df.select(parse_date("s").alias("d")).collect()]
    assert got == [dt.date(2024, 2, 29), None, dt.date(2024, 12, 31), None, None]


def test_completed_years(spark):  # N16, X9
    rows = [(dt.date(2000, 2, 29), dt.date(2001, 2, 28), 0), (dt.date(2000, 2, 29), dt.date(2001, 3, 1), 1),
            (dt.date(2006, 5, 1), dt.date(2024, 5, 1), 18), (dt.date(2006, 5, 2), dt.date(2024, 5, 1), 17),
            (dt.date(2024, 6, 1), dt.date(2024, 1, 1), -1), (dt.date(2024, 1, 1), dt.date(2024, 1, 1), 0)]
    df = spark.createDataFrame(rows, "b date, a date, want int")
    for r in df.select(completed_years("b", "a").alias("y"), "want").collect():
        assert r.y == r.want


def test_days_and_month_start(spark):  # X7, X8
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 3, 1), 2024, 2)], "a date, b date, y int, m int")
    r = df.select(days_between("a", "b").alias("d"), month_start("y", "m").alias("ms")).first()
    assert r.d == 60 and r.ms == dt.date(2024, 2, 1)


def test_clean_names():  # D1
    assert clean_name("Código Vigente") == "codigo_vigente"
    assert clean_name("Nombre Dependencia Jerárquica (SEREMI / Servicio de Salud)") == \
        "nombre_dependencia_jerarquica_seremi_servicio_de_salud"
    assert clean_names(["a", "A", "", "2x"]) == ["a", "a_2", "x3", "x2x"]
    assert clean_name("% NP total") == "percent_np_total"
    assert clean_name("N# casos") == "n_number_casos"
    assert clean_name("totalEgresos") == "total_egresos"


def test_split_code_label(spark):  # D10
    df = spark.createDataFrame([("C50 - Breast",), ("J35 - a - b",), ("nohyphen",), (None,)], "s string")
    code, label = split_code_label("s")
    got = [(r.c, r.l) for r in df.select(code.alias("c"), label.alias("l")).collect()]
    assert got == [("C50", "Breast"), ("J35", "a - b"), ("nohyphen", None), (None, None)]


def test_strip_last_char(spark):  # X3
    df = spark.createDataFrame([("123456789",), (None,)], "s string")
    assert [r.x for r in df.select(strip_last_char("s").alias("x")).collect()] == ["12345678", None]


def test_strict_running_sum_stays_null(spark):  # N4
    from waitlens.operators.ranking import running_total
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 1), ("b", 1, 2), ("b", 2, 3)],
                               "k string, m int, v int")
    out = running_total(df, ["k"], ["m"], F.col("v"), F.lit(10), "acc")
    got = {(r.k, r.m): r.acc for r in out.collect()}
    assert got == {("a", 1): 15, ("a", 2): None, ("a", 3): None, ("b", 1): 12, ("b", 2): 15}
    # Spark's plain running sum would skip the null
    w = Window.partitionBy("k").orderBy("m")
    assert df.select(F.sum("v").over(w).alias("s")).where(F.col("s").isNull()).count() == 0
