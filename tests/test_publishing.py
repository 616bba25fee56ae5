"""Versions, snapshots, statistics and buckets of published tables."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from waitlens.plans import gap, referrals, rejection, snapshots
from waitlens.sources import bucketing, statistics, versions
from waitlens.sources.snapshots import publish_snapshot, read_snapshots, snapshot_at, snapshot_dates

SF = "/root/testdata/sf0.001"
LIST = "sigte_id string, run string, estab_orig string, estab_dest string, presta_min string, tipo_prest int, f_entrada date, f_salida date, c_salida string"


def waiting(spark, rows):
    return spark.createDataFrame([(i, f"p{i}", "1", dest, spec, 1, dt.date(2024, 1, 1), None, None) for i, dest, spec in rows], LIST)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_failed_publish_leaves_the_old_version(spark, tmp_path):  # S12
    base = str(tmp_path / "results")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, base)

    def write(n):
        return lambda folder: spark.range(n).write.parquet(f"{folder}/t")

    def rows():
        return spark.read.parquet(versions.current(spark, base) + "/t").count()

    first = versions.publish_version(spark, base, write(3))
    assert rows() == 3

    def fails(folder):
        write(9)(folder)
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        versions.publish_version(spark, base, fails)
    assert rows() == 3 and versions.current(spark, base) == first
    held = spark.read.parquet(first + "/t")
    versions.publish_version(spark, base, write(5))
    assert rows() == 5 and held.count() == 3  # a reader that started before goes on with its version
    assert len(versions.versions(spark, base)) == 3
    versions.publish_version(spark, base, write(6))
    gone = versions.drop_old_versions(spark, base, keep=2)
    assert len(gone) == 2 and rows() == 6 and len(versions.versions(spark, base)) == 2
    assert not [n for n in os.listdir(base) if n.startswith("_CURRENT.") and not n.endswith(".crc")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_catalogue_in_versions(spark, tmp_path):  # S12, S13
    from waitlens.sources.catalog import Tables, publish_versioned
    tables = Tables.from_driver(spark, SF, staging=str(tmp_path / "staging"))
    base = str(tmp_path / "tables")
    publish_versioned(tables, base)
    want = Tables.from_published(spark, base).abbreviations.count()
    again = Tables.from_driver(spark, SF, staged=str(tmp_path / "staging"))
    again._cache["abbreviations"] = tables.abbreviations.unionByName(tables.abbreviations)
    with pytest.raises(ValueError, match="duplicated key"):
        publish_versioned(again, base)
    assert Tables.from_published(spark, base).abbreviations.count() == want
    programming = Tables.from_published(spark, base).programming
    assert {r.hospital for r in programming.select("hospital").distinct().collect()} == {f"h{i}" for i in range(5)}


def test_one_aggregation_of_the_programming(spark, tmp_path):  # S4, P2
    from waitlens.registry import TEST, Context
    from waitlens.sources.catalog import Tables
    ctx = Context(Tables.from_driver(spark, SF, staging=str(tmp_path / "staging")), TEST)
    assert "HashAggregate" not in plan(ctx.programming) and re.search(r"PartitionFilters: \[[^]]*hospital", plan(ctx.programming))


def test_snapshots_are_replaced_by_date_and_state(spark, tmp_path):  # S5
    path = str(tmp_path / "lists")
    publish_snapshot(waiting(spark, [("a", "1", "x"), ("b", "1", "x"), ("c", "2", None)]), path, date="2025-05-12", state="abierta")
    publish_snapshot(waiting(spark, [("b", "1", "x"), ("c", "1", None), ("d", "2", "y"), (None, "2", "y")]), path, date="2025-06-09", state="abierta")
    publish_snapshot(waiting(spark, [("z", "1", "x")]), path, date="2025-06-09", state="cerrada")
    assert snapshot_dates(spark, path) == [dt.date(2025, 5, 12), dt.date(2025, 6, 9)]
    opened = read_snapshots(spark, path, state="abierta")
    got = {(r.estab_dest, r.presta_min): tuple(r)[2:] for r in snapshots.flow(opened, before="2025-05-12", after="2025-06-09", service=1).collect()}
    # siguen, salen, entran, movidas_desde, movidas_hacia
    assert got == {("1", "x"): (1, 1, 0, 0, 0), ("2", None): (0, 0, 0, 1, 0), ("1", None): (0, 0, 0, 0, 1), ("2", "y"): (0, 0, 1, 0, 0)}
    assert [r.sigte_id for r in snapshot_at(spark, path, "2025-06-01").orderBy("sigte_id").collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="no snapshot"):
        snapshot_at(spark, path, "2025-05-11")
    publish_snapshot(waiting(spark, [("q", "1", "x")]), path, date="2025-06-09", state="abierta")  # again: only its own folder
    count = {(str(r.fecha_corte), r.estado): r["count"] for r in read_snapshots(spark, path).groupBy("fecha_corte", "estado").count().collect()}
    assert count == {("2025-05-12", "abierta"): 3, ("2025-06-09", "abierta"): 1, ("2025-06-09", "cerrada"): 1}
    one = read_snapshots(spark, path, dates=["2025-05-12"], state="abierta")
    assert re.search(r"PartitionFilters: \[[^]]*fecha_corte", plan(one)) and "PushedFilters: []" in plan(one)
    assert all("fecha_corte=2025-05-12" in r.f for r in one.select(F.input_file_name().alias("f")).collect())
    publish_snapshot(waiting(spark, [("q", "1", "x")]).limit(0), path, date="2025-06-09", state="abierta")  # an empty list empties it
    assert read_snapshots(spark, path, dates=["2025-06-09"], state="abierta").count() == 0


def test_as_of_date_from_statistics(spark):  # A7, J7, P7
    day = dt.date
    rows = [("a", "p", "1", "5", "07-1", 1, day(2024, 1, 1), None, None), ("b", "p", "2", "5", "07-1", 1, day(2024, 3, 1), day(2024, 9, 1), "N"),
            ("c", "p", None, "6", "09-1", 2, day(2025, 1, 1), None, None), ("d", "p", "1", "6", None, None, None, day(2026, 1, 1), "A")]
    df = spark.createDataFrame(rows, LIST).withColumns({c: F.lit("x") for c in ("dv", "sexo", "presta_est", "sospecha_diag", "id_local")}).withColumn(
        "fecha_nac", F.lit("2000-01-01").cast("date"))
    dims = {"estab": spark.createDataFrame([("5", "S5", "1", "C", "Primario")], "codigo_vigente string, nombre_oficial string, codigo_comuna string, nombre_comuna string, nivel_de_atencion string"),
            "specs": spark.createDataFrame([("07-1", "Cardio")], "codigosigte string, desc_esp string"),
            "abbrev": spark.createDataFrame([("5", "S5")], "codigo_vigente string, abreviacion string"),
            "reasons": spark.createDataFrame([("N", "No pertinencia")], "n string, causal string")}
    stats = statistics.list_statistics(df, df.limit(0)).where("lista = 'open_list'")
    for filters in ({}, {"service": 1}, {"service": [1, 2], "open_only": True}, {"sites": ["1"]}, {"sites": "5", "site_role": "dest", "service": 1},
                    {"sites": "9"}, {"as_of": "input", "service": 1}, {"entry_from": "2024-02-01"}, {"exclude_dental": True, "service": 2}):
        want = referrals.enrich_referrals(df, **dims, **filters)
        got = referrals.enrich_referrals(df, **dims, **filters, statistics=stats)
        assert sorted(map(str, want.collect())) == sorted(map(str, got.collect())), filters
    both = referrals.enrich_referrals(df, **dims)
    for filters in ({"service": 1}, {"sites": ["1"]}, {"entry_from": "2024-01-01", "entry_to": "2024-03-01"}, {"exit_from": "2024-09-01", "exit_to": "2025-12-31"}):
        want, got = referrals.enrich_referrals(df, **dims, **filters), referrals.refiltered(both, **filters)
        assert want.columns == got.columns and sorted(map(str, want.collect())) == sorted(map(str, got.collect())), filters


def test_bucketed_cohort_needs_no_shuffle(spark, tmp_path):  # J5, P29
    people = [(str(i), f"{i}", "C1" if i % 2 else "C2") for i in range(200)]
    registry = spark.createDataFrame(people, "rut_paciente string, rut_paciente_sdv string, comuna_establecimiento string")
    rows = spark.createDataFrame([(str(i % 210) if i % 7 else None, "07-1" if i % 3 else "07-2") for i in range(900)], "run string, presta_min string")
    subset = spark.createDataFrame([("07-1",)], "codigosigte string")
    for name, df, key in (("r", registry, "rut_paciente_sdv"), ("l", rows, "run")):
        bucketing.write_bucketed(df, f"test_bucketed_{name}", str(tmp_path / name), key=key, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r, l = (bucketing.read_bucketed(spark, f"test_bucketed_{n}") for n in "rl")
        joined = l.join(r.where("comuna_establecimiento = 'C1'"), l.run == r.rut_paciente_sdv)
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "Exchange" in plan(rows.join(registry, rows.run == registry.rut_paciente_sdv))
        got = gap.enrolled_cohort(l, l, r, communes=["C1"], subset=subset)
        want = gap.enrolled_cohort(rows, rows, registry, communes=["C1"], subset=subset)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not bucketing.is_hot(spark, "test_bucketed_l")
    hot = rows.select(F.lit("1").alias("run"), "presta_min").limit(300).unionByName(rows)
    bucketing.write_bucketed(hot, "test_bucketed_h", str(tmp_path / "h"), key="run", buckets=16)
    assert bucketing.is_hot(spark, "test_bucketed_h")
    assert "SelectedBucketsCount" not in plan(bucketing.read_bucketed(spark, "test_bucketed_h").where("run = '1'"))
    assert bucketing.read_bucketed(spark, "test_bucketed_h").count() == hot.where("run is not null").count()
    for name in "rlh":
        spark.sql(f"DROP TABLE test_bucketed_{name}")


def test_reasons_of_the_dimension_become_columns(spark):  # A8, N14
    exits = spark.createDataFrame([("S", "Cardio", dt.date(2024, 5, 1), c) for c in ("No pertinencia", "Otra", "Fallecimiento", None, "desconocida")],
                                  "abrev_destino string, desc_esp string, f_salida date, causal string")
    reasons = spark.createDataFrame([("1", "No pertinencia"), ("2", "Otra"), ("3", "Fallecimiento"), ("4", None)], "n string, causal string")
    r = rejection.np_rate(exits, years=[2024], reasons=reasons, min_total=1, na_column="na").first()
    assert (r.no_pertinencia, r.otra, r.fallecimiento, r.na, r.total_egresos, r.porc_np_total) == (1, 1, 1, 2, 5, 0.2)
    from waitlens.operators.aggregates import pivot_values
    with pytest.raises(ValueError, match="too many"):
        pivot_values(spark.range(30).select(F.col("id").cast("string").alias("causal")), "causal", limit=20)


def test_either_identifier_once(spark):  # F10, P38
    from waitlens.operators.predicates import lookup_either
    rows = [("1", "9", "a"), ("2", "1", "b"), (None, "1", "c"), ("1", "1", "d"), ("1", "1", "d"), ("3", None, "e"), (None, None, "f")]
    reg = spark.createDataFrame(rows, "rut string, rut_paciente string, x string")
    ids = spark.createDataFrame([("1",), ("1",), (None,)], "id string")
    assert sorted(r.x for r in lookup_either(reg, ids, "id", "rut", "rut_paciente").collect()) == ["a", "b", "c", "d", "d"]


def test_waits_in_fractions_of_days(spark):  # X8, P33
    rows = [(4, "3", "2024-01-10 11:59:00", "a"), (4, "3", "2024-01-10 12:01:00", "b"), (4, "3", "2024-01-10 12:00:00", "c"), (4, "3", "2024-01-11 12:00:00", "d")]
    df = spark.createDataFrame(rows, "tipo_prest int, estab_dest string, f string, especialidad_grupo string").select(
        "*", F.col("f").cast("timestamp").alias("f_entrada"), F.lit(None).cast("date").alias("f_salida"), F.lit(None).cast("string").alias("tipo_error"))
    got = {r.especialidad_grupo: r["mean"] for r in gap.waiting_time_stats(df, service=4, site="3", at="2024-01-15").collect()}
    assert got == {"a": 5.0, "b": 4.0, "c": 4.0, "d": 4.0}  # 4.5 and 3.5 days go to the even number
