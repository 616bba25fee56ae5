"""Readers and writers (S1-S13) on small files written in a temporary folder."""

import os

import pytest

from waitlens.operators.columns import clean_columns
from waitlens.sources.readers import bind_sheets, read_csv, read_published, read_waiting_list
from waitlens.sources.writers import write_table


def test_csv_with_banner_line(spark, tmp_path):  # S1
    p = tmp_path / "estab.csv"
    p.write_text("Listado de establecimientos 2025\ncodigo,nombre\n113100,Hospital A\n113130,Hospital B\n")
    df = read_csv(spark, str(p), "codigo string, nombre string", skip_lines=1)
    assert sorted(r.codigo for r in df.collect()) == ["113100", "113130"]


def test_codes_keep_leading_zero(spark, tmp_path):  # S6, N10
    p = tmp_path / "rem.csv"
    p.write_text("mes;codigo_prestacion\n1;07020130\n")
    df = read_csv(spark, str(p), "mes int, codigo_prestacion string", sep=";")
    assert df.first().codigo_prestacion == "07020130"


def test_latin1(spark, tmp_path):  # S7
    p = tmp_path / "map.csv"
    p.write_bytes("especialidad,destino\nOtorrinolaringología,13-130\n".encode("latin-1"))
    df = read_csv(spark, str(p), "especialidad string, destino string", encoding="ISO-8859-1")
    assert df.first().especialidad == "Otorrinolaringología"


def test_publish_round_trip_partitioned(spark, tmp_path):  # S12, S13
    df = spark.createDataFrame([(1, "a"), (4, "b")], "tipo_prest int, x string")
    target = os.path.join(tmp_path, "t")
    write_table(df, target, partition_by=["tipo_prest"])
    back = read_published(spark, target)
    assert sorted((r.tipo_prest, r.x) for r in back.collect()) == [(1, "a"), (4, "b")]
    assert back.where("tipo_prest = 1").count() == 1


def test_sheets_bind_by_name(spark):  # S4, U1
    a = spark.createDataFrame([("1", "x")], ["Id Deis", "Rut"])
    b = spark.createDataFrame([("x", "2")], ["Rut", "Id Deis"])
    out = bind_sheets({"A": clean_columns(a), "B": clean_columns(b)})
    assert sorted((r.hospital, r.id_deis) for r in out.collect()) == [("A", "1"), ("B", "2")]


def test_waiting_list_text_dates(spark, tmp_path):  # S5, N9
    p = tmp_path / "le.csv"
    header = ("run,dv,sexo,fecha_nac,estab_orig,estab_dest,f_entrada,f_salida,tipo_prest,presta_min,presta_est,"
              "sospecha_diag,c_salida,sigte_id,id_local")
    p.write_text(header + "\n1,9,F,2000-02-30,1,2,2024-01-10,,1,07-001,x,C50 - a,,s1,l1\n")
    df = read_waiting_list(spark, str(p), fmt="csv").first()
    assert df.fecha_nac is None and str(df.f_entrada) == "2024-01-10" and df.f_salida is None


def test_tables_from_configured_paths(spark, tmp_path):  # S11 + S1/S2/S5/S7 through the catalogue
    import datetime as dt

    from waitlens.plans import dims, referrals
    from waitlens.sources.catalog import Tables
    from waitlens.sources.config import InputPaths, Source
    from waitlens.sources.schemas import WAITING_LIST

    def text(name, body, enc="utf-8"):
        p = tmp_path / name
        p.write_bytes(body.encode(enc))
        return str(p)

    estab = text("estab.csv", "Listado 2025\n" + ",".join(
        ["Código Vigente", "Código Antiguo", "Nombre Oficial", "Código Comuna", "Nombre Comuna", "Nivel de Atención",
         "Nombre Dependencia Jerárquica (SEREMI / Servicio de Salud)", "Nivel de Complejidad"]) + "\n100,9,Hospital A,1,Buin,Terciario,Net,Alta\n")
    abbrev = text("abbrev.csv", "codigo_vigente,abreviacion\n100,HA\n")
    specs = text("specs.csv", "codigosigte,desc_esp,id_esp_seccion_a,id_esp_seccion_b,id_programacion\n"
                              "07-001,Cardiología,07020130,09600342,7020130\n", "latin-1")
    reasons = text("reasons.csv", "n,causal\n14,No pertinencia\n")
    lists = {}
    for name, fout in (("open", None), ("closed", dt.date(2024, 2, 1))):
        path = str(tmp_path / name)
        spark.createDataFrame([("1", "9", "F", dt.date(2000, 1, 1), "100", "100", dt.date(2024, 1, 1), fout, 1,
                                "07-001", "x", "C50 - a", "14" if fout else None, "s", "l")], WAITING_LIST) \
            .write.parquet(path)
        lists[name] = Source(path)
    paths = InputPaths(establishments=Source(estab, fmt="csv", skip_lines=1), abbreviations=Source(abbrev, fmt="csv"),
                       specialties=Source(specs, fmt="csv", encoding="ISO-8859-1"),
                       exit_reasons=Source(reasons, fmt="csv"), open_list=lists["open"], closed_list=lists["closed"],
                       production=Source(str(tmp_path / "none")), registry=Source(str(tmp_path / "none")),
                       referral_map=Source(str(tmp_path / "none")))
    t = Tables.from_paths(spark, paths)
    estab_df = dims.establishments(t.establishments_raw, t.abbreviations)
    assert estab_df.first().abreviacion == "HA"
    ex = referrals.enrich_exits(t.closed_list, estab=estab_df, specs=t.specialties, abbrev=t.abbreviations,
                                reasons=t.exit_reasons, service=1).first()
    assert (ex.desc_esp, ex.causal, ex.abrev_destino) == ("Cardiología", "No pertinencia", "HA")


def test_banner_only_dropped_at_file_start(spark, tmp_path):  # S1 on a file read in many splits
    p = tmp_path / "big.csv"
    body = "".join(f"{i:06d},name{i}\n" for i in range(3000))
    p.write_text("Banner line\ncodigo,nombre\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_csv(spark, str(p), "codigo string, nombre string", skip_lines=1)
        assert df.rdd.getNumPartitions() >= 1
        codes = sorted(r.codigo for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert codes == [f"{i:06d}" for i in range(3000)]


def test_csv_sheets_by_header(spark, tmp_path):  # S4, D5: separator, charset, another order, a column named by place
    from waitlens.sources.readers import read_sheets
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_bytes("Programación médica\nId Especialidad;Id Deis;rutsdv\nOtorrinolaringología;7000001;r1\n".encode("latin-1"))
    b.write_bytes("Programación médica\nid_deis;id_especialidad;rut profesional;otra\n200;7020130;r2;x\n".encode("latin-1"))
    schema = "id_deis string, id_especialidad string, rutsdv string"
    options = {"fmt": "csv", "sep": ";", "encoding": "ISO-8859-1", "skip_lines": 1}
    out = bind_sheets(read_sheets(spark, {"A": str(a), "B": str(b)}, schema, renames={"B": {3: "rutsdv"}}, **options))
    assert sorted(tuple(r) for r in out.collect()) == [("200", "7020130", "r2", "B"), ("7000001", "Otorrinolaringología", "r1", "A")]
    with pytest.raises(ValueError, match="rutsdv.*|b.csv"):
        read_sheets(spark, {"B": str(b)}, schema, **options)


def test_waiting_list_parquet_datetimes(spark, tmp_path):  # S5, S9: date-time columns keep their day
    import datetime as dt
    path = str(tmp_path / "le")
    spark.createDataFrame([(dt.datetime(2024, 1, 10, 8, 30), None, "2000-02-29 00:00:00")],
                          "f_entrada timestamp, f_salida timestamp, fecha_nac string").write.parquet(path)
    r = read_waiting_list(spark, path).first()
    assert (r.f_entrada, r.f_salida, r.fecha_nac) == (dt.date(2024, 1, 10), None, dt.date(2000, 2, 29))


def test_literal_table_types_and_no_python_scan(spark):  # S3
    from waitlens.sources.literals import SERVICE_TYPES, service_types
    df = service_types(spark)
    assert df.dtypes == [("n", "int"), ("descripcion", "string")]
    assert [tuple(r) for r in df.orderBy("n").collect()] == list(SERVICE_TYPES)
    assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
