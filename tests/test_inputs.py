"""Inputs by header name, key checks, and the way from CSV extracts to published analyses."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_columns_are_found_by_header(spark, tmp_path):  # S2, S6: other order, more columns
    from waitlens.sources.readers import read_csv
    from waitlens.sources.schemas import PRODUCTION
    names = ["mes", "id_servicio", "Ano", "id_establecimiento", "codigo_prestacion", "id_region", "id_comuna"]
    names += [f"Col{i:02d}" for i in range(1, 27)]
    values = ["1", "13", "2024", "113100", "07020130", "13", "130"] + [str(i) for i in range(1, 27)]
    (tmp_path / "rem.csv").write_text(";".join(names) + "\n" + ";".join(values) + "\n")
    r = read_csv(spark, str(tmp_path / "rem.csv"), PRODUCTION, sep=";").first()
    assert (r.mes, r.ano, r.id_servicio, r.codigo_prestacion) == (1, 2024, 13, "07020130")
    assert (r.col01, r.col09, r.col19, r.col26) == (1.0, 9.0, 19.0, 26.0)


@pytest.mark.parametrize("skip_lines", [0, 1])
def test_missing_column_is_an_error(spark, tmp_path, skip_lines):
    from waitlens.sources.readers import read_csv
    (tmp_path / "x.csv").write_text("banner\n" * skip_lines + "codigo,otro\n1,2\n")
    with pytest.raises(ValueError, match="nombre"):
        read_csv(spark, str(tmp_path / "x.csv"), "codigo string, nombre string", skip_lines=skip_lines)


def test_banner_header_by_name(spark, tmp_path):  # S1
    from waitlens.sources.readers import read_csv
    (tmp_path / "x.csv").write_text("a banner, with a comma\nNombre Oficial;extra;Código Vigente\nHospital;x;0100\n")
    r = read_csv(spark, str(tmp_path / "x.csv"), "codigo_vigente string, nombre_oficial string", sep=";", skip_lines=1).collect()
    assert [(x.codigo_vigente, x.nombre_oficial) for x in r] == [("0100", "Hospital")]


def test_each_file_has_its_own_header(spark, tmp_path):  # S5, S6, S8
    from waitlens.sources.readers import read_csv
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("mes,ano,v\n2,2024,1.5\n")
    (tmp_path / "a" / "2.csv").write_text("\ufeffAño,otra,Mes,V\n2024,x,3,2.5\n")
    (tmp_path / "a" / "_hidden.csv").write_text("x\n1\n")
    (tmp_path / "a" / "empty.csv").write_text("")
    schema = "mes int, ano int, v double"
    for source in (str(tmp_path / "a"), str(tmp_path / "a" / "*.csv"), [str(tmp_path / "a" / "1.csv"), str(tmp_path / "a" / "2.csv")]):
        got = read_csv(spark, source, schema)
        assert sorted(tuple(r) for r in got.collect()) == [(2, 2024, 1.5), (3, 2024, 2.5)] and got.columns == ["mes", "ano", "v"]
    (tmp_path / "a" / "3.csv").write_text("mes,ano\n1,2\n")
    with pytest.raises(ValueError, match=r"3\.csv.*'v'"):
        read_csv(spark, str(tmp_path / "a"), schema)
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none*.csv"), schema)


def test_compressed_files_and_names_with_blanks(spark, tmp_path):
    import gzip

    from waitlens.sources.readers import read_csv
    with gzip.open(tmp_path / "lista de espera ñ.csv.gz", "wt", encoding="latin-1") as f:
        f.write("Título\nCódigo;Año\nñ;2024\n")
    got = read_csv(spark, str(tmp_path / "*.gz"), "codigo string, ano int", sep=";", encoding="ISO-8859-1", skip_lines=1)
    assert [tuple(r) for r in got.collect()] == [("ñ", 2024)]


def test_latin1_below_a_banner_in_many_splits(spark, tmp_path):  # S1 + S7
    from waitlens.sources.readers import read_csv
    for k, names in enumerate(("Código;Descripción", "Descripción;Código")):
        rows = [(f"{k}{i:05d}", f"Pediatría número {i}") for i in range(1500)]
        body = "".join(";".join(r if k == 0 else r[::-1]) + "\n" for r in rows)
        (tmp_path / f"{k}.csv").write_bytes(f"Año 2024\nsegunda línea\n{names}\n{body}".encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = read_csv(spark, str(tmp_path), "codigo string, descripcion string", sep=";", encoding="ISO-8859-1", skip_lines=2)
        rows = sorted(tuple(r) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == sorted((f"{k}{i:05d}", f"Pediatría número {i}") for k in (0, 1) for i in range(1500))


def test_positional_columns_need_no_header_names(spark, tmp_path):  # S10, D5
    from waitlens.sources.readers import read_positional
    (tmp_path / "p.csv").write_text("uno,,tres,cuatro\na,b,1.5,x\n")
    got = read_positional(spark, str(tmp_path / "p.csv"), "x1 string, especialidad string, m01 double")
    assert [tuple(r) for r in got.collect()] == [("a", "b", 1.5)]
    with pytest.raises(ValueError, match="4 columns"):
        read_positional(spark, str(tmp_path / "p.csv"), "a string, b string, c string, d string, e string")


def test_a_parameter_that_is_not_set_is_named(spark):
    from waitlens.registry import PLANS, Context, Params
    from waitlens.sources.catalog import Tables
    tables = Tables(spark, lambda name: spark.createDataFrame([], "codigo_vigente string"))
    with pytest.raises(ValueError, match="network"):
        PLANS["establishments"](Context(tables, Params()))


def test_waiting_list_honours_options(spark, tmp_path):  # S5
    from waitlens.sources.readers import read_waiting_list
    header = ("id_local;run;dv;sexo;fecha_nac;estab_orig;estab_dest;f_entrada;f_salida;tipo_prest;presta_min;presta_est;"
              "sospecha_diag;c_salida;sigte_id;otra")
    (tmp_path / "le.csv").write_bytes((header + "\nl1;1;9;F;2000-01-02;1;2;2024-01-10;;1;07-001;x;Otitis media niño;;s1;z\n").encode("latin-1"))
    r = read_waiting_list(spark, str(tmp_path / "le.csv"), fmt="csv", sep=";", encoding="ISO-8859-1").first()
    assert (r.run, r.id_local, str(r.f_entrada), r.tipo_prest, r.sospecha_diag) == ("1", "l1", "2024-01-10", 1, "Otitis media niño")


def test_clean_names_stay_unique():  # D1
    from waitlens.functions.text import clean_names
    assert clean_names(["a", "a", "a_2", "A"]) == ["a", "a_2", "a_2_2", "a_3"]


def test_strict_mean_and_median(spark):  # A5, A6, P33
    from waitlens.plans import gap
    rows = [(4, "3", "2024-01-01", None, None, "g"), (4, "3", "2024-01-11", None, None, "g"),
            (4, "3", None, None, None, "h"), (4, "3", "2024-01-11", None, None, "h")]
    df = spark.createDataFrame(rows, "tipo_prest int, estab_dest string, f string, f_salida date, tipo_error string, especialidad_grupo string")
    df = df.withColumn("f_entrada", F.col("f").cast("date")).drop("f")
    got = {r.especialidad_grupo: (r.n, r["mean"], r["median"]) for r in gap.waiting_time_stats(df, service=4, site="3", at="2024-01-21").collect()}
    assert got == {"g": (2, 15.0, 15.0), "h": (2, None, None)}


def test_cube_joins_null_codes_with_null_codes(spark):  # N1, J4, P24
    from waitlens.plans import cube
    production = spark.createDataFrame([(1, 2024, "5", None, "070", "090", 1.0, 2.0)], (
        "mes int, ano int, id_establecimiento string, codigosigte string, codigo_prestacion_x string, codigo_prestacion_y string, "
        "consultas_menores15 double, consultas_mayores double"))
    counts = spark.createDataFrame([(2024, 1, "5", None, 7)], "ano int, mes int, estab_dest string, presta_min string, n long")
    out = cube.monthly_cube(
        production, specs=spark.createDataFrame([], "codigosigte string, desc_esp string"),
        demand=counts.withColumnRenamed("n", "demanda_mensual"),
        plan_monthly=spark.createDataFrame([], "id_deis string, id_especialidad string, id_actividad string, prog_mensual double"),
        abbrev=spark.createDataFrame([("5", "S5")], "codigo_vigente string, abreviacion string"),
        exits=counts.withColumnRenamed("n", "egresos_mensual")).first()
    assert (out.demanda_mensual, out.egresos_mensual, out.produccion_cne) == (7, 7, 3.0)


def test_misrouted_with_an_empty_code_list(spark):  # P34
    from waitlens.plans import routing
    v2 = spark.createDataFrame([(3, "Cardio", "H66 - otitis", "2024-01-01")], "edad_sic int, desc_esp string, sospecha_diag string, f string")
    v2 = v2.withColumn("f_entrada", F.col("f").cast("date"))
    rmap = spark.createDataFrame([("Cardio", "13-1", "h66"), ("Cardio", "13-1", "x9"), ("Other", "13-2", "H66")], (
        "descripcion_especialidad_demandada string, codigo_deis_establecimiento_destino string, codigo_cie_10_diagnostico_opcional string"))

    def found(destination):
        return routing.misrouted(v2, rmap, specialty="Cardio", destination=destination, entry_from="2023-01-01").count()

    assert found("13-1") == 1 and found("13-2") == 0


def test_running_total_has_one_order(spark):  # W1 with several production codes in a month
    from waitlens.plans import cube
    rows = [(1, "5", "c", "b", 6, 0), (1, "5", "c", "a", 6, 0), (2, "5", "c", "a", 1, 2)]
    df = spark.createDataFrame(rows, "mes int, id_establecimiento string, codigosigte string, codigo_prestacion_x string, demanda_mensual long, egresos_mensual long")
    df = df.withColumns({"codigo_prestacion_y": F.lit("y"), "abreviacion": F.lit("S"), "fecha": F.make_date(F.lit(2024), "mes", F.lit(1))})
    start = spark.createDataFrame([("S", "c", 10)], "abreviacion string, codigosigte string, n long")
    out = cube.running_backlog(df, start, start_keys=["abreviacion", "codigosigte"], start_value="n").collect()
    assert sorted((r.mes, r.codigo_prestacion_x, r.demanda_acumulada) for r in out) == [(1, "a", 16), (1, "b", 22), (2, "a", 21)]


def test_session_keeps_submitted_settings_and_needs_a_shared_folder(monkeypatch):
    from waitlens import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Remote:
        conf = Conf({"spark.master": "spark://host:7077"})

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Remote())


def extracts(spark, folder):
    """The test tables as CSV files with shuffled columns, banner and Latin-1, and their configuration."""
    from waitlens.sources.catalog import TABLE_NAMES, Tables
    from waitlens.sources.config import InputPaths, Source
    from waitlens.sources.testviews import DriverViews
    tables = Tables.from_driver(spark, SF)
    sources = {}
    for name in TABLE_NAMES:
        if name in ("service_types", "programming", "list_statistics", "sigte_datetimes"):
            continue
        df = getattr(tables, name)
        if name == "projection":  # read by position, whatever its headers are
            df = df.toDF(*[f"Proyección {i}" for i, _ in enumerate(df.columns)])
        else:
            df = df.select(*reversed(df.columns), F.lit("x").alias("una columna más"))
        pdf = df.toPandas()
        path, latin = f"{folder}/{name}.csv", name == "referral_map"
        banner = "Listado de establecimientos\n" if name == "establishments_raw" else ""
        with open(path, "w", encoding="latin-1" if latin else "utf-8") as out:
            out.write(banner + pdf.to_csv(index=False, sep=";" if name == "production_raw" else ","))
        sources[name] = Source(path, fmt="csv", sep=";" if name == "production_raw" else ",",
                               encoding="ISO-8859-1" if latin else "UTF-8", skip_lines=int(bool(banner)))
    files = {}
    for name, sheet in DriverViews(spark, SF).programming_sheets().items():
        files[name] = f"{name}.csv"
        with open(f"{folder}/{name}.csv", "w", encoding="latin-1") as out:
            out.write("Programación\n" + sheet.toPandas().to_csv(index=False, sep=";"))
    main = {"establishments": "establishments_raw", "production": "production_raw", "registry": "registry_raw"}
    plain = ("abbreviations", "specialties", "exit_reasons", "open_list", "closed_list", "referral_map")
    return InputPaths(**{k: sources.pop(v) for k, v in main.items()}, **{k: sources.pop(k) for k in plain},
                      programming_folder=str(folder), programming_files=files, programming_format="csv", programming_sep=";", programming_encoding="ISO-8859-1",
                      programming_skip_lines=1, programming_renames={"h3": {3: "rutsdv"}}, extras=sources)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_from_csv_to_published_analyses(spark, tmp_path):
    from dataclasses import replace

    from waitlens import workflow
    from waitlens.registry import PLANS, TEST, Context
    from waitlens.sources.catalog import Tables, publish
    paths = extracts(spark, tmp_path)
    published = str(tmp_path / "published")
    publish(Tables.from_paths(spark, paths), published)
    params = replace(TEST, np_min_total=1)
    done = workflow.run(spark, Tables.from_dir(spark, published), str(tmp_path / "out"), params=params)
    assert set(done) == set(PLANS)
    direct = Context(Tables.from_driver(spark, SF), params)
    for name in ("np_rate", "programming_by_activity", "gap_new_projected", "open_closed_union", "monthly_cube", "dashboard_backlog", "programming_union", "wait_mean_median", "gap_projected", "misrouted_by_pattern"):
        want = PLANS[name](direct)
        got = spark.read.parquet(done[name])
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols

        def rows(df):
            return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())

        assert rows(got) == rows(want), name
    with open(f"{tmp_path}/abbreviations.csv") as f:
        lines = f.read().splitlines()
    with open(f"{tmp_path}/abbreviations.csv", "a") as f:
        f.write(lines[1] + "\n")
    with pytest.raises(ValueError, match="duplicated key"):
        workflow.run(spark, Tables.from_paths(spark, paths), str(tmp_path / "again"), params=params, names=["np_rate"])
