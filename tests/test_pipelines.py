"""Domain pipelines on small hand-made fixtures with hand-computed results
(the cases listed in FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from waitlens.plans import cube, dims, gap, production, programming, referrals, rejection, routing
from waitlens.sources.schemas import WAITING_LIST

D = dt.date


@pytest.fixture(scope="module")
def dimargs(spark):
    estab_raw = spark.createDataFrame([
        ("100", "900", "Hospital A", "1", "Buin", "Terciario", "Net", "Alta"),
        ("200", "901", "Centro B", "1", "Buin", "Primario", "Net", "Baja"),
        ("300", "902", "Hospital C", "2", "Paine", "Secundario", "Other", "Alta"),
    ], ["Código Vigente", "Código Antiguo", "Nombre Oficial", "Código Comuna", "Nombre Comuna", "Nivel de Atención",
        "Nombre Dependencia Jerárquica (SEREMI / Servicio de Salud)", "Nivel de Complejidad"])
    abbrev = spark.createDataFrame([("100", "HA"), ("200", "CB"), ("300", "HC")], "codigo_vigente string, abreviacion string")
    specs = spark.createDataFrame([("07-001", "Cardio", "07020130", "09600342", "7020130"),
                                   ("07-002", "Derma", "07020230", None, "7020230"),
                                   ("09-001", "Dental", None, None, "9000001")],
                                  "codigosigte string, desc_esp string, id_esp_seccion_a string, "
                                  "id_esp_seccion_b string, id_programacion string")
    reasons = spark.createDataFrame([("1", "Atención realizada"), ("14", "No pertinencia")], "n string, causal string")
    return {"estab": dims.establishments(estab_raw, abbrev, network="Net"), "specs": specs,
            "abbrev": dims.abbreviations(abbrev), "reasons": reasons}


def referral(run="1", birth=D(2000, 1, 1), orig="200", dest="100", fin=D(2024, 1, 10), fout=None, tipo=1,
             code="07-001", diag="C50 - Tumor", exit_code=None, sid="s"):
    return (run, "9", "F", birth, orig, dest, fin, fout, tipo, code, "x", diag, exit_code, sid, "l")


def test_np_rate_counts_pivot_and_threshold(spark, dimargs):  # P9, P10
    rows = [referral(fout=D(2024, 3, 1), exit_code="14", sid=f"a{i}") for i in range(3)]
    rows += [referral(fout=D(2024, 3, 1), exit_code="1", sid=f"b{i}") for i in range(6)]
    rows += [referral(fout=D(2024, 3, 1), exit_code="99", sid="c")]  # unknown reason still counts in total
    rows += [referral(fout=D(2023, 3, 1), exit_code="14", sid="d")]  # other year
    rows += [referral(fout=D(2024, 3, 1), exit_code="14", code="09-001", sid="e")]  # dental code out
    rows += [referral(fout=D(2024, 3, 1), exit_code="14", tipo=2, sid="f")]  # other service
    closed = spark.createDataFrame(rows, WAITING_LIST)
    exits = referrals.enrich_exits(closed, service=1, **dimargs)
    reasons = {"Atención realizada": "atencion_realizada", "No pertinencia": "no_pertinencia"}
    out = rejection.np_rate(exits, years=(2024,), reasons=reasons).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.abrev_destino, r.desc_esp, r.anio) == ("HA", "Cardio", 2024)
    assert (r.atencion_realizada, r.no_pertinencia, r.total_egresos, r.porc_np_total) == (6, 3, 10, 0.3)
    assert rejection.np_rate(exits, years=(2024,), reasons=reasons, min_total=11).count() == 0


def test_as_of_date_filtered_versus_input(spark, dimargs):  # P6 vs P8, N18
    rows = [referral(fin=D(2024, 1, 1), sid="open"),
            referral(fin=D(2024, 1, 1), fout=D(2024, 6, 30), tipo=2, sid="late")]  # filtered out by service
    raw = spark.createDataFrame(rows, WAITING_LIST)
    v1 = referrals.enrich_referrals(raw, service=1, **dimargs).first()
    assert v1.f_salida_o_maxima == D(2024, 1, 1) and v1.tiempo_espera == 0
    v2 = referrals.enrich_referrals_v2(raw, site="100", service=1, **dimargs).first()
    assert v2.f_salida_o_maxima == D(2024, 6, 30) and v2.tiempo_espera == 181


def test_role_playing_and_age(spark, dimargs):  # P6, J2, X9
    raw = spark.createDataFrame([referral(birth=D(2006, 1, 10), fin=D(2024, 1, 10))], WAITING_LIST)
    r = referrals.enrich_referrals(raw, **dimargs).first()
    assert (r.establecimiento_origen, r.nivel_de_atencion_origen) == ("Centro B", "Primario")
    assert (r.establecimiento_destino, r.abrev_destino, r.desc_esp, r.edad_sic) == ("Hospital A", "HA", "Cardio", 18)


def test_open_closed_union(spark, dimargs):  # P7
    open_raw = spark.createDataFrame([referral(sid="o1"), referral(fout=D(2024, 2, 1), sid="o2")], WAITING_LIST)
    closed_raw = spark.createDataFrame([referral(fout=D(2024, 2, 1), sid="c1"), referral(sid="c2")], WAITING_LIST)
    out = referrals.open_closed_union(open_raw, closed_raw, **dimargs)
    assert sorted(r.sigte_id for r in out.collect()) == ["c1", "c2", "o1"]


def test_age_band_18_has_no_band(spark, dimargs):  # P13
    rows = [referral(birth=D(2006, 1, 1), fin=D(2024, 1, 2), fout=D(2024, 6, 1), exit_code="14", diag="Autismo", sid="a"),
            referral(birth=D(2010, 1, 1), fin=D(2024, 1, 2), fout=D(2024, 6, 1), exit_code="14", diag="x AUTISMO", sid="b"),
            referral(birth=D(2010, 1, 1), fin=D(2024, 1, 2), fout=D(2024, 6, 1), exit_code="14", diag=None, sid="c")]
    exits = referrals.enrich_exits(spark.createDataFrame(rows, WAITING_LIST), service=1, **dimargs)
    out = {r.grupo_edad: r.n for r in rejection.rejected_by_age_band(
        exits, word="autismo", np_code="14", exit_from="2024-01-01").collect()}
    assert out == {None: 1, "6 a 14": 1}


def test_top_diagnoses_tie_break(spark, dimargs):  # P12, P41
    rows = [referral(fout=D(2024, 5, 1), exit_code="14", diag=f"D{i:02d}", sid=f"{i}") for i in range(12)]
    rows += [referral(fout=D(2024, 5, 1), exit_code="14", diag="D11", sid="x")]
    exits = referrals.enrich_exits(spark.createDataFrame(rows, WAITING_LIST), service=1, **dimargs)
    counts = rejection.rejected_diagnosis_counts(exits, np_code="14", year=2024, specialties=["Cardio"])
    top = rejection.top_rejected_diagnoses(counts)
    got = sorted((r.sospecha_diag, r.n) for r in top.collect())
    assert got == sorted([("D11", 2)] + [(f"D{i:02d}", 1) for i in range(9)])
    ranked = {r.sospecha_diag: r.diagnostico_orden for r in rejection.ranked_diagnoses(counts).collect()}
    assert ranked["D11"] == 10 and ranked["D00"] == 1


def test_production_null_keys_pair(spark):  # P3-P5, N1, B10
    specs = spark.createDataFrame([("07-001", "Cardio", "07020130", "09600342", "7020130")],
                                  "codigosigte string, desc_esp string, id_esp_seccion_a string, "
                                  "id_esp_seccion_b string, id_programacion string")
    cols = ("mes int, ano int, id_servicio int, id_establecimiento string, codigo_prestacion string, id_region int, "
            "id_comuna int, col01 double, col02 double, col09 double, col10 double, col13 double, col16 double, "
            "col17 double, col19 double, col20 double, col21 double, col22 double, col26 double")
    rem = spark.createDataFrame([
        (1, 2024, 13, "100", "07020130", 13, 1, 10.0, None, None, None, None, None, None, 1.0, 2.0, 3.0, 4.0, 6.0),
        (1, 2024, 13, "100", "07099999", 13, 1, 5.0, None, None, None, None, None, None, 1.0, 1.0, 1.0, 2.0, 3.0),
        (1, 2024, 13, "100", "09600342", 13, 1, 7.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, None, 2.0, 1.0, None, None),
        (1, 2024, 13, "100", "09699999", 13, 1, 8.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, None, 3.0, 1.0, None, None),
        (1, 2024, 12, "100", "07020130", 13, 1, 99.0, None, None, None, None, None, None, 1.0, 1.0, 1.0, 1.0, 1.0),
    ], cols)
    a = production.section_a(rem, specs=specs, service=13, codes=["07020130", "07099999"])
    a1 = production.section_a1(rem, specs=specs, service=13, codes=["09600342", "09699999"])
    out = {(r.codigo_prestacion_x, r.codigo_prestacion_y): r.nsp_nuevas for r in production.combined(a, a1).collect()}
    assert out == {("07020130", "09600342"): 2.0, ("07099999", "09699999"): 3.0}


def test_programming_strict_and_rounding(spark):  # P2, P16, P20, N7, N9
    cols = ("id_deis string, id_especialidad string, rutsdv string, id_actividad string, produccion_1_sem string, "
            "produccion_2_sem string, horas_asignadas double, total_horas_semanales_contratadas_run double")
    s1 = spark.createDataFrame([("100", "7020130", "r1", "1", "3", "3", 1.0, 2.0),
                                ("100", "7020230", "r1", "1", "s/i", "4", 1.0, 2.0)], cols)
    s2 = spark.createDataFrame([("200", "7020130", "r2", "1", "9", "9", 1.0, 2.0)],
                               cols.replace("rutsdv", "rut_prof"))
    plan = programming.consolidate([s1, s2], third_column_fix=(1,))
    yearly = {(r.id_deis, r.id_especialidad): r for r in programming.yearly(plan).collect()}
    assert yearly[("100", "7020230")].produccion_1_sem is None
    # The yearly total adds the two semester sums of the same aggregation
    assert (yearly[("100", "7020130")].produccion_anual, yearly[("200", "7020130")].produccion_anual) == (6.0, 18.0)
    assert yearly[("100", "7020230")].produccion_anual is None
    monthly = {(r.id_deis, r.id_especialidad): r.prog_mensual for r in programming.monthly(programming.yearly(plan)).collect()}
    assert monthly[("100", "07020130")] == 0.0  # 6 / 12 = 0.5 rounds to even
    assert monthly[("200", "07020130")] == 2.0  # 18 / 12 = 1.5 rounds to even


def test_running_backlog_gap_month(spark):  # P25, N4
    cube_df = spark.createDataFrame([
        (1, 2024, "100", "HA", "07-001", "Cardio", 5, 2, 1.0, 1.0, D(2024, 1, 1)),
        (2, 2024, "100", "HA", "07-001", "Cardio", 4, None, 1.0, 1.0, D(2024, 2, 1)),
        (3, 2024, "100", "HA", "07-001", "Cardio", 3, 1, 1.0, 1.0, D(2024, 3, 1)),
    ], "mes int, ano int, id_establecimiento string, abreviacion string, codigosigte string, desc_esp string, "
       "demanda_mensual long, egresos_mensual long, produccion_cne double, prog_mensual double, fecha date")
    start = spark.createDataFrame([("HA", "07-001", 10)], "abreviacion string, codigosigte string, n long")
    out = cube.running_backlog(cube_df, start, start_keys=["abreviacion", "codigosigte"], start_value="n")
    assert [r.demanda_acumulada for r in out.orderBy("fecha").collect()] == [13, None, None]


def test_hospital_gap_still_waiting(spark, dimargs):  # P31, F9
    rows = [referral(fin=D(2023, 5, 1), sid="a"),  # waiting at start
            referral(fin=D(2023, 5, 1), fout=D(2023, 12, 1), sid="b"),  # left before start
            referral(fin=D(2023, 5, 1), fout=D(2024, 2, 1), sid="c"),  # still waiting at start
            referral(fin=D(2024, 3, 1), sid="d"),  # entered in the year
            referral(fin=D(2024, 3, 1), code=None, sid="e")]  # null code kept
    both = referrals.enrich_referrals(spark.createDataFrame(rows, WAITING_LIST), **dimargs)
    prod = spark.createDataFrame([("100", "07020130", "07-001", 10.0, 4.0, 2.0, 1.0, 1.0)],
                                 "id_establecimiento string, codigo_prestacion_x string, codigosigte string, "
                                 "total_consultas double, consultas_menores15 double, consultas_mayores double, "
                                 "nsp_nuevas double, nsp_controles double")
    out = {r.presta_min: r for r in gap.hospital_gap(both.limit(0), both, prod, year=2024, site="100",
                                                     specs=dimargs["specs"]).collect()}
    r = out["07-001"]
    assert (r.demanda_inicial, r.demanda_2024, r.demanda_total) == (2, 1, 3)
    assert (r.produccion_cne, r.produccion_nsp_cne, r.produccion_total_cne_2024, r.brecha) == (6.0, 1.0, 7.0, 0.43)


def test_portfolio_crosstab(spark, dimargs):  # P35, D10
    rows = [referral(orig="200", dest="100", diag="C50 - a", sid="1"),
            referral(orig="200", dest="300", diag="J35", sid="2"),
            referral(orig="200", dest="100", diag="Z00 - b - c", sid="3")]
    le = referrals.enrich_referrals(spark.createDataFrame(rows, WAITING_LIST), **dimargs)
    sites = spark.createDataFrame([("900", "200", "Buin", "West")], "codigo_antiguo string, x2 string, comuna string, minired string")
    portfolio = spark.createDataFrame([("C50",), ("J35",)], "codigo string")
    out = {(r.destino, r.cartera): r.n for r in routing.portfolio_crosstab(
        le, network_sites=sites, network="West", portfolio=portfolio, target_site="100", excluded_site="999").collect()}
    assert out == {("si", "si"): 1, ("si", "no"): 1}  # site 300 is outside the network dimension


def test_misrouted_pattern_any_case(spark, dimargs):  # P34, J6
    rows = [referral(birth=D(2015, 1, 1), diag="J35 - amigdalas", fin=D(2024, 1, 1), sid="1"),
            referral(birth=D(2015, 1, 1), diag="h66 otitis", fin=D(2024, 1, 1), sid="2"),
            referral(birth=D(2015, 1, 1), diag="Z00", fin=D(2024, 1, 1), sid="3"),
            referral(birth=D(2000, 1, 1), diag="J35", fin=D(2024, 1, 1), sid="4")]
    v2 = referrals.enrich_referrals_v2(spark.createDataFrame(rows, WAITING_LIST), site="100", service=1, **dimargs)
    rmap = spark.createDataFrame([("Cardio", "13-130", "J35"), ("Cardio", "13-130", "H66"), ("Cardio", "13-130", ""),
                                  ("Cardio", "13-999", "Z00")],
                                 "descripcion_especialidad_demandada string, codigo_deis_establecimiento_destino string, "
                                 "codigo_cie_10_diagnostico_opcional string")
    out = routing.misrouted(v2, rmap, specialty="Cardio", destination="13-130", entry_from="2023-01-01")
    assert sorted(r.sospecha_diag for r in out.collect()) == ["J35 - amigdalas", "h66 otitis"]


def test_misrouted_codes_literal_or_as_patterns(spark):  # P34, J6, X2
    texts = ["J35 - amigdalas", "j35.1 adenoides", "xJ351", "J3", "", None, "K", "ab.c", "abxc", "ÑJ35"]
    v2 = spark.createDataFrame([(i, 3, "Cardio", t, D(2024, 1, 1)) for i, t in enumerate(texts)],
                               "sigte_id int, edad_sic int, desc_esp string, sospecha_diag string, f_entrada date")

    def found(codes, **kw):
        rmap = spark.createDataFrame([("Cardio", "13-1", c) for c in codes], (
            "descripcion_especialidad_demandada string, codigo_deis_establecimiento_destino string, "
            "codigo_cie_10_diagnostico_opcional string"))
        out = routing.misrouted(v2, rmap, specialty="Cardio", destination="13-1", entry_from="2023-01-01", **kw)
        return sorted(r.sigte_id for r in out.collect())

    for codes in (["J35"], ["J35.1", "k"], ["B.C", "J35.1", "j35"], ["amigdalas y mas"], ["J3", "J35", "J351"], ["", None], []):
        want = [i for i, t in enumerate(texts) if t is not None and any(c and c.upper() in t.upper() for c in codes)]
        assert found(codes) == want, codes
    assert found(["j35.1"], codes_as_patterns=True) == [1]
    assert found(["b.c", "^k$"], codes_as_patterns=True) == [6, 7, 8]
    assert found([], codes_as_patterns=True) == found(["", None], codes_as_patterns=True) == []


def test_waiting_time_stats(spark):  # P33, A5, A6
    sigte = spark.createDataFrame([(4, "100", D(2024, 12, 1), None, None, "G"), (4, "100", D(2024, 12, 11), None, None, "G"),
                                   (4, "100", D(2024, 12, 21), None, None, "G"), (4, "100", D(2024, 1, 1), None, "dup", "G")],
                                  "tipo_prest int, estab_dest string, f_entrada date, f_salida date, tipo_error string, "
                                  "especialidad_grupo string")
    r = gap.waiting_time_stats(sigte, service=4, site="100", at="2025-01-15").first()
    assert (r.n, r.mean, r.median) == (3, 35.0, 35.0)


def test_registry_cleaning(spark):  # P39, X3
    raw = spark.createDataFrame([("123K", None, "A", "c", "1", "Buin"), (None, None, "B", "c", "1", "Buin")],
                                "rut_paciente string, rut string, apellido_paterno string, consultorio_inscripcion string, "
                                "comuna_establecimiento_id string, comuna_establecimiento string")
    out = dims.registry(raw).collect()
    assert len(out) == 1 and out[0].rut_paciente_sdv == "123" and out[0].rut_sdv is None


def test_choices_and_yearly_long(spark):  # P43, P40, A9
    rates = spark.createDataFrame([("Cardio", 2024, 10, 6, 0.3), ("Cardio", 2024, 5, None, 0.2)],
                                  "desc_esp string, anio int, total_egresos long, atencion_realizada long, porc_np_total double")
    long = {(r.tipo): r.valor for r in rejection.yearly_totals_long(rates).collect()}
    assert long == {"total_egresos": 15, "total_ar": 6}
    assert rejection.np_share_mean(rates).first().pct_np == pytest.approx(0.25)
    assert cube.choices(rates, "desc_esp").count() == 1
    assert F is not None


def test_gap_production_null_rules(spark):  # P30/P31 production side: N2, N3, N8
    specs = spark.createDataFrame([("07-001", "Cardio"), ("07-002", "Derma"), ("07-003", "Neuro")],
                                  "codigosigte string, desc_esp string")
    prod = spark.createDataFrame([
        ("100", "07-001", 10.0, 4.0, None, 1.0, None),   # null inside a group: skipped
        ("100", "07-001", 5.0, 1.0, 2.0, None, None),
        ("100", "07-002", 0.0, None, None, None, None),  # all null: 0; zero total: null share
        ("100", "07-003", None, 1.0, 1.0, 0.0, 0.0),     # strict total null; no-show total 0: null share
    ], "id_establecimiento string, codigosigte string, total_consultas double, consultas_menores15 double, "
       "consultas_mayores double, nsp_nuevas double, nsp_controles double")
    out = {r.codigosigte: r for r in gap.gap_production(prod, site="100", names=specs).collect()}
    a, b, c = out["07-001"], out["07-002"], out["07-003"]
    assert (a.produccion_total, a.produccion_cne, a.produccion_nsp_cne, a.proporcion_cne) == (15.0, 7.0, 1.0, 0.47)
    assert (b.produccion_cne, b.produccion_nsp_total, b.proporcion_cne, b.proporcion_nsp_cne) == (0.0, 0.0, None, None)
    assert (c.produccion_total, c.proporcion_cne, c.produccion_control, c.proporcion_nsp_cne) == (None, None, None, None)


def test_publish_rejects_duplicated_dimension_key(spark, tmp_path):  # N12 at publish
    from waitlens.sources.catalog import TABLE_NAMES, Tables, publish

    frames = {n: spark.createDataFrame([("x",)], "a string") for n in TABLE_NAMES}
    frames["specialties"] = spark.createDataFrame([("07-001", "A"), ("07-001", "B")], "codigosigte string, desc_esp string")
    frames["abbreviations"] = spark.createDataFrame([("1", "S1")], "codigo_vigente string, abreviacion string")
    frames["exit_reasons"] = spark.createDataFrame([("A", "x")], "n string, causal string")
    frames["service_types"] = spark.createDataFrame([(1, "x")], "n int, descripcion string")
    frames["establishments_raw"] = spark.createDataFrame([("1",)], ["Código Vigente"])
    frames["open_list"] = spark.createDataFrame([(1, "1", "07-001")], "tipo_prest int, estab_dest string, presta_min string")
    frames["closed_list"] = frames["open_list"]
    frames["production_raw"] = spark.createDataFrame([(13, "1", "07020130")],
                                                     "id_servicio int, id_establecimiento string, codigo_prestacion string")
    tables = Tables(spark, frames.__getitem__)
    with pytest.raises(ValueError, match="specialties"):
        publish(tables, str(tmp_path / "pub"))


def test_v2_from_enriched_list_equals_direct_v2(spark, dimargs):  # P8 reuse of the enriched open list
    rows = [referral(fin=D(2024, 1, 1), sid="a"), referral(fin=D(2024, 2, 1), code="09-001", sid="b"),
            referral(fin=D(2024, 3, 1), code=None, sid="c"), referral(fin=D(2024, 6, 30), tipo=2, sid="d"),
            referral(fin=D(2024, 1, 5), dest="300", sid="e")]
    raw = spark.createDataFrame(rows, WAITING_LIST)
    direct = referrals.enrich_referrals_v2(raw, site="100", service=1, **dimargs)
    reused = referrals.v2_from_enriched(referrals.enrich_referrals(raw, **dimargs), site="100", service=1)
    cols = sorted(direct.columns)
    assert sorted(reused.columns) == cols

    def rows_of(df):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())

    assert rows_of(direct) == rows_of(reused)
    assert {r.f_salida_o_maxima for r in reused.collect()} == {D(2024, 6, 30)}  # as-of from a row V2 drops
