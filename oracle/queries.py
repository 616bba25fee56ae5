"""One SQL text per registered query, over the views of ``oracle.views``.

Parameters repeat the values of ``waitlens.registry`` literally."""

from __future__ import annotations

from oracle.views import BASE_VIEWS

V1_COLS = ("run, dv, sexo, fecha_nac, estab_orig, establecimiento_origen, codigo_comuna, nombre_comuna, "
           "nivel_de_atencion_origen, f_entrada, tipo_prest, presta_min, sospecha_diag, estab_dest, "
           "establecimiento_destino, presta_est, f_salida, c_salida, abrev_destino, nivel_de_atencion_destino, "
           "sigte_id, id_local")
V2_COLS = ("run, dv, sexo, fecha_nac, estab_orig, codigo_comuna, nivel_de_atencion_origen, f_entrada, tipo_prest, "
           "presta_min, sospecha_diag, estab_dest, presta_est, f_salida, c_salida, abrev_destino, "
           "nivel_de_atencion_destino")
V3_COLS = ("run, dv, sexo, fecha_nac, estab_orig, codigo_comuna, f_entrada, tipo_prest, presta_min, sospecha_diag, "
           "estab_dest, presta_est, f_salida, c_salida, abrev_destino")
KEEP_NULL_NOT_DENTAL = "NOT coalesce(regexp_matches(presta_min, '^09'), false)"


def q(*steps: tuple[str, str], final: str) -> str:
    ctes, seen = [], set()
    for name, sql in list(BASE_VIEWS) + list(steps):
        if name not in seen:  # step lists share prefixes; keep the first definition
            seen.add(name)
            ctes.append((name, sql))
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + final


def lst(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def joined(src: str) -> str:
    """Both site roles, abbreviation, then the V1 projection source."""
    return f"""SELECT r.*, ed.nombre_oficial AS establecimiento_destino, ed.nivel_de_atencion AS nivel_de_atencion_destino,
        eo.nombre_oficial AS establecimiento_origen, eo.codigo_comuna, eo.nombre_comuna,
        eo.nivel_de_atencion AS nivel_de_atencion_origen, ab.abreviacion AS abrev_destino
        FROM {src} r LEFT JOIN estab ed ON r.estab_dest = ed.codigo_vigente
        LEFT JOIN estab eo ON r.estab_orig = eo.codigo_vigente LEFT JOIN abbrev ab ON r.estab_dest = ab.codigo_vigente"""


def names(src: str, cols: str) -> str:
    return f"""SELECT {', '.join('x.' + c.strip() for c in cols.split(','))}, sp.desc_esp, rs.causal FROM {src} x
        LEFT JOIN specs sp ON x.presta_min = sp.codigosigte LEFT JOIN reasons rs ON x.c_salida = rs.n"""


AGE = ("CAST(year(f_entrada) - year(fecha_nac) - CASE WHEN month(f_entrada) * 100 + day(f_entrada) "
       "< month(fecha_nac) * 100 + day(fecha_nac) THEN 1 ELSE 0 END AS INTEGER)")


def with_wait(src: str, as_of_src: str) -> str:
    return f"""SELECT x.*, coalesce(x.f_salida, m.mx) AS f_salida_o_maxima,
        CAST(coalesce(x.f_salida, m.mx) - x.f_entrada AS INTEGER) AS tiempo_espera, {AGE.replace('f_entrada', 'x.f_entrada').replace('fecha_nac', 'x.fecha_nac')} AS edad_sic
        FROM {src} x, (SELECT greatest(max(f_entrada), max(f_salida)) AS mx FROM {as_of_src}) m"""


def enrich(prefix: str, src: str, where: str = "TRUE", as_of: str = "filtered") -> list[tuple[str, str]]:
    """CTE steps of the V1 enrichment; the last step is named ``prefix``."""
    return [
        (f"{prefix}_j", joined(src)),
        (f"{prefix}_f", f"SELECT {V1_COLS} FROM {prefix}_j WHERE {where}"),
        (f"{prefix}_n", names(f"{prefix}_f", V1_COLS)),
        (prefix, with_wait(f"{prefix}_n", f"{prefix}_n" if as_of == "filtered" else src)),
    ]


def enrich_v2(prefix: str, src: str, site: str, service: int = 1) -> list[tuple[str, str]]:
    where = f"tipo_prest IN ({service}) AND estab_dest IN ('{site}') AND {KEEP_NULL_NOT_DENTAL}"
    steps = enrich(prefix + "_v1", src, where, as_of="input")
    return steps + [(prefix, f"SELECT {V2_COLS}, desc_esp, causal, f_salida_o_maxima, tiempo_espera, edad_sic "
                             f"FROM {prefix}_v1")]


def exits_cne() -> list[tuple[str, str]]:
    return [
        ("ex_j", joined("closed_list")),
        ("ex_f", f"SELECT {V3_COLS} FROM ex_j WHERE tipo_prest = 1 AND {KEEP_NULL_NOT_DENTAL}"),
        ("exits_cne", names("ex_f", V3_COLS)),
    ]


LE_CNE = enrich("le_cne", "open_list", "tipo_prest IN (1) AND f_salida IS NULL")

REASON_COLS = ("count(*) FILTER (WHERE causal = 'Atención realizada') AS atencion_realizada, "
               "count(*) FILTER (WHERE causal = 'No pertinencia') AS no_pertinencia, "
               "count(*) FILTER (WHERE causal = 'Otra causal') AS otra_causal, count(*) AS total_egresos")


def np_rate(years, min_total=3) -> list[tuple[str, str]]:
    lo, hi = min(years), max(years) + 1
    return exits_cne() + [(
        "np_rates",
        f"""SELECT *, round_even(no_pertinencia / total_egresos, 2) AS porc_np_total FROM (
            SELECT abrev_destino, desc_esp, CAST(year(f_salida) AS INTEGER) AS anio, {REASON_COLS}
            FROM exits_cne WHERE f_salida >= DATE '{lo}-01-01' AND f_salida < DATE '{hi}-01-01'
              AND year(f_salida) IN ({lst(years)})
            GROUP BY abrev_destino, desc_esp, CAST(year(f_salida) AS INTEGER)) w WHERE total_egresos >= {min_total}""")]


NP_RATES = np_rate((1997, 1998, 1999))

TOP = exits_cne() + [
    ("top_counts", """SELECT desc_esp, sospecha_diag, count(*) AS n FROM exits_cne
        WHERE c_salida = 'N' AND f_salida > DATE '1997-12-31' AND f_salida < DATE '1999-01-01'
          AND desc_esp IN ('Specialty 01', 'Specialty 02', 'Specialty 03', 'Specialty 04', 'Specialty 05')
        GROUP BY desc_esp, sospecha_diag"""),
    ("top_diag", """SELECT desc_esp, sospecha_diag, n FROM (SELECT *, row_number() OVER (PARTITION BY desc_esp
        ORDER BY n DESC, sospecha_diag ASC NULLS LAST) AS rn FROM top_counts) t WHERE rn <= 3"""),
]

SECTION_A = """SELECT mes, ano, id_establecimiento, codigo_prestacion, id_region, id_comuna, col01 AS total_consultas,
    col19 AS total_beneficiarios, col20 AS sexo_hombres, col21 AS sexo_mujeres, col22 AS consultas_menores15,
    col26 AS consultas_mayores, sp.codigosigte
    FROM production_raw pr LEFT JOIN specs sp ON pr.codigo_prestacion = sp.id_esp_seccion_a
    WHERE id_servicio = 13 AND codigo_prestacion IN ({codes}) AND id_establecimiento IN ({sites})""".format(
    codes=lst(f"07{i:06d}" for i in range(1, 26)), sites=lst(str(i) for i in range(20)))
SECTION_A1 = """SELECT mes, id_servicio, ano, id_establecimiento, codigo_prestacion, id_region, id_comuna,
    col01 AS pertinentes, col02 AS pertinentes_aps, col09 AS pertinentes_box, col10 AS pertinentes_box_aps,
    col13 AS cr_inicial, col16 AS cr_alta_menor15, col17 AS cr_alta_mayor15, col20 AS nsp_nuevas,
    col21 AS nsp_controles, sp.codigosigte
    FROM production_raw pr LEFT JOIN specs sp ON pr.codigo_prestacion = sp.id_esp_seccion_b
    WHERE id_servicio = 13 AND codigo_prestacion IN ({codes}) AND id_establecimiento IN ({sites})""".format(
    codes=lst(f"09{i:06d}" for i in range(1, 26)), sites=lst(str(i) for i in range(20)))
PRODUCTION = [
    ("sec_a", SECTION_A), ("sec_a1", SECTION_A1),
    ("production", """SELECT a.mes, a.ano, CAST(a.id_establecimiento AS VARCHAR) AS id_establecimiento,
        a.codigo_prestacion AS codigo_prestacion_x, a.id_region, a.id_comuna, a.total_consultas, a.total_beneficiarios,
        a.sexo_hombres, a.sexo_mujeres, a.consultas_menores15, a.consultas_mayores, a.codigosigte, b.id_servicio,
        b.codigo_prestacion AS codigo_prestacion_y, b.pertinentes, b.pertinentes_aps, b.pertinentes_box,
        b.pertinentes_box_aps, b.cr_inicial, b.cr_alta_menor15, b.cr_alta_mayor15, b.nsp_nuevas, b.nsp_controles
        FROM sec_a a LEFT JOIN sec_a1 b ON a.id_establecimiento IS NOT DISTINCT FROM b.id_establecimiento
         AND a.codigosigte IS NOT DISTINCT FROM b.codigosigte AND a.mes IS NOT DISTINCT FROM b.mes
         AND a.ano IS NOT DISTINCT FROM b.ano AND a.id_region IS NOT DISTINCT FROM b.id_region
         AND a.id_comuna IS NOT DISTINCT FROM b.id_comuna"""),
]


def strict_sum(x: str, bigint: bool = False) -> str:
    s = f"sum({x})"
    if bigint:
        s = f"CAST({s} AS BIGINT)"
    return f"CASE WHEN count({x}) = count(*) THEN {s} END"


PLAN_YEARLY = [("plan_yearly", f"""SELECT id_deis, id_especialidad, id_actividad,
    {strict_sum('TRY_CAST(produccion_1_sem AS DOUBLE)')} AS produccion_1_sem,
    {strict_sum('TRY_CAST(produccion_2_sem AS DOUBLE)')} AS produccion_2_sem,
    {strict_sum('TRY_CAST(produccion_1_sem AS DOUBLE)')} + {strict_sum('TRY_CAST(produccion_2_sem AS DOUBLE)')} AS produccion_anual,
    {strict_sum('horas_asignadas')} AS horas
    FROM programming WHERE id_actividad IN ('1', '2') GROUP BY id_deis, id_especialidad, id_actividad""")]
PLAN_MONTHLY = PLAN_YEARLY + [("plan_monthly", """SELECT id_deis, '0' || id_especialidad AS id_especialidad, id_actividad,
    produccion_1_sem, produccion_2_sem, produccion_anual, horas,
    round_even((produccion_1_sem + produccion_2_sem) / 12, 0) AS prog_mensual FROM plan_yearly""")]
HOURS = [("hours", f"""SELECT id_deis, id_especialidad, id_actividad,
    {strict_sum('total_horas_semanales_contratadas_run')} AS horas_totales
    FROM programming GROUP BY id_deis, id_especialidad, id_actividad""")]

NAMED = lst(f"S{i}" for i in range(0, 25, 2))
DEMAND = LE_CNE + [("demand", """SELECT CAST(year(f_entrada) AS INTEGER) AS ano, CAST(month(f_entrada) AS INTEGER) AS mes,
    estab_dest, presta_min, count(*) AS demanda_mensual FROM le_cne GROUP BY 1, 2, 3, 4""")]
EXITS_M = exits_cne() + [("exits_m", """SELECT * FROM (SELECT CAST(year(f_salida) AS INTEGER) AS ano,
    CAST(month(f_salida) AS INTEGER) AS mes, estab_dest, presta_min, count(*) AS egresos_mensual FROM exits_cne
    GROUP BY 1, 2, 3, 4) t WHERE ano > 1998 AND ano < 2000""")]


def named_sites(src: str) -> str:
    return f"""SELECT t.estab_dest, t.presta_min, t.n, e.abreviacion, sp.desc_esp FROM {src} t
        LEFT JOIN estab e ON t.estab_dest = e.codigo_vigente LEFT JOIN specs sp ON t.presta_min = sp.codigosigte
        WHERE e.abreviacion IN ({NAMED}) AND sp.desc_esp IS NOT NULL"""


YEARLY_EXITS = EXITS_M + [
    ("yex_s", f"SELECT estab_dest, presta_min, {strict_sum('egresos_mensual', True)} AS n FROM exits_m GROUP BY 1, 2"),
    ("yearly_exits", named_sites("yex_s"))]
BACKLOG = DEMAND + [
    ("bl_s", f"""SELECT estab_dest, presta_min, {strict_sum('demanda_mensual', True)} AS n FROM demand
        WHERE ano < 1999 GROUP BY 1, 2"""),
    ("backlog", named_sites("bl_s"))]
STARTING = BACKLOG + YEARLY_EXITS + [
    ("starting", """SELECT b.estab_dest, b.presta_min, b.n AS acum_le, b.abreviacion, b.desc_esp, y.n AS acum_egresos,
        b.n + y.n AS demanda_acumulada FROM backlog b LEFT JOIN yearly_exits y
        ON b.estab_dest IS NOT DISTINCT FROM y.estab_dest AND b.abreviacion IS NOT DISTINCT FROM y.abreviacion
        AND b.presta_min IS NOT DISTINCT FROM y.presta_min AND b.desc_esp IS NOT DISTINCT FROM y.desc_esp""")]

CUBE = PRODUCTION + LE_CNE + DEMAND[len(LE_CNE):] + PLAN_MONTHLY + exits_cne() + EXITS_M[len(exits_cne()):] + [
    ("cube_m", """SELECT p.mes, p.ano, p.id_establecimiento, ab.abreviacion, p.codigosigte, sp.desc_esp,
        p.codigo_prestacion_x, p.codigo_prestacion_y, d.demanda_mensual,
        x.egresos_mensual, p.consultas_menores15 + p.consultas_mayores AS produccion_cne, pm.prog_mensual,
        make_date(p.ano, p.mes, 1) AS fecha
        FROM production p LEFT JOIN specs sp ON p.codigosigte = sp.codigosigte
        LEFT JOIN demand d ON p.ano = d.ano AND p.mes = d.mes AND p.id_establecimiento = d.estab_dest
          AND p.codigosigte IS NOT DISTINCT FROM d.presta_min
        LEFT JOIN (SELECT id_deis, id_especialidad, prog_mensual FROM plan_monthly WHERE id_actividad = '1') pm
          ON p.id_establecimiento = pm.id_deis AND p.codigo_prestacion_x = pm.id_especialidad
        LEFT JOIN abbrev ab ON p.id_establecimiento = ab.codigo_vigente
        LEFT JOIN exits_m x ON p.ano = x.ano AND p.mes = x.mes AND p.id_establecimiento = x.estab_dest
          AND p.codigosigte IS NOT DISTINCT FROM x.presta_min
        WHERE p.ano = 1999""")]

SUBSET_A = "(SELECT id_esp_seccion_a FROM specialty_subset WHERE id_esp_seccion_a IS NOT NULL)"
SUMMARY = PRODUCTION + [("summary", f"""SELECT codigosigte, desc_esp, produccion_total, produccion_cne,
    round_even(produccion_cne / nullif(produccion_total, 0), 2) AS proporcion_cne,
    produccion_total - produccion_cne AS produccion_control, produccion_nsp_total, produccion_nsp_cne FROM (
    SELECT p.codigosigte, ss.desc_esp, {strict_sum('total_consultas')} AS produccion_total,
      {strict_sum('consultas_mayores + consultas_menores15')} AS produccion_cne,
      {strict_sum('nsp_nuevas + nsp_controles')} AS produccion_nsp_total, {strict_sum('nsp_nuevas')} AS produccion_nsp_cne
    FROM production p LEFT JOIN specialty_subset ss ON p.codigosigte = ss.codigosigte
    WHERE p.codigo_prestacion_x IN {SUBSET_A} AND p.id_establecimiento = '3'
    GROUP BY p.codigosigte, ss.desc_esp) t""")]
SUPPLY = SUMMARY + PLAN_YEARLY + HOURS + [("supply0", """SELECT s.*, pl.prog_cne_anual, y.id_especialidad,
      y.distribucion_ambulatoria, y.distribucion_nueva, y.rendimiento_nueva, h.id_deis, h.horas_totales
    FROM summary s
    LEFT JOIN (SELECT sp.codigosigte, p.produccion_1_sem + p.produccion_2_sem AS prog_cne_anual FROM plan_yearly p
               LEFT JOIN specs sp ON p.id_especialidad = sp.id_programacion
               WHERE p.id_deis = '3' AND p.id_actividad = '1'
                 AND p.id_especialidad IN (SELECT id_programacion FROM specialty_subset WHERE id_programacion IS NOT NULL)) pl
      ON s.codigosigte = pl.codigosigte
    LEFT JOIN (SELECT presta_min, id_especialidad, distribucion_ambulatoria, distribucion_nueva, rendimiento_nueva
               FROM yield_table) y ON s.codigosigte = y.presta_min
    LEFT JOIN (SELECT id_deis, id_especialidad, horas_totales FROM hours WHERE id_actividad = '1' AND id_deis = '3') h
      ON y.id_especialidad = h.id_especialidad"""),
    ("supply", """SELECT *, round_even((produccion_cne + produccion_nsp_cne) / nullif(produccion_cne_estandar, 0), 2)
        AS proporcion_real_estandar FROM (SELECT *, round_even(horas_totales * distribucion_ambulatoria * distribucion_nueva
        * rendimiento_nueva * 31.4::DOUBLE, 0) AS produccion_cne_estandar FROM supply0) t""")]

PERSON = "run, dv, rut_sdv, rut, rut_paciente, apellido_paterno"
COHORT = exits_cne() + LE_CNE + [
    ("reg_c", "SELECT * FROM registry WHERE comuna_establecimiento IN ('BUILDING', 'MACHINERY')"),
    ("cohort", f"""SELECT * EXCLUDE ({PERSON}, rut_paciente_sdv) FROM (SELECT e.*, r.* FROM exits_cne e
          JOIN reg_c r ON e.run = r.rut_paciente_sdv WHERE e.presta_min IN (SELECT codigosigte FROM specialty_subset)) a
        UNION ALL BY NAME
        SELECT * EXCLUDE ({PERSON}, rut_paciente_sdv) FROM (SELECT l.*, r.* FROM le_cne l JOIN reg_c r
          ON l.run = r.rut_paciente_sdv WHERE l.presta_min IN (SELECT codigosigte FROM specialty_subset)) b""")]


def gap_prod(name_join: str, subset: bool) -> str:
    sub = f"AND p.codigo_prestacion_x IN {SUBSET_A}" if subset else ""
    return f"""SELECT codigosigte, desc_esp, produccion_total, produccion_cne, produccion_nsp_total, produccion_nsp_cne,
        round_even(CASE WHEN produccion_total <> 0 THEN produccion_cne / produccion_total END, 2) AS proporcion_cne,
        produccion_total - produccion_cne AS produccion_control,
        round_even(CASE WHEN produccion_nsp_total <> 0 THEN produccion_nsp_cne / produccion_nsp_total END, 2) AS proporcion_nsp_cne
        FROM (SELECT p.codigosigte, nm.desc_esp, {strict_sum('total_consultas')} AS produccion_total,
          coalesce(sum(consultas_menores15), 0) + coalesce(sum(consultas_mayores), 0) AS produccion_cne,
          coalesce(sum(nsp_nuevas), 0) + coalesce(sum(nsp_controles), 0) AS produccion_nsp_total,
          coalesce(sum(nsp_nuevas), 0) AS produccion_nsp_cne
          FROM production p {name_join} WHERE p.id_establecimiento = '3' {sub}
          GROUP BY p.codigosigte, nm.desc_esp) t"""


def gap_steps(initial_where: str, current_where: str, src: str, prod: str, year: int = 1999) -> list[tuple[str, str]]:
    return [
        ("g_ini", f"SELECT presta_min, desc_esp, count(*) AS demanda_inicial FROM {src} WHERE {initial_where} GROUP BY 1, 2"),
        ("g_cur", f"SELECT presta_min, desc_esp, count(*) AS n FROM {src} WHERE {current_where} GROUP BY 1, 2"),
        ("g_prod", prod),
        ("gap", f"""SELECT i.presta_min, i.desc_esp, i.demanda_inicial, c.n AS demanda_{year},
            i.demanda_inicial + c.n AS demanda_total, p.produccion_total, p.produccion_cne, p.produccion_nsp_total,
            p.produccion_nsp_cne, p.proporcion_cne, p.produccion_control, p.proporcion_nsp_cne,
            p.produccion_cne + p.produccion_nsp_cne AS produccion_total_cne_{year},
            round_even((i.demanda_inicial + c.n) / nullif(p.produccion_cne + p.produccion_nsp_cne, 0), 2) AS brecha
            FROM g_ini i LEFT JOIN g_cur c ON i.presta_min IS NOT DISTINCT FROM c.presta_min
              AND i.desc_esp IS NOT DISTINCT FROM c.desc_esp
            LEFT JOIN g_prod p ON i.presta_min IS NOT DISTINCT FROM p.codigosigte
              AND i.desc_esp IS NOT DISTINCT FROM p.desc_esp"""),
    ]


COHORT_GAP = COHORT + PRODUCTION + gap_steps(
    "f_entrada < DATE '1999-01-01'", "f_entrada > DATE '1998-12-31'", "cohort",
    gap_prod("LEFT JOIN specialty_subset nm ON p.codigosigte = nm.codigosigte", True))
HOSP = (enrich("h_open", "open_list") + enrich("h_closed", "closed_list", "tipo_prest IN (1)") + [
    ("h_both", """SELECT * FROM (SELECT * FROM h_open UNION ALL SELECT * FROM h_closed) t
        WHERE tipo_prest = 1 AND estab_dest = '3' AND NOT coalesce(regexp_matches(presta_min, '09-'), false)""")])
def hospital_gap_steps(year: int) -> list[tuple[str, str]]:
    return HOSP + PRODUCTION + gap_steps(
        f"f_entrada < DATE '{year}-01-01' AND (f_salida >= DATE '{year}-01-01' OR f_salida IS NULL)",
        f"f_entrada >= DATE '{year}-01-01'", "h_both",
        gap_prod("LEFT JOIN specs nm ON p.codigo_prestacion_x = nm.id_esp_seccion_a", False), year)


HOSPITAL_GAP = hospital_gap_steps(1999)
FULL_GAP_YEAR = 1996

V2_OPEN = enrich_v2("v2", "open_list", "3")
V2_CHILD = enrich_v2("v7", "open_list", "7")
MISROUTED = V2_CHILD + [
    ("codes", """SELECT DISTINCT codigo_cie_10_diagnostico_opcional AS code FROM referral_map
        WHERE descripcion_especialidad_demandada = 'Specialty 04' AND codigo_deis_establecimiento_destino = '13-10'
          AND codigo_cie_10_diagnostico_opcional <> ''"""),
]

SPLIT_CODE = "CASE WHEN regexp_matches(sospecha_diag, '\\s*-\\s*') THEN regexp_extract(sospecha_diag, '^(.*?)\\s*-\\s*(.*)$', 1) ELSE sospecha_diag END"
SPLIT_LABEL = "CASE WHEN regexp_matches(sospecha_diag, '\\s*-\\s*') THEN regexp_extract(sospecha_diag, '^(.*?)\\s*-\\s*(.*)$', 2) END"

AGE_BAND = """CASE WHEN edad_sic >= 0 AND edad_sic <= 5 THEN 'Menor de 5' WHEN edad_sic > 5 AND edad_sic <= 14 THEN '6 a 14'
    WHEN edad_sic > 14 AND edad_sic < 18 THEN '15 a 17' WHEN edad_sic > 18 THEN '18 o más' END"""

ORACLE_SQL: dict[str, str] = {
    "establishments": q(final="SELECT * FROM estab"),
    "registry_clean": q(final="SELECT * FROM registry"),
    "inline_dim": q(final="""SELECT c.tipo_prest, c.n, st.descripcion FROM (SELECT tipo_prest, count(*) AS n FROM open_list
        GROUP BY tipo_prest) c LEFT JOIN service_types st ON c.tipo_prest = st.n"""),
    "referrals_enriched": q(*enrich("e", "open_list", f"""tipo_prest IN (1) AND estab_orig IN ({lst(str(i) for i in range(0, 25, 2))})
        AND f_entrada >= DATE '1996-01-01' AND f_entrada <= DATE '2000-12-31'"""), final="SELECT * FROM e"),
    "open_closed_union": q(*enrich("o", "open_list", "f_salida IS NULL"),
                           *enrich("c", "closed_list"),
                           final="SELECT * FROM o UNION ALL SELECT * FROM c"),
    "referrals_v2": q(*V2_OPEN, final="SELECT * FROM v2"),
    "exits_enriched": q(*exits_cne(), final="SELECT * FROM exits_cne"),
    "specialty_extract": q(*LE_CNE, final="""SELECT * FROM le_cne WHERE presta_min IN ('07-002', '07-003', '07-004')
        AND nombre_comuna IN ('AMERICA', 'ASIA', 'EUROPE') AND nivel_de_atencion_destino IN ('Terciario', 'Secundario')"""),
    "under15_open": q(*V2_CHILD, final="SELECT * FROM v7 WHERE edad_sic < 15 AND presta_min = '07-004'"),
    "under15_closed": q(("closed_1", "SELECT * FROM closed_list WHERE tipo_prest = 1"), *enrich_v2("v7c", "closed_1", "7"),
                        final="SELECT * FROM v7c WHERE edad_sic < 15 AND presta_min = '07-004'"),
    "exits_export": q(*enrich("x", "closed_list", """tipo_prest IN (1) AND estab_orig IN ('7')
        AND f_salida >= DATE '1997-01-01' AND f_salida <= DATE '1999-12-31'"""), final="SELECT * FROM x"),
    "np_rate": q(*np_rate((1998,)), final="SELECT * FROM np_rates"),
    "np_rate_all_years": q(*NP_RATES, final="SELECT * FROM np_rates"),
    "np_rate_ordered": q(*NP_RATES, final="""SELECT r.*, o.orden_esp FROM np_rates r LEFT JOIN (
        SELECT abrev_destino, desc_esp, CAST(row_number() OVER (PARTITION BY abrev_destino
          ORDER BY porc_np_total DESC NULLS LAST, desc_esp ASC NULLS LAST) AS INTEGER) AS orden_esp
        FROM np_rates WHERE anio = 1999) o ON r.abrev_destino IS NOT DISTINCT FROM o.abrev_destino
        AND r.desc_esp IS NOT DISTINCT FROM o.desc_esp"""),
    "top_diagnoses": q(*TOP, final="SELECT * FROM top_diag"),
    "ranked_diagnoses": q(*TOP, final="""SELECT desc_esp, sospecha_diag, n, CAST(row_number() OVER (PARTITION BY desc_esp
        ORDER BY n ASC, sospecha_diag ASC NULLS LAST) AS INTEGER) AS diagnostico_orden FROM (SELECT * FROM (SELECT *,
        row_number() OVER (PARTITION BY desc_esp ORDER BY n DESC, sospecha_diag ASC NULLS LAST) AS rn FROM top_counts) t
        WHERE rn <= 3) u"""),
    "age_bands": q(*exits_cne(), final=f"""SELECT grupo_edad, desc_esp, count(*) AS n FROM (SELECT *, {AGE_BAND} AS grupo_edad
        FROM (SELECT *, {AGE} AS edad_sic FROM exits_cne) a) b
        WHERE regexp_matches(sospecha_diag, '(?i)ring') AND c_salida = 'N' AND edad_sic > 5
          AND f_salida >= DATE '1997-05-08' GROUP BY grupo_edad, desc_esp"""),
    "rejected_by_diagnosis": q(*exits_cne(), final="""SELECT sospecha_diag, count(*) AS n FROM exits_cne WHERE c_salida = 'N'
        AND f_salida >= DATE '1998-01-01' AND f_salida <= DATE '1998-12-31' AND desc_esp = 'Specialty 07'
        GROUP BY sospecha_diag"""),
    "exits_by_reason_group": q(*exits_cne(), final="""SELECT * FROM (SELECT CAST(year(f_salida) AS INTEGER) AS year, estab_orig,
        CASE WHEN c_salida = 'A' THEN 'Atendido' WHEN c_salida = 'N' THEN 'No Pertinente' ELSE 'Otra' END AS causal_grupo,
        count(*) AS n FROM exits_cne WHERE presta_min = '07-007' GROUP BY 1, 2, 3) t WHERE year = 1998"""),
    "yearly_totals_long": q(*NP_RATES, final="""UNPIVOT (SELECT desc_esp, anio, CAST(coalesce(sum(total_egresos), 0) AS BIGINT) AS total_egresos,
        CAST(coalesce(sum(atencion_realizada), 0) AS BIGINT) AS total_ar FROM np_rates GROUP BY desc_esp, anio)
        ON total_egresos, total_ar INTO NAME tipo VALUE valor"""),
    "np_share_mean": q(*NP_RATES, final="SELECT desc_esp, anio, avg(round_even(porc_np_total * 100, 0)) / 100 AS pct_np FROM np_rates GROUP BY 1, 2"),
    "programming_union": q(final="SELECT * FROM programming"),
    "programming_yearly": q(*PLAN_YEARLY, final="SELECT * FROM plan_yearly"),
    "programming_hours": q(*HOURS, final="SELECT * FROM hours"),
    "programming_monthly": q(*PLAN_MONTHLY, final="SELECT * FROM plan_monthly"),
    "production_section_a": q(("sec_a", SECTION_A), final="SELECT * FROM sec_a"),
    "production_section_a1": q(("sec_a1", SECTION_A1), final="SELECT * FROM sec_a1"),
    "production_sections_null_safe": q(*PRODUCTION, final="SELECT * FROM production"),
    "production_grain_report": q(*PRODUCTION, final="""SELECT id_establecimiento, codigosigte, mes, ano, count(*) AS filas
        FROM production GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"""),
    "production_summary": q(*SUMMARY, final="SELECT * FROM summary"),
    "monthly_demand": q(*DEMAND, final="SELECT * FROM demand"),
    "monthly_exits": q(*EXITS_M, final="SELECT * FROM exits_m"),
    "yearly_exits_named_sites": q(*YEARLY_EXITS, final="SELECT * FROM yearly_exits"),
    "backlog_before_year": q(*BACKLOG, final="SELECT * FROM backlog"),
    "starting_demand": q(*STARTING, final="SELECT * FROM starting"),
    "monthly_cube": q(*CUBE, final="SELECT * FROM cube_m"),
    "running_backlog": q(*CUBE, ("bstart", """SELECT ab.abreviacion, t.presta_min AS codigosigte, t.n FROM (
            SELECT estab_dest, presta_min, CASE WHEN count(demanda_mensual) = count(*) THEN CAST(sum(demanda_mensual) AS BIGINT) END AS n
            FROM demand WHERE ano < 1999 GROUP BY 1, 2) t LEFT JOIN abbrev ab ON t.estab_dest = ab.codigo_vigente"""),
        ("bbegin", "SELECT abreviacion, codigosigte, CAST(coalesce(sum(n), 0) AS BIGINT) AS valor_inicial FROM bstart GROUP BY 1, 2"),
        final="""SELECT *, valor_inicial + CASE WHEN count(demanda_mensual - egresos_mensual) OVER w = count(*) OVER w
            THEN CAST(sum(demanda_mensual - egresos_mensual) OVER w AS BIGINT) END AS demanda_acumulada
            FROM (SELECT c.*, CAST(coalesce(b.valor_inicial, 0) AS BIGINT) AS valor_inicial FROM cube_m c LEFT JOIN bbegin b
              ON c.abreviacion = b.abreviacion AND c.codigosigte = b.codigosigte WHERE c.codigosigte IS NOT NULL) t
            WINDOW w AS (PARTITION BY id_establecimiento, codigosigte ORDER BY fecha, codigo_prestacion_x NULLS FIRST, codigo_prestacion_y NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "dashboard_backlog": q(*CUBE, *STARTING, ("dbegin", """SELECT abreviacion, desc_esp,
            CAST(coalesce(sum(demanda_acumulada), 0) AS BIGINT) AS valor_inicial FROM starting GROUP BY 1, 2"""),
        final="""SELECT *, valor_inicial + CASE WHEN count(demanda_mensual - egresos_mensual) OVER w = count(*) OVER w
            THEN CAST(sum(demanda_mensual - egresos_mensual) OVER w AS BIGINT) END AS demanda_acumulada
            FROM (SELECT c.*, CAST(coalesce(b.valor_inicial, 0) AS BIGINT) AS valor_inicial FROM cube_m c LEFT JOIN dbegin b
              ON c.abreviacion = b.abreviacion AND c.desc_esp = b.desc_esp WHERE c.codigosigte IS NOT NULL) t
            WINDOW w AS (PARTITION BY id_establecimiento, codigosigte ORDER BY fecha, codigo_prestacion_x NULLS FIRST, codigo_prestacion_y NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "choices_sites": q(*STARTING, final="SELECT DISTINCT abreviacion FROM starting"),
    "choices_specialties": q(*STARTING, final="SELECT DISTINCT desc_esp FROM starting"),
    "supply_vs_standard": q(*SUPPLY, final="SELECT * FROM supply"),
    "supply_mean_ratio": q(*SUPPLY, final="SELECT avg(round_even(proporcion_real_estandar * 100, 0)) / 100 AS promedio FROM supply"),
    "enrolled_cohort": q(*COHORT, final="SELECT * FROM cohort"),
    "cohort_gap": q(*COHORT_GAP, final="SELECT * FROM gap"),
    "hospital_gap": q(*HOSPITAL_GAP, final="SELECT * FROM gap"),
    "hospital_gap_full": q(*hospital_gap_steps(FULL_GAP_YEAR), final=f"""SELECT
        CASE WHEN i.demanda_inicial IS NOT NULL THEN i.presta_min ELSE c.presta_min END AS presta_min,
        CASE WHEN i.demanda_inicial IS NOT NULL THEN i.desc_esp ELSE c.desc_esp END AS desc_esp,
        coalesce(i.demanda_inicial, 0) AS demanda_inicial, coalesce(c.n, 0) AS demanda_{FULL_GAP_YEAR},
        coalesce(i.demanda_inicial, 0) + coalesce(c.n, 0) AS demanda_total, p.produccion_total, p.produccion_cne,
        p.produccion_nsp_total, p.produccion_nsp_cne, p.proporcion_cne, p.produccion_control, p.proporcion_nsp_cne,
        p.produccion_cne + p.produccion_nsp_cne AS produccion_total_cne_{FULL_GAP_YEAR},
        round_even((coalesce(i.demanda_inicial, 0) + coalesce(c.n, 0)) / nullif(p.produccion_cne + p.produccion_nsp_cne, 0), 2) AS brecha
        FROM g_ini i FULL JOIN g_cur c ON i.presta_min IS NOT DISTINCT FROM c.presta_min AND i.desc_esp IS NOT DISTINCT FROM c.desc_esp
        LEFT JOIN g_prod p ON (CASE WHEN i.demanda_inicial IS NOT NULL THEN i.presta_min ELSE c.presta_min END) IS NOT DISTINCT FROM p.codigosigte
          AND (CASE WHEN i.demanda_inicial IS NOT NULL THEN i.desc_esp ELSE c.desc_esp END) IS NOT DISTINCT FROM p.desc_esp"""),
    "still_waiting_at": q(*HOSP[:-1], final="""SELECT estab_dest, presta_min, count(*) AS en_espera FROM (
        SELECT * FROM h_open UNION ALL SELECT * FROM h_closed) t WHERE tipo_prest = 1 AND f_entrada < DATE '1999-01-01'
        AND (f_salida >= DATE '1999-01-01' OR f_salida IS NULL) GROUP BY estab_dest, presta_min"""),
    "gap_current": q(*HOSPITAL_GAP, final="SELECT * FROM gap WHERE produccion_cne IS NOT NULL"),
    "gap_new_projected": q(*HOSPITAL_GAP, final="""SELECT g.presta_min, g.desc_esp, g.demanda_inicial, g.demanda_1999, g.demanda_total,
        p.m03, p.m06, p.m07, p.m08, p.m09, p.m10, p.total, p.devueltos, p.abiertos
        FROM gap g LEFT JOIN projection p ON g.presta_min = p.x1 WHERE g.produccion_cne IS NULL"""),
    "gap_projected": q(*HOSPITAL_GAP, final="""SELECT g.*, p.* EXCLUDE (x1, especialidad)
        FROM gap g LEFT JOIN projection p ON g.presta_min = p.x1"""),
    "gap_total_new_visits": q(*HOSPITAL_GAP, final="""SELECT coalesce(sum(produccion_cne), 0) AS total_cne FROM gap
        WHERE produccion_cne IS NOT NULL"""),
    "wait_mean_median": q(final="""SELECT especialidad_grupo, count(*) AS n, CASE WHEN count(espera) = count(*) THEN round_even(avg(espera), 0) END AS mean,
        CASE WHEN count(espera) = count(*) THEN round_even(median(espera), 0) END AS median FROM (SELECT especialidad_grupo,
        CAST(DATE '2002-01-01' - f_entrada AS INTEGER) AS espera FROM sigte WHERE tipo_prest = 4 AND tipo_error IS NULL
        AND estab_dest = '3' AND f_salida IS NULL) t GROUP BY especialidad_grupo"""),
    "misrouted_by_pattern": q(*MISROUTED, final="""SELECT v7.*, 'si' AS corresponde_destino FROM v7
        WHERE v7.edad_sic < 15 AND v7.desc_esp = 'Specialty 04'
        AND EXISTS (SELECT 1 FROM codes WHERE regexp_matches(v7.sospecha_diag, '(?i)' || codes.code)) AND v7.f_entrada >= DATE '1996-04-01'"""),
    "misrouted_by_regex": q(*MISROUTED, final="""SELECT v7.*, 'si' AS corresponde_destino FROM v7
        WHERE v7.edad_sic < 15 AND v7.desc_esp = 'Specialty 04' AND v7.f_entrada >= DATE '1996-04-01'
        AND regexp_matches(v7.sospecha_diag, (SELECT '(?i)' || string_agg(code, '|') FROM codes))"""),
    "portfolio_crosstab": q(*enrich("pc", "open_list", "tipo_prest IN (1)"), final=f"""SELECT destino, cartera, count(*) AS n FROM (
        SELECT CASE WHEN estab_dest = '7' THEN 'si' ELSE 'no' END AS destino,
          CASE WHEN ({SPLIT_CODE}) IN (SELECT codigo FROM portfolio) THEN 'si' ELSE 'no' END AS cartera
        FROM pc WHERE estab_orig IN (SELECT x2 FROM network_sites WHERE minired = 'Red AMERICA') AND estab_dest <> '11'
          AND nivel_de_atencion_origen = 'Primario' AND nivel_de_atencion_destino IN ('Secundario', 'Terciario')) t
        GROUP BY destino, cartera"""),
    "diagnosis_split": q(*LE_CNE, final=f"""SELECT sigte_id, sospecha_diag, {SPLIT_CODE} AS codigo_cie10,
        {SPLIT_LABEL} AS glosa_cie10 FROM le_cne"""),
    "registry_lookup": q(*exits_cne(), final="""SELECT * FROM registry r WHERE r.rut IN (SELECT run || dv FROM exits_cne
        WHERE c_salida = 'N' AND year(f_salida) = 1998) OR r.rut_paciente IN (SELECT run || dv FROM exits_cne
        WHERE c_salida = 'N' AND year(f_salida) = 1998)"""),
    "exits_of_site": q(("ex_j", joined("closed_list")),
        ("ex_f", f"SELECT {V3_COLS} FROM ex_j WHERE tipo_prest = 1 AND estab_dest = '7' AND {KEEP_NULL_NOT_DENTAL}"),
        ("exits_site", names("ex_f", V3_COLS)), final="SELECT * FROM exits_site"),
    "np_rate_from_dimension": q(*exits_cne(), final="""SELECT *, round_even(no_pertinencia / total_egresos, 2) AS porc_np_total FROM (
        SELECT abrev_destino, desc_esp, CAST(year(f_salida) AS INTEGER) AS anio,
          count(*) FILTER (WHERE causal = 'Atención realizada') AS atencion_realizada,
          count(*) FILTER (WHERE causal = 'No pertinencia') AS no_pertinencia,
          count(*) FILTER (WHERE causal IS NULL OR causal = 'Otra causal') AS na, count(*) AS total_egresos
        FROM exits_cne WHERE year(f_salida) IN (1997, 1998, 1999) GROUP BY 1, 2, 3) w WHERE total_egresos >= 3"""),
    "programming_by_activity": q(final="""SELECT id_actividad, count(DISTINCT id_deis) AS establecimientos,
        count(DISTINCT id_especialidad) AS especialidades,
        CASE WHEN count(horas) = count(*) THEN sum(horas) END AS horas,
        CASE WHEN count(anual) = count(*) THEN sum(anual) END AS produccion_anual, 'Actividad ' || id_actividad AS actividad
        FROM (SELECT id_deis, id_especialidad, id_actividad,
            CASE WHEN count(horas_asignadas) = count(*) THEN sum(horas_asignadas) END AS horas,
            CASE WHEN count(TRY_CAST(produccion_1_sem AS DOUBLE)) = count(*) THEN sum(TRY_CAST(produccion_1_sem AS DOUBLE)) END
            + CASE WHEN count(TRY_CAST(produccion_2_sem AS DOUBLE)) = count(*) THEN sum(TRY_CAST(produccion_2_sem AS DOUBLE)) END AS anual
            FROM programming WHERE id_actividad IN ('1', '2') GROUP BY 1, 2, 3) y GROUP BY id_actividad"""),
    "snapshot_backlog": q(final="""SELECT d.fecha_corte, estab_dest, count(*) AS en_espera, count(DISTINCT run) AS personas,
        CAST(max(d.fecha_corte - f_entrada) AS INTEGER) AS espera_maxima
        FROM (SELECT * FROM open_list UNION ALL SELECT * FROM closed_list) l
        JOIN (VALUES (DATE '1998-01-01'), (DATE '1999-01-01')) d(fecha_corte)
          ON l.f_entrada < d.fecha_corte AND (l.f_salida IS NULL OR l.f_salida >= d.fecha_corte)
        WHERE tipo_prest = 1 GROUP BY 1, 2"""),
    "snapshot_flow": q(("each", """SELECT sigte_id,
            max(place) FILTER (WHERE f_entrada < DATE '1997-01-01' AND (f_salida IS NULL OR f_salida >= DATE '1997-01-01')) AS a,
            max(place) FILTER (WHERE f_entrada < DATE '1999-01-01' AND (f_salida IS NULL OR f_salida >= DATE '1999-01-01')) AS b
            FROM (SELECT *, estab_dest || chr(1) || coalesce(presta_min, '') AS place
              FROM (SELECT * FROM open_list UNION ALL SELECT * FROM closed_list) l WHERE tipo_prest = 1) t GROUP BY sigte_id"""),
        ("seen", """SELECT a AS place, CASE WHEN b IS NULL THEN 'salen' WHEN a = b THEN 'siguen' ELSE 'movidas_desde' END AS k FROM each WHERE a IS NOT NULL
            UNION ALL SELECT b, CASE WHEN a IS NULL THEN 'entran' ELSE 'movidas_hacia' END FROM each WHERE b IS NOT NULL AND (a IS NULL OR a <> b)"""),
        final="""SELECT split_part(place, chr(1), 1) AS estab_dest, nullif(split_part(place, chr(1), 2), '') AS presta_min,
        count(*) FILTER (WHERE k = 'siguen') AS siguen, count(*) FILTER (WHERE k = 'salen') AS salen, count(*) FILTER (WHERE k = 'entran') AS entran,
        count(*) FILTER (WHERE k = 'movidas_desde') AS movidas_desde, count(*) FILTER (WHERE k = 'movidas_hacia') AS movidas_hacia
        FROM seen GROUP BY place"""),
    "wait_mean_median_datetimes": q(final="""SELECT especialidad_grupo, count(*) AS n, CASE WHEN count(espera) = count(*) THEN round_even(avg(espera), 0) END AS mean,
        CASE WHEN count(espera) = count(*) THEN round_even(median(espera), 0) END AS median FROM (SELECT presta_est AS especialidad_grupo,
        round_even(epoch(TIMESTAMP '2002-01-01 00:00:00' - (f_entrada + to_hours(CAST(split_part(sigte_id, '-', 1) AS BIGINT) % 24)
          + to_minutes(7 * CAST(split_part(sigte_id, '-', 2) AS BIGINT)))) / 86400, 0) AS espera
        FROM ref_base WHERE tipo_prest = 4 AND estab_dest = '3' AND f_salida IS NULL) t GROUP BY especialidad_grupo"""),
}
ORACLE_SQL["enrolled_cohort_bucketed"] = ORACLE_SQL["enrolled_cohort"]
ORACLE_SQL["dashboard_from_published"] = ORACLE_SQL["dashboard_backlog"]
ORACLE_SQL["choices_from_published"] = q(*STARTING, final="""SELECT DISTINCT 'abreviacion' AS columna, abreviacion AS valor FROM starting
    UNION ALL SELECT DISTINCT 'desc_esp', desc_esp FROM starting""")
