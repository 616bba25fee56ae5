"""Test-table views in SQL: the domain tables derived from the driver tables."""

BRAND = "([1, 2, 3, 4, 7, 19, 20, 21])[CAST(substr(p.p_brand, 7) AS INTEGER) % 8 + 1]"



def spec_code(b: str) -> str:
    return f"(CASE WHEN {b} >= 21 THEN '09-' ELSE '07-' END || lpad(CAST({b} AS VARCHAR), 3, '0'))"


def spec_name(b: str) -> str:
    return f"('Specialty ' || lpad(CAST({b} AS VARCHAR), 2, '0'))"


BASE_VIEWS: list[tuple[str, str]] = [
    ("sites", "SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name FROM nation n "
              "JOIN region r ON n.n_regionkey = r.r_regionkey"),
    ("estab_raw", """SELECT CAST(n_nationkey AS VARCHAR) AS codigo_vigente, CAST(n_nationkey + 100 AS VARCHAR) AS codigo_antiguo,
        n_name AS nombre_oficial, CAST(n_regionkey AS VARCHAR) AS codigo_comuna, r_name AS nombre_comuna,
        CASE WHEN n_nationkey % 3 = 0 THEN 'Primario' WHEN n_nationkey % 3 = 1 THEN 'Secundario' ELSE 'Terciario' END AS nivel_de_atencion,
        CASE WHEN n_regionkey = 4 THEN 'North network' ELSE 'South network' END AS red,
        CASE WHEN n_nationkey % 2 = 0 THEN 'Alta' ELSE 'Baja' END AS nivel_de_complejidad FROM sites"""),
    ("abbrev", "SELECT CAST(n_nationkey AS VARCHAR) AS codigo_vigente, 'S' || CAST(n_nationkey AS VARCHAR) AS abreviacion FROM nation"),
    ("estab", """SELECT e.codigo_vigente, e.codigo_antiguo, e.nombre_oficial, e.codigo_comuna, e.nombre_comuna, e.nivel_de_atencion,
        e.red AS nombre_dependencia_jerarquica_seremi_servicio_de_salud, e.nivel_de_complejidad, a.abreviacion
        FROM estab_raw e LEFT JOIN abbrev a ON e.codigo_vigente = a.codigo_vigente WHERE e.red = 'South network'"""),
    ("brands", f"SELECT DISTINCT {BRAND} AS b FROM part p"),
    ("specs", f"""SELECT {spec_code('b')} AS codigosigte, {spec_name('b')} AS desc_esp,
        CASE WHEN b NOT IN (19, 20) THEN '07' || lpad(CAST(b AS VARCHAR), 6, '0') END AS id_esp_seccion_a,
        CASE WHEN b >= 2 THEN '09' || lpad(CAST(b AS VARCHAR), 6, '0') END AS id_esp_seccion_b,
        '7' || lpad(CAST(b AS VARCHAR), 6, '0') AS id_programacion FROM brands"""),
    ("reasons", "SELECT * FROM (VALUES ('A', 'Atención realizada'), ('N', 'No pertinencia'), ('R', 'Otra causal')) t(n, causal)"),
    ("service_types", "SELECT * FROM (VALUES (1, 'Consulta nueva de especialidad'), (2, 'Consulta control'), "
                      "(3, 'Procedimiento'), (4, 'Intervención quirúrgica')) t(n, descripcion)"),
    ("ref_base", f"""SELECT CAST(o.o_custkey AS VARCHAR) AS run, CAST(o.o_custkey % 10 AS VARCHAR) AS dv,
        CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
        CAST(DATE '1950-01-01' + CAST((o.o_custkey * 7919) % 16000 AS INTEGER) AS DATE) AS fecha_nac,
        CAST(c.c_nationkey AS VARCHAR) AS estab_orig, CAST(s.s_nationkey AS VARCHAR) AS estab_dest,
        CAST(o.o_orderdate AS DATE) AS f_entrada,
        CASE WHEN l.l_linestatus = 'F' AND l.l_shipdate >= o.o_orderdate THEN CAST(l.l_shipdate AS DATE) END AS f_salida,
        ([1, 1, 1, 4, 2])[CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)] AS tipo_prest,
        CASE WHEN p.p_size <= 48 THEN {spec_code(BRAND)} END AS presta_min,
        p.p_type AS presta_est,
        CASE WHEN p.p_size <= 5 THEN p.p_name ELSE p.p_name || ' - ' || o.o_orderpriority END AS sospecha_diag,
        CASE WHEN l.l_linestatus = 'F' AND l.l_shipdate >= o.o_orderdate THEN l.l_returnflag END AS c_salida,
        CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS sigte_id,
        CAST(l.l_suppkey AS VARCHAR) AS id_local, l.l_linestatus AS _status, l.l_tax AS _tax
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey"""),
    ("open_list", "SELECT * EXCLUDE (_status, _tax) FROM ref_base WHERE _status = 'O'"),
    ("closed_list", "SELECT * EXCLUDE (_status, _tax) FROM ref_base WHERE _status = 'F'"),
    ("sigte", """SELECT tipo_prest, estab_dest,
        CASE WHEN NOT (_tax < 0.01 AND presta_est = 'PROMO') THEN f_entrada END AS f_entrada, f_salida, CASE WHEN _tax > 0.07 THEN 'duplicado' END AS tipo_error,
        presta_est AS especialidad_grupo FROM ref_base"""),
    ("line_sites", f"""SELECT s.s_nationkey, n.n_regionkey, {BRAND} AS brand_no,
        CAST(month(l.l_shipdate) AS INTEGER) AS mes, CAST(year(l.l_shipdate) AS INTEGER) AS ano,
        l.l_returnflag, l.l_linestatus, l.l_linenumber, l.l_discount, l.l_quantity, l.l_suppkey
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey"""),
    ("production_raw", """
        SELECT mes, ano, CASE WHEN n_regionkey = 4 THEN 14 ELSE 13 END AS id_servicio, CAST(s_nationkey AS VARCHAR) AS id_establecimiento,
          '07' || lpad(CAST(brand_no AS VARCHAR), 6, '0') AS codigo_prestacion, n_regionkey AS id_region, s_nationkey AS id_comuna,
          CAST(count(*) AS DOUBLE) AS col01, CAST(NULL AS DOUBLE) AS col02, CAST(NULL AS DOUBLE) AS col09, CAST(NULL AS DOUBLE) AS col10,
          CAST(NULL AS DOUBLE) AS col13, CAST(NULL AS DOUBLE) AS col16, CAST(NULL AS DOUBLE) AS col17,
          CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS col19,
          CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS col20,
          CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS col21,
          CAST(CASE WHEN brand_no = 3 THEN nullif(count(*) FILTER (WHERE l_linenumber <= 2), 0) ELSE count(*) FILTER (WHERE l_linenumber <= 2) END AS DOUBLE) AS col22,
          CAST(CASE WHEN brand_no = 3 THEN nullif(count(*) FILTER (WHERE l_linenumber > 2), 0) ELSE count(*) FILTER (WHERE l_linenumber > 2) END AS DOUBLE) AS col26
        FROM line_sites GROUP BY mes, ano, n_regionkey, s_nationkey, brand_no
        UNION ALL
        SELECT mes, ano, CASE WHEN n_regionkey = 4 THEN 14 ELSE 13 END, CAST(s_nationkey AS VARCHAR),
          '09' || lpad(CAST(brand_no AS VARCHAR), 6, '0'), n_regionkey, s_nationkey,
          CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE),
          CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE), CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE),
          CAST(count(*) FILTER (WHERE l_linenumber = 1) AS DOUBLE), CAST(count(*) FILTER (WHERE l_linenumber = 2) AS DOUBLE),
          CAST(count(*) FILTER (WHERE l_linenumber >= 3) AS DOUBLE), CAST(NULL AS DOUBLE),
          CAST(CASE WHEN brand_no = 3 THEN nullif(count(*) FILTER (WHERE l_discount < 0.05), 0) ELSE count(*) FILTER (WHERE l_discount < 0.05) END AS DOUBLE),
          CAST(CASE WHEN brand_no = 3 THEN nullif(count(*) FILTER (WHERE l_discount >= 0.05), 0) ELSE count(*) FILTER (WHERE l_discount >= 0.05) END AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
        FROM line_sites WHERE l_linestatus = 'O' OR brand_no <> 7 GROUP BY mes, ano, n_regionkey, s_nationkey, brand_no"""),
    ("programming", """SELECT CAST(s_nationkey AS VARCHAR) AS id_deis, '7' || lpad(CAST(brand_no AS VARCHAR), 6, '0') AS id_especialidad,
        CAST(l_suppkey AS VARCHAR) AS rutsdv, CAST(l_linenumber % 3 + 1 AS VARCHAR) AS id_actividad,
        CASE WHEN count(*) FILTER (WHERE mes <= 6) = 0 THEN 's/i'
             ELSE CAST(CAST(sum(CASE WHEN mes <= 6 THEN l_quantity ELSE 0.0 END) AS BIGINT) AS VARCHAR) END AS produccion_1_sem,
        CASE WHEN count(*) FILTER (WHERE NOT (mes <= 6)) = 0 THEN 's/i'
             ELSE CAST(CAST(sum(CASE WHEN NOT (mes <= 6) THEN l_quantity ELSE 0.0 END) AS BIGINT) AS VARCHAR) END AS produccion_2_sem,
        CAST(count(*) AS DOUBLE) * 1.5 AS horas_asignadas, CAST(count(*) AS DOUBLE) * 0.25 AS total_horas_semanales_contratadas_run
        FROM line_sites GROUP BY n_regionkey, s_nationkey, brand_no, l_suppkey, l_linenumber % 3 + 1"""),
    ("registry_raw", """SELECT CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) || CAST(c_custkey % 10 AS VARCHAR) END AS rut_paciente,
        CASE WHEN c_acctbal <= 9000 AND c_acctbal >= -500 THEN CAST(c_custkey AS VARCHAR) || CAST(c_custkey % 10 AS VARCHAR) END AS rut,
        c_name AS apellido_paterno, 'Centro ' || CAST(c_nationkey AS VARCHAR) AS consultorio_inscripcion,
        CAST(c_nationkey AS VARCHAR) AS comuna_establecimiento_id, c_mktsegment AS comuna_establecimiento,
        CAST(c_nationkey AS VARCHAR) AS codigo_deis_comuna FROM customer"""),
    ("registry", """SELECT rut_paciente, rut, apellido_paterno, consultorio_inscripcion, comuna_establecimiento_id, comuna_establecimiento,
        substring(rut_paciente, 1, length(rut_paciente) - 1) AS rut_paciente_sdv, substring(rut, 1, length(rut) - 1) AS rut_sdv
        FROM registry_raw WHERE rut_paciente IS NOT NULL OR rut IS NOT NULL"""),
    ("referral_map", f"""SELECT DISTINCT {spec_name(BRAND)} AS descripcion_especialidad_demandada,
        '13-' || CAST(p.p_size % 25 AS VARCHAR) AS codigo_deis_establecimiento_destino,
        CASE WHEN p.p_type = 'PROMO' THEN '' ELSE upper(split_part(p.p_name, ' ', 2)) END AS codigo_cie_10_diagnostico_opcional
        FROM part p"""),
    ("network_sites", """SELECT CAST(n_nationkey + 100 AS VARCHAR) AS codigo_antiguo, CAST(n_nationkey AS VARCHAR) AS x2,
        r_name AS comuna, 'Red ' || r_name AS minired FROM sites"""),
    ("portfolio", "SELECT DISTINCT p_name AS codigo FROM part WHERE starts_with(p_name, 'red ') OR starts_with(p_name, 'blue ')"),
    ("specialty_subset", """SELECT codigosigte, desc_esp, id_esp_seccion_a, id_programacion FROM specs
        WHERE starts_with(codigosigte, '07-')"""),
    ("yield_table", """SELECT codigosigte AS presta_min, desc_esp, id_programacion AS id_especialidad,
        CAST(CAST(substr(codigosigte, 4, 3) AS INTEGER) + 60 AS DOUBLE) / 100 AS distribucion_ambulatoria,
        0.4::DOUBLE AS distribucion_nueva, CAST(CAST(substr(codigosigte, 4, 3) AS INTEGER) % 4 + 2 AS DOUBLE) AS rendimiento_nueva
        FROM specs"""),
    ("projection", f"""SELECT {spec_code(BRAND)} AS x1, {spec_name(BRAND)} AS especialidad,
        {', '.join(f"CAST(count(*) FILTER (WHERE month(l.l_shipdate) = {k}) AS DOUBLE) AS m{k:02d}" for k in range(1, 13))},
        {', '.join(f"CAST(count(*) FILTER (WHERE quarter(l.l_shipdate) = {q}) AS DOUBLE) AS q{q}" for q in range(1, 5))},
        CAST(count(*) AS DOUBLE) AS total, CAST(count(*) FILTER (WHERE l.l_returnflag = 'R') AS DOUBLE) AS devueltos,
        CAST(count(*) FILTER (WHERE l.l_linestatus = 'O') AS DOUBLE) AS abiertos
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2"""),
]
