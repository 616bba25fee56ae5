"""Declared schemas of the reference's inputs (after header cleaning).

Codes are strings from the start: inference would turn ``07020130`` into a
number and lose the leading zero (N10)."""

from __future__ import annotations

ESTABLISHMENTS = ("codigo_vigente string, codigo_antiguo string, nombre_oficial string, codigo_comuna string, "
                  "nombre_comuna string, nivel_de_atencion string, "
                  "nombre_dependencia_jerarquica_seremi_servicio_de_salud string, nivel_de_complejidad string")
ABBREVIATIONS = "codigo_vigente string, abreviacion string"
SPECIALTIES = ("codigosigte string, desc_esp string, id_esp_seccion_a string, id_esp_seccion_b string, "
               "id_programacion string")
EXIT_REASONS = "n string, causal string"
SERVICE_TYPES = "n int, descripcion string"
WAITING_LIST = ("run string, dv string, sexo string, fecha_nac date, estab_orig string, estab_dest string, "
                "f_entrada date, f_salida date, tipo_prest int, presta_min string, presta_est string, "
                "sospecha_diag string, c_salida string, sigte_id string, id_local string")
# Raw waiting-list extracts carry dates as text; they are parsed leniently.
WAITING_LIST_TEXT = WAITING_LIST.replace(" date", " string")
PRODUCTION = ("mes int, ano int, id_servicio int, id_establecimiento string, codigo_prestacion string, "
              "id_region int, id_comuna int, col01 double, col02 double, col09 double, col10 double, "
              "col13 double, col16 double, col17 double, col19 double, col20 double, col21 double, "
              "col22 double, col26 double")
PROGRAMMING = ("id_deis string, id_especialidad string, rutsdv string, id_actividad string, "
               "produccion_1_sem string, produccion_2_sem string, horas_asignadas double, "
               "total_horas_semanales_contratadas_run double")
REGISTRY = ("rut_paciente string, rut string, apellido_paterno string, consultorio_inscripcion string, "
            "comuna_establecimiento_id string, comuna_establecimiento string, codigo_deis_comuna string")
SIGTE = ("tipo_prest int, estab_dest string, f_entrada date, f_salida date, tipo_error string, "
         "especialidad_grupo string")
NETWORK_SITES = "codigo_antiguo string, x2 string, comuna string, minired string"
PORTFOLIO = "codigo string"
SPECIALTY_SUBSET = "codigosigte string, desc_esp string, id_esp_seccion_a string, id_programacion string"
YIELD_TABLE = ("presta_min string, desc_esp string, id_especialidad string, distribucion_ambulatoria double, "
               "distribucion_nueva double, rendimiento_nueva double")
# Read by position (D5): two names, 12 months, 4 quarters, three totals.
PROJECTION = ("x1 string, especialidad string, " + ", ".join(f"m{k:02d} double" for k in range(1, 13)) + ", "
              + ", ".join(f"q{k} double" for k in range(1, 5)) + ", total double, devueltos double, abiertos double")
# The reference keys its activities by ``n`` (as text).
PROGRAMMED_ACTIVITIES = "n string, actividad string"
REFERRAL_MAP = ("descripcion_especialidad_demandada string, codigo_deis_establecimiento_destino string, "
                "codigo_cie_10_diagnostico_opcional string")
