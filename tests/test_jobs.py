"""Jobs on small hand-made frames that hold the awkward rows of the real sources."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from support import values
from tamiz.operators import audits
from tamiz.plans import contract as K
from tamiz.plans import flows, gold, indicators, refresh, silver, star
from tamiz.workload import flow_queries, load_queries
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables


def day(y, m, d=1):
    return dt.date(y, m, d)


# ---- raw files to flat tables


def test_gdp_sheets(frame):
    real = frame([("1965", "10.5", "5", "2", "3.1"), ("2024 (p)", "20", "6", "3", None), ("2025", None, None, None, None)],
                 "`Años` string, `PIB \n(Millones)` string, `Población` string, `PIB Per cápita` string, tasa string")
    assert values(silver.gdp_real(real), "anio", "pib_real_musd", "variacion_pib_pct") == [(1965, 10.5, 3.1), (2024, 20.0, None)]
    nominal = frame([("1999", "", "", "100"), ("2000", "", "", "200"), ("2024 (p)", "", "", "300"), ("2025", "", "", None)],
                    "a string, b string, c string, d string")
    assert values(silver.gdp_nominal(nominal)) == [(day(2000, 1), 2000, 200.0), (day(2024, 1), 2024, 300.0)]


def test_series_files(frame):
    oil = frame([("2024-01-02", 70.5, 1000), ("2024-01-03", None, 1010)], "`Período` string, precio_petroleo_wti double, riesgo_pais_pb int")
    assert values(star.daily_fact(silver.daily_indicators(oil))) == [(day(2024, 1, 2), 70.5, 1000), (day(2024, 1, 3), None, 1010)]
    index = frame([("2024-05-01", 1.0, 2.0, 3.0, 4.0)], "FECHA string, IEE_Global double, Comercio double, Construccion double, Manufactura double")
    assert values(star.expectations_fact(silver.expectations_index(index))) == [(day(2024, 5), 1.0, 2.0, 3.0, 4.0)]
    vab = frame([(2020, "Manabí")], "`Año` int, Provincia string")
    assert silver.value_added(vab).columns == ["anio", "provincia"]


SURVEY = "encuesta string, periodo string, indicador string, nacional string, urbana string, rural string, hombre string, mujer string"


def survey_sheet(frame):
    return frame(
        [
            ("Encuesta", "Periodo", "Indicadores", "Total", "Urbana", "Rural", "", ""),
            (" ENEMDU ", "dic-07", " Desempleo (%) ", "5.0", "6.1", "-", "1", "1"),
            ("ENEMDU", "2016-03-01 00:00:00", "Desempleo (%)", "4.0", "5.0", "3.0", "1", "1"),
            ("ENEMDU", "sin fecha", "Desempleo (%)", "9.0", None, None, "1", "1"),
            ("ACUMULADA", "dic-07", "Desempleo (%)", None, "9.9", "2.0", "1", "1"),
            (None, None, "nota", None, None, None, None, None),
        ],
        SURVEY,
    )


def test_survey_long_then_wide_then_quarters(frame):
    long = silver.labour_survey(survey_sheet(frame))
    assert long.where("valor is null").count() == 0
    assert sorted(values(long.where("periodo = 'dic-07'"), "encuesta", "fecha", "anio", "area", "valor"))[0] == (
        "ACUMULADA", day(2007, 12), 2007, "rural", 2.0,
    )
    wide = star.employment_fact(long)
    # two surveys share dic-07: per area the first by name that has a value; undated rows go
    assert sorted(values(wide)) == [
        ("2016-03-01 00:00:00", 2016, "Desempleo (%)", 4.0, 5.0, 3.0),
        ("dic-07", 2007, "Desempleo (%)", 5.0, 9.9, 2.0),
    ]
    assert values(gold.employment_trend(wide)) == [
        (2007, 4, "Desempleo (%)", 5.0, 9.9, 2.0), (2016, 1, "Desempleo (%)", 4.0, 5.0, 3.0),
    ]


def test_census_long(frame):
    names = ", ".join(f"`{n}` string" for n in K.CENSUS_NAMES)
    blank = [None] * len(K.BRANCHES)
    rows = [
        ("1", " Azuay", "Cuenca ", "Hombre", "15-19", "9", "5", "4", *blank[2:]),
        ("2", None, None, None, None, "Fuente", *blank),
        ("3", "Loja", None, "Mujer", "20-24", "1", "x", None, *blank[2:]),
    ]
    got = values(silver.census_occupation(frame(rows, names)))
    assert sorted(got) == [
        ("AZUAY", "CUENCA", "Hombre", "15-19", 9.0, K.BRANCHES[0], 5.0),
        ("AZUAY", "CUENCA", "Hombre", "15-19", 9.0, K.BRANCHES[1], 4.0),
    ]


def directory_sheet(frame):
    rows = [
        (1, "10", "0991", " acme s.a. ", "Activa", "Guayas", "Guayaquil", "G", "G46"),
        (2, "11", None, "sin ruc", "DISUELTA", "Loja", "Loja", "A", "A01"),
        (3, "12", "0991", "acme copia", "ACTIVA", "Guayas", "Guayaquil", "G", "G46"),
        (4, "x", "0992", "sin expediente", "ACTIVA", "Loja", "Loja", "A", "A01"),
        (5, "10", "0993", "beta", "Inactiva", "Cañar", None, "C", "C10"),
    ]
    return frame(rows, "fila int, Expediente string, RUC string, Nombre string, `Situación Legal` string, Provincia string, "
                       "`Cantón` string, `CIIU Nivel 1` string, `CIIU Nivel 6` string")


def test_directory_first_row_wins_and_nulls_stay_null(frame):
    got = silver.company_directory(directory_sheet(frame), order="fila")
    assert sorted(values(got, "expediente", "ruc", "nombre", "situacion_legal", "canton")) == [
        (10, "0991", "ACME S.A.", "ACTIVA", "GUAYAQUIL"), (10, "0993", "BETA", "INACTIVA", None),
    ]


def test_repeated_file_number_does_not_multiply_ranking_rows(frame):
    directory = silver.company_directory(directory_sheet(frame), order="fila")
    ranking = frame([(2020.0, 10.0, "1,234.50", "7"), (2021.0, 99.0, "5", "8"), (2021.0, None, "5", "8")],
                    "anio double, expediente double, ingresos_totales string, `Activos` string")
    got = silver.company_ranking(ranking, directory)
    assert sorted(values(got, "anio", "expediente", "ingresos_totales", "activos", "ruc"), key=str) == [
        (2020, 10, None, 7.0, "0991"), (2021, 99, 5.0, 8.0, None),
    ]


def test_school_history(frame):
    rows = [("2009-2010 Inicio", " azuay", "01", "Cuenca", "0101", " X ", "01H1", "Fiscal", "12.0", "bad", "3", "9"),
            ("2009-2010 Inicio", "azuay", "01", "Cuenca", "0101", "Y", None, "Fiscal", "1", "1", "1", "1")]
    names = ["Año_lectivo", "Provincia", "Cod_Provincia", "Canton", "Cod_Canton", "Nombre_Institucion", "Codigo_Institucion",
             "Sostenimiento", "Total_Estudiantes", "Bachillerato", "3er Año Bachillerato", "Etnia"]
    got = silver.school_history(frame(rows, ", ".join(f"`{n}` string" for n in names)))
    assert values(got, "anio_lectivo", "provincia", "amie", "nombre_institucion", "total_estudiantes", "bachillerato", "bachilleres_3er_anio") == [
        ("2009-2010", "AZUAY", "01H1", "X", 12, 0, 3),
    ]
    assert "etnia" not in got.columns


def test_single_year_register(frame):
    rows = [(1, "2023-2024", "A1", 10, 30, 14, 16), (2, "2023-2024", "A1", 11, 31, 14, 16), (3, "2022-2023", "A1", None, 5, 1, None), (4, "2023-2024", "B2", 1, 9, 1, 2)]
    names = "fila int, `Año lectivo` string, AMIE string, `Total Docentes` int, `Total Estudiantes` int, `Estudiantes Femenino` int, `Estudiantes Masculino` int"
    register = frame(rows, names)
    everything = silver.school_register(register, order="fila")
    assert sorted(values(everything, "cod_amie", "anio_lectivo", "total_docentes")) == [("A1", "2022-2023", 0), ("A1", "2023-2024", 10), ("B2", "2023-2024", 1)]
    latest = silver.school_register(register, "2023-2024", order="fila")
    assert latest.count() == 2
    assert values(audits.unbalanced(latest, "total_estudiantes", ["estudiantes_f", "estudiantes_m"]), "cod_amie") == [("B2",)]


# ---- envelope to flat tables


def envelope(frame):
    rows = [
        (K.GDP_REAL, '{"anio_fiscal": 2023, "pib_real_millones": 100.0, "poblacion_total": 18000, "tasa_variacion_anual": 2.5}'),
        (K.GDP_REAL, '{"anio_fiscal": 2024, "pib_real_millones": 98.0, "tasa_variacion_anual": -2.0}'),
        (K.GDP_NOMINAL, '{"anio_fiscal": 2023, "pib_pc_nominal_usd": 6500.0}'),
        (K.VALUE_ADDED, '{"anio": null, "Provincia": "ManabÃ­", "VAB (miles)": 5.5}'),
        (K.VALUE_ADDED, '{"anio": null, "Provincia": "MANABI", "VAB (miles)": 4.5}'),
        (K.DIRECTORY, '{"datos": {"ruc": "09", "expediente": 1, "situacion_legal": "ACTIVA", "provincia": "MANABÃ\u008d", "ciiu_nivel1": "A"}}'),
        (K.DIRECTORY, '{"datos": {"ruc": null, "expediente": 2, "situacion_legal": "INACTIVA", "provincia": "None", "ciiu_nivel1": "None"}}'),
        (K.SCHOOLS + "_2025", '{"periodo_lectivo": "2025-2026 Inicio", "anio_base": 2025, "institucion": {"cod_provincia": "13", "provincia": "Manabí"}, "estudiantes_detallado": {"bachillerato": {"3er_ano_m": 6375, "3er_ano_h": 6075}}}'),
        (K.SCHOOLS + "_2025", '{"periodo_lectivo": "2025-2026 Inicio", "anio_base": 2024, "institucion": {"provincia": "Manabí"}, "estudiantes_detallado": {"bachillerato": {"3er_ano_m": 1}}}'),
        (K.EMPLOYMENT, '{"anio_fiscal": 2024, "periodo_original": "dic-24", "nombre_indicador": "Empleo", "metricas": {"nacional_total": "8,5", "area_urbana": 5, "area_rural": "None"}}'),
        (K.EMPLOYMENT, None),
    ]
    return frame(rows, "INDICADOR string, DATOS_JSON string")


SCHEMAS = {
    K.GDP_REAL: "anio_fiscal INT, pib_real_millones DOUBLE, poblacion_total BIGINT, tasa_variacion_anual DOUBLE",
    K.GDP_NOMINAL: "anio_fiscal INT, pib_pc_nominal_usd DOUBLE",
    K.VALUE_ADDED: "anio INT, Provincia STRING, `VAB (miles)` DOUBLE",
    K.DIRECTORY: "datos STRUCT<ruc: STRING, expediente: BIGINT, situacion_legal: STRING, provincia: STRING, ciiu_nivel1: STRING>",
    K.RANKING: "expediente BIGINT",
    K.SCHOOLS: "periodo_lectivo STRING, anio_base INT, institucion STRUCT<cod_provincia: STRING, provincia: STRING>, estudiantes_detallado STRUCT<bachillerato: STRUCT<`3er_ano_m`: BIGINT, `3er_ano_h`: BIGINT>>",
    K.EMPLOYMENT: "anio_fiscal INT, periodo_original STRING, nombre_indicador STRING, metricas STRUCT<nacional_total: STRING, area_urbana: STRING, area_rural: STRING>",
}


def test_envelope_to_gold(spark, frame, tmp_path):
    layer = flows.Layer(spark, "file://" + str(tmp_path / "silver"))
    for _ in range(2):
        flat = flows.load_envelope(envelope(frame), SCHEMAS, layer)
    assert "fact_ranking_empresarial" not in flat  # no records: nothing is written
    assert values(flat["fact_mineduc_bachilleres"].where("anio = 2025")) == [(2025, "Manabí", 12450.0)]
    assert values(flat["fact_empleo_enemdu"]) == [("dic-24", 2024, "Empleo", None, 5.0, None)]
    assert sorted(values(flat["fact_directorio_companias"], "ruc", "provincia")  , key=str) == [("09", "MANABÍ"), (None, None)]
    views = gold.flat_views(flat)
    assert values(views["gold_pib_tendencia"]) == [(2023, 100.0, 2.5, "Crecimiento fuerte"), (2024, 98.0, -2.0, "Contracción")]
    assert values(views["gold_vab_provincia"]) == [(None, "MANABI", 10.0)]
    assert values(views["gold_empleo_ciiu"]) == [("Agricultura, Ganadería y Pesca", 1)]
    assert values(views["gold_empleo_tendencia"]) == [("dic-24", "Empleo", "urbana", 5.0)]
    assert values(views["gold_bachilleres_vs_empresas"]) == [("Manabí", 12450.0, 1, 12450.0)]
    gold.register(views)
    assert spark.sql("SELECT max(empresas_activas) FROM gold_empresas_provincia").first()[0] == 1


def test_gdp_fusion_keeps_years_without_nominal(frame):
    got = indicators.gdp(envelope(frame), SCHEMAS[K.GDP_REAL], SCHEMAS[K.GDP_NOMINAL])
    assert sorted(values(got, "anio_fiscal", "pib_pc_nominal_usd"), key=str) == [(2023, 6500.0), (2024, None)]


# ---- flat tables to star schema, refresh, audits


@pytest.fixture(scope="module")
def flat(frame):
    return {
        "macro_anual": frame([(2023, 100.0, 18.0, 0.0), (2024, 98.0, None, -2.0), (2025, 99.0, 1.0, None)], "anio int, pib_real_musd double, poblacion_miles double, variacion_pib_pct double"),
        "pib_nominal": frame([(2023, 6500.0), (1999, 1.0)], "periodo int, pib_percapita_nominal_usd double"),
        "indicadores_diarios": frame([(day(2024, 1, i), float(i), i) for i in range(1, 32)], "fecha date, precio_petroleo_wti double, riesgo_pais_pb int"),
        "iee": frame([(day(2024, 1), 1.0)], "fecha date, iee_global double"),
        "vab": frame([(2020, "Manabí", "Manta", "A", 1.0), (2020, "MANABI ", "manta", "", 2.0), (2020, "Manabí", None, "Z", 3.0), (2020, None, None, "A", 4.0)], "anio int, provincia string, canton string, ciiu string, vab_miles_usd double"),
        "empleo": silver.labour_survey(survey_sheet(frame)),
        "ocupacion_censo": frame([("AZUAY", "CUENCA", "Hombre", "15", "x", 5.0)], "provincia string, canton string, sexo string, grupo_edad string, rama_actividad string, personas_ocupadas double"),
        "ranking": frame([("09", "MANABI", 2020, 10.0, 1.0, "A"), ("09", "Manabí", 2021, 20.0, 2.0, "A"), ("77", "LOJA", 2020, 5.0, 1.0, "Q9")], "ruc string, provincia string, anio int, ingresos_totales double, activos double, ciiu_n6 string"),
        "oferta_academica": frame([("MANABI", "13", "MANTA", "1308", "2024-2025", "13H1", 10, 4, 3), ("AZUAY", "01", "CUENCA", "0101", "2024-2025", "01H1", 20, 8, 6), ("AZUAY", "01", "CUENCA", "0101", "2023-2024", "01H1", 20, 8, 60)], "provincia string, cod_provincia string, canton string, cod_canton string, anio_lectivo string, amie string, total_estudiantes int, bachillerato int, bachilleres_3er_anio int"),
        "empresas": frame([("09", 1, "ACTIVA", "Manabí", "Portoviejo", "A", "A"), ("09", 2, "ACTIVA", "Manabí", "Manta", "A", "A"), ("08", 3, "INACTIVA", "Loja", "Loja", "A", "X"), (None, 4, "ACTIVA", "Loja", "Loja", "A", "A")], "ruc string, expediente bigint, situacion_legal string, provincia string, canton string, ciiu_n1 string, ciiu_n6 string"),
        "ciiu": frame([("A", "Agricultura"), ("A", "Otra"), (None, "x")], "ciiu string, descripcion string"),
    }


@pytest.fixture(scope="module")
def built(spark, flat, tmp_path_factory):
    layer = flows.Layer(spark, "file://" + str(tmp_path_factory.mktemp("star")))
    for _ in range(2):  # a second run replaces, it does not append
        built_tables = flows.build_star(flat, layer)
    return built_tables, layer


def test_star_dimensions(built):
    tables, _ = built
    assert values(tables["dim_geografia"].orderBy("id_geografia")) == [
        (1, "AZUAY", "01", "CUENCA", "0101"), (2, "LOJA", None, "LOJA", None), (3, "MANABI", None, None, None),
        (4, "MANABI", "13", "MANTA", "1308"), (5, "MANABI", None, "PORTOVIEJO", None),
    ]
    assert values(tables["dim_tiempo"].orderBy("id_tiempo"), "id_tiempo", "fecha", "anio") == [
        (1, day(1999, 1), 1999), (2, day(2023, 1), 2023), (3, day(2024, 1), 2024), (4, day(2025, 1), 2025),
    ]
    assert values(tables["dim_ciiu"]) == [("A", "Agricultura")]
    assert sorted(values(tables["dim_empresas"], "ruc", "expediente")) == [("08", 3), ("09", 1)]


def test_star_facts(built):
    tables, _ = built
    assert sorted(values(tables["fact_vab"], "id_geografia", "vab_miles_usd"), key=str) == [(3, 3.0), (4, 1.0), (4, 2.0), (None, 4.0)]
    # a province stands for its first canton
    assert sorted(values(tables["fact_ranking_empresarial"], "ruc", "id_geografia", "anio")) == [("09", 3, 2020), ("09", 3, 2021), ("77", 2, 2020)]
    assert sorted(values(tables["fact_macro_anual"], "id_tiempo", "pib_percapita_nominal_usd"), key=str) == [(2, 6500.0), (3, None), (4, None)]


def test_star_gold(built):
    tables, _ = built
    views = gold.star_views(tables)
    assert [r.clasificacion for r in views["gold_pib_tendencia"].collect()] == ["Estancamiento", "Contracción", "Contracción"]
    oil = views["gold_petroleo_30dias"].collect()
    assert oil[0].promedio_movil_30d == 1.0 and oil[30].promedio_movil_30d == sum(range(2, 32)) / 30
    assert values(views["gold_empresas_provincia"]) == [("MANABI", 1, 30.0, 3.0)]
    assert values(views["gold_bachilleres_vs_empresas"]) == [("MANABI", 3, 1, 3.0), ("AZUAY", 6, 0, None)]


def test_audits_name_every_orphan(built):
    tables, _ = built
    report = {(r.tabla, r.columna): (r.con_valor, r.sin_referencia) for r in flows.audit_star(tables).collect()}
    assert len(report) == len(K.REFERENCES)
    assert report[("dim_empresas", "ciiu_n6")] == (2, 1)
    assert report[("fact_ranking_empresarial", "ruc")] == (3, 1)
    assert report[("fact_ranking_empresarial", "ciiu_n6")] == (3, 1)
    assert report[("fact_vab", "id_geografia")] == (3, 0)
    assert sorted(values(flows.audit_gold(tables)))[0] == ("gold_bachilleres_vs_empresas", 2)


def test_refresh(built, frame):
    tables, layer = built
    directory = frame(
        [("09", 1, "ACTIVA", "Manabí", "Manta"), ("", 2, "ACTIVA", "Loja", "Loja"), ("10", 7, "ACTIVA", "Azuay", "Cuenca"), ("11", 7, "ACTIVA", "Loja", "Loja")],
        "ruc string, expediente bigint, situacion_legal string, provincia string, canton string",
    )
    companies = layer.put("dim_empresas_nueva", refresh.companies(directory))
    assert sorted(values(companies, "ruc", "provincia")) == [("09", "MANABI"), ("10", "AZUAY"), ("11", "LOJA")]
    rows = frame([(1, "2023.0", "1,234.50", "None"), (2, "2023", "1", "1"), (7, "2023", "x", ""), (99, "2023", "1", "1")], "expediente bigint, anio string, ingresos_totales string, activos string")
    ranking = refresh.ranking(rows, refresh.directory_lookup(directory), tables["dim_geografia"])
    assert sorted(values(ranking, "ruc", "id_geografia", "anio", "ingresos_totales", "activos")) == [
        ("09", 3, 2023, 1234.5, None), ("11", 2, 2023, None, None),
    ]
    newer = frame([(2023, 200.0, 18000, None, 1.0), (1950, 1.0, 1, 1.0, 1.0)], "anio_fiscal int, pib_real_millones double, poblacion_total bigint, pib_pc_nominal_usd double, tasa_variacion_anual double")
    macro = refresh.macro(tables["fact_macro_anual"], newer, tables["dim_tiempo"])
    assert sorted(values(macro), key=str) == [(2, 200.0, 18.0, None, 1.0), (3, 98.0, None, None, -2.0), (4, 99.0, 1.0, None, None)]


def test_new_school_year(built, frame):
    tables, _ = built
    grades = {refresh.SCHOOL_GRADE.format(g, s): v for (g, s), v in {("1er", "m"): "1", ("1er", "h"): "x", ("2do", "m"): None, ("2do", "h"): "2.5", ("3er", "m"): "6", ("3er", "h"): " 4"}.items()}
    flat_rows = frame([("13H9", "N", "Fiscal", "Manabí", "Manta", "30", *grades.values())], "institucion_amie string, institucion_nombre string, institucion_sostenimiento string, institucion_provincia string, institucion_canton string, "
                      + f"{refresh.SCHOOL_TOTAL} string, " + ", ".join(f"{c} string" for c in grades))
    got = refresh.school_year(flat_rows, tables["dim_geografia"], "2025-2026")
    assert values(got) == [(4, "2025-2026", "13H9", "N", "Fiscal", 30, 11, 10)]


def test_head_counts_stay_apart(frame):
    flat = frame([("dic-24", 2024, "Empleo", 8.0, 5.0, None)], "periodo string, anio int, indicador string, total_nacional double, total_urbana double, total_rural double")
    assert values(refresh.employment_counts(flat)) == [(2024, "dic-24", "Empleo", 8, 5, None)]


def test_constraints(built, frame):
    tables, _ = built
    required, unique = flows.audit_constraints(tables)
    assert {r.nulos for r in required.collect()} == {0}
    assert {r.claves_repetidas for r in unique.collect()} == {0}
    broken = {"dim_ciiu": frame([("A", "x"), ("A", "y"), (None, "z")], "ciiu string, descripcion string")}
    assert values(audits.check_required(broken, K.STAR)) == [("dim_ciiu", "ciiu", 1)]
    assert values(audits.check_unique(broken, {"dim_ciiu": ("ciiu",)}), "claves_repetidas", "filas_sobrantes") == [(1, 1)]


def test_refresh_of_a_stored_star_is_repeatable(spark, flat, frame, tmp_path):
    layer = flows.Layer(spark, "file://" + str(tmp_path / "star"))
    flows.build_star(flat, layer)
    newer = {
        "fact_directorio_companias": frame([("09", 1, "ACTIVA", "Manabí", "Manta", "", "A"), (" ", 2, "ACTIVA", "Loja", "Loja", "A", "A")], "ruc string, expediente bigint, situacion_legal string, provincia string, canton string, ciiu_nivel1 string, ciiu_nivel6 string"),
        "fact_ranking_empresarial": frame([(1, "2024", "7", " "), (2, "2024", "8", "A")], "expediente bigint, anio string, ingresos_totales string, ciiu_n6 string"),
        "fact_macro_anual": frame([(2024, 50.0, 1000, 2.0, 3.0)], "anio_fiscal int, pib_real_millones double, poblacion_total bigint, pib_pc_nominal_usd double, tasa_variacion_anual double"),
        "fact_empleo_enemdu": frame([("dic-24", 2024, "Empleo", 8.0, 5.0, 3.0)], "periodo string, anio int, indicador string, total_nacional double, total_urbana double, total_rural double"),
        "fact_mineduc_amie": frame([("13H9", "N", "Fiscal", "Manabí", "Manta", "30", "1", "1", "1", "1", "1", "1")], "institucion_amie string, institucion_nombre string, institucion_sostenimiento string, institucion_provincia string, institucion_canton string, " + f"{refresh.SCHOOL_TOTAL} string, " + ", ".join(f"{refresh.SCHOOL_GRADE.format(g, x)} string" for g in refresh.GRADES for x in refresh.SEXES)),
    }
    for _ in range(2):
        tables = flows.refresh_star(newer, layer, "2025-2026")
    assert values(tables["dim_empresas"], "ruc", "ciiu_n1", "ciiu_n6") == [("09", None, "A")]
    assert values(tables["fact_ranking_empresarial"], "ruc", "anio", "ingresos_totales", "ciiu_n6") == [("09", 2024, 7.0, None)]
    assert tables["fact_oferta_academica"].groupBy("anio_lectivo").count().orderBy("anio_lectivo").collect()[-1] == ("2025-2026", 1)
    assert sorted(values(tables["fact_macro_anual"], "pib_real_musd")) == [(50.0,), (99.0,), (100.0,)]
    assert tables["fact_vab"].where("ciiu = ''").count() == 0 and tables["fact_vab"].count() == 4
    assert values(tables["fact_empleo_poblacion"], "total_nacional") == [(8,)]


NEWER = {
    "fact_directorio_companias": [("09", 1, "ACTIVA", "Manabí", "Manta", "", "A")],
    "fact_ranking_empresarial": [(1, "2024", "7", " ")],
}


def test_refresh_that_breaks_half_way_leaves_the_old_star_whole(spark, flat, frame, tmp_path):
    layer = flows.Layer(spark, "file://" + str(tmp_path / "star"))
    flows.build_star(flat, layer)
    before = {name: sorted(values(layer.get(name, schema)), key=str) for name, schema in K.STAR.items() if name != "fact_empleo_poblacion"}
    grades = [refresh.SCHOOL_GRADE.format(g, x) for g in refresh.GRADES for x in refresh.SEXES]
    school = frame([("13H9", "N", "Fiscal", "Manabí", "Nueva", *["1"] * 7)], "institucion_amie string, institucion_nombre string, institucion_sostenimiento string, institucion_provincia string, institucion_canton string, "
                   + ", ".join(f"{c} string" for c in [refresh.SCHOOL_TOTAL, *grades]))
    from pyspark.sql import functions as F

    newer = {
        "fact_directorio_companias": frame(NEWER["fact_directorio_companias"], "ruc string, expediente bigint, situacion_legal string, provincia string, canton string, ciiu_nivel1 string, ciiu_nivel6 string"),
        "fact_ranking_empresarial": frame(NEWER["fact_ranking_empresarial"], "expediente bigint, anio string, ingresos_totales string, ciiu_n6 string"),
        "fact_macro_anual": frame([(2024, 50.0, 1000, 2.0, 3.0)], "anio_fiscal int, pib_real_millones double, poblacion_total bigint, pib_pc_nominal_usd double, tasa_variacion_anual double"),
        "fact_empleo_enemdu": frame([("dic-24", 2024, "Empleo", 8.0, 5.0, 3.0)], "periodo string, anio int, indicador string, total_nacional double, total_urbana double, total_rural double"),
        "fact_mineduc_amie": school,
    }
    lost = school.withColumn("institucion_amie", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        flows.refresh_star({**newer, "fact_mineduc_amie": lost}, layer, "2025-2026")
    assert {name: sorted(values(layer.get(name, K.STAR[name])), key=str) for name in before} == before
    with pytest.raises(LookupError):
        layer.get("fact_empleo_poblacion")
    report = {(r.tabla, r.medida): r.valor for r in flows.refresh_star(newer, layer, "2025-2026").report.collect()}
    assert report["dim_geografia", "nuevas"] == 1 and report["fact_vab", "limpiadas"] == 1
    assert report["fact_oferta_academica", "sin_geografia"] == 0 and report["fact_oferta_academica", "cargadas"] == 1
    again = {(r.tabla, r.medida): r.valor for r in flows.refresh_star(newer, layer, "2025-2026").report.collect()}
    assert again["dim_geografia", "nuevas"] == 0 and again["fact_oferta_academica", "cargadas"] == 0 and again["fact_vab", "limpiadas"] == 0


@pytest.mark.parametrize("parts", [1, 8])
def test_first_and_last_row_mean_the_order_in_the_files(spark, frame, tmp_path, parts):
    from pyspark.sql import functions as F

    from tamiz.sources.envelope import read_envelope

    rows = []
    for i in range(200):  # every number comes twice and every company too; names do not tell which came first
        rows.append((i, "A", f'{{"ruc": "r{i % 50}", "expediente": {i % 40}, "nombre": "n{(i * 37) % 200:03}", "provincia": "p{(i * 53) % 200:03}", "canton": "c"}}'))
    path = "file://" + str(tmp_path / f"e{parts}")
    made = frame(rows, "i INT, INDICADOR STRING, DATOS_JSON STRING").withColumn("INDICADOR", F.lit(K.DIRECTORY))
    (made.repartitionByRange(parts, "i") if parts > 1 else made.coalesce(1)).sortWithinPartitions("i").drop("i").write.parquet(path)
    envelope = read_envelope(spark, path, K.ORDER)
    flat = indicators.companies(envelope, "ruc STRING, expediente BIGINT, nombre STRING, provincia STRING, canton STRING")
    first, last = {}, {}
    for i, _, text in rows:
        first.setdefault(f"r{i % 50}", f"n{(i * 37) % 200:03}")
        last[i % 40] = (f"r{i % 50}", f"p{(i * 53) % 200:03}")
    assert dict(values(refresh.companies(flat), "ruc", "nombre")) == first
    assert {r.expediente: (r.ruc, r.provincia) for r in refresh.directory_lookup(flat).collect()} == last
    dimension = star.company_dimension(flat)
    assert dict(values(dimension, "ruc", "nombre")) == first and K.ORDER not in dimension.columns


def test_line_sums_make_the_same_tables_as_the_lines(spark, frame):
    shipped = dt.datetime(1997, 3, 1)
    lines = frame(
        [
            (1, 10.25, 3.0, "R", "F", shipped), (1, 1.5, None, "N", "F", shipped), (1, None, 7.0, None, None, shipped), (1, 4.0, 2.0, "R", "O", None),
            (2, 0.1, 5.0, "A", "F", shipped), (2, 0.1, 5.0, "A", "F", shipped), (None, 9.0, 1.0, "R", "F", shipped), (3, float("nan"), None, "N", None, shipped),
        ],
        "l_suppkey bigint, l_extendedprice double, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    )
    t = SimpleNamespace(
        spark=spark, lineitem=lines, supplier=frame([(1, "a", 0), (2, "b", 1), (2, "b", 1), (3, "c", 0), (None, "d", 0)], "s_suppkey bigint, s_name string, s_nationkey int"),
        nation=frame([(0, "X", 0), (1, "Y", 0)], "n_nationkey int, n_name string, n_regionkey int"), region=frame([(0, "Z")], "r_regionkey int, r_name string"),
    )
    sums = M.line_sums(t)
    for build in (M.schools, M.value_added, M.gdp_nominal):
        rows = sorted(values(build(t)), key=str)
        assert rows and sorted(values(build(t, sums)), key=str) == rows, build.__name__


def test_flat_tables_read_stored_sums_instead_of_the_lines(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    made = flow_queries.sources(t)
    flat = {**flow_queries.flat_tables(t, made), **flow_queries._newer(t, made)}
    read = [name for name, df in flat.items() if any("lineitem" in path or "orders" in path for path in df.inputFiles())]
    assert sorted(read) == ["iee", "indicadores_diarios", "ocupacion_censo"]


def test_order_sums_make_the_same_tables_as_the_orders(spark, frame):
    first, later = dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 31, 23)
    orders = frame(
        [
            (1, 7, 10.25, first, "1-URGENT", "F"), (1, 7, 10.25, first, "1-URGENT", "F"), (2, 7, 0.1, later, "1-URGENT", "F"), (3, 8, None, later, None, "O"),
            (4, None, 5.0, later, "2-HIGH", None), (5, None, 5.0, dt.datetime(1998, 1, 1), "2-HIGH", "P"), (6, 9, float("nan"), None, "2-HIGH", "F"), (None, 9, 3.3, None, None, None),
        ],
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp, o_orderpriority string, o_orderstatus string",
    )
    t = SimpleNamespace(spark=spark, orders=orders, lineitem=frame([(1, 2.5), (1, 2.5)], "l_orderkey bigint, l_extendedprice double"))
    sums, totals = M.order_sums(t), M.company_totals(t, by_year=True)
    for rows, same in ((M.survey(t), M.survey(t, sums)), (M.gdp_real(t), M.gdp_real(t, sums, totals))):
        assert rows.schema == same.schema
        assert rows.count() > 2 and sorted(values(same), key=str) == sorted(values(rows), key=str)


def test_tables_of_a_refresh_read_the_orders_no_more_than_their_figures_need(spark, monkeypatch):
    """Besides the totals of companies, one job reads the orders for both the survey and the yearly series."""
    read = []
    for module in (M, flow_queries):
        monkeypatch.setattr(module, "materialise", lambda df, name: read.append((name, any("orders" in p for p in df.inputFiles()))) or df.localCheckpoint())
    flow_queries.sources(Tables(spark, "/root/testdata/sf0.001"))
    assert sorted(name for name, orders in read if orders) == ["rounds", "totals"]


def test_tax_numbers_are_the_same_text_as_by_pattern(frame):
    numbers = frame([(0,), (1,), (9_999_999_999,), (10_000_000_000,), (-5,), (2**63 - 1,), (None,)], "n bigint")
    assert numbers.where(~M.tax_number(F.col("n")).eqNullSafe(F.format_string("%010d", "n"))).count() == 0


def test_files_of_broken_rows_are_written_by_all_tasks_each_under_its_header(spark, tmp_path):
    body = spark.range(1000, numPartitions=7).where("id % 2 = 0").select(F.concat(F.lit("fila "), "id").alias("value"))
    load_queries._under_headers(body, "clave").write.text(str(tmp_path / "parts"))
    parts = [p.read_text().splitlines() for p in (tmp_path / "parts").glob("part-*")]
    assert len(parts) == 7 and all(lines[0] == "clave" and lines.count("clave") == 1 for lines in parts)
    assert sorted(x for lines in parts for x in lines[1:]) == sorted(f"fila {i}" for i in range(0, 1000, 2))
