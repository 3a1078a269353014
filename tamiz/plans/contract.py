"""Names, types and references of the star schema, and of the raw inputs.

Everything in this module is fixed values: table and column names, types, column renames and
labels that the data and its readers share.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()


def _table(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not (rest and rest[0])) for name, kind, *rest in fields])


REQUIRED = True

STAR: dict[str, T.StructType] = {
    "dim_geografia": _table(
        ("id_geografia", _L, REQUIRED), ("provincia", _S, REQUIRED), ("cod_provincia", _S),
        ("canton", _S), ("cod_canton", _S),
    ),
    "dim_tiempo": _table(
        ("id_tiempo", _L, REQUIRED), ("fecha", _DATE, REQUIRED), ("anio", _I, REQUIRED), ("mes", _I), ("trimestre", _I)
    ),
    "dim_ciiu": _table(("ciiu", _S, REQUIRED), ("descripcion", _S)),
    "dim_empresas": _table(
        ("ruc", _S, REQUIRED), ("expediente", _L), ("nombre", _S), ("situacion_legal", _S), ("provincia", _S),
        ("canton", _S), ("ciiu_n1", _S), ("ciiu_n6", _S), ("fecha_constitucion", _S), ("ultimo_balance", _S),
    ),
    "fact_macro_anual": _table(
        ("id_tiempo", _L), ("pib_real_musd", _D), ("poblacion_miles", _D), ("pib_percapita_nominal_usd", _D),
        ("variacion_pib_pct", _D),
    ),
    "fact_indicadores_diarios": _table(("fecha", _DATE, REQUIRED), ("precio_petroleo_wti", _D), ("riesgo_pais_pb", _I)),
    "fact_iee": _table(
        ("fecha", _DATE, REQUIRED), ("iee_global", _D), ("comercio", _D), ("construccion", _D), ("manufactura", _D)
    ),
    "fact_vab": _table(("id_geografia", _L), ("anio", _I, REQUIRED), ("ciiu", _S), ("vab_miles_usd", _D)),
    "fact_empleo": _table(
        ("periodo", _S, REQUIRED), ("anio", _I), ("indicador", _S, REQUIRED), ("total_nacional", _D),
        ("total_urbana", _D), ("total_rural", _D),
    ),
    "fact_ocupacion_censo": _table(
        ("id_geografia", _L), ("sexo", _S), ("grupo_edad", _S), ("rama_actividad", _S), ("personas_ocupadas", _D)
    ),
    "fact_ranking_empresarial": _table(
        ("ruc", _S), ("id_geografia", _L), ("anio", _I), ("ingresos_totales", _D), ("activos", _D),
        ("patrimonio", _D), ("utilidad_neta", _D), ("ciiu_n6", _S),
    ),
    "fact_oferta_academica": _table(
        ("id_geografia", _L), ("anio_lectivo", _S, REQUIRED), ("amie", _S, REQUIRED), ("nombre_institucion", _S),
        ("sostenimiento", _S), ("total_estudiantes", _L), ("bachillerato", _L), ("bachilleres_3er_anio", _L),
    ),
    "fact_empleo_poblacion": _table(
        ("anio", _I, REQUIRED), ("periodo", _S, REQUIRED), ("indicador", _S, REQUIRED), ("total_nacional", _L),
        ("total_urbana", _L), ("total_rural", _L),
    ),
}

# (table, column, referred table, referred key)
REFERENCES = (
    ("dim_empresas", "ciiu_n1", "dim_ciiu", "ciiu"),
    ("dim_empresas", "ciiu_n6", "dim_ciiu", "ciiu"),
    ("fact_macro_anual", "id_tiempo", "dim_tiempo", "id_tiempo"),
    ("fact_vab", "id_geografia", "dim_geografia", "id_geografia"),
    ("fact_vab", "ciiu", "dim_ciiu", "ciiu"),
    ("fact_ocupacion_censo", "id_geografia", "dim_geografia", "id_geografia"),
    ("fact_ranking_empresarial", "ruc", "dim_empresas", "ruc"),
    ("fact_ranking_empresarial", "id_geografia", "dim_geografia", "id_geografia"),
    ("fact_ranking_empresarial", "ciiu_n6", "dim_ciiu", "ciiu"),
    ("fact_oferta_academica", "id_geografia", "dim_geografia", "id_geografia"),
)

UNIQUE_KEYS = {
    "dim_geografia": ("provincia", "canton"),
    "dim_tiempo": ("fecha",),
    "dim_ciiu": ("ciiu",),
    "dim_empresas": ("ruc",),
}

# The place of a row in its files, where a flat table keeps it.
ORDER = "orden"

# Tables whose files are laid out by a column that queries filter on.
PARTITIONS = {"fact_oferta_academica": ("anio_lectivo",), "envelope": ("INDICADOR",)}

AREAS = ("nacional", "urbana", "rural")
AREA_TOTALS = {area: f"total_{area}" for area in AREAS}

BRANCHES = (
    "agricultura_ganaderia_silvicultura_pesca", "explotacion_minas_canteras", "industrias_manufactureras",
    "suministro_electricidad_gas_vapor", "distribucion_agua_alcantarillado_saneamiento", "construccion",
    "comercio_mayor_menor", "transporte_almacenamiento", "alojamiento_servicios_comida", "informacion_comunicacion",
    "actividades_financieras_seguros", "actividades_inmobiliarias", "actividades_profesionales_cientificas_tecnicas",
    "actividades_servicios_administrativos_apoyo", "administracion_publica_defensa", "ensenanza",
    "atencion_salud_asistencia_social", "arte_entretenimiento_recreacion", "otras_actividades_servicios",
    "actividades_hogares_empleadores", "organizaciones_organos_extraterritoriales", "no_clasificado",
)

GDP_MARKER = "Años"
GDP_REAL_NAMES = ("anio", "pib_real_musd", "poblacion_miles", "pib_percapita_usd", "variacion_pib_pct")
GDP_NOMINAL_POSITIONS = {0: "periodo", 3: "pib_percapita_nominal_usd"}
GDP_NOMINAL_FIRST_YEAR = 2000

SURVEY_NAMES = ("encuesta", "periodo", "indicador", "nacional", "urbana", "rural", "hombre", "mujer")
CENSUS_KEYS = ("provincia", "canton", "sexo", "grupo_edad", "total_ocupados")
CENSUS_NAMES = ("indice", *CENSUS_KEYS, *BRANCHES)

DIRECTORY_RENAMES = {"ciiu_nivel_1": "ciiu_n1", "ciiu_nivel_6": "ciiu_n6"}
DIRECTORY_COLUMNS = (
    "expediente", "ruc", "nombre", "situacion_legal", "provincia", "canton", "ciiu_n1", "ciiu_n6",
    "fecha_constitucion", "ultimo_balance",
)

RANKING_TYPES = {
    "anio": _D, "expediente": _D, "posicion_general": _D, "ingresos_ventas": _D, "ingresos_totales": _D,
    "activos": _D, "patrimonio": _D, "utilidad_neta": _D, "n_empleados": _D, "ciiu_n1": _S, "ciiu_n6": _S,
}
RANKING_WHOLE = ("anio", "expediente", "n_empleados")

SCHOOL_COLUMNS = (
    "Año_lectivo", "Provincia", "Cod_Provincia", "Canton", "Cod_Canton", "Nombre_Institucion", "Codigo_Institucion",
    "Sostenimiento", "Total_Estudiantes", "Bachillerato", "Estudiante_Bachillerato_edad_15_17", "3er Año Bachillerato",
)
SCHOOL_RENAMES = {
    "ano_lectivo": "anio_lectivo",
    "codigo_institucion": "amie",
    "3er_ano_bachillerato": "bachilleres_3er_anio",
    "estudiante_bachillerato_edad_15_17": "estudiantes_bachillerato_15_17",
}
SCHOOL_COUNTS = ("total_estudiantes", "bachillerato", "estudiantes_bachillerato_15_17", "bachilleres_3er_anio")
SCHOOL_YEAR_LABEL = " Inicio"

REGISTER_RENAMES = {
    "Año lectivo": "anio_lectivo",
    "AMIE": "cod_amie",
    "Nombre_Institución": "nombre_institucion",
    "Provincia": "provincia",
    "Nivel Educación": "nivel_educacion",
    "Sostenimiento": "sostenimiento",
    "Área": "area",
    "Total Docentes": "total_docentes",
    "Total Estudiantes": "total_estudiantes",
    "Estudiantes Femenino": "estudiantes_f",
    "Estudiantes Masculino": "estudiantes_m",
}
REGISTER_COUNTS = ("total_docentes", "total_estudiantes", "estudiantes_f", "estudiantes_m")

UNEMPLOYMENT = "Desempleo (%)"

# Indicators of the record envelope.
GDP_REAL = "PIB_REAL_PER_CAPITA"
GDP_NOMINAL = "PIB_NOMINAL_PER_CAPITA"
VALUE_ADDED = "VAB_CANTONAL_CIIU"
DIRECTORY = "SUPERCIAS_DIRECTORIO"
RANKING = "SUPERCIAS_RANKING"
SCHOOLS = "MINEDUC_AMIE"
EMPLOYMENT = "INEC_ENEMDU_POBLACIONES"
