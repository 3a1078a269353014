"""Loads: files with awkward rows, files to star, figures of a refresh, ids that outlive it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.operators import audits
from tamiz.plans import contract as K
from tamiz.plans import flows, star
from tamiz.session import scratch_path
from tamiz.sources import files, tables
from tamiz.workload import mapping as M
from tamiz.workload.flow_queries import NEW_PERIOD, _newer, flat_tables, sources
from tamiz.workload.registry import Tables, query, sql_sum


@query("""SELECT o_orderkey, 'say "' || o_orderpriority || '", ok' || chr(10) || ' ;"' || o_orderstatus || '" ' AS nota FROM orders""")
def csv_quotes(t: Tables) -> DataFrame:
    """Cells with quotes, separators, line breaks and outer spaces, written and read back."""
    path = scratch_path(t.spark, "csv-quotes")
    note = F.concat(F.lit('say "'), "o_orderpriority", F.lit('", ok\n ;"'), "o_orderstatus", F.lit('" '))
    rows = t.orders.select("o_orderkey", note.alias("nota"))
    tables.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema, ";")


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS clave, s_name AS nombre, CAST(NULL AS VARCHAR) AS telefono FROM supplier
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, p_brand FROM part"""
)
def sheets_with_own_headers(t: Tables) -> DataFrame:
    """Two sheets with different headers: each file is read under its own names."""
    path = scratch_path(t.spark, "sheets")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("clave"), F.col("s_name").alias("nombre"))
    parts = t.part.select(F.col("p_partkey").alias("clave"), F.col("p_brand").alias("telefono"))
    for df in (suppliers, parts):
        # several sheets of each kind, as they are exported: a title, a header, the rows of some keys
        rows = df.select(F.concat_ws(",", *df.columns).alias("value"), F.pmod("clave", F.lit(4)).alias("hoja"), F.lit(2).alias("orden"))
        top = [(text, hoja, orden) for hoja in range(4) for orden, text in enumerate(["2 hojas", f"Clave,{df.columns[1]}"])]
        lines = t.spark.createDataFrame(top, "value string, hoja long, orden int").unionByName(rows)
        lines.repartition("hoja").sortWithinPartitions("hoja", "orden").drop("orden").write.mode("append").partitionBy("hoja").text(path)
    sheet = files.read_sheet_below_marker(t.spark, path, "Clave")
    return sheet.select(F.col("Clave").alias("clave"), "nombre", "telefono")


def _under_headers(body: DataFrame, header: str) -> DataFrame:
    """Lines (``value``) below a header in every part file, as exports have it: each task writes one, whose first line
    brings the header along, so nothing is shuffled."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return body.select(F.when(first, F.concat(F.lit(f"{header}\n"), "value")).otherwise(F.col("value")).alias("value"))


_BAD = "CASE WHEN o_orderkey % 7 = 0 THEN 'celdas de mas' WHEN o_orderkey % 11 = 0 THEN 'celdas de menos' WHEN o_orderkey % 13 = 0 THEN 'no es numero' END"


@query(
    f"""SELECT clase, count(*) AS filas, CAST(sum(o_orderkey) AS BIGINT) AS claves FROM
  (SELECT o_orderkey, unnest(['leidas', {_BAD}]) AS clase FROM orders) WHERE clase IS NOT NULL GROUP BY clase"""
)
def unparsed_rows(t: Tables) -> DataFrame:
    """Rows with cells too many or too few, and texts in columns of numbers: found, with their place, and still loaded."""
    path = scratch_path(t.spark, "csv-bad")
    key = F.col("o_orderkey")
    kind = F.when(key % 7 == 0, "mas").when(key % 11 == 0, "menos").when(key % 13 == 0, "texto").otherwise("")
    amount = F.when(kind == "texto", F.lit("s/d")).otherwise(F.col("o_totalprice").cast("string"))
    # the note of some rows holds a line break, so that both ways of reading meet bad rows
    note = F.when(key % 2 == 0, F.concat(F.lit('"a\nb '), "o_orderpriority", F.lit('"'))).otherwise(F.col("o_orderpriority"))
    line = F.when(kind == "menos", F.concat_ws(",", key, amount)).otherwise(F.concat_ws(",", key, amount, note, F.when(kind == "mas", F.lit("x"))))
    for rows in (t.orders.where(key % 2 == 0), t.orders.where(key % 2 == 1)):
        _under_headers(rows.select(line.alias("value")), "clave,monto,nota").write.mode("append").text(path)
    read = files.read_csv(t.spark, path, T.StructType.fromDDL("clave bigint, monto double, nota string"), order="orden", corrupt="malo")
    loaded, rejected = files.set_aside(read, "malo", "orden", "pedidos")
    cells = F.size(F.split(F.regexp_replace("registro", r'"[^"]*"', ""), ","))
    why = F.when(cells > 3, "celdas de mas").when(cells < 3, "celdas de menos").otherwise("no es numero")
    placed = rejected.where(F.col("archivo").isNotNull() & F.col("bloque").isNotNull())
    found = placed.select(why.alias("clase"), F.split_part("registro", F.lit(","), F.lit(1)).cast("bigint").alias("clave"))
    everything = loaded.select(F.lit("leidas").alias("clase"), "clave").unionByName(found)
    return everything.groupBy("clase").agg(F.count("*").alias("filas"), F.sum("clave").alias("claves"))


# ---- raw files to star in one run


def _raw_files(t: Tables, base: str) -> dict[str, str]:
    """The flat tables as the exports they come from; names hold quotes and line breaks."""
    geography = M.geography(t)
    folders = {}

    def raw(name: str, df: DataFrame, sep: str = ",", encoding: str = files.UTF8) -> None:
        folders[name] = f"{base}/{name}"
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **files.QUOTES}
        df.write.options(header=True, sep=sep, encoding=encoding, **kept).csv(folders[name])

    def sheet(name: str, lines: DataFrame, header: list[str]) -> None:
        folders[name] = f"{base}/{name}"
        titles = t.spark.createDataFrame([(line,) for line in header], "value string").coalesce(1)
        titles.unionByName(lines.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lines.columns]).alias("value"))).write.text(folders[name])

    label = F.concat(F.col("anio").cast("string"), F.when(F.col("anio") >= 1998, F.lit(" (p)")).otherwise(F.lit(""))).alias("anio")
    sheet("macro_anual", M.gdp_real(t).select(label, "pib_real_musd", "poblacion_miles", F.lit("").alias("c"), "variacion_pib_pct"), ["Banco Central,,,,", "Años,PIB,Población,PIB per cápita,Tasa"])
    nominal = M.gdp_nominal(t).select(F.col("periodo").cast("string"), F.lit("x").alias("a"), F.lit("x").alias("b"), "pib_percapita_nominal_usd")
    sheet("pib_nominal", nominal, ["Banco Central,,,", "Años,PIB,Población,Per cápita"])
    raw("indicadores_diarios", M.daily(t).withColumnRenamed("fecha", "Período"))
    month = F.trunc("o_orderdate", "month").cast("date")
    raw("iee", t.orders.groupBy(month.alias("FECHA")).agg(F.count("*").cast("double").alias("IEE_Global")))
    raw("vab", M.value_added(t).select(F.col("anio").alias("Año"), F.col("provincia").alias("Provincia"), F.col("canton").alias("Canton"), F.col("ciiu").alias("CIIU"), F.col("valor").alias("VAB_miles_USD")))
    survey = star.employment_fact(M.survey(t)).select(
        F.lit("ENEMDU").alias("e"), "periodo", "indicador", "total_nacional", "total_urbana", "total_rural", F.lit("1").alias("h"), F.lit("1").alias("m")
    )
    sheet("empleo", survey, ["Encuesta nacional,,,,,,,", "Encuesta,Periodo,Indicadores,Total,Urbana,Rural,Hombre,Mujer"])
    sheet("ocupacion_censo", M.census_sheet(t).select(*K.CENSUS_NAMES), ["Censo" + "," * (len(K.CENSUS_NAMES) - 1)])
    name = F.concat(F.lit('"'), "nombre", F.lit('", S.A.\nMatriz'))
    raw("empresas", M.companies(t).select(
        F.concat("expediente", F.lit(".0")).alias("EXPEDIENTE"), F.format_string("%010d", "ruc").alias("RUC"), name.alias("NOMBRE"),
        F.lower("situacion_legal").alias("SITUACIÓN LEGAL"), M.accented(F.col("provincia")).alias("PROVINCIA"), F.col("canton").alias("CANTÓN"),
        F.col("ciiu_n1").alias("CIIU NIVEL 1"), F.col("ciiu_n6").alias("CIIU NIVEL 6"),
    ))
    raw("ciiu", t.customer.select(F.col("c_mktsegment").alias("CIIU"), F.lit("descripción").alias("DESCRIPCION")).distinct(), encoding=files.LATIN1)
    raw("oferta_academica", M.schools(t).join(geography, "id_geografia").select(
        F.concat("anio_lectivo", F.lit(" Inicio")).alias("Año_lectivo"), F.col("provincia").alias("Provincia"), F.lit("9").alias("Cod_Provincia"),
        F.col("canton").alias("Canton"), F.col("nombre_institucion").alias("Nombre_Institucion"), F.col("amie").alias("Codigo_Institucion"),
        F.lit("Fiscal").alias("Sostenimiento"), F.col("total_estudiantes").alias("Total_Estudiantes"), F.col("bachillerato").alias("Bachillerato"),
        F.concat("bachilleres_3er_anio", F.lit(".0")).alias("3er Año Bachillerato"), F.lit("01").alias("Cod_Canton"), F.lit("x").alias("Etnia"),
    ))
    raw("ranking", M.company_totals(t, by_year=True).select(
        F.concat("anio", F.lit(".0")).alias("anio"), F.col("ruc").alias("expediente"), "ingresos_totales", "activos", F.lit("Q").alias("ciiu_n6")
    ))
    return folders


_STAR_FROM_FILES: dict[str, tuple[str, str, str]] = {
    "fact_vab": ("concat_ws(' ', anio, ciiu, id_geografia)", "vab_miles_usd", f"SELECT concat_ws(' ', anio, ciiu, id), valor FROM ({M.SQL_VALUE_ADDED}) JOIN geo USING (provincia, canton)"),
    "fact_ocupacion_censo": (
        "concat_ws(' ', id_geografia, sexo, grupo_edad, rama_actividad)", "personas_ocupadas",
        f"SELECT concat_ws(' ', id, sexo, grupo_edad, rama_actividad), personas_ocupadas FROM ({M.SQL_CENSUS}) JOIN geo USING (provincia, canton)",
    ),
    "fact_oferta_academica": (
        "concat_ws(' ', id_geografia, anio_lectivo, amie, nombre_institucion)", "CAST(bachilleres_3er_anio * 1000000 + bachillerato AS DOUBLE) + total_estudiantes / 1000000D",
        f"""SELECT concat_ws(' ', id, anio_lectivo, amie, nombre_institucion), CAST(bachilleres_3er_anio * 1000000 + bachillerato AS DOUBLE) + total_estudiantes / 1000000::DOUBLE
        FROM ({M.SQL_SCHOOLS}) JOIN ({M.SQL_GEOGRAPHY}) USING (id_geografia) JOIN geo USING (provincia, canton)""",
    ),
    "fact_ranking_empresarial": (
        "concat_ws(' ', ruc, anio, id_geografia, ciiu_n6)", "ingresos_totales",
        f"""SELECT concat_ws(' ', printf('%010d', o_custkey), year(o_orderdate), (SELECT min(id) FROM geo WHERE geo.provincia = r_name), 'Q'), {sql_sum('o_totalprice')}
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        GROUP BY o_custkey, year(o_orderdate), r_name""",
    ),
    "fact_empleo": ("concat_ws(' ', periodo, anio, indicador)", "total_nacional", f"""SELECT concat_ws(' ', periodo, CASE WHEN anio < 2000 THEN anio + 100 ELSE anio END, indicador), max(valor) FILTER (WHERE area = 'nacional')
        FROM ({M.SQL_SURVEY}) GROUP BY periodo, anio, indicador"""),
    "fact_macro_anual": (
        "CAST(id_tiempo AS STRING)", "pib_real_musd",
        "SELECT CAST((SELECT count(DISTINCT y) FROM (SELECT anio AS y FROM yearly UNION SELECT year(l_shipdate) FROM lineitem) WHERE y <= anio) AS VARCHAR), pib_real_musd FROM yearly",
    ),
    "fact_indicadores_diarios": ("CAST(fecha AS STRING)", "precio_petroleo_wti", f"SELECT CAST(fecha AS VARCHAR), precio_petroleo_wti FROM ({M.SQL_DAILY})"),
    "dim_empresas": (
        "concat_ws('|', ruc, nombre, situacion_legal, provincia, canton, ciiu_n1, ciiu_n6)", "CAST(expediente AS DOUBLE)",
        f"""SELECT concat_ws('|', printf('%010d', ruc), upper('"' || nombre || '", S.A.' || chr(10) || 'Matriz'), situacion_legal, upper(translate(lower(provincia), 'ao', 'áó')),
        canton, ciiu_n1, ciiu_n6), CAST(expediente AS DOUBLE) FROM ({M.SQL_COMPANIES})""",
    ),
    "dim_ciiu": ("concat_ws(' ', ciiu, descripcion)", "CAST(NULL AS DOUBLE)", "SELECT DISTINCT c_mktsegment || ' descripción', CAST(NULL AS DOUBLE) FROM customer"),
}


@query(
    f"""WITH geo AS (SELECT provincia, canton, row_number() OVER (ORDER BY provincia, canton) AS id FROM
    (SELECT provincia, canton FROM ({M.SQL_VALUE_ADDED}) UNION SELECT provincia, canton FROM ({M.SQL_COMPANIES})
     UNION SELECT provincia, canton FROM ({M.SQL_SCHOOLS}) JOIN ({M.SQL_GEOGRAPHY}) USING (id_geografia))),
  yearly AS ({M.SQL_YEARLY})
  """
    + "\n  UNION ALL ".join(f"SELECT '{name}' AS tabla, * FROM ({sql}) AS x(clave, valor)" for name, (_, _, sql) in _STAR_FROM_FILES.items())
)
def files_to_star(t: Tables) -> DataFrame:
    """Raw exports to the star schema in one run, and every row of its tables. Rounds name their year by two digits,
    which are those of this century."""
    folders = _raw_files(t, scratch_path(t.spark, "raw"))
    built = flows.files_to_star(t.spark, folders, flows.Layer(t.spark, scratch_path(t.spark, "silver")), flows.Layer(t.spark, scratch_path(t.spark, "star")))
    return audits.union_all(
        [built[name].select(F.lit(name).alias("tabla"), F.expr(key).alias("clave"), F.expr(value).alias("valor")) for name, (key, value, _) in _STAR_FROM_FILES.items()]
    )


# ---- figures of a refresh, and ids that outlive it


_PAIRS = "(SELECT DISTINCT o_custkey, year(o_orderdate) AS anio FROM orders)"
_YEARS = "(SELECT DISTINCT year(o_orderdate) AS anio FROM orders)"
_ROUNDS = f"(SELECT DISTINCT periodo, indicador FROM ({M.SQL_SURVEY}))"
_SCHOOLS = f"({M.SQL_SCHOOLS}) WHERE anio_lectivo = '{NEW_PERIOD}'"


@query(
    f"""SELECT 'dim_empresas' AS tabla, unnest(['leidas', 'excluidas', 'cargadas', 'perdidos']) AS medida,
    unnest([count(*), count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), count(*) FILTER (WHERE c_mktsegment <> 'BUILDING'), 0]) AS valor FROM customer
  UNION ALL SELECT 'fact_ranking_empresarial', unnest(['leidas', 'sin_expediente', 'sin_geografia', 'cargadas', 'perdidos']),
    unnest([count(*), count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), 0, count(*) FILTER (WHERE c_mktsegment <> 'BUILDING'), 0]) FROM {_PAIRS} JOIN customer ON c_custkey = o_custkey
  UNION ALL SELECT 'fact_macro_anual', unnest(['leidas', 'sin_anio', 'actualizadas', 'sin_cambio', 'cargadas', 'perdidos']),
    unnest([count(*) FILTER (WHERE anio >= 1998) + 1, 1, count(*) FILTER (WHERE anio >= 1998), count(*) FILTER (WHERE anio < 1998), count(*), 0]) FROM {_YEARS}
  UNION ALL SELECT 'fact_empleo_poblacion', unnest(['leidas', 'cargadas', 'perdidos']), unnest([count(*), count(*), count(*) FILTER (WHERE indicador = '1-URGENT')]) FROM {_ROUNDS}
  UNION ALL SELECT 'fact_oferta_academica', unnest(['leidas', 'sin_geografia', 'cargadas', 'perdidos']),
    unnest([count(*), count(*) FILTER (WHERE CAST(amie AS INT) % 4 = 1), count(*), 0]) FROM {_SCHOOLS}
  UNION ALL SELECT 'dim_geografia', 'nuevas', count(DISTINCT id_geografia) FROM {_SCHOOLS} AND CAST(amie AS INT) % 3 = 0 AND CAST(amie AS INT) % 4 <> 1
  UNION ALL SELECT 'fact_vab', 'limpiadas', 0"""
)
def refresh_report(t: Tables) -> DataFrame:
    """What a refresh read, matched, left out, lost and loaded, table by table, counted while it wrote."""
    made = sources(t)
    flat = flat_tables(t, made)
    flat["oferta_academica"] = flat["oferta_academica"].where(F.col("anio_lectivo") != NEW_PERIOD)
    layer = flows.Layer(t.spark, scratch_path(t.spark, "report-star"))
    flows.build_star(flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat), layer)
    newer = _newer(t, made)
    one = newer["fact_macro_anual"].limit(1).withColumn("anio_fiscal", F.lit(2050))
    newer["fact_macro_anual"] = newer["fact_macro_anual"].unionByName(one)
    newer["fact_empleo_enemdu"] = newer["fact_empleo_enemdu"].withColumn("total_urbana", F.when(F.col("indicador") == "1-URGENT", "n/d").otherwise("7"))
    newer["fact_mineduc_amie"] = _moved_schools(newer["fact_mineduc_amie"])
    return flows.refresh_star(flows.Layer(t.spark, scratch_path(t.spark, "newer")).put_all(newer), layer, NEW_PERIOD).report


def _moved_schools(schools: DataFrame) -> DataFrame:
    """Some schools in places nobody has seen, some in none."""
    number = F.col("institucion_amie").cast("int")
    canton = F.when(number % 3 == 0, F.concat(F.lit("nuevo "), "institucion_canton")).otherwise(F.col("institucion_canton"))
    province = F.when(number % 4 == 1, F.lit(None).cast("string")).otherwise(F.col("institucion_provincia"))
    return schools.withColumns({"institucion_canton": canton, "institucion_provincia": province})


@query(
    f"""WITH first AS (SELECT provincia, canton, row_number() OVER (ORDER BY provincia, canton) AS id FROM
    (SELECT provincia, canton FROM ({M.SQL_VALUE_ADDED}) UNION SELECT provincia, canton FROM ({M.SQL_COMPANIES})
     UNION SELECT provincia, canton FROM ({M.SQL_SCHOOLS}) JOIN ({M.SQL_GEOGRAPHY}) USING (id_geografia) WHERE anio_lectivo <> '{NEW_PERIOD}')),
  placed AS (SELECT provincia, CASE WHEN CAST(amie AS INT) % 3 = 0 THEN 'NUEVO ' || canton ELSE canton END AS canton FROM ({M.SQL_SCHOOLS}) JOIN ({M.SQL_GEOGRAPHY}) USING (id_geografia)
    WHERE anio_lectivo = '{NEW_PERIOD}' AND CAST(amie AS INT) % 4 <> 1),
  second AS (SELECT provincia, canton, (SELECT max(id) FROM first) + row_number() OVER (ORDER BY provincia, canton) AS id FROM
    (SELECT DISTINCT provincia, canton FROM placed WHERE (provincia, canton) NOT IN (SELECT (provincia, canton) FROM first))),
  known AS (SELECT * FROM first UNION ALL SELECT * FROM second),
  third AS (SELECT provincia, canton, (SELECT max(id) FROM known) + row_number() OVER (ORDER BY provincia, canton) AS id FROM (SELECT DISTINCT provincia, 'ANTES' AS canton FROM ({M.SQL_COMPANIES})))
  SELECT id AS id_geografia, provincia, canton, (SELECT count(*) FROM placed WHERE placed.provincia = k.provincia AND placed.canton = k.canton) AS escuelas
  FROM (SELECT * FROM known UNION ALL SELECT * FROM third) k"""
)
def places_outlive_refresh(t: Tables) -> DataFrame:
    """Two refreshes bring new places: ids that were given stay, new ones follow them, and facts refer to both."""
    made = sources(t)
    flat = flat_tables(t, made)
    flat["oferta_academica"] = flat["oferta_academica"].where(F.col("anio_lectivo") != NEW_PERIOD)
    layer = flows.Layer(t.spark, scratch_path(t.spark, "places-star"))
    flows.build_star(flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat), layer)
    newer = _newer(t, made)
    newer["fact_mineduc_amie"] = _moved_schools(newer["fact_mineduc_amie"])
    stored = flows.Layer(t.spark, scratch_path(t.spark, "newer")).put_all(newer)
    flows.refresh_star(stored, layer, NEW_PERIOD)
    more = stored["fact_directorio_companias"]
    stored["fact_directorio_companias"] = more.unionByName(more.withColumns({"canton": F.lit("antes"), "ruc": F.concat("ruc", F.lit("x"))}))
    star_tables = flows.refresh_star(stored, layer, NEW_PERIOD)
    schools = star_tables["fact_oferta_academica"].where(F.col("anio_lectivo") == NEW_PERIOD).groupBy("id_geografia").agg(F.count("*").alias("n"))
    return star_tables["dim_geografia"].join(schools, "id_geografia", "left").select(
        "id_geografia", "provincia", "canton", F.coalesce("n", F.lit(0)).alias("escuelas")
    )
