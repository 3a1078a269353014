"""Projections, reshaping, joins and dimensions on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.numbers import exact_sum, half_up, number_or_null
from tamiz.operators.columns import (
    conform, keep_wanted, lower_case_columns, rename, rename_by_position, snake_case_columns,
)
from tamiz.operators.keys import dense_ids, resolve_key
from tamiz.operators.rows import contains_ci, drop_missing, first_per_key, value_of_first, value_of_last
from tamiz.operators.summary import top
from tamiz.plans import contract as K
from tamiz.plans import indicators, refresh, silver, star
from tamiz.sources.envelope import parse_records, records_of, schema_profile, unseen_keys
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables, query, sql_sum


@query("SELECT event_id, user_id, value AS monto_usd FROM events WHERE event_type = 'click'")
def envelope_by_indicator(t: Tables) -> DataFrame:
    records = parse_records(records_of(M.envelope(t), "click"), M.PAYLOAD_SCHEMA)
    return records.select(
        "record.event_id", F.col("record.usuario.id").alias("user_id"),
        number_or_null(F.col("record.metricas.monto_usd")).alias("monto_usd"),
    )


@query(
    """SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
  WHERE starts_with(event_type, 'p') OR starts_with(event_type, 's') GROUP BY event_type"""
)
def envelope_by_prefix(t: Tables) -> DataFrame:
    envelope = M.envelope(t)
    chosen = records_of(envelope, "p", prefix=True).unionByName(records_of(envelope, "s", prefix=True))
    return (
        chosen.select(F.col("INDICADOR").alias("event_type"), F.from_json("DATOS_JSON", "event_id BIGINT").alias("r"))
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.sum("r.event_id").alias("ids"))
    )


@query(
    """SELECT event_id, user_id AS usuario_id, CAST(value AS VARCHAR) AS metricas_monto_usd,
    CAST(json_extract(props, '$.k') AS BIGINT) AS metricas_detalle_k FROM events"""
)
def json_flatten(t: Tables) -> DataFrame:
    return indicators.flat_records(M.envelope(t), "", M.PAYLOAD_SCHEMA, prefix=True)


@query(
    """SELECT event_id, user_id AS id, CAST(value AS VARCHAR) AS monto_usd, CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events WHERE event_type = 'purchase'"""
)
def json_flatten_last_segment(t: Tables) -> DataFrame:
    return indicators.flat_records(M.envelope(t), "purchase", M.PAYLOAD_SCHEMA, last_segment=True)


@query(
    f"""SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, {sql_sum('value')} AS valor FROM events GROUP BY 1"""
)
def resolve_columns(t: Tables) -> DataFrame:
    """The amount column is found by a part of its name."""
    renamed = M.envelope(t).withColumn("INDICADOR", F.lit(K.VALUE_ADDED))
    flat = indicators.value_added(renamed, M.PAYLOAD_SCHEMA)
    return flat.groupBy(F.col("metricas_detalle_k").alias("k")).agg(
        F.count("*").alias("n"), half_up(exact_sum(number_or_null(F.col("valor"))), 2).alias("valor")
    )


@query(
    """SELECT event_type AS INDICADOR, count(*) AS registros,
    'OBJECT<event_id: BIGINT, metricas: OBJECT<detalle: OBJECT<k: BIGINT>, monto_usd: STRING>, usuario: OBJECT<id: BIGINT>>' AS esquema
  FROM events GROUP BY event_type"""
)
def json_schema_profile(t: Tables) -> DataFrame:
    return schema_profile(M.envelope(t))


@query("SELECT 'metricas' AS clave, count(*) AS registros FROM events")
def json_unseen_keys(t: Tables) -> DataFrame:
    declared = T.StructType.fromDDL("event_id BIGINT, usuario STRUCT<id: BIGINT>")
    return unseen_keys(M.envelope(t), declared)


@query("SELECT n_nationkey AS id_nacion, n_name AS nombre, n_regionkey AS region FROM nation")
def rename_project(t: Tables) -> DataFrame:
    by_position = rename_by_position(t.nation, {0: "id_nacion", 1: "canton", 2: "region"})
    return rename(by_position, {"canton": "nombre"})


@query("SELECT c_custkey AS codigo_cliente, c_name AS nombre_compania, c_acctbal AS saldo_usd, c_mktsegment AS ano_3er FROM customer", name="snake_case_columns")
def snake_case_columns_customer(t: Tables) -> DataFrame:
    named = t.customer.select(
        F.col("c_custkey").alias(" Código Cliente"), F.col("c_name").alias("Nombre  (Compañía)"),
        F.col("c_acctbal").alias("Saldo_USD "), F.col("c_mktsegment").alias("Año 3er"),
    )
    return snake_case_columns(named)


@query("SELECT s_suppkey, s_name FROM supplier")
def lower_case_columns_supplier(t: Tables) -> DataFrame:
    return lower_case_columns(t.supplier.select(F.col("s_suppkey").alias("S_SuppKey"), F.col("s_name").alias("S_NAME")))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_linenumber AS VARCHAR) AS linea,
    count(*) AS veces FROM lineitem GROUP BY ALL"""
)
def typed_subset_scan(t: Tables) -> DataFrame:
    """Wanted columns that exist, in forced types; one wanted column does not exist."""
    wanted = ["l_orderkey", "l_linenumber", "l_quantity", "l_color"]
    typed = keep_wanted(t.lineitem, wanted).withColumns(
        {"l_quantity": F.col("l_quantity").try_cast("bigint"), "linea": F.col("l_linenumber").cast("string")}
    )
    return typed.groupBy(*typed.columns).agg(F.count("*").alias("veces"))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
    CASE WHEN NULL THEN '' END AS nota FROM orders"""
)
def conform_schema(t: Tables) -> DataFrame:
    target = T.StructType.fromDDL("o_orderkey STRING, o_totalprice BIGINT, nota STRING")
    return conform(t.orders, target)


@query(
    """SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%'"""
)
def filter_like(t: Tables) -> DataFrame:
    return t.part.where(contains_ci(F.col("p_name"), "RED")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%widget%' ORDER BY p_partkey LIMIT 10")
def sample_rows(t: Tables) -> DataFrame:
    """The first ten rows of a filter, as the ad-hoc checks show them."""
    return t.part.where(contains_ci(F.col("p_name"), "widget")).select("p_partkey", "p_name").orderBy("p_partkey").limit(10)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) >= 2000 AND o_orderstatus = 'F'")
def filter_compare(t: Tables) -> DataFrame:
    since = F.lit("2000-01-01").cast("timestamp_ntz")
    return t.orders.where((F.col("o_orderdate") >= since) & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'")
def clean_not_null(t: Tables) -> DataFrame:
    gaps = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))
    return drop_missing(gaps, ["o_orderpriority"])


@query(
    f"""WITH yearly AS ({M.SQL_YEARLY}), nominal AS ({M.SQL_GDP_NOMINAL}), realgdp AS ({M.SQL_GDP_REAL})
  SELECT row_number() OVER (ORDER BY anio) AS id_tiempo, pib_real_musd, poblacion_miles, pib_percapita_nominal_usd, variacion_pib_pct
  FROM realgdp LEFT JOIN nominal USING (anio)"""
)
def fuse_series_by_year(t: Tables) -> DataFrame:
    """Two yearly series fused, under the id of the year."""
    real = M.gdp_real(t)
    return star.macro_fact(real, M.gdp_nominal(t), star.time([real.select("anio")]))


def _dirty_places(t: Tables, key: str, nation_key: str, table: DataFrame) -> DataFrame:
    """Rows with a carelessly written province and canton; one canton is missing."""
    named = table.select(key, nation_key).join(M.geography(t), F.col(nation_key) + 1 == F.col("id_geografia"))
    return named.select(
        key, M.accented(F.col("provincia")).alias("provincia"),
        M.accented(F.nullif(F.col("canton"), F.lit("NATION_0"))).alias("canton"),
    )


@query(
    """SELECT c_custkey, CASE WHEN n_name = 'NATION_7' THEN NULL ELSE CAST(n_nationkey + 1 AS BIGINT) END AS id_geografia
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def geo_key_resolve(t: Tables) -> DataFrame:
    """Composite key with a missing part on both sides; one place is not in the dimension."""
    dim = M.geography(t).withColumn("canton", F.nullif(F.col("canton"), F.lit("NATION_0"))).where(
        ~F.col("canton").eqNullSafe("NATION_7")
    )
    placed = star.with_place(_dirty_places(t, "c_custkey", "c_nationkey", t.customer), dim)
    return placed.select("c_custkey", "id_geografia")


@query(
    f"""WITH geo AS ({M.SQL_GEOGRAPHY}) SELECT s_suppkey, (SELECT min(id_geografia) FROM geo g WHERE g.provincia = geo.provincia) AS id_geografia
  FROM supplier JOIN geo ON id_geografia = s_nationkey + 1"""
)
def coarse_key_resolve(t: Tables) -> DataFrame:
    """A province stands for its first canton."""
    placed = star.with_province(_dirty_places(t, "s_suppkey", "s_nationkey", t.supplier), M.geography(t))
    return placed.select("s_suppkey", "id_geografia")


_SALES = f"""SELECT o_custkey AS expediente, CAST(year(o_orderdate) AS INT) AS anio, {sql_sum('o_totalprice')} AS ingresos_totales
  FROM orders GROUP BY ALL"""


def _directory(t: Tables) -> DataFrame:
    """Companies, of which those of one segment have no tax number."""
    blank = F.when(F.col("ciiu_n6") == "BUILDING", F.lit("  ")).otherwise(F.format_string("%010d", F.col("ruc")))
    return M.companies(t).withColumn("ruc", blank)


def _yearly_sales(t: Tables) -> DataFrame:
    """Company totals by year as text, the amounts with thousands commas."""
    totals = t.orders.groupBy(F.col("o_custkey").alias("expediente"), F.year("o_orderdate").alias("anio")).agg(
        half_up(exact_sum(F.col("o_totalprice")), 2).alias("ingresos_totales")
    )
    return totals.select(
        "expediente", F.col("anio").cast("string").alias("anio"),
        F.format_number("ingresos_totales", 2).alias("ingresos_totales"),
        F.lit("None").alias("activos"), F.lit("").alias("patrimonio"), F.lit("1,000").alias("utilidad_neta"),
        F.lit("A01").alias("ciiu_n6"),
    )


@query(
    f"""WITH geo AS ({M.SQL_GEOGRAPHY}), prov AS (SELECT provincia, min(id_geografia) AS id_geografia FROM geo GROUP BY 1), e AS ({M.SQL_COMPANIES}), s AS ({_SALES})
  SELECT lpad(CAST(ruc AS VARCHAR), 10, '0') AS ruc, id_geografia, anio, ingresos_totales, CAST(NULL AS DOUBLE) AS activos,
    CAST(NULL AS DOUBLE) AS patrimonio, CAST(1000 AS DOUBLE) AS utilidad_neta, 'A01' AS ciiu_n6
  FROM s JOIN e USING (expediente) JOIN prov USING (provincia) WHERE e.ciiu_n6 <> 'BUILDING'"""
)
def lookup_enrich(t: Tables) -> DataFrame:
    """Ranking rows through the directory: rows of companies without a tax number go."""
    return refresh.ranking(_yearly_sales(t), refresh.directory_lookup(_directory(t)), M.geography(t))


@query(
    f"""WITH e AS ({M.SQL_COMPANIES}), s AS ({_SALES})
  SELECT expediente, anio, ingresos_totales, CASE WHEN situacion_legal = 'ACTIVA' THEN nombre END AS nombre
  FROM s JOIN e USING (expediente)"""
)
def lookup_left(t: Tables) -> DataFrame:
    """Left enrichment: companies the (partial) directory lacks keep their rows."""
    directory = M.companies(t).where(F.col("situacion_legal") == "ACTIVA")
    sales = _yearly_sales(t).withColumn("ingresos_totales", F.replace("ingresos_totales", F.lit(","), F.lit("")))
    ranked = silver.company_ranking(sales.drop("ciiu_n6", "activos", "patrimonio", "utilidad_neta"), directory)
    return ranked.select("expediente", F.col("anio").cast("int").alias("anio"), "ingresos_totales", F.initcap("nombre").alias("nombre"))


@query(
    """SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS ultimo, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS primero
  FROM orders GROUP BY o_custkey"""
)
def last_row_per_key(t: Tables) -> DataFrame:
    order = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        value_of_last("o_orderkey", order).alias("ultimo"), value_of_first("o_orderkey", order).alias("primero")
    )


@query(
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""".replace(
        "SELECT *", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR)[:10] AS l_shipdate, l_partkey, l_suppkey, l_extendedprice"
    )
)
def dedup_first(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    first = first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])
    return first.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"),
        "l_partkey", "l_suppkey", "l_extendedprice",
    )


_SHEET = f"""SELECT {M.SQL_MONTH.format('o_orderdate')} || '-' || strftime(o_orderdate, '%y') AS periodo, o_orderpriority AS indicador,
    {sql_sum("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")} AS nacional,
    {sql_sum("CASE WHEN o_orderstatus = 'O' AND month(o_orderdate) <> 6 THEN o_totalprice END")} AS urbana,
    {sql_sum("CASE WHEN o_orderstatus = 'P' THEN o_totalprice END")} AS rural,
    2000 + CAST(strftime(o_orderdate, '%y') AS INT) AS anio, CAST(month(o_orderdate) AS INT) AS mes
  FROM orders GROUP BY ALL"""


@query(
    f"""SELECT periodo, CAST(make_date(anio, mes, 1) AS VARCHAR) AS fecha, CAST(anio AS INT) AS anio, indicador, area, valor
  FROM (UNPIVOT ({_SHEET}) ON nacional, urbana, rural INTO NAME area VALUE valor) WHERE valor IS NOT NULL"""
)
def unpivot_areas(t: Tables) -> DataFrame:
    """A wide survey sheet (text numbers, ``-`` for no value) to long form."""
    month = F.trunc("o_orderdate", "month")
    value = {"F": "nacional", "O": "urbana", "P": "rural"}
    sums = [
        half_up(exact_sum(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice"))), 2).alias(area)
        for status, area in value.items()
    ]
    wide = t.orders.groupBy(month.alias("mes"), F.col("o_orderpriority").alias("indicador")).agg(*sums)
    sheet = wide.select(
        F.lit("ENEMDU ").alias("encuesta"), M.period_text(F.col("mes")).alias("periodo"),
        F.concat(F.lit(" "), "indicador").alias("indicador"),
        F.col("nacional").cast("decimal(20,2)").cast("string").alias("nacional"),
        F.when(F.month("mes") == 6, "-").otherwise(F.col("urbana").cast("decimal(20,2)").cast("string")).alias("urbana"),
        F.col("rural").cast("decimal(20,2)").cast("string").alias("rural"),
        F.lit("").alias("hombre"), F.lit("").alias("mujer"),
    )
    return silver.labour_survey(sheet).select("periodo", F.col("fecha").cast("string").alias("fecha"), "anio", "indicador", "area", "valor")


@query(M.SQL_CENSUS)
def unpivot_branches(t: Tables) -> DataFrame:
    """A census sheet with 22 branch columns to long form."""
    return silver.census_occupation(M.census_sheet(t)).drop("total_ocupados")


@query(
    f"""SELECT periodo, anio, indicador, max(CASE WHEN area = 'nacional' THEN valor END) AS total_nacional,
    max(CASE WHEN area = 'urbana' THEN valor END) AS total_urbana, max(CASE WHEN area = 'rural' THEN valor END) AS total_rural
  FROM ({M.SQL_SURVEY}) GROUP BY periodo, anio, indicador"""
)
def pivot_areas(t: Tables) -> DataFrame:
    return star.employment_fact(M.survey(t))


@query(
    f"""SELECT row_number() OVER (ORDER BY provincia, canton NULLS FIRST) AS id_geografia, provincia,
    CAST(cod_provincia AS VARCHAR) AS cod_provincia, canton, CAST(cod_canton AS VARCHAR) AS cod_canton FROM (
    SELECT DISTINCT r_name AS provincia, n_name AS canton, CASE WHEN c IS NOT NULL THEN n_regionkey END AS cod_provincia, CASE WHEN c IS NOT NULL THEN n_nationkey END AS cod_canton
    FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT DISTINCT c_nationkey AS c FROM customer) ON c = n_nationkey
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer)
    UNION ALL SELECT DISTINCT r_name, CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS INT)
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
)
def dim_geography(t: Tables) -> DataFrame:
    """Places of three sources that write them differently; codes come with one of them."""
    suppliers = _dirty_places(t, "s_suppkey", "s_nationkey", t.supplier)
    exact = t.supplier.select("s_nationkey").join(M.geography(t), F.col("s_nationkey") + 1 == F.col("id_geografia"))
    coded = t.customer.select("c_nationkey").join(M.geography(t), F.col("c_nationkey") + 1 == F.col("id_geografia")).join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    coded = coded.select(
        F.initcap("provincia").alias("provincia"), "canton", F.col("n_regionkey").cast("string").alias("cod_provincia"),
        F.col("n_nationkey").cast("string").alias("cod_canton"),
    )
    no_canton = suppliers.withColumn("canton", F.lit(None).cast("string"))
    return star.geography([suppliers.where(F.col("canton").isNotNull()), no_canton, exact], coded)


@query(
    """SELECT row_number() OVER (ORDER BY anio) AS id_tiempo, CAST(anio AS VARCHAR) || '-01-01' AS fecha, CAST(anio AS INT) AS anio, 1 AS mes, 1 AS trimestre
  FROM (SELECT year(o_orderdate) AS anio FROM orders UNION SELECT year(l_shipdate) FROM lineitem)"""
)
def dim_time(t: Tables) -> DataFrame:
    years = [t.orders.select(F.year("o_orderdate")), t.lineitem.select(F.year("l_shipdate"))]
    return star.time(years).withColumn("fecha", F.col("fecha").cast("string"))


@query("SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id, c_custkey FROM customer")
def dense_ids_customer(t: Tables) -> DataFrame:
    """Consecutive ids over a large table, numbered in parallel."""
    return dense_ids(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment", "c_custkey"], "id").drop("c_mktsegment")


@query(
    f"""SELECT n_nationkey + 1 AS id_geografia, CAST(year(l_shipdate) AS INT) AS anio, l_returnflag AS ciiu, {sql_sum('l_extendedprice')} AS vab_miles_usd
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""".replace(
        "n_nationkey + 1", "CAST(n_nationkey + 1 AS BIGINT)"
    )
)
def value_added_fact(t: Tables) -> DataFrame:
    flat = M.value_added(t).withColumnRenamed("valor", "vab_miles_usd")
    return star.value_added_fact(flat, M.geography(t))


@query(
    """SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey"""
)
def single_key_resolve(t: Tables) -> DataFrame:
    dim = t.nation.where(F.col("n_regionkey") != 2).select("n_name", "n_nationkey")
    return resolve_key(t.customer.select("c_custkey", "c_nationkey"), dim, {"n_nationkey": F.col("c_nationkey")}, "n_name").select(
        "c_custkey", "n_name"
    )


@query(
    f"""SELECT o_custkey, {sql_sum('o_totalprice')} AS total FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 15"""
)
def top_customers(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(half_up(exact_sum(F.col("o_totalprice")), 2).alias("total"))
    return top(totals, "total", 15, ["o_custkey"])
