"""Gold views on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.labels import SECTORS, OTHER_SECTOR
from tamiz.functions.numbers import exact_sum
from tamiz.operators.audits import view_rows
from tamiz.operators.rows import latest_period
from tamiz.operators.summary import share_within, value_counts
from tamiz.operators.windows import trailing_mean_of_rows
from tamiz.plans import gold, star
from tamiz.session import materialise, scratch_path
from tamiz.sources.layers import Layer
from tamiz.workload import mapping as M
from tamiz.workload.registry import ORACLES, Tables, query, sql_avg, sql_round, sql_sum

INDICATOR = "1-URGENT"
TOP_SECTORS = 10

_CLASS = """CASE WHEN {0} > 2 THEN 'Crecimiento fuerte' WHEN {0} > 0 THEN 'Crecimiento moderado'
    WHEN {0} = 0 THEN 'Estancamiento' ELSE 'Contracción' END"""

_COMPANIES_BY_PROVINCE = f"""SELECT provincia,
    count(DISTINCT CASE WHEN situacion_legal = 'ACTIVA' THEN ruc END) AS empresas_activas,
    {sql_sum('o_totalprice')} AS ingresos_totales, {sql_sum('activos')} AS activos_totales
  FROM orders JOIN ({M.SQL_COMPANIES}) e ON ruc = o_custkey
  LEFT JOIN ({M.SQL_LINES}) l ON l_orderkey = o_orderkey GROUP BY provincia"""


@query(_COMPANIES_BY_PROVINCE)
def gold_company_by_region(t: Tables) -> DataFrame:
    return gold.companies_by_province(M.ranking(t), M.companies(t), M.geography(t))


@query(
    f"""WITH geo AS ({M.SQL_GEOGRAPHY}), schools AS ({M.SQL_SCHOOLS}),
  grad AS (SELECT provincia, CAST(sum(bachilleres_3er_anio) AS BIGINT) AS bachilleres_3er_anio FROM schools JOIN geo USING (id_geografia)
    WHERE anio_lectivo = (SELECT max(anio_lectivo) FROM schools) GROUP BY provincia),
  emp AS ({_COMPANIES_BY_PROVINCE})
  SELECT grad.provincia, bachilleres_3er_anio, coalesce(empresas_activas, 0) AS empresas_activas,
    {sql_round('bachilleres_3er_anio / nullif(empresas_activas, 0)')} AS bachilleres_por_empresa
  FROM grad LEFT JOIN emp ON emp.provincia = grad.provincia"""
)
def gold_ratio_by_region(t: Tables) -> DataFrame:
    geography = M.geography(t)
    by_province = gold.companies_by_province(M.ranking(t), M.companies(t), geography)
    # stored by school year, so that the latest one is found by its folder
    layer = Layer(t.spark, scratch_path(t.spark, "schools"), {"schools": ["anio_lectivo"]})
    layer.put("schools", M.schools(t))
    return gold.graduates_per_company(layer.latest("schools", "anio_lectivo"), geography, by_province, newest=True)


_GDP_TREND = f"""WITH yearly AS ({M.SQL_YEARLY}), nominal AS ({M.SQL_GDP_NOMINAL}), realgdp AS ({M.SQL_GDP_REAL})
  SELECT realgdp.anio, pib_real_musd, pib_percapita_nominal_usd, variacion_pib_pct,
    {_CLASS.format('variacion_pib_pct')} AS clasificacion
  FROM realgdp LEFT JOIN nominal USING (anio)"""


def _macro(t: Tables):
    real, nominal = materialise(M.gdp_real(t), "gdp-real"), M.gdp_nominal(t)
    dim = star.time([real.select("anio")])
    return star.macro_fact(real, nominal, dim), dim


@query(_GDP_TREND)
def gold_gdp_trend(t: Tables) -> DataFrame:
    return gold.gdp_trend(*_macro(t))


@query(
    f"""WITH yearly AS ({M.SQL_YEARLY}), realgdp AS ({M.SQL_GDP_REAL})
  SELECT anio, pib_real_musd, variacion_pib_pct, {_CLASS.format('variacion_pib_pct')} AS clasificacion FROM realgdp"""
)
def gold_gdp_trend_flat(t: Tables) -> DataFrame:
    names = {"anio": "anio_fiscal", "pib_real_musd": "pib_real_millones", "variacion_pib_pct": "tasa_variacion_anual"}
    return gold.flat_gdp_trend(M.gdp_real(t).withColumnsRenamed(names))


_EMPLOYMENT_TREND = f"""WITH survey AS ({M.SQL_SURVEY})
  SELECT anio, trimestre, indicador,
    {sql_avg("CASE WHEN area = 'nacional' THEN valor END")} AS tasa_nacional,
    {sql_avg("CASE WHEN area = 'urbana' THEN valor END")} AS tasa_urbana,
    {sql_avg("CASE WHEN area = 'rural' THEN valor END")} AS tasa_rural
  FROM survey WHERE indicador = '{INDICATOR}' GROUP BY ALL"""


def _employment(t: Tables) -> DataFrame:
    return star.employment_fact(M.survey(t))


@query(_EMPLOYMENT_TREND)
def gold_employment_trend(t: Tables) -> DataFrame:
    return gold.employment_trend(_employment(t), INDICATOR)


_OIL = f"""WITH daily AS ({M.SQL_DAILY})
  SELECT CAST(fecha AS VARCHAR) AS fecha, precio_petroleo_wti, riesgo_pais_pb,
    {sql_round('''CAST(sum(CAST(precio_petroleo_wti AS DECIMAL(24,6))) OVER w AS DOUBLE)
      / count(precio_petroleo_wti) OVER w''')} AS promedio_movil_30d
  FROM daily WINDOW w AS (ORDER BY fecha ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""


@query(_OIL)
def moving_avg_30(t: Tables) -> DataFrame:
    return gold.oil_30_days(M.daily(t)).withColumn("fecha", F.col("fecha").cast("string"))


@query(
    f"""SELECT o_orderkey, o_totalprice,
    {sql_round('''CAST(sum(CAST(o_totalprice AS DECIMAL(24,6))) OVER w AS DOUBLE) / count(o_totalprice) OVER w''')} AS promedio
  FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
)
def moving_avg_30_rows(t: Tables) -> DataFrame:
    """The moving average over every order in date order: a series of any length."""
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return trailing_mean_of_rows(orders, ["o_orderdate", "o_orderkey"], "o_totalprice", "promedio").drop("o_orderdate")


_SECTORS = " ".join(f"WHEN '{letter}' THEN '{name}'" for letter, name in SECTORS.items())


@query(
    f"""SELECT CASE letra {_SECTORS} ELSE '{OTHER_SECTOR}' END AS sector_economico, total_empresas FROM (
    SELECT chr(CAST(64 + CAST(substr(p_brand, 7) AS INT) AS INT)) AS letra, count(*) AS total_empresas FROM part GROUP BY 1
    ORDER BY total_empresas DESC, letra LIMIT {TOP_SECTORS})"""
)
def topn_sector(t: Tables) -> DataFrame:
    letter = F.char(F.substring("p_brand", 7, 9).cast("int") + 64)
    return gold.flat_companies_by_sector(t.part.select(letter.alias("ciiu_nivel1")), TOP_SECTORS)


@query(
    f"""SELECT anio, provincia, {sql_sum('valor')} AS vab_total FROM ({M.SQL_VALUE_ADDED}) GROUP BY ALL"""
)
def group_sum_two_keys(t: Tables) -> DataFrame:
    return gold.flat_value_added_by_province(M.value_added(t))


@query(
    f"""SELECT periodo, indicador, area, valor AS valor_tasa FROM ({M.SQL_SURVEY})"""
)
def gold_employment_long(t: Tables) -> DataFrame:
    return gold.flat_employment_trend(_employment(t))


@query(
    f"""SELECT provincia, count(*) AS empresas_activas FROM ({M.SQL_COMPANIES})
  WHERE situacion_legal ILIKE '%activ%' GROUP BY provincia"""
)
def filter_like_group(t: Tables) -> DataFrame:
    """Status by substring, which also takes in the inactive companies."""
    return gold.flat_companies_by_province(M.companies(t))


@query(
    f"""SELECT provincia, count(*) AS empresas_activas FROM ({M.SQL_COMPANIES})
  WHERE situacion_legal = 'ACTIVA' GROUP BY provincia"""
)
def filter_equal_group(t: Tables) -> DataFrame:
    return gold.flat_companies_by_province(M.companies(t), substring=False)


def _graduates(t: Tables) -> DataFrame:
    """Shipped quantities by year and province."""
    schools = M.schools(t).join(M.geography(t), "id_geografia")
    graduates = schools.groupBy(
        F.substring_index("anio_lectivo", "-", 1).cast("int").alias("anio"), "provincia"
    ).agg(F.sum("bachilleres_3er_anio").cast("double").alias("bachilleres_3ro"))
    return materialise(graduates, "graduates")  # read twice by the latest year; lineitem once


_FLAT_RATIO = f"""WITH geo AS ({M.SQL_GEOGRAPHY}), schools AS ({M.SQL_SCHOOLS}),
  bach AS (SELECT CAST(split_part(anio_lectivo, '-', 1) AS INT) AS anio, provincia, CAST(sum(bachilleres_3er_anio) AS DOUBLE) AS bachilleres_3ro
    FROM schools JOIN geo USING (id_geografia) GROUP BY ALL),
  emp AS (SELECT provincia, count(*) AS n FROM ({M.SQL_COMPANIES}) WHERE situacion_legal ILIKE '%activ%' GROUP BY ALL)
  SELECT bach.provincia, bachilleres_3ro,
    coalesce(n, 0) AS empresas_activas, {sql_round('bachilleres_3ro / nullif(n, 0)', 3)} AS ratio_bachilleres_por_empresa
  FROM bach LEFT JOIN emp ON emp.provincia = bach.provincia WHERE anio = (SELECT max(anio) FROM bach)"""


@query(_FLAT_RATIO)
def gold_ratio_flat(t: Tables) -> DataFrame:
    return gold.flat_graduates_per_company(_graduates(t), M.companies(t))


@query(
    f"""SELECT n_name, count(*) AS pedidos, {sql_sum('o_totalprice')} AS total FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY n_name"""
)
def latest_period_filter(t: Tables) -> DataFrame:
    """Orders of the latest year by nation; summed per customer before the joins."""
    orders = t.orders.select(F.year("o_orderdate").alias("anio"), "o_custkey", "o_totalprice")
    per_customer = latest_period(orders, "anio").groupBy("o_custkey").agg(
        F.count("*").alias("n"), exact_sum(F.col("o_totalprice")).alias("total")
    )
    customer, nation = t.customer.select("c_custkey", "c_nationkey"), t.nation.select("n_nationkey", "n_name")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("n").alias("pedidos"), F.round(F.sum("total"), 2).cast("double").alias("total"))
    )


@query(
    f"""SELECT n_name, c_mktsegment, clientes,
    {sql_round("CAST(clientes AS DOUBLE) * 100 / sum(clientes) OVER (PARTITION BY n_name)")} AS pct
  FROM (SELECT n_name, c_mktsegment, count(*) AS clientes FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""
)
def share_within_group(t: Tables) -> DataFrame:
    counted = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("clientes"))
    named = counted.join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return share_within(named, ["n_name"], "clientes", "pct").select("n_name", "c_mktsegment", "clientes", "pct")


@query(
    f"""WITH schools AS ({M.SQL_SCHOOLS}), geo AS ({M.SQL_GEOGRAPHY})
  SELECT 'total' AS indicador, '' AS clave, CAST(sum(total_estudiantes) AS BIGINT) AS valor FROM schools
  UNION ALL SELECT 'provincia', provincia, CAST(sum(total_estudiantes) AS BIGINT) FROM schools JOIN geo USING (id_geografia) GROUP BY provincia
  UNION ALL SELECT 'anio_lectivo', anio_lectivo, count(amie) FROM schools GROUP BY anio_lectivo"""
)
def kpi_totals(t: Tables) -> DataFrame:
    return gold.enrolment_figures(M.schools(t), M.geography(t))


@query("SELECT event_type, count(*) AS total FROM events GROUP BY event_type")
def group_count(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("total")).orderBy(F.desc("total"), "event_type")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment", name="value_counts")
def value_counts_segment(t: Tables) -> DataFrame:
    return value_counts(t.customer, "c_mktsegment")


@query(
    "\n  UNION ALL ".join(
        f"SELECT '{view}' AS vista, count(*) AS filas FROM ({ORACLES[key]})"
        for view, key in {
            "gold_pib_tendencia": "gold_gdp_trend",
            "gold_empleo_tendencia": "gold_employment_trend",
            "gold_petroleo_30dias": "moving_avg_30",
            "gold_empresas_provincia": "gold_company_by_region",
            "gold_bachilleres_vs_empresas": "gold_ratio_by_region",
        }.items()
    )
)
def gold_smoke(t: Tables) -> DataFrame:
    """Rows of every view of the star schema."""
    macro, dim_time = _macro(t)
    employment = _employment(t)
    tables = {
        "fact_macro_anual": macro,
        "dim_tiempo": dim_time,
        "fact_empleo": employment.withColumn(
            "indicador", F.when(F.col("indicador") == INDICATOR, gold.K.UNEMPLOYMENT).otherwise(F.col("indicador"))
        ),
        "fact_indicadores_diarios": M.daily(t),
        "fact_ranking_empresarial": M.ranking(t),
        "dim_empresas": M.companies(t),
        "dim_geografia": M.geography(t),
        "fact_oferta_academica": M.schools(t),
    }
    return view_rows(gold.star_views(tables))
