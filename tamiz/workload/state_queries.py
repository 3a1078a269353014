"""Results from what earlier loads left: long series, mergeable counts, partial views, records without a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators import states
from tamiz.operators.columns import flatten
from tamiz.operators.keys import dense_ids
from tamiz.operators.windows import trailing_mean_of_rows
from tamiz.plans import partials
from tamiz.session import materialise, scratch_path
from tamiz.sources import envelope
from tamiz.sources.layers import Layer
from tamiz.workload import mapping as M
from tamiz.workload.gold_queries import _COMPANIES_BY_PROVINCE
from tamiz.workload.registry import ORACLES, Tables, query, sql_round, sql_sum

LAST_YEAR = 2001


@query(
    f"""SELECT serie, o_orderkey, o_totalprice,
    {sql_round('''CAST(sum(CAST(o_totalprice AS DECIMAL(24,6))) OVER w AS DOUBLE) / count(o_totalprice) OVER w''')} AS promedio
  FROM (SELECT *, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 40 END AS serie FROM orders)
  WINDOW w AS (PARTITION BY serie ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
)
def moving_avg_by_series(t: Tables) -> DataFrame:
    """Moving averages of many series at once; one of them, without a name, holds a third of the rows."""
    key = F.col("o_custkey")
    orders = t.orders.select(F.when(key % 3 != 0, key % 40).alias("serie"), "o_orderkey", "o_orderdate", "o_totalprice")
    means = trailing_mean_of_rows(orders, ["o_orderdate", "o_orderkey"], "o_totalprice", "promedio", chunk=1000, series=["serie"])
    return means.drop("o_orderdate")


def _loads(t: Tables, df: DataFrame, date: str) -> list[DataFrame]:
    """A table as two loads arrived: history, and the last year with some days that history has too."""
    year = F.year(date)
    return [df.where(year < LAST_YEAR), df.where((year >= LAST_YEAR) | df[date].isNull())]


@query(
    """SELECT 'orders' AS fuente, min(CAST(o_orderdate AS DATE)) AS minimo, max(CAST(o_orderdate AS DATE)) AS maximo,
    count(DISTINCT date_trunc('month', o_orderdate)) AS periodos, count(*) AS filas, count(*) FILTER (WHERE o_orderstatus = 'P') AS filas_con_nulos FROM orders"""
)
def coverage_of_loads(t: Tables) -> DataFrame:
    """Coverage over two loads from what was stored for each, months that both have counted once."""
    rows = t.orders.select(
        F.col("o_orderdate").cast("date").alias("dia"), F.trunc("o_orderdate", "month").alias("mes"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total"), (F.col("o_orderkey") % 2).alias("carga"),
    )
    layer = Layer(t.spark, scratch_path(t.spark, "coverage"))
    for n in range(2):
        load = rows.where(F.col("carga") == n)
        days = states.coverage_state(load, "orders", "dia", ["total"])
        months = states.coverage_state(load, "orders", "mes")
        layer.put_all({f"dias_{n}": days, f"meses_{n}": months})
    by_day = states.coverage_of([layer.get(f"dias_{n}") for n in range(2)])
    by_month = states.coverage_of([layer.get(f"meses_{n}") for n in range(2)]).select("fuente", "periodos")
    return by_day.drop("periodos").join(by_month, "fuente").select("fuente", "minimo", "maximo", "periodos", "filas", "filas_con_nulos")


@query(
    """SELECT n_name AS canton, count(DISTINCT o_custkey) AS empresas, count(DISTINCT CASE WHEN year(o_orderdate) < 2001 THEN o_custkey END) AS empresas_antes
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name"""
)
def distinct_over_loads(t: Tables) -> DataFrame:
    """Companies by place, exactly, from one stored set for each load; a company of both loads counts once."""
    ids = materialise(dense_ids(t.customer.select("c_custkey", "c_nationkey"), ["c_custkey"], "id_empresa"), "company-ids")
    named = ids.join(t.nation.select("n_nationkey", F.col("n_name").alias("canton")), F.col("c_nationkey") == F.col("n_nationkey"))
    placed = t.orders.select("o_custkey", "o_orderdate").join(named, F.col("o_custkey") == F.col("c_custkey"))
    layer = Layer(t.spark, scratch_path(t.spark, "distinct"))
    for name, load in zip(("antes", "nuevas"), _loads(t, placed, "o_orderdate")):
        layer.put(name, states.distinct_state(load, ["canton"], "id_empresa"))
    before, later = layer.get("antes"), layer.get("nuevas")
    everything = states.count_distinct(states.merge_distinct([before, later], ["canton"]), ["canton"], "empresas")
    only_before = states.count_distinct(before, ["canton"], "empresas_antes")
    return everything.join(only_before, "canton", "left").select("canton", "empresas", F.coalesce("empresas_antes", F.lit(0)).alias("empresas_antes"))


def _partial_layer(t: Tables) -> tuple[Layer, DataFrame, DataFrame]:
    """Partials of the history, then of the last year; the years that are stored are not read again."""
    geography = M.geography(t)
    companies = materialise(M.companies(t), "companies")
    ids = materialise(dense_ids(companies.select("ruc"), ["ruc"], "id_empresa"), "company-ids")
    facts = Layer(t.spark, scratch_path(t.spark, "facts"), {"ranking": ["anio"], "schools": ["anio_lectivo"], "vab": ["anio"]})
    facts.put_all({"ranking": M.ranking(t, by_year=True), "schools": M.schools(t), "vab": M.value_added(t)})
    layer = Layer(t.spark, scratch_path(t.spark, "partials"), partials.PARTITIONS)
    last = f"{LAST_YEAR}-{LAST_YEAR + 1}"
    for old in (True, False):
        def part(name: str, period: str, value) -> DataFrame:  # noqa: E306
            rows = facts.get(name)
            return rows.where((F.col(period) < value) if old else (F.col(period) >= value))

        partials.append(layer, {
            **partials.ranking_partials(part("ranking", "anio", LAST_YEAR), ids),
            partials.GRADUATES: partials.school_partial(part("schools", "anio_lectivo", last)),
            partials.VALUE_ADDED: partials.value_added_partial(part("vab", "anio", LAST_YEAR)),
        })
    by_province = partials.companies_by_province(layer.get(partials.REVENUE), layer.get(partials.COMPANIES), companies, ids, geography)
    return layer, geography, by_province


@query(_COMPANIES_BY_PROVINCE)
def companies_from_partials(t: Tables) -> DataFrame:
    """The company view from partials by year: sums, and sets of companies."""
    return _partial_layer(t)[2]


@query(ORACLES["gold_ratio_by_region"])
def graduates_from_partials(t: Tables) -> DataFrame:
    """The view of graduates from the newest partial alone."""
    layer, geography, by_province = _partial_layer(t)
    return partials.graduates_by_province(layer, geography, by_province)


@query(f"SELECT anio, provincia, {sql_sum('valor')} AS vab_total FROM ({M.SQL_VALUE_ADDED}) GROUP BY anio, provincia")
def value_added_from_partials(t: Tables) -> DataFrame:
    layer = _partial_layer(t)[0]
    return partials.value_added_by_province(layer.get(partials.VALUE_ADDED))


_LATE = "event_id % 3 = 0"


@query(
    f"""SELECT event_id, CASE WHEN {_LATE} THEN event_id + 0.5 ELSE CAST(event_id AS DOUBLE) END AS metricas_monto,
    CASE WHEN {_LATE} THEN event_type END AS metricas_clase, CASE WHEN {_LATE} THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS usuario,
    CASE WHEN {_LATE} THEN user_id % 2 = 0 END AS nuevo FROM events"""
)
def records_without_schema(t: Tables) -> DataFrame:
    """Records stored as they came. A later load brings a new key, a wider number and a text where a number was."""
    late = F.expr(_LATE)
    old = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"metricas":{"monto":'), "event_id", F.lit('},"usuario":'), "user_id", F.lit(',"nuevo":null}'))
    new = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"metricas":{"monto":'), "event_id", F.lit('.5,"clase":"'), "event_type",
        F.lit('"},"usuario":"u'), "user_id", F.lit('","nuevo":'), (F.col("user_id") % 2 == 0).cast("string"), F.lit("}"),
    )
    layer = Layer(t.spark, scratch_path(t.spark, "variants"))
    schema = None
    for name, rows, payload in (("antes", t.events.where(~late), old), ("nuevas", t.events.where(late), new)):
        load = rows.select(F.lit("A").alias(envelope.INDICATOR), payload.alias(envelope.PAYLOAD))
        stored = layer.put(name, envelope.as_variants(load))
        found = envelope.variant_schema(stored)
        schema = found if schema is None else envelope.join_schemas(schema, found)
    records = layer.get("antes").unionByName(layer.get("nuevas"))
    return flatten(envelope.read_variants(records, schema), "record")


@query(
    """SELECT clave, count(*) AS registros, CAST(sum(n) AS BIGINT) AS suma FROM (
    SELECT 'event_id' AS clave, event_id AS n FROM events UNION ALL SELECT 'm.a', user_id FROM events
    UNION ALL SELECT 'm.o.b', event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'm.lista', 0 FROM events) GROUP BY clave"""
)
def record_leaves(t: Tables) -> DataFrame:
    """Every value of nested records in long form, whatever keys they have."""
    inner = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"o":{"b":'), "event_id", F.lit("}"))).otherwise(F.lit(',"o":{}'))
    payload = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"m":{"a":'), "user_id", inner, F.lit(',"lista":[1,2]}}'))
    rows = t.events.select(F.lit("A").alias(envelope.INDICATOR), payload.alias(envelope.PAYLOAD))
    records = materialise(envelope.as_variants(rows), "variants")
    leaves = envelope.variant_leaves(t.spark, records, envelope.variant_schema(records))
    number = F.coalesce(F.col("valor").try_cast("bigint"), F.lit(0))
    return leaves.groupBy("clave").agg(F.count("*").alias("registros"), F.sum(number).alias("suma"))
