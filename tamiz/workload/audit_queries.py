"""Data-quality reports on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.operators import audits
from tamiz.operators.columns import conform_losses
from tamiz.operators.summary import null_counts, repeated_keys, share_where, top
from tamiz.plans import refresh
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables, query, sql_round

# Parents are cut down so that there are orphans: the driver tables have none.
REFERENCES = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderstatus <> 'P'"),
    ("lineitem", "l_partkey", "part", "p_partkey", "p_size > 3"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", "true"),
    ("orders", "o_custkey", "customer", "c_custkey", "c_mktsegment <> 'BUILDING'"),
    ("customer", "c_nationkey", "nation", "n_nationkey", "n_regionkey <> 1"),
    ("supplier", "s_nationkey", "nation", "n_nationkey", "n_regionkey <> 1"),
    ("nation", "n_regionkey", "region", "r_regionkey", "r_regionkey <> 1"),
    ("labels", "doc_id", "documents", "doc_id", "lang <> 'de'"),
)


def _sql_reference(child: str, column: str, parent: str, key: str, condition: str) -> str:
    total, missing = f"count({column})", f"count({column}) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column} AND {condition}))"
    return f"""SELECT '{child}' AS tabla, '{column}' AS columna, '{parent}' AS tabla_referida, con_valor, sin_referencia,
    coalesce({sql_round('sin_referencia * 100 / nullif(con_valor, 0)', 3)}, 0) AS pct_sin_referencia
  FROM (SELECT count(*) AS con_valor, count(*) - count(hit) AS sin_referencia FROM {child} c
    LEFT JOIN (SELECT {key} AS k, 1 AS hit FROM {parent} WHERE {condition}) ON k = c.{column})"""


@query("\n  UNION ALL ".join(_sql_reference(*r) for r in REFERENCES))
def fk_check_all(t: Tables) -> DataFrame:
    """All declared references in one report."""
    by_child: dict[str, list] = {}
    for child, column, parent, key, condition in REFERENCES:
        by_child.setdefault(child, []).append((column, parent, getattr(t, parent).where(condition), key))
    return audits.union_all([audits.child_references(getattr(t, child), child, own) for child, own in by_child.items()])


@query(
    """SELECT l_partkey AS clave, count(*) AS filas FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 3) GROUP BY l_partkey"""
)
def fk_orphans(t: Tables) -> DataFrame:
    return audits.orphan_keys(t.lineitem, "l_partkey", t.part.where(F.col("p_size") > 3), "p_partkey")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 15"""
)
def duplicate_keys(t: Tables) -> DataFrame:
    """The fifteen most repeated keys."""
    keys = ["l_orderkey", "l_linenumber"]
    return top(repeated_keys(t.lineitem, keys), "n", 15, keys)


@query(
    """SELECT count(*) AS claves_repetidas, CAST(sum(n - 1) AS BIGINT) AS filas_sobrantes FROM (
    SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def duplicate_summary(t: Tables) -> DataFrame:
    return audits.duplicate_summary(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    f"""SELECT 'o_orderpriority' AS columna, count(*) AS filas, count(*) FILTER (WHERE o_orderpriority IN ('5-LOW', '2-HIGH')) AS vacias,
    {sql_round("count(*) FILTER (WHERE o_orderpriority IN ('5-LOW', '2-HIGH')) * 100 / count(*)")} AS pct_vacias FROM orders"""
)
def blank_key_share(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    gaps = F.when(priority == "5-LOW", F.lit(None)).when(priority == "2-HIGH", " \t").otherwise(priority)
    return audits.blank_share(t.orders.select(gaps.alias("o_orderpriority")), "o_orderpriority")


@query(
    f"""SELECT count(*) AS filas, count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')) AS sin_coincidencia,
    {sql_round("count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')) * 100 / count(*)")} AS pct_sin_coincidencia FROM orders"""
)
def unmatched_share(t: Tables) -> DataFrame:
    """Ranking rows whose file number the directory does not have."""
    lookup = M.companies(t).where(F.col("ciiu_n6") != "MACHINERY").withColumn("ruc", F.col("ruc").cast("string"))
    rows = t.orders.select(F.col("o_custkey").alias("expediente"))
    return audits.unmatched_share(refresh.ranking_matches(rows, refresh.directory_lookup(lookup)), "ruc")


@query(
    f"""SELECT l_returnflag, {sql_round("count(*) FILTER (WHERE l_discount > 0.05) * 100 / count(*)")} AS pct_descuento FROM lineitem GROUP BY l_returnflag"""
)
def share_where_discount(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(share_where(F.col("l_discount") > 0.05).alias("pct_descuento"))


_TYPES = {
    "region": ("r_regionkey int", "r_name string"),
    "nation": ("n_nationkey int", "n_name string", "n_regionkey int"),
    "customer": ("c_custkey bigint", "c_name string", "c_nationkey int", "c_acctbal double", "c_mktsegment string"),
    "supplier": ("s_suppkey bigint", "s_name string", "s_nationkey int", "s_acctbal double"),
    "part": ("p_partkey bigint", "p_name string", "p_brand string", "p_type string", "p_size int", "p_retailprice double"),
    "lineitem": (
        "l_orderkey bigint", "l_partkey bigint", "l_suppkey bigint", "l_linenumber int", "l_quantity double", "l_extendedprice double",
        "l_discount double", "l_tax double", "l_returnflag string", "l_linestatus string", "l_shipdate timestamp_ntz",
    ),
    "events": ("event_id bigint", "ts timestamp_ntz", "user_id bigint", "event_type string", "value double", "props string"),
    "pages": ("page_id bigint", "url string", "html string"),
    "benchmark": ("item_id bigint", "text string"),
    "labels": ("doc_id bigint", "quality int", "toxic int"),
    "orders": (
        "o_orderkey bigint", "o_custkey bigint", "o_orderstatus string", "o_totalprice double",
        "o_orderdate timestamp_ntz", "o_orderpriority string",
    ),
    "documents": ("doc_id bigint", "text string", "lang string", "source string", "n_chars bigint"),
    "embeddings": ("vec_id bigint", "embedding array<float>", "label int"),
    "conversations": ("conv_id bigint", "turn bigint", "role string", "text string"),
}


@query(
    "\n  UNION ALL ".join(
        f"SELECT '{name}' AS tabla, (SELECT count(*) FROM {name}) AS filas, '{column.split()[0]}' AS columna, '{column.split()[1]}' AS tipo"
        for name, columns in _TYPES.items()
        for column in columns
    )
)
def table_inventory(t: Tables) -> DataFrame:
    return audits.inventory({name: getattr(t, name) for name in _TYPES})


@query(
    """SELECT 'pedidos' AS fuente, CAST(min(year(o_orderdate)) AS INT) AS minimo, CAST(max(year(o_orderdate)) AS INT) AS maximo,
    count(DISTINCT year(o_orderdate)) AS periodos, count(*) AS filas, count(*) FILTER (WHERE o_orderpriority IN ('5-LOW') OR o_orderstatus = 'P') AS filas_con_nulos FROM orders
  UNION ALL SELECT 'envios', CAST(min(year(l_shipdate)) AS INT), CAST(max(year(l_shipdate)) AS INT), count(DISTINCT year(l_shipdate)), count(*), 0 FROM lineitem"""
)
def coverage_stats(t: Tables) -> DataFrame:
    """Periods two sources cover, side by side."""
    orders = t.orders.select(
        F.year("o_orderdate").alias("anio"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("a"), F.nullif("o_orderstatus", F.lit("P")).alias("b")
    )
    lines = t.lineitem.select(F.year("l_shipdate").alias("anio"))
    return audits.union_all([audits.coverage(orders, "pedidos", "anio", ["a", "b"]), audits.coverage(lines, "envios", "anio")])


@query(
    """SELECT columna, nulos, nulos = total AS vacia FROM (
    SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS l_returnflag, count(*) FILTER (WHERE l_tax = 0) AS l_tax,
      count(*) AS l_discount, 0 AS l_quantity FROM lineitem),
    LATERAL (VALUES ('l_returnflag', l_returnflag), ('l_tax', l_tax), ('l_discount', l_discount), ('l_quantity', l_quantity)) v(columna, nulos)"""
)
def null_profile(t: Tables) -> DataFrame:
    """NULLs per column, most first, and columns that are empty."""
    gaps = t.lineitem.select(
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.lit(None).cast("double").alias("l_discount"), "l_quantity",
    )
    return null_counts(gaps).orderBy(F.desc("nulos"), "columna").limit(15)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_linenumber + floor(l_quantity / 2) AS partes, count(*) AS veces FROM lineitem
  WHERE l_quantity <> l_linenumber + floor(l_quantity / 2) GROUP BY ALL"""
)
def balance_check(t: Tables) -> DataFrame:
    """Rows whose total is not the sum of two parts."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.floor(F.col("l_quantity") / 2).alias("mitad")
    )
    odd = audits.unbalanced(lines, "l_quantity", ["l_linenumber", "mitad"])
    return odd.groupBy(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (F.col("l_linenumber") + F.col("mitad")).cast("double").alias("partes")
    ).agg(F.count("*").alias("veces"))


@query(
    """SELECT columna, perdidos AS valores_perdidos FROM (SELECT count(*) FILTER (WHERE o_orderpriority <> '') AS a, 0 AS b FROM orders),
    LATERAL (VALUES ('o_orderpriority', a), ('o_orderkey', b)) v(columna, perdidos)"""
)
def conform_losses_orders(t: Tables) -> DataFrame:
    """Values a stricter type cannot hold."""
    return conform_losses(t.orders, T.StructType.fromDDL("o_orderpriority INT, o_orderkey STRING"))


@query(
    """SELECT 'customer' AS tabla, 'c_custkey' AS clave, 0 AS claves_repetidas, 0 AS filas_sobrantes
  UNION ALL SELECT 'events', 'user_id, event_type', count(*), CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1)"""
)
def unique_check(t: Tables) -> DataFrame:
    """Repeats of keys declared unique."""
    return audits.check_unique(
        {"customer": t.customer, "events": t.events}, {"customer": ["c_custkey"], "events": ["user_id", "event_type"]}
    )


@query(
    """SELECT 'orders' AS tabla, 'o_orderkey' AS columna, 0 AS nulos
  UNION ALL SELECT 'orders', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM orders
  UNION ALL SELECT 'part', 'p_brand', count(*) FILTER (WHERE p_size > 40) FROM part"""
)
def required_check(t: Tables) -> DataFrame:
    """NULLs in columns declared as required."""
    orders = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    part = t.part.withColumn("p_brand", F.when(F.col("p_size") <= 40, F.col("p_brand")))
    declared = {
        "orders": T.StructType.fromDDL("o_orderkey BIGINT NOT NULL, o_orderpriority STRING NOT NULL, o_orderdate TIMESTAMP"),
        "part": T.StructType.fromDDL("p_brand STRING NOT NULL"),
    }
    return audits.check_required({"orders": orders, "part": part}, declared)


@query("SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]') ORDER BY doc_id LIMIT 10")
def accented_sample(t: Tables) -> DataFrame:
    return audits.accented_sample(t.documents.select("doc_id", "text"), "text", ["doc_id"])


@query(
    """SELECT CAST(year(o_orderdate) AS INT) AS anio, o_orderpriority, count(*) AS total FROM orders GROUP BY ALL"""
)
def period_counts(t: Tables) -> DataFrame:
    """Rows per period and indicator."""
    return t.orders.groupBy(F.year("o_orderdate").alias("anio"), "o_orderpriority").agg(F.count("*").alias("total")).orderBy("anio", "o_orderpriority")
