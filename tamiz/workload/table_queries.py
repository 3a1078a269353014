"""Sources and sinks on the driver tables. Each run writes to a fresh folder and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.numbers import exact_sum, half_up, number_or_null
from tamiz.functions.text import strip
from tamiz.operators import audits
from tamiz.plans import silver
from tamiz.plans import contract as K
from tamiz.session import scratch_path
from tamiz.sources import files, tables
from tamiz.streaming.batches import load_in_batches
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables, query, sql_avg, sql_sum


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_roundtrip(t: Tables) -> DataFrame:
    """A wide ``;`` CSV written, then three of its columns read by name in forced types."""
    path = scratch_path(t.spark, "csv")
    tables.write_csv(t.supplier, path)
    wanted = {"s_suppkey": T.LongType(), "s_name": T.StringType(), "s_acctbal": T.DoubleType(), "s_phone": T.StringType()}
    return files.read_csv_columns(t.spark, path, wanted, sep=";")


@query("SELECT c_custkey, 'Compañía ' || c_name AS nombre, c_acctbal FROM customer")
def csv_latin1(t: Tables) -> DataFrame:
    """A ``;`` CSV in Latin-1."""
    path = scratch_path(t.spark, "csv-latin1")
    named = t.customer.select("c_custkey", F.concat(F.lit("Compañía "), "c_name").alias("nombre"), "c_acctbal")
    named.write.options(header=True, sep=";", encoding=files.LATIN1, **files.QUOTES).csv(path)
    return files.read_csv(t.spark, path, named.schema, ";", files.LATIN1)


@query(
    "SELECT doc_id, lang, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents"
)
def charset_fallback(t: Tables) -> DataFrame:
    """CSV files of whole texts, some in UTF-8 and some in Latin-1, read together."""
    path = scratch_path(t.spark, "csv-charsets")
    lines = t.documents.select("doc_id", "lang", strip(F.regexp_replace("text", r"\s+", " ")).alias("text"))
    spanish = F.col("lang") == "es"
    for rows, encoding in ((lines.where(spanish), files.LATIN1), (lines.where(~spanish), files.UTF8)):
        rows.write.mode("append").options(header=True, encoding=encoding, **files.QUOTES).csv(path)
    return files.read_csv_any_charset(t.spark, path, lines.schema)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS codigo, s_name AS nombre, s_acctbal AS saldo FROM supplier")
def preamble_scan(t: Tables) -> DataFrame:
    """A sheet exported as CSV: titles, then a header found by its first cell, then the data."""
    path = scratch_path(t.spark, "sheet")
    titles = t.spark.createDataFrame([("Reporte de proveedores;;",), ("Fecha de corte;;",), (";;",), ("Años;Nombre;Saldo",)], "value string")
    rows = t.supplier.select(F.concat_ws(";", "s_suppkey", "s_name", "s_acctbal").alias("value"))
    titles.coalesce(1).unionByName(rows).write.text(path)
    sheet = files.read_sheet_below_marker(t.spark, path, K.GDP_MARKER, sep=";")
    return sheet.select(F.col("Años").alias("codigo"), F.col("Nombre").alias("nombre"), number_or_null(F.col("Saldo")).alias("saldo"))


@query(
    f"""SELECT CAST(year(o_orderdate) AS INT) AS anio, {sql_avg('o_totalprice')} AS valor FROM orders GROUP BY ALL"""
)
def preamble_by_position(t: Tables) -> DataFrame:
    """A sheet read by position, its titles and footer dropped for want of a key."""
    path = scratch_path(t.spark, "sheet-position")
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("anio")).agg(half_up(F.sum(F.col("o_totalprice").cast("decimal(24,6)")).cast("double") / F.count("*"), 2).alias("valor"))
    extra = t.spark.createDataFrame([("Título,,",), ("Años,b,Valor",), ("Fuente: propia,,",)], "value string")
    rows = yearly.select(F.concat_ws(",", F.concat("anio", F.lit(" (p)")), F.lit("x"), "valor").alias("value"))
    extra.unionByName(rows).write.text(path)
    sheet = files.read_sheet(t.spark, path, ["anio", "b", "valor"], F.col("anio").rlike(r"^\d{4}"))
    return sheet.select(silver.year_of_label(F.col("anio")).alias("anio"), number_or_null(F.col("valor")).alias("valor"))


@query("SELECT c_custkey, upper(c_mktsegment) AS segmento, c_acctbal FROM customer")
def table_replace(t: Tables) -> DataFrame:
    """A table written twice, left alone by an empty load, archived and rebuilt."""
    path, archive = scratch_path(t.spark, "flat"), scratch_path(t.spark, "staged")
    flat = t.customer.select("c_custkey", F.lower("c_mktsegment").alias("segmento"), "c_acctbal")
    for _ in range(2):
        tables.replace_table(flat, path)
    if tables.replace_unless_empty(flat.where(F.lit(False)), path):
        raise RuntimeError("an empty frame replaced a table")
    tables.archive_and_rebuild(t.spark, path, archive, lambda df: df.withColumn("segmento", F.upper("segmento")))
    return tables.read_table(t.spark, path)


_BY_YEAR = f"SELECT CAST(year(o_orderdate) AS INT) AS anio, count(*) AS n, {sql_sum('o_totalprice')} AS total FROM orders GROUP BY ALL"
LAST_YEAR = 2001


@query(_BY_YEAR)
def period_append_guard(t: Tables) -> DataFrame:
    """History, then the last year appended twice: the second time adds nothing."""
    path = scratch_path(t.spark, "periods")
    orders = t.orders.select(F.year("o_orderdate").alias("anio"), "o_orderkey", "o_totalprice")
    tables.replace_table(orders.where(F.col("anio") < LAST_YEAR), path, ["anio"])
    for _ in range(2):
        tables.append_new_periods(orders.where(F.col("anio") == LAST_YEAR), path, "anio")
    return tables.read_table(t.spark, path).groupBy("anio").agg(
        F.count("*").alias("n"), half_up(exact_sum(F.col("o_totalprice")), 2).alias("total")
    )


@query(
    """SELECT c_custkey, CASE WHEN n IS NULL THEN c_acctbal WHEN n = 1 THEN NULL ELSE miles END AS saldo, n IS NOT NULL AS actualizada
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(24,6))), 2) AS DOUBLE) / 1000 AS miles
    FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey"""
)
def update_from_source(t: Tables) -> DataFrame:
    """Balances replaced by scaled order totals where there are any, NULL totals included."""
    path = scratch_path(t.spark, "balances")
    tables.replace_table(t.customer.select("c_custkey", F.col("c_acctbal").alias("saldo")), path)
    totals = t.orders.where(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), half_up(exact_sum(F.col("o_totalprice")), 2).alias("total")
    )
    source = totals.select("c_custkey", F.when(F.col("n") > 1, F.col("total") / 1000).alias("saldo"))
    tables.refresh_in_place(
        t.spark, path, lambda old: tables.update_matched(old, source, "c_custkey", ["saldo"], flag="actualizada")
    )
    return tables.read_table(t.spark, path)


@query(f"SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, {sql_sum('value')} AS valor FROM events GROUP BY event_type")
def chunked_append(t: Tables) -> DataFrame:
    """The envelope loaded in bounded batches, its payload flattened on the way."""
    target, chunks = scratch_path(t.spark, "loaded"), scratch_path(t.spark, "chunks")
    M.envelope(t).repartition(8).write.parquet(chunks)
    flat = lambda batch: batch.select(
        F.col("INDICADOR").alias("event_type"), F.from_json("DATOS_JSON", M.PAYLOAD_SCHEMA).alias("r")
    ).select("event_type", "r.event_id", number_or_null(F.col("r.metricas.monto_usd")).alias("valor"))
    load_in_batches(t.spark, chunks, t.spark.read.parquet(chunks).schema, target, flat, files_per_batch=3)
    return tables.read_table(t.spark, target).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"), half_up(exact_sum(F.col("valor")), 2).alias("valor")
    )


@query(
    "SELECT count(*) FILTER (WHERE year(o_orderdate) < 2001) AS antes, count(*) AS despues, count(*) FILTER (WHERE year(o_orderdate) >= 2001) AS nuevas FROM orders",
    name="load_delta",
)
def load_delta_orders(t: Tables) -> DataFrame:
    """Row counts before and after a load."""
    year = F.year("o_orderdate")
    return audits.load_delta(t.orders.where(year < LAST_YEAR), t.orders)
