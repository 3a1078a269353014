"""Scalar functions as column jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.charset import damage, repair_mojibake
from tamiz.functions.labels import growth_class
from tamiz.functions.numbers import (
    amount_or_null, exact_sum, half_up, integer_or_zero, number_or_null, number_or_zero, row_sum,
)
from tamiz.functions.periods import period_date, period_text, year_start
from tamiz.functions.text import geo_key, missing_to_null, strip_label, strip_upper
from tamiz.operators.audits import charset_scores, damaged_text
from tamiz.operators.rows import blank_counts, clear_blank, clear_missing
from tamiz.plans import indicators, silver
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables, query, sql_sum

# Letters the documents hold, for the SQL side (whose upper case of ß is one letter).
_TRIMMED = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"
_FOLD = f"translate(upper(replace({_TRIMMED}, 'ß', 'SS')), 'ÁÄÇÈÉÊÍÑÓÖÚÜ', 'AACEEEINOOUU')"


@query(f"SELECT doc_id, regexp_replace({_FOLD}, '[^\\x00-\\x7F]+', '', 'g') AS clave FROM documents")
def geo_text_key(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", geo_key(F.col("text")).alias("clave"))


@query("SELECT doc_id, text AS reparado, text AS intacto, regexp_matches(text, '[^\\x00-\\x7F]') AS danado FROM documents")
def mojibake_repair(t: Tables) -> DataFrame:
    """Texts damaged on purpose, repaired; and sound texts, which must come back as they are."""
    text = F.col("text")
    broken = t.documents.select("doc_id", "text", damage(text).alias("malo"))
    return broken.select(
        "doc_id",
        repair_mojibake(F.col("malo")).alias("reparado"),
        repair_mojibake(text).alias("intacto"),
        (F.col("malo") != text).alias("danado"),
    )


@query(
    """SELECT 'malo' AS columna, count(*) AS filas, count(*) FILTER (WHERE regexp_matches(text, '[À-ÿ]')) AS con_marcas,
    count(*) FILTER (WHERE regexp_matches(text, '[^\\x00-\\x7F]')) AS no_ascii FROM documents"""
)
def mojibake_scan(t: Tables) -> DataFrame:
    return damaged_text(t.documents.select(damage(F.col("text")).alias("malo")), "malo")


@query(
    """SELECT charset, count(*) AS filas, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS decodificadas,
    CAST(round(CAST(count(*) FILTER (WHERE ok) * 100 / count(*) AS DECIMAL(38,6)), 2) AS DOUBLE) AS pct
  FROM (SELECT 'cp1252' AS charset, true AS ok FROM documents
    UNION ALL SELECT 'cp437', NOT regexp_matches(text, '[^\\x00-\\x7F]') FROM documents) GROUP BY charset"""
)
def charset_score(t: Tables) -> DataFrame:
    """Which reversal decodes texts that were misread as cp1252."""
    return charset_scores(t.documents.select(damage(F.col("text")).alias("malo")), "malo", ["cp437", "cp1252"])


@query(
    f"""SELECT l_returnflag, count(*) AS filas, count(precio) AS montos, {sql_sum('precio')} AS total,
    {sql_sum('CASE WHEN precio < 1000 THEN precio END')} AS total_sin_comas,
    CAST(sum(CASE WHEN l_tax = 0.08 THEN 0 ELSE l_quantity END) AS BIGINT) AS enteros,
    CAST(sum(trunc(l_discount * 100)) AS BIGINT) AS centesimas
  FROM (SELECT *, CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS precio FROM lineitem) GROUP BY l_returnflag"""
)
def tolerant_number(t: Tables) -> DataFrame:
    """Amounts written with commas or as a missing-value text, counts as text, decimals cut."""
    missing = F.col("l_tax") == 0.08
    grouped = F.trim(F.format_number("l_extendedprice", 2))
    dirty = t.lineitem.select(
        "l_returnflag",
        F.when(missing, F.lit(" None ")).otherwise(F.concat(F.lit(" "), grouped)).alias("monto"),
        F.when(missing, F.lit("n/d")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("cantidad"),
        F.format_number(F.col("l_discount") * 100, 1).alias("decimal"),
    )
    return dirty.groupBy("l_returnflag").agg(
        F.count("*").alias("filas"),
        F.count(amount_or_null(F.col("monto"))).alias("montos"),
        half_up(exact_sum(amount_or_null(F.col("monto"))), 2).alias("total"),
        half_up(exact_sum(number_or_null(F.col("monto"))), 2).alias("total_sin_comas"),
        F.sum(integer_or_zero(F.col("cantidad"))).alias("enteros"),
        F.sum(number_or_zero(F.col("decimal"))).alias("centesimas"),
    )


@query(
    """SELECT CAST(fecha AS VARCHAR) AS fecha, CAST(year(fecha) AS INT) AS anio, CAST(quarter(fecha) AS INT) AS trimestre, count(*) AS n FROM (
    SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL
      WHEN o_orderdate >= DATE '1999-01-01' THEN CAST(o_orderdate AS DATE)
      ELSE make_date(2000 + CAST(strftime(o_orderdate, '%y') AS BIGINT), month(o_orderdate), 1) END AS fecha FROM orders) GROUP BY ALL"""
)
def period_parse(t: Tables) -> DataFrame:
    """Round labels in both of their forms, and some that are neither."""
    date = F.col("o_orderdate").cast("date")
    label = (
        F.when(F.col("o_orderpriority") == "5-LOW", "sin fecha")
        .when(F.col("o_orderdate") >= F.lit("1999-01-01").cast("date"), F.concat(date.cast("string"), F.lit(" 00:00:00")))
        .otherwise(F.concat(F.lit(" "), F.initcap(period_text(date))))
    )
    parsed = t.orders.select(label.alias("periodo")).select(period_date(F.col("periodo")).alias("fecha"))
    return (
        parsed.groupBy("fecha")
        .agg(F.count("*").alias("n"))
        .select(F.col("fecha").cast("string").alias("fecha"), F.year("fecha").alias("anio"), F.quarter("fecha").alias("trimestre"), "n")
    )


@query(
    f"""WITH yearly AS ({M.SQL_YEARLY}), realgdp AS ({M.SQL_GDP_REAL})
  SELECT anio, pib_real_musd, variacion_pib_pct, CAST(anio AS VARCHAR) || '-01-01' AS fecha,
    CAST(anio AS VARCHAR) || '-' || CAST(anio + 1 AS VARCHAR) AS anio_lectivo FROM realgdp"""
)
def suffix_strip(t: Tables) -> DataFrame:
    """A yearly sheet whose labels carry ``(p)``, cleaned as the real series; school-year labels."""
    real = M.gdp_real(t)
    sheet = real.select(
        F.concat("anio", F.when(F.col("anio") >= 2000, " (p)").otherwise("")).alias("Años"),
        F.col("pib_real_musd").cast("string"), F.col("poblacion_miles").cast("string"), F.lit("1").alias("pc"),
        F.col("variacion_pib_pct").cast("string"),
    )
    label = F.concat("anio", F.lit("-"), F.col("anio") + 1, F.lit(" Inicio "))
    return silver.gdp_real(sheet).select(
        "anio", "pib_real_musd", "variacion_pib_pct", year_start(F.col("anio")).cast("string").alias("fecha"),
        strip_label(label, " Inicio").alias("anio_lectivo"),
    )


@query(
    f"""SELECT anio, pib_percapita_nominal_usd, CAST(anio AS VARCHAR) || '-01-01' AS fecha FROM ({M.SQL_GDP_NOMINAL}) WHERE anio >= 2000"""
)
def nominal_since_2000(t: Tables) -> DataFrame:
    """The nominal series: columns by position, provisional marks, years from 2000 on."""
    sheet = M.gdp_nominal(t).select(
        F.concat("periodo", F.lit(" (p)")).alias("Años"), F.lit("").alias("b"), F.lit("").alias("c"),
        F.col("pib_percapita_nominal_usd").cast("string").alias("d"),
    )
    return silver.gdp_nominal(sheet).select(
        F.col("periodo").alias("anio"), "pib_percapita_nominal_usd", F.col("fecha").cast("string").alias("fecha")
    )


@query("SELECT c_custkey, upper(c_name) AS nombre, upper(c_mktsegment) AS segmento FROM customer")
def trim_upper(t: Tables) -> DataFrame:
    padded = t.customer.select(
        "c_custkey",
        F.concat(F.lit("\t "), F.lower("c_name"), F.lit(" \n")).alias("nombre"),
        F.concat(F.lit("　"), F.initcap("c_mktsegment")).alias("segmento"),
    )
    return padded.withColumns({c: strip_upper(F.col(c)) for c in ("nombre", "segmento")})


@query(
    """SELECT coalesce(p_brand_limpia, 'NULO') AS marca, coalesce(p_type, 'NULO') AS tipo, count(*) AS n FROM (
    SELECT CASE WHEN p_size <= 15 THEN NULL ELSE p_brand END AS p_brand_limpia, CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS p_type FROM part) GROUP BY ALL"""
)
def sentinel_to_null(t: Tables) -> DataFrame:
    """Missing values spelt in several ways become NULL; so does blank text of code columns."""
    size = F.col("p_size")
    spelled = F.when(size <= 5, "None").when(size <= 10, " nan ").when(size <= 15, "").otherwise(F.col("p_brand"))
    dirty = t.part.select(spelled.alias("marca"), F.when(size == 50, "   ").otherwise(F.col("p_type")).alias("tipo"))
    clean = clear_blank(clear_missing(dirty, ["marca"]), ["tipo"])
    filled = clean.select([F.coalesce(c, F.lit("NULO")).alias(c) for c in clean.columns])
    return filled.groupBy("marca", "tipo").agg(F.count("*").alias("n"))


@query(
    """SELECT 'p_brand' AS columna, count(*) FILTER (WHERE p_size <= 10) AS filas_limpiadas FROM part
  UNION ALL SELECT 'p_type', count(*) FILTER (WHERE p_size = 50) FROM part"""
)
def blank_cleanup_counts(t: Tables) -> DataFrame:
    size = F.col("p_size")
    dirty = t.part.select(
        F.when(size <= 10, "  ").otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(size == 50, "\t").otherwise(F.col("p_type")).alias("p_type"),
    )
    return blank_counts(dirty, ["p_brand", "p_type"])


@query(
    """SELECT CAST(year(l_shipdate) AS INT) AS anio, n_name AS provincia,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END + CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber END) AS DOUBLE) AS bachilleres_3ro
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
    name="row_sum",
)
def row_sum_graduates(t: Tables) -> DataFrame:
    """Two sibling columns with gaps added per row, then by year and province."""
    lines = t.lineitem.select(
        "l_suppkey",
        F.year("l_shipdate").alias("anio_base"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("bachillerato_3er_ano_m"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("bachillerato_3er_ano_h"),
    )
    named = lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.nation.select("n_nationkey", F.col("n_name").alias("institucion_provincia")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return indicators.graduates(named.drop("l_suppkey", "s_suppkey", "s_nationkey", "n_nationkey"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + CASE WHEN l_tax > 0 THEN l_tax ELSE 0 END AS suma,
    CASE WHEN l_discount * 100 - 5 > 2 THEN 'Crecimiento fuerte' WHEN l_discount * 100 - 5 > 0 THEN 'Crecimiento moderado'
      WHEN l_discount * 100 - 5 = 0 THEN 'Estancamiento' ELSE 'Contracción' END AS clase, count(*) AS veces
  FROM lineitem GROUP BY ALL"""
)
def row_functions(t: Tables) -> DataFrame:
    """Row sum with missing parts and the growth class, line by line."""
    rate = F.col("l_discount") * 100 - 5
    shaped = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        row_sum(F.col("l_quantity"), F.when(F.col("l_tax") > 0, F.col("l_tax"))).alias("suma"),
        growth_class(rate).alias("clase"),
    )
    return shaped.groupBy(*shaped.columns).agg(F.count("*").alias("veces"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang, source FROM documents")
def missing_text(t: Tables) -> DataFrame:
    lang = F.when(F.col("lang") == "en", " NaN").otherwise(F.concat(F.col("lang"), F.lit(" ")))
    return t.documents.select("doc_id", missing_to_null(lang).alias("lang"), "source")
