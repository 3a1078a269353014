"""The driver tables seen as the inputs of the analytics jobs.

Company = customer, school = supplier, province = region, canton = nation, industry code =
market segment, school year and survey rounds = dates of orders and shipments. The tables are
clean, so damage (accents, missing-value texts, commas) is made by expression where a job
needs it. Each mapping has its SQL beside it, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.numbers import EXACT, exact_avg, exact_sum, half_up, ratio
from tamiz.functions.periods import MONTHS, period_text
from tamiz.plans.contract import BRANCHES
from tamiz.plans.star import with_province
from tamiz.session import materialise
from tamiz.workload.registry import Tables, sql_avg, sql_round, sql_sum

ACTIVE_BALANCE = 2500

SQL_MONTH = "list_extract([" + ", ".join(f"'{m}'" for m in MONTHS) + "], CAST(month({0}) AS INT))"


def accented(c: Column) -> Column:
    """Lower case with two accented letters and spaces around, as a careless source writes it."""
    return F.concat(F.lit(" "), F.translate(F.lower(c), "ao", "áó"), F.lit("  "))


def geography(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    region = t.region.select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("id_geografia"),
        F.col("r_name").alias("provincia"),
        F.col("n_name").alias("canton"),
    )


SQL_GEOGRAPHY = """SELECT CAST(n_nationkey + 1 AS BIGINT) AS id_geografia, r_name AS provincia, n_name AS canton
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


def companies(t: Tables) -> DataFrame:
    customer = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    joined = customer.join(geography(t), F.col("c_nationkey") + 1 == F.col("id_geografia"))
    return joined.select(
        F.col("c_custkey").alias("ruc"),
        F.col("c_custkey").alias("expediente"),
        F.col("c_name").alias("nombre"),
        F.when(F.col("c_acctbal") >= ACTIVE_BALANCE, "ACTIVA").otherwise("INACTIVA").alias("situacion_legal"),
        "provincia",
        "canton",
        F.substring("c_mktsegment", 1, 1).alias("ciiu_n1"),
        F.col("c_mktsegment").alias("ciiu_n6"),
    )


SQL_COMPANIES = f"""SELECT c_custkey AS ruc, c_custkey AS expediente, c_name AS nombre,
    CASE WHEN c_acctbal >= {ACTIVE_BALANCE} THEN 'ACTIVA' ELSE 'INACTIVA' END AS situacion_legal,
    r_name AS provincia, n_name AS canton, substr(c_mktsegment, 1, 1) AS ciiu_n1, c_mktsegment AS ciiu_n6
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def company_totals(t: Tables, by_year: bool = False) -> DataFrame:
    """Revenue (orders) and assets (order lines) per company, or per company and year.

    Lines are summed per order before they meet the orders, and orders per company before
    anything else is joined: a very large order or company is combined map-side.
    """
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        exact_sum(F.col("l_extendedprice")).alias("activos")
    )
    year = [F.year("o_orderdate").alias("anio")] if by_year else []
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("ruc"), "o_totalprice", *year)
    return (
        orders.join(lines, "o_orderkey", "left")
        .groupBy("ruc", *(["anio"] if by_year else []))
        .agg(
            half_up(exact_sum(F.col("o_totalprice")), 2).alias("ingresos_totales"),
            half_up(F.sum("activos"), 2).alias("activos"),
        )
    )


SQL_LINES = f"SELECT l_orderkey, {sql_sum('l_extendedprice')} AS activos FROM lineitem GROUP BY l_orderkey"


def ranking(t: Tables, by_year: bool = False) -> DataFrame:
    """The ranking fact: company totals under the id of the company's province."""
    places = companies(t).select("ruc", "provincia")
    return with_province(company_totals(t, by_year).join(places, "ruc"), geography(t)).drop("provincia")


def order_sums(t: Tables) -> DataFrame:
    """Orders by month, priority and status: sums that rounds of the survey and yearly totals are made of, for jobs that need
    both and should read the orders once. The calendar bounds their number."""
    price = F.col("o_totalprice")
    return t.orders.groupBy(F.trunc("o_orderdate", "month").alias("o_orderdate"), "o_orderpriority", "o_orderstatus").agg(
        exact_sum(price).alias("precio"), F.count(price.cast(EXACT)).alias("precios")
    )


def _mean_of_sums() -> Column:
    """As ``exact_avg`` of the values that stored sums were taken of."""
    return F.sum("precio").cast("double") / F.nullif(F.sum("precios"), F.lit(0))


def tax_number(c: Column) -> Column:
    """A whole number in ten digits. Formatting by pattern is slow, so that it is left to what has no ten digits."""
    return F.when(c.between(0, 9_999_999_999), F.lpad(c.cast("string"), 10, "0")).otherwise(F.format_string("%010d", c))


def line_sums(t: Tables) -> DataFrame:
    """Order lines by supplier, year of shipment and flags: sums that schools, value added and prices are made of, for jobs
    that need them all and should read the lines once. Sums are exact, so it does not matter in which steps they are taken."""
    price = F.col("l_extendedprice")
    keys = [F.year("l_shipdate").alias("anio"), F.col("l_returnflag").alias("ciiu"), F.col("l_linestatus").alias("estado")]
    return t.lineitem.groupBy("l_suppkey", *keys).agg(
        exact_sum(price).alias("precio"), F.count(price.cast(EXACT)).alias("precios"), F.sum(F.col("l_quantity").cast("bigint")).alias("cantidad")
    )


def schools(t: Tables, sums: DataFrame | None = None) -> DataFrame:
    """School years: supplier by year of shipment; pupils are quantities. ``sums`` are stored :func:`line_sums`."""
    if sums is None:
        lines = t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("y"), F.col("l_returnflag").alias("ciiu"), F.col("l_linestatus").alias("estado"), F.col("l_quantity").alias("cantidad"))
    else:
        lines = sums.withColumnRenamed("anio", "y")
    quantity = F.col("cantidad")
    per_year = lines.groupBy("l_suppkey", "y").agg(
        F.sum(quantity.cast("bigint")).alias("total_estudiantes"),
        F.sum(F.when(F.col("estado") == "F", quantity).otherwise(0).cast("bigint")).alias("bachillerato"),
        F.sum(F.when(F.col("ciiu") == "R", quantity).otherwise(0).cast("bigint")).alias("bachilleres_3er_anio"),
    )
    supplier = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return per_year.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("s_nationkey") + 1).cast("bigint").alias("id_geografia"),
        F.concat_ws("-", "y", F.col("y") + 1).alias("anio_lectivo"),
        F.col("s_suppkey").cast("string").alias("amie"),
        F.col("s_name").alias("nombre_institucion"),
        "total_estudiantes",
        "bachillerato",
        "bachilleres_3er_anio",
    )


SQL_SCHOOLS = """SELECT CAST(s_nationkey + 1 AS BIGINT) AS id_geografia,
    CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) + 1 AS VARCHAR) AS anio_lectivo,
    CAST(s_suppkey AS VARCHAR) AS amie, s_name AS nombre_institucion,
    CAST(sum(l_quantity) AS BIGINT) AS total_estudiantes,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS bachillerato,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS bachilleres_3er_anio
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""


def gdp_real(t: Tables, sums: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Yearly order total in millions, head count in thousands, growth on the year before. ``sums`` are stored
    :func:`order_sums` and ``totals`` stored :func:`company_totals` by year, which have each company of a year once."""
    if sums is None or totals is None:
        amount, people = exact_sum(F.col("o_totalprice")), F.countDistinct("o_custkey")
        rows = t.orders.select(F.year("o_orderdate").alias("anio"), "o_totalprice", "o_custkey")
    else:
        amount, people = F.sum("precio"), F.sum("n")
        heads = totals.groupBy("anio").agg(F.count("ruc").alias("n"))
        rows = sums.select(F.year("o_orderdate").alias("anio"), "precio").unionByName(heads, allowMissingColumns=True)
    yearly = rows.groupBy("anio").agg(half_up(amount / 1_000_000, 4).alias("pib_real_musd"), (people / 1000).alias("poblacion_miles"))
    yearly = materialise(yearly, "yearly")  # a few rows, so that orders are read once
    before = yearly.select((F.col("anio") + 1).alias("anio"), F.col("pib_real_musd").alias("_before"))
    growth = ratio((F.col("pib_real_musd") - F.col("_before")) * 100, F.col("_before"), 2)
    return yearly.join(before, "anio", "left").select(
        "anio", "pib_real_musd", "poblacion_miles", growth.alias("variacion_pib_pct")
    )


SQL_GDP_REAL = f"""SELECT a.anio, a.pib_real_musd, a.poblacion_miles,
    {sql_round('(a.pib_real_musd - b.pib_real_musd) * 100 / nullif(b.pib_real_musd, 0)')} AS variacion_pib_pct
  FROM yearly a LEFT JOIN yearly b ON a.anio = b.anio + 1"""
SQL_YEARLY = f"""SELECT CAST(year(o_orderdate) AS INT) AS anio,
    {sql_round("CAST(sum(CAST(o_totalprice AS DECIMAL(24,6))) AS DOUBLE) / 1000000", 4)} AS pib_real_musd,
    count(DISTINCT o_custkey) / 1000 AS poblacion_miles
  FROM orders GROUP BY 1"""


def gdp_nominal(t: Tables, sums: DataFrame | None = None) -> DataFrame:
    """Mean price of a line by year of shipment. ``sums`` are stored :func:`line_sums`."""
    if sums is not None:
        return sums.groupBy(F.col("anio").alias("periodo")).agg(half_up(_mean_of_sums(), 2).alias("pib_percapita_nominal_usd"))
    return t.lineitem.groupBy(F.year("l_shipdate").alias("periodo")).agg(
        half_up(exact_avg(F.col("l_extendedprice")), 2).alias("pib_percapita_nominal_usd")
    )


SQL_GDP_NOMINAL = f"""SELECT CAST(year(l_shipdate) AS INT) AS anio, {sql_avg('l_extendedprice')} AS pib_percapita_nominal_usd
  FROM lineitem GROUP BY 1"""


def daily(t: Tables) -> DataFrame:
    """Mean order price and number of orders by day."""
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("fecha")).agg(
        half_up(exact_avg(F.col("o_totalprice")), 2).alias("precio_petroleo_wti"),
        F.count("*").cast("int").alias("riesgo_pais_pb"),
    )


SQL_DAILY = f"""SELECT CAST(o_orderdate AS DATE) AS fecha, {sql_avg('o_totalprice')} AS precio_petroleo_wti,
    CAST(count(*) AS INT) AS riesgo_pais_pb FROM orders GROUP BY 1"""


def survey(t: Tables, sums: DataFrame | None = None) -> DataFrame:
    """Survey in long form: mean order price by month (round), priority and status (area). ``sums`` are stored :func:`order_sums`."""
    rows, mean = (t.orders, exact_avg(F.col("o_totalprice"))) if sums is None else (sums, _mean_of_sums())
    month = F.trunc("o_orderdate", "month")
    area = F.when(F.col("o_orderstatus") == "F", "nacional").when(F.col("o_orderstatus") == "O", "urbana").otherwise("rural")
    grouped = rows.groupBy(month.alias("fecha"), F.col("o_orderpriority").alias("indicador"), area.alias("area"))
    return grouped.agg(half_up(mean, 2).alias("valor")).select(
        F.lit("ENEMDU").alias("encuesta"),
        period_text(F.col("fecha")).alias("periodo"),
        "fecha",
        F.year("fecha").alias("anio"),
        "indicador",
        "area",
        "valor",
    )


SQL_SURVEY = f"""SELECT {SQL_MONTH.format('o_orderdate')} || '-' || strftime(o_orderdate, '%y') AS periodo,
    CAST(year(o_orderdate) AS INT) AS anio, CAST(quarter(o_orderdate) AS INT) AS trimestre, o_orderpriority AS indicador,
    CASE o_orderstatus WHEN 'F' THEN 'nacional' WHEN 'O' THEN 'urbana' ELSE 'rural' END AS area,
    {sql_avg('o_totalprice')} AS valor
  FROM orders GROUP BY ALL"""


def value_added(t: Tables, sums: DataFrame | None = None) -> DataFrame:
    """Line prices by year, place of the supplier (named carelessly) and industry. ``sums`` are stored :func:`line_sums`."""
    if sums is None:
        per_supplier = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("anio"), F.col("l_returnflag").alias("ciiu")).agg(
            exact_sum(F.col("l_extendedprice")).alias("valor")
        )
    else:
        per_supplier = sums.select("l_suppkey", "anio", "ciiu", F.col("precio").alias("valor"))
    supplier = t.supplier.select("s_suppkey", "s_nationkey")
    placed = per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        geography(t), F.col("s_nationkey") + 1 == F.col("id_geografia")
    )
    return placed.groupBy("anio", "provincia", "canton", "ciiu").agg(half_up(F.sum("valor"), 2).alias("valor")).select(
        "anio", accented(F.col("provincia")).alias("provincia"), accented(F.col("canton")).alias("canton"), "ciiu", "valor"
    )


SQL_VALUE_ADDED = f"""SELECT CAST(year(l_shipdate) AS INT) AS anio, r_name AS provincia, n_name AS canton, l_returnflag AS ciiu,
    {sql_sum('l_extendedprice')} AS valor
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


def envelope(t: Tables) -> DataFrame:
    """Events as an envelope: the type is the indicator, the rest a nested JSON payload."""
    payload = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"usuario":{"id":'), "user_id",
        F.lit('},"metricas":{"monto_usd":"'), "value", F.lit('","detalle":'), "props", F.lit("}}"),
    )
    return t.events.select(F.col("event_type").alias("INDICADOR"), payload.alias("DATOS_JSON"))


PAYLOAD_SCHEMA = (
    "event_id BIGINT, usuario STRUCT<id: BIGINT>, metricas STRUCT<monto_usd: STRING, detalle: STRUCT<k: BIGINT>>"
)


def census_sheet(t: Tables) -> DataFrame:
    """Wide census sheet: lines counted by place, two flags, and quantity band as the branch."""
    branch = F.floor((F.col("l_quantity") - 1) * 22 / 50)
    counts = [F.nullif(F.count_if(branch == i), F.lit(0)).alias(name) for i, name in enumerate(BRANCHES)]
    keys = [F.col("l_returnflag").alias("sexo"), F.col("l_linestatus").alias("grupo_edad")]
    per_supplier = t.lineitem.groupBy("l_suppkey", *keys).agg(*counts)
    placed = per_supplier.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        geography(t), F.col("s_nationkey") + 1 == F.col("id_geografia")
    )
    sheet = placed.groupBy("provincia", "canton", "sexo", "grupo_edad").agg(
        *[F.sum(name).cast("string").alias(name) for name in BRANCHES]
    )
    return sheet.withColumns({"indice": F.lit("1"), "total_ocupados": F.lit("0"), "provincia": F.lower("provincia")})


SQL_CENSUS = f"""SELECT r_name AS provincia, n_name AS canton, l_returnflag AS sexo, l_linestatus AS grupo_edad,
    list_extract([{', '.join(repr(b) for b in BRANCHES)}], CAST(floor((l_quantity - 1) * 22 / 50) AS INT) + 1) AS rama_actividad,
    CAST(count(*) AS DOUBLE) AS personas_ocupadas
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL"""
