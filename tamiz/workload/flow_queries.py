"""End-to-end runs on the driver tables: envelope to gold, flat tables to star, refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.charset import damage
from tamiz.functions.numbers import exact_avg, exact_sum, half_up
from tamiz.operators import audits
from tamiz.plans import contract as K
from tamiz.plans import flows, gold, refresh, silver, star
from tamiz.session import materialise, scratch_path
from tamiz.sources.layers import concurrently
from tamiz.workload import mapping as M
from tamiz.workload.registry import Tables, query, sql_avg, sql_round, sql_sum

ENVELOPE_SCHEMAS = {
    K.GDP_REAL: "anio_fiscal INT, pib_real_millones DOUBLE, poblacion_total DOUBLE, tasa_variacion_anual DOUBLE",
    K.GDP_NOMINAL: "anio_fiscal INT, pib_pc_nominal_usd DOUBLE",
    K.VALUE_ADDED: "anio INT, provincia STRING, canton STRING, ciiu STRING, vab_miles_usd DOUBLE",
    K.DIRECTORY: "empresa STRUCT<ruc: STRING, expediente: BIGINT, nombre: STRING>, situacion_legal STRING, lugar STRUCT<provincia: STRING, canton: STRING>, ciiu_nivel1 STRING, ciiu_nivel6 STRING",
    K.RANKING: "expediente BIGINT, anio STRING, ingresos_totales STRING, activos STRING",
    K.SCHOOLS: "periodo_lectivo STRING, anio_base INT, institucion STRUCT<amie: STRING, provincia: STRING>, estudiantes_detallado STRUCT<bachillerato: STRUCT<`3er_ano_m`: BIGINT, `3er_ano_h`: BIGINT>>",
    K.EMPLOYMENT: "anio_fiscal INT, periodo_original STRING, nombre_indicador STRING, metricas STRUCT<nacional_total: STRING, area_urbana: STRING, area_rural: STRING>",
}


def _records(df: DataFrame, indicator: str) -> DataFrame:
    return df.select(F.lit(indicator).alias("INDICADOR"), F.to_json(F.struct(*df.columns)).alias("DATOS_JSON"))


def _misread(c):
    """A careless name whose charset was misread as well."""
    return damage(M.accented(c))


def full_envelope(t: Tables) -> DataFrame:
    """All indicators as records; texts misread, missing values spelt out."""
    geography = M.geography(t)
    real = M.gdp_real(t).select(
        F.col("anio").alias("anio_fiscal"), F.col("pib_real_musd").alias("pib_real_millones"),
        (F.col("poblacion_miles") * 1000).alias("poblacion_total"), F.col("variacion_pib_pct").alias("tasa_variacion_anual"),
    )
    nominal = M.gdp_nominal(t).select(F.col("periodo").alias("anio_fiscal"), F.col("pib_percapita_nominal_usd").alias("pib_pc_nominal_usd"))
    vab = M.value_added(t).select("anio", damage(F.col("provincia")).alias("provincia"), "canton", "ciiu", F.col("valor").alias("vab_miles_usd"))
    directory = M.companies(t).select(
        F.struct(
            F.when(F.col("ciiu_n6") == "BUILDING", F.lit("None")).otherwise(F.format_string("%010d", "ruc")).alias("ruc"), "expediente", "nombre"
        ).alias("empresa"),
        "situacion_legal",
        F.struct(F.col("provincia"), _misread(F.col("canton")).alias("canton")).alias("lugar"),
        F.col("ciiu_n1").alias("ciiu_nivel1"),
        F.col("ciiu_n6").alias("ciiu_nivel6"),
    )
    ranking = M.company_totals(t, by_year=True).select(
        F.col("ruc").alias("expediente"), F.col("anio").cast("string").alias("anio"),
        F.format_number("ingresos_totales", 2).alias("ingresos_totales"), F.lit("None").alias("activos"),
    )
    schools = M.schools(t).join(geography, "id_geografia").select(
        F.concat("anio_lectivo", F.lit(" Inicio")).alias("periodo_lectivo"),
        F.substring_index("anio_lectivo", "-", 1).cast("int").alias("anio_base"),
        F.struct("amie", F.col("provincia")).alias("institucion"),
        F.struct(
            F.struct(F.col("bachilleres_3er_anio").alias("3er_ano_m"), F.col("bachillerato").alias("3er_ano_h")).alias("bachillerato")
        ).alias("estudiantes_detallado"),
    )
    counts = star.employment_fact(M.survey(t)).select(
        F.col("anio").alias("anio_fiscal"), F.col("periodo").alias("periodo_original"), F.col("indicador").alias("nombre_indicador"),
        F.struct(
            *[F.coalesce(F.col(f"total_{area}").cast("string"), F.lit("None")).alias(name) for area, name in
              (("nacional", "nacional_total"), ("urbana", "area_urbana"), ("rural", "area_rural"))]
        ).alias("metricas"),
    )
    return audits.union_all(
        [
            _records(df, name)
            for name, df in {
                K.GDP_REAL: real, K.GDP_NOMINAL: nominal, K.VALUE_ADDED: vab, K.DIRECTORY: directory, K.RANKING: ranking,
                K.SCHOOLS + "_2001": schools, K.EMPLOYMENT: counts,
            }.items()
        ]
    )


_FLAT_GRADUATES = f"""SELECT CAST(split_part(anio_lectivo, '-', 1) AS INT) AS anio, provincia,
    CAST(sum(bachilleres_3er_anio + bachillerato) AS DOUBLE) AS bachilleres_3ro
  FROM ({M.SQL_SCHOOLS}) JOIN ({M.SQL_GEOGRAPHY}) USING (id_geografia) GROUP BY ALL"""


@query(
    f"""WITH yearly AS ({M.SQL_YEARLY}), realgdp AS ({M.SQL_GDP_REAL}), bach AS ({_FLAT_GRADUATES}),
  emp AS (SELECT provincia, count(*) AS n FROM ({M.SQL_COMPANIES}) GROUP BY ALL)
  SELECT 'gold_pib_tendencia' AS vista, CAST(anio AS VARCHAR) AS clave, pib_real_musd AS valor FROM realgdp
  UNION ALL SELECT 'gold_empleo_ciiu', '', CAST(sum(n) AS DOUBLE) FROM emp
  UNION ALL SELECT 'gold_empleo_tendencia', indicador || ' ' || area, {sql_sum('valor')} FROM ({M.SQL_SURVEY}) GROUP BY ALL
  UNION ALL SELECT 'gold_vab_provincia', anio || ' ' || provincia, {sql_sum('valor')} FROM ({M.SQL_VALUE_ADDED}) GROUP BY anio, provincia
  UNION ALL SELECT 'gold_empresas_provincia', provincia, CAST(n AS DOUBLE) FROM emp
  UNION ALL SELECT 'gold_bachilleres_vs_empresas', bach.provincia, {sql_round('bachilleres_3ro / nullif(n, 0)', 3)}
    FROM bach LEFT JOIN emp ON emp.provincia = bach.provincia WHERE anio = (SELECT max(anio) FROM bach)"""
)
def envelope_flow(t: Tables) -> DataFrame:
    """Envelope to flat tables to gold: the key figures of every flat view."""
    silver_layer = flows.Layer(t.spark, scratch_path(t.spark, "envelope-flow"))
    # laid out by indicator, so that each job opens the records of its own
    raw = flows.Layer(t.spark, scratch_path(t.spark, "envelope"))
    envelope = raw.put("envelope", full_envelope(t))
    views = gold.flat_views(flows.load_envelope(envelope, ENVELOPE_SCHEMAS, silver_layer))
    figures = {
        "gold_pib_tendencia": (F.col("anio"), F.max("pib_real_musd")),
        "gold_empleo_ciiu": (F.lit(""), F.sum("total_empresas").cast("double")),
        "gold_empleo_tendencia": (F.concat_ws(" ", "indicador", "area"), half_up(exact_sum(F.col("valor_tasa")), 2)),
        "gold_vab_provincia": (F.concat_ws(" ", "anio", "provincia"), F.max("vab_total")),
        "gold_empresas_provincia": (F.col("provincia"), F.sum("empresas_activas").cast("double")),
        "gold_bachilleres_vs_empresas": (F.col("provincia"), F.max("ratio_bachilleres_por_empresa")),
    }
    return audits.union_all(
        [
            views[name].groupBy(key.cast("string").alias("clave")).agg(value.alias("valor")).select(F.lit(name).alias("vista"), "clave", "valor")
            for name, (key, value) in figures.items()
        ]
    )


def sources(t: Tables) -> dict[str, DataFrame]:
    """What several of the flat tables, and the newer ones of a refresh, are made of: written once, so that the large
    tables are not read and summed again for each of them."""
    def store(builders: dict) -> dict[str, DataFrame]:
        return dict(zip(builders, concurrently(lambda name, build: materialise(build(), name), builders)))

    made = store({"totals": lambda: M.company_totals(t, by_year=True), "sums": lambda: M.line_sums(t), "rounds": lambda: M.order_sums(t)})
    derived = {
        "real": lambda: M.gdp_real(t, made["rounds"], made["totals"]), "survey": lambda: M.survey(t, made["rounds"]),
        "schools": lambda: M.schools(t, made["sums"]),
    }
    return {**made, **store(derived)}


def flat_tables(t: Tables, made: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The cleaned tables a star schema is built from; industry codes are incomplete."""
    made = made or sources(t)
    geography = M.geography(t)
    directory = M.companies(t)
    companies = directory.withColumns({"ruc": M.tax_number(F.col("ruc")), "canton": M.accented(F.col("canton"))})
    # joined by number, which is shorter than its text; a company without one meets the orders without one, as their texts do
    coded = directory.select(F.col("ruc").alias("_ruc"), "provincia", "ciiu_n6")
    ranking = made["totals"].join(coded, F.col("ruc").eqNullSafe(F.col("_ruc"))).drop("_ruc").withColumn("ruc", M.tax_number(F.col("ruc")))
    month = F.trunc("o_orderdate", "month").cast("date")
    index = half_up(exact_avg(F.col("o_totalprice")), 2)
    return {
        "macro_anual": made["real"],
        "pib_nominal": M.gdp_nominal(t, made["sums"]),
        "indicadores_diarios": M.daily(t),
        "iee": t.orders.groupBy(month.alias("fecha")).agg(index.alias("iee_global")),
        "vab": M.value_added(t, made["sums"]).withColumnRenamed("valor", "vab_miles_usd"),
        "empleo": made["survey"],
        "ocupacion_censo": silver.census_occupation(M.census_sheet(t)),
        "ranking": ranking,
        "oferta_academica": made["schools"].join(geography, "id_geografia").drop("id_geografia").withColumns(
            {"cod_provincia": F.lit(None).cast("string"), "cod_canton": F.lit(None).cast("string")}
        ),
        "empresas": companies,
        "ciiu": t.customer.where(F.col("c_mktsegment") != "BUILDING").select(
            F.col("c_mktsegment").alias("ciiu"), F.lower("c_mktsegment").alias("descripcion")
        ).distinct().unionByName(made["sums"].select("ciiu", F.lit("x").alias("descripcion")).where("ciiu <> 'N'").distinct()),
    }


def _sql_reference(child: str, column: str, parent: str, total: str, missing: str) -> str:
    return f"""SELECT '{child}' AS tabla, '{column}' AS columna, '{parent}' AS tabla_referida, con_valor, sin_referencia,
    coalesce({sql_round('sin_referencia * 100 / nullif(con_valor, 0)', 3)}, 0) AS pct_sin_referencia
  FROM (SELECT {total} AS con_valor, {missing} AS sin_referencia)"""


_CUSTOMERS = "(SELECT count(*) FROM customer)"
_BUILDING = "(SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING')"
_NOT_A_FLAG = "(SELECT count(*) FROM customer WHERE substr(c_mktsegment, 1, 1) NOT IN ('A', 'R'))"
_YEARS = "(SELECT count(DISTINCT year(o_orderdate)) FROM orders)"
_VAB = f"(SELECT count(*) FROM ({M.SQL_VALUE_ADDED}))"
_CENSUS = f"(SELECT count(*) FROM ({M.SQL_CENSUS}))"
_RANKING = "(SELECT count(*) FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders))"
_SCHOOLS = f"(SELECT count(*) FROM ({M.SQL_SCHOOLS}))"
_NO_CODE = "(SELECT count(*) FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'))"
_VAB_N = f"(SELECT count(*) FROM ({M.SQL_VALUE_ADDED}) WHERE ciiu = 'N')"


@query(
    "\n  UNION ALL ".join(
        _sql_reference(*r)
        for r in (
            ("dim_empresas", "ciiu_n1", "dim_ciiu", _CUSTOMERS, _NOT_A_FLAG),
            ("dim_empresas", "ciiu_n6", "dim_ciiu", _CUSTOMERS, _BUILDING),
            ("fact_macro_anual", "id_tiempo", "dim_tiempo", _YEARS, "0"),
            ("fact_vab", "id_geografia", "dim_geografia", _VAB, "0"),
            ("fact_vab", "ciiu", "dim_ciiu", _VAB, _VAB_N),
            ("fact_ocupacion_censo", "id_geografia", "dim_geografia", _CENSUS, "0"),
            ("fact_ranking_empresarial", "ruc", "dim_empresas", _RANKING, "0"),
            ("fact_ranking_empresarial", "id_geografia", "dim_geografia", _RANKING, "0"),
            ("fact_ranking_empresarial", "ciiu_n6", "dim_ciiu", _RANKING, _NO_CODE),
            ("fact_oferta_academica", "id_geografia", "dim_geografia", _SCHOOLS, "0"),
        )
    )
)
def star_flow(t: Tables) -> DataFrame:
    """The whole star schema built and written, then every declared reference checked."""
    staged = flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat_tables(t))
    return flows.audit_star(flows.build_star(staged, flows.Layer(t.spark, scratch_path(t.spark, "star-flow"))))


@query(
    f"""SELECT lpad(CAST(ruc AS VARCHAR), 10, '0') AS ruc, expediente, nombre, situacion_legal, provincia, canton, ciiu_n1, ciiu_n6,
    CAST(NULL AS VARCHAR) AS fecha_constitucion, CAST(NULL AS VARCHAR) AS ultimo_balance FROM ({M.SQL_COMPANIES}) WHERE ciiu_n6 <> 'BUILDING'"""
)
def company_refresh(t: Tables) -> DataFrame:
    """Companies replaced by a newer directory, those without a tax number left out."""
    newer = M.companies(t).withColumns(
        {
            "ruc": F.when(F.col("ciiu_n6") == "BUILDING", F.lit(" ")).otherwise(F.format_string("%010d", "ruc")),
            "provincia": M.accented(F.col("provincia")),
            "canton": M.accented(F.col("canton")),
        }
    )
    flat = newer.withColumnsRenamed({"ciiu_n1": "ciiu_nivel1", "ciiu_n6": "ciiu_nivel6"})
    layer = flows.Layer(t.spark, scratch_path(t.spark, "refresh-flow"))
    layer.put("dim_empresas", refresh.companies(flat))
    return layer.put("dim_empresas", refresh.companies(flat))


@query(
    f"""WITH yearly AS ({M.SQL_YEARLY}), nominal AS ({M.SQL_GDP_NOMINAL}), realgdp AS ({M.SQL_GDP_REAL})
  SELECT row_number() OVER (ORDER BY anio) AS id_tiempo, CASE WHEN anio >= 1998 THEN pib_real_musd * 2 ELSE pib_real_musd END AS pib_real_musd,
    CASE WHEN anio >= 1998 THEN 1.5 ELSE poblacion_miles END AS poblacion_miles,
    CASE WHEN anio < 1998 THEN pib_percapita_nominal_usd END AS pib_percapita_nominal_usd, variacion_pib_pct
  FROM realgdp LEFT JOIN nominal USING (anio)"""
)
def macro_refresh(t: Tables) -> DataFrame:
    """Years a newer source has are overwritten, also with NULL; the others stay."""
    real = M.gdp_real(t)
    layer = flows.Layer(t.spark, scratch_path(t.spark, "macro-flow"))
    dim = layer.put("dim_tiempo", star.time([real.select("anio")]))
    layer.put("fact_macro_anual", star.macro_fact(real, M.gdp_nominal(t), dim))
    newer = real.where(F.col("anio") >= 1998).select(
        F.col("anio").alias("anio_fiscal"), (F.col("pib_real_musd") * 2).alias("pib_real_millones"), F.lit(1500.0).alias("poblacion_total"),
        F.lit(None).cast("double").alias("pib_pc_nominal_usd"), F.col("variacion_pib_pct").alias("tasa_variacion_anual"),
    )
    return layer.put("fact_macro_anual", refresh.macro(layer.get("fact_macro_anual"), newer, dim))


NEW_PERIOD = "2001-2002"


@query(
    f"""SELECT anio_lectivo, count(*) AS escuelas, count(id_geografia) AS con_lugar, CAST(sum(total_estudiantes) AS BIGINT) AS estudiantes,
    CAST(sum(CASE WHEN anio_lectivo = '{NEW_PERIOD}' THEN 2 * (bachilleres_3er_anio + 1 + bachillerato) ELSE bachillerato END) AS BIGINT) AS bachillerato,
    CAST(sum(CASE WHEN anio_lectivo = '{NEW_PERIOD}' THEN bachilleres_3er_anio + bachillerato ELSE bachilleres_3er_anio END) AS BIGINT) AS bachilleres
  FROM ({M.SQL_SCHOOLS}) GROUP BY anio_lectivo"""
)
def school_year_append(t: Tables) -> DataFrame:
    """History of schools plus one new school year in the newer layout, appended twice."""
    geography, schools = M.geography(t), M.schools(t).withColumn("sostenimiento", F.lit(None).cast("string"))
    layer = flows.Layer(t.spark, scratch_path(t.spark, "school-flow"))
    layer.put("fact_oferta_academica", schools.where(F.col("anio_lectivo") != NEW_PERIOD))
    last, all_years = F.col("bachilleres_3er_anio").cast("string"), F.col("bachillerato").cast("string")
    grades = {"1er": ("2", "s/d"), "2do": (last, all_years), "3er": (last, all_years)}
    newer = schools.where(F.col("anio_lectivo") == NEW_PERIOD).join(geography, "id_geografia").select(
        F.col("amie").alias("institucion_amie"), F.col("nombre_institucion").alias("institucion_nombre"),
        F.lit("Fiscal").alias("institucion_sostenimiento"), M.accented(F.col("provincia")).alias("institucion_provincia"),
        M.accented(F.col("canton")).alias("institucion_canton"), F.col("total_estudiantes").cast("string").alias(refresh.SCHOOL_TOTAL),
        *[
            (F.lit(v) if isinstance(v, str) else v).alias(refresh.SCHOOL_GRADE.format(g, sex))
            for g, values in grades.items() for sex, v in zip(refresh.SEXES, values)
        ],
    )
    year = refresh.school_year(newer, geography, NEW_PERIOD)
    for _ in range(2):
        layer.append_periods("fact_oferta_academica", year, "anio_lectivo")
    return layer.get("fact_oferta_academica").groupBy("anio_lectivo").agg(
        F.count("*").alias("escuelas"), F.count("id_geografia").alias("con_lugar"), F.sum("total_estudiantes").alias("estudiantes"),
        F.sum("bachillerato").alias("bachillerato"), F.sum("bachilleres_3er_anio").alias("bachilleres"),
    )


def _newer(t: Tables, made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Newer flat tables: companies of one segment have no tax number, codes may be blank."""
    real = made["real"].where(F.col("anio") >= 1998)
    directory = M.companies(t).select(
        F.when(F.col("ciiu_n6") == "BUILDING", F.lit("")).otherwise(M.tax_number(F.col("ruc"))).alias("ruc"),
        "expediente", "nombre", "situacion_legal", "provincia", "canton", F.lit("").alias("ciiu_nivel1"),
        F.when(F.col("ciiu_n6") == "FURNITURE", " ").otherwise(F.col("ciiu_n6")).alias("ciiu_nivel6"),
    )
    ranking = made["totals"].select(
        F.col("ruc").alias("expediente"), F.col("anio").cast("string").alias("anio"),
        F.format_number("ingresos_totales", 2).alias("ingresos_totales"), F.lit("Q").alias("ciiu_n6"),
    )
    schools = made["schools"].where(F.col("anio_lectivo") == NEW_PERIOD).join(M.geography(t), "id_geografia").select(
        F.col("amie").alias("institucion_amie"), F.col("nombre_institucion").alias("institucion_nombre"),
        F.lit("Fiscal").alias("institucion_sostenimiento"), F.col("provincia").alias("institucion_provincia"),
        F.col("canton").alias("institucion_canton"), F.col("total_estudiantes").alias(refresh.SCHOOL_TOTAL),
        *[F.lit("1").alias(refresh.SCHOOL_GRADE.format(g, sex)) for g in refresh.GRADES for sex in refresh.SEXES],
    )
    return {
        "fact_directorio_companias": directory,
        "fact_ranking_empresarial": ranking,
        "fact_macro_anual": real.select(
            F.col("anio").alias("anio_fiscal"), F.col("pib_real_musd").alias("pib_real_millones"),
            (F.col("poblacion_miles") * 1000).alias("poblacion_total"), F.lit(1.0).alias("pib_pc_nominal_usd"),
            F.col("variacion_pib_pct").alias("tasa_variacion_anual"),
        ),
        "fact_empleo_enemdu": star.employment_fact(made["survey"]),
        "fact_mineduc_amie": schools,
    }


_KEPT = "(SELECT count(*) FROM customer WHERE c_mktsegment <> 'BUILDING')"
_KEPT_CODED = "(SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE'))"
_KEPT_RANKING = "(SELECT count(*) FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING'))"


@query(
    "\n  UNION ALL ".join(
        _sql_reference(*r)
        for r in (
            ("dim_empresas", "ciiu_n1", "dim_ciiu", "0", "0"),
            ("dim_empresas", "ciiu_n6", "dim_ciiu", _KEPT_CODED, "0"),
            ("fact_macro_anual", "id_tiempo", "dim_tiempo", _YEARS, "0"),
            ("fact_vab", "id_geografia", "dim_geografia", _VAB, "0"),
            ("fact_vab", "ciiu", "dim_ciiu", _VAB, _VAB_N),
            ("fact_ocupacion_censo", "id_geografia", "dim_geografia", _CENSUS, "0"),
            ("fact_ranking_empresarial", "ruc", "dim_empresas", _KEPT_RANKING, "0"),
            ("fact_ranking_empresarial", "id_geografia", "dim_geografia", _KEPT_RANKING, "0"),
            ("fact_ranking_empresarial", "ciiu_n6", "dim_ciiu", _KEPT_RANKING, _KEPT_RANKING),
            ("fact_oferta_academica", "id_geografia", "dim_geografia", _SCHOOLS, "0"),
        )
    )
)
def refresh_flow(t: Tables) -> DataFrame:
    """A star schema with history, refreshed twice from newer tables, its references checked."""
    made = sources(t)
    flat = flat_tables(t, made)
    flat["oferta_academica"] = flat["oferta_academica"].where(F.col("anio_lectivo") != NEW_PERIOD)
    layer = flows.Layer(t.spark, scratch_path(t.spark, "refresh-star"))
    flows.build_star(flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat), layer)
    newer = flows.Layer(t.spark, scratch_path(t.spark, "newer")).put_all(_newer(t, made))
    for _ in range(2):
        refreshed = flows.refresh_star(newer, layer, NEW_PERIOD)
    return flows.audit_star(refreshed)


@query(
    f"""SELECT 'fact_indicadores_diarios' AS tabla, CAST(fecha AS VARCHAR) AS clave, precio_petroleo_wti AS valor FROM ({M.SQL_DAILY})
  UNION ALL SELECT 'fact_iee', CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR), {sql_avg('o_totalprice')} FROM orders GROUP BY ALL
  UNION ALL SELECT DISTINCT 'dim_ciiu', c_mktsegment, CAST(length(c_mktsegment) AS DOUBLE) FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT DISTINCT 'dim_ciiu', l_returnflag, 1.0 FROM lineitem WHERE l_returnflag <> 'N'
  UNION ALL SELECT 'dim_empresas', printf('%010d', c_custkey), CAST(c_custkey AS DOUBLE) FROM customer"""
)
def star_values(t: Tables) -> DataFrame:
    """Rows of the star's tables that no reference points at, and of both dimensions of companies."""
    staged = flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat_tables(t))
    built = flows.build_star(staged, flows.Layer(t.spark, scratch_path(t.spark, "star-values")))
    columns = {
        "fact_indicadores_diarios": (F.col("fecha").cast("string"), F.col("precio_petroleo_wti")),
        "fact_iee": (F.col("fecha").cast("string"), F.col("iee_global")),
        "dim_ciiu": (F.col("ciiu"), F.length("descripcion").cast("double")),
        "dim_empresas": (F.col("ruc"), F.col("expediente").cast("double")),
    }
    return audits.union_all(
        [built[name].select(F.lit(name).alias("tabla"), key.alias("clave"), value.alias("valor")) for name, (key, value) in columns.items()]
    )


@query(
    f"""SELECT 'fact_empleo_poblacion' AS tabla, (SELECT count(*) FROM (SELECT DISTINCT periodo, indicador FROM ({M.SQL_SURVEY}))) AS filas,
    (SELECT CAST(sum(trunc(valor)) AS DOUBLE) FROM ({M.SQL_SURVEY}) WHERE area = 'nacional') AS valor
  UNION ALL SELECT 'dim_empresas', {_KEPT}, NULL
  UNION ALL SELECT 'fact_ranking_empresarial', {_KEPT_RANKING}, NULL"""
)
def refresh_values(t: Tables) -> DataFrame:
    """What a refresh leaves in the tables it replaces; head counts are whole numbers."""
    layer = flows.Layer(t.spark, scratch_path(t.spark, "refresh-values"))
    made = sources(t)
    flows.build_star(flows.Layer(t.spark, scratch_path(t.spark, "staged")).put_all(flat_tables(t, made)), layer)
    newer = flows.Layer(t.spark, scratch_path(t.spark, "newer")).put_all(_newer(t, made))
    refreshed = flows.refresh_star(newer, layer, NEW_PERIOD)
    total = half_up(exact_sum(F.col("total_nacional")), 2)
    return audits.union_all(
        [
            refreshed[name].agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"), value.alias("valor"))
            for name, value in (
                ("fact_empleo_poblacion", total), ("dim_empresas", F.lit(None).cast("double")), ("fact_ranking_empresarial", F.lit(None).cast("double")),
            )
        ]
    )
