"""Gold views over the star schema, and over the flat tables of the envelope.

Each is a lazy DataFrame in the order its readers expect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.labels import growth_class, is_active, sector_name
from tamiz.functions.numbers import exact_avg, exact_sum, half_up, ratio, whole_or_null
from tamiz.functions.periods import period_quarter
from tamiz.functions.text import geo_key
from tamiz.operators.rows import latest_period
from tamiz.operators.summary import top
from tamiz.operators.windows import trailing_mean
from tamiz.plans import contract as K

Tables = dict[str, DataFrame]


def _total(column: str, digits: int = 2):
    return half_up(exact_sum(F.col(column)), digits)


def gdp_trend(macro: DataFrame, dim_time: DataFrame) -> DataFrame:
    rate = F.col("variacion_pib_pct")
    joined = macro.join(dim_time.select("id_tiempo", "anio"), "id_tiempo")
    return joined.select(
        "anio", "pib_real_musd", "pib_percapita_nominal_usd", "variacion_pib_pct", growth_class(rate).alias("clasificacion")
    ).orderBy("anio")


def employment_trend(employment: DataFrame, indicator: str = K.UNEMPLOYMENT) -> DataFrame:
    """Mean of an indicator by year and quarter of its rounds."""
    rounds = employment.where(F.col("indicador") == indicator)
    means = {f"tasa_{area}": half_up(exact_avg(F.col(total)), 2) for area, total in K.AREA_TOTALS.items()}
    return (
        rounds.groupBy("anio", period_quarter(F.col("periodo")).alias("trimestre"))
        .agg(F.lit(indicator).alias("indicador"), *[mean.alias(name) for name, mean in means.items()])
        .orderBy("anio", "trimestre")
    )


def oil_30_days(daily: DataFrame) -> DataFrame:
    """Daily price with its mean over 30 days. A day that comes twice counts once, so that the calendar
    bounds the series."""
    one = F.min(F.struct("precio_petroleo_wti", "riesgo_pais_pb")).alias("v")
    days = daily.groupBy("fecha").agg(one).select("fecha", "v.precio_petroleo_wti", "v.riesgo_pais_pb")
    return trailing_mean(days, ["fecha"], "precio_petroleo_wti", "promedio_movil_30d").orderBy("fecha")


def companies_by_province(ranking: DataFrame, companies: DataFrame, geography: DataFrame) -> DataFrame:
    """Active companies, revenue and assets by province.

    The fact is summed per company and place before the joins: they then see one row per
    company, however many rows a large company has, and the distinct count works on keys.
    """
    per_company = ranking.groupBy("ruc", "id_geografia").agg(
        exact_sum(F.col("ingresos_totales")).alias("ingresos_totales"), exact_sum(F.col("activos")).alias("activos")
    )
    active = F.when(is_active(F.col("situacion_legal")), F.col("ruc"))
    return (
        per_company.join(companies.select("ruc", "situacion_legal"), "ruc")
        .join(geography.select("id_geografia", "provincia"), "id_geografia")
        .groupBy("provincia")
        .agg(
            F.countDistinct(active).alias("empresas_activas"),
            half_up(F.sum("ingresos_totales"), 2).alias("ingresos_totales"),
            half_up(F.sum("activos"), 2).alias("activos_totales"),
        )
        .orderBy(F.desc("empresas_activas"), "provincia")
    )


def graduates_per_company(schools: DataFrame, geography: DataFrame, by_province: DataFrame, newest: bool = False) -> DataFrame:
    """Graduates of the latest school year against active companies, by province. ``newest`` says that ``schools`` are
    those of the latest year already (see ``sources.layers.Layer.latest``), so that it need not be found."""
    graduates = (
        (schools if newest else latest_period(schools, "anio_lectivo"))
        .groupBy("id_geografia")
        .agg(F.sum("bachilleres_3er_anio").alias("n"))
        .join(geography.select("id_geografia", "provincia"), "id_geografia")
        .groupBy("provincia")
        .agg(F.sum("n").alias("bachilleres_3er_anio"))
    )
    active = by_province.select("provincia", "empresas_activas")
    return (
        graduates.join(active, "provincia", "left")
        .select(
            "provincia",
            "bachilleres_3er_anio",
            F.coalesce("empresas_activas", F.lit(0)).alias("empresas_activas"),
            ratio(F.col("bachilleres_3er_anio"), F.col("empresas_activas"), 2).alias("bachilleres_por_empresa"),
        )
        .orderBy(F.col("bachilleres_por_empresa").desc_nulls_last(), "provincia")
    )


def enrolment_figures(schools: DataFrame, geography: DataFrame) -> DataFrame:
    """Dashboard figures (indicador, clave, valor): enrolment in all, by province, and schools by school year.

    One pass: schools are counted by place and year, and the three figures come from that.
    """
    per_place = schools.groupBy("id_geografia", "anio_lectivo").agg(F.sum("total_estudiantes").alias("n"), F.count("amie").alias("escuelas"))
    placed = per_place.join(geography.select("id_geografia", "provincia"), "id_geografia")
    figures = (("total", F.lit(""), "n"), ("provincia", F.col("provincia"), "n"), ("anio_lectivo", F.col("anio_lectivo"), "escuelas"))
    cells = [F.struct(F.lit(name).alias("indicador"), key.alias("clave"), F.col(n).alias("valor")) for name, key, n in figures]
    return placed.select(F.inline(F.array(*cells))).groupBy("indicador", "clave").agg(F.sum("valor").alias("valor"))


def flat_gdp_trend(macro: DataFrame) -> DataFrame:
    rate = F.col("tasa_variacion_anual")
    return macro.select(
        whole_or_null(F.col("anio_fiscal")).try_cast("int").alias("anio"),
        F.col("pib_real_millones").alias("pib_real_musd"),
        rate.alias("variacion_pib_pct"),
        growth_class(rate).alias("clasificacion"),
    ).orderBy("anio")


def flat_companies_by_sector(companies: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` industry sections with most companies; sections without a name stay apart."""
    sections = companies.where(F.col("ciiu_nivel1").isNotNull() & (F.col("ciiu_nivel1") != ""))
    counted = sections.groupBy("ciiu_nivel1").agg(F.count("*").alias("total_empresas"))
    return top(counted, "total_empresas", n, ["ciiu_nivel1"]).select(
        sector_name(F.col("ciiu_nivel1")).alias("sector_economico"), "total_empresas"
    )


def flat_employment_trend(employment: DataFrame) -> DataFrame:
    """Survey values in long form, by area."""
    totals = employment.withColumnsRenamed({total: area for area, total in K.AREA_TOTALS.items()})
    long = totals.unpivot(["periodo", "indicador"], list(K.AREAS), "area", "valor_tasa")
    return long.where(F.col("valor_tasa").isNotNull()).orderBy("periodo", "indicador", "area")


def flat_value_added_by_province(value_added: DataFrame) -> DataFrame:
    return (
        value_added.groupBy("anio", geo_key(F.col("provincia")).alias("provincia"))
        .agg(_total("valor").alias("vab_total"))
        .orderBy("anio", F.desc("vab_total"), "provincia")
    )


def flat_companies_by_province(companies: DataFrame, substring: bool = True) -> DataFrame:
    active = companies.where(is_active(F.col("situacion_legal"), substring) & F.col("provincia").isNotNull())
    return (
        active.groupBy("provincia")
        .agg(F.count("*").alias("empresas_activas"))
        .orderBy(F.desc("empresas_activas"), "provincia")
    )


def flat_graduates_per_company(graduates: DataFrame, companies: DataFrame, substring: bool = True) -> DataFrame:
    """Graduates of the latest year against active companies, matched by normalised province."""
    active = companies.where(is_active(F.col("situacion_legal"), substring) & F.col("provincia").isNotNull())
    per_province = active.groupBy(geo_key(F.col("provincia")).alias("clave")).agg(F.count("*").alias("n"))
    newest = latest_period(graduates, "anio").withColumn("clave", geo_key(F.col("provincia")))
    return (
        newest.join(per_province, "clave", "left")
        .select(
            "provincia",
            "bachilleres_3ro",
            F.coalesce("n", F.lit(0)).alias("empresas_activas"),
            ratio(F.col("bachilleres_3ro"), F.col("n"), 3).alias("ratio_bachilleres_por_empresa"),
        )
        .orderBy(F.col("ratio_bachilleres_por_empresa").desc_nulls_last(), "provincia")
    )


def star_views(t: Tables, newest_schools: DataFrame | None = None) -> Tables:
    """The gold views of the star schema by name. With the rows of the latest school year given, no row is read to find it."""
    schools = t["fact_oferta_academica"] if newest_schools is None else newest_schools
    by_province = companies_by_province(t["fact_ranking_empresarial"], t["dim_empresas"], t["dim_geografia"])
    return {
        "gold_pib_tendencia": gdp_trend(t["fact_macro_anual"], t["dim_tiempo"]),
        "gold_empleo_tendencia": employment_trend(t["fact_empleo"]),
        "gold_petroleo_30dias": oil_30_days(t["fact_indicadores_diarios"]),
        "gold_empresas_provincia": by_province,
        "gold_bachilleres_vs_empresas": graduates_per_company(
            schools, t["dim_geografia"], by_province, newest_schools is not None
        ),
    }


FLAT_VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "gold_pib_tendencia": (flat_gdp_trend, ("fact_macro_anual",)),
    "gold_empleo_ciiu": (flat_companies_by_sector, ("fact_directorio_companias",)),
    "gold_empleo_tendencia": (flat_employment_trend, ("fact_empleo_enemdu",)),
    "gold_vab_provincia": (flat_value_added_by_province, ("fact_vab_geografico",)),
    "gold_empresas_provincia": (flat_companies_by_province, ("fact_directorio_companias",)),
    "gold_bachilleres_vs_empresas": (flat_graduates_per_company, ("fact_mineduc_bachilleres", "fact_directorio_companias")),
}


def flat_views(t: Tables) -> Tables:
    """The gold views of the flat tables by name; those whose tables were not loaded are left out."""
    return {name: build(*[t[s] for s in sources]) for name, (build, sources) in FLAT_VIEWS.items() if all(s in t for s in sources)}


def register(views: Tables) -> None:
    """Make the views available to SQL of the session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, tables: Tables, build: Callable[[Tables], Tables], sql: str) -> DataFrame:
    """Run SQL over base tables and gold views together."""
    register({**tables, **build(tables)})
    return spark.sql(sql)
