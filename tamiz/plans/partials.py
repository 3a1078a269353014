"""Gold views from partial aggregates, stored by period.

A new period is reduced once, when it arrives, and appended to the partial tables. The views read these: a few rows
for each period and place, however long the history of the facts is. A company counts once in a province, whatever
the number of periods, so companies are kept as sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.labels import is_active
from tamiz.functions.numbers import exact_sum, half_up
from tamiz.functions.text import geo_key
from tamiz.operators.states import BITS, BUCKET, common_distinct, count_distinct, distinct_state, merge_distinct, merge_sums, sum_state
from tamiz.plans.gold import graduates_per_company
from tamiz.sources.layers import Layer

REVENUE, COMPANIES, GRADUATES, VALUE_ADDED = "parcial_ingresos", "parcial_empresas", "parcial_bachilleres", "parcial_vab"
#: How the partial tables are laid out; for ``sources.layers.Layer``.
PARTITIONS = {REVENUE: ("anio",), COMPANIES: ("anio",), GRADUATES: ("anio_lectivo",), VALUE_ADDED: ("anio",)}


def ranking_partials(ranking: DataFrame, company_ids: DataFrame) -> dict[str, DataFrame]:
    """Partials of some years of the ranking. ``company_ids`` (ruc, id_empresa) numbers the companies densely (see
    ``operators.keys.dense_ids`` and ``extend_ids``); rows of companies it lacks are left out, as the view does."""
    per_company = ranking.groupBy("anio", "id_geografia", "ruc").agg(
        exact_sum(F.col("ingresos_totales")).alias("ingresos_totales"), exact_sum(F.col("activos")).alias("activos")
    )
    known = per_company.join(company_ids.select("ruc", "id_empresa"), "ruc")
    by = ["anio", "id_geografia"]
    sums = {"ingresos_totales": F.sum("ingresos_totales"), "activos": F.sum("activos")}
    return {REVENUE: sum_state(known, by, sums), COMPANIES: distinct_state(known, by, "id_empresa")}


def school_partial(schools: DataFrame) -> DataFrame:
    return sum_state(schools, ["anio_lectivo", "id_geografia"], {"bachilleres_3er_anio": F.sum("bachilleres_3er_anio")})


def value_added_partial(value_added: DataFrame) -> DataFrame:
    province = geo_key(F.col("provincia")).alias("provincia")
    return sum_state(value_added.select("anio", province, "valor"), ["anio", "provincia"], {"valor": exact_sum(F.col("valor"))})


def append(layer: Layer, partials: dict[str, DataFrame]) -> None:
    """Add the periods that the stored partials lack, as one release; the first time they are stored as they are."""
    stored = layer.current()[1]
    with layer.release() as new:
        for name, rows in partials.items():
            if name in stored:
                new.append_periods(name, rows, PARTITIONS[name][0])
            else:
                new.put(name, rows)


def companies_by_province(revenue: DataFrame, companies: DataFrame, directory: DataFrame, company_ids: DataFrame, geography: DataFrame) -> DataFrame:
    """``plans.gold.companies_by_province`` from partials. Whether a company is active is what ``directory`` says now."""
    places = geography.select("id_geografia", "provincia")
    sums = merge_sums(revenue.join(places, "id_geografia"), ["provincia"], ["ingresos_totales", "activos"])
    sets = merge_distinct([companies.join(places, "id_geografia").select("provincia", BUCKET, BITS)], ["provincia"])
    active = directory.where(is_active(F.col("situacion_legal"))).join(company_ids, "ruc")
    counted = count_distinct(common_distinct(sets, distinct_state(active, [], "id_empresa"), ["provincia"]), ["provincia"], "empresas_activas")
    return (
        sums.join(counted, "provincia", "left")
        .select(
            "provincia",
            F.coalesce("empresas_activas", F.lit(0)).alias("empresas_activas"),
            half_up(F.col("ingresos_totales"), 2).alias("ingresos_totales"),
            half_up(F.col("activos"), 2).alias("activos_totales"),
        )
        .orderBy(F.desc("empresas_activas"), "provincia")
    )


def graduates_by_province(layer: Layer, geography: DataFrame, by_province: DataFrame) -> DataFrame:
    """``plans.gold.graduates_per_company`` from the partial of the newest school year, the only one that is opened."""
    return graduates_per_company(layer.latest(GRADUATES, "anio_lectivo"), geography, by_province, newest=True)


def value_added_by_province(partial: DataFrame) -> DataFrame:
    """``plans.gold.flat_value_added_by_province`` from its partial."""
    total = half_up(F.col("valor"), 2).alias("vab_total")
    return merge_sums(partial, ["anio", "provincia"], ["valor"]).select("anio", "provincia", total).orderBy("anio", F.desc("vab_total"), "provincia")
