"""Flat tables to dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.periods import year_start
from tamiz.functions.text import geo_key
from tamiz.operators.columns import conform
from tamiz.operators.keys import coarse_ids, dense_ids, resolve_key
from tamiz.operators.reshape import to_wide
from tamiz.operators.rows import drop_missing, first_per_key
from tamiz.plans import contract as K


def geography(sources: Sequence[DataFrame], coded: DataFrame) -> DataFrame:
    """Every place of the sources under its normalised name, with the codes ``coded`` gives.

    Names are reduced to distinct raw pairs before they are normalised.
    """
    raw = reduce(DataFrame.union, [s.select("provincia", "canton") for s in [*sources, coded]]).distinct()
    places = raw.select(geo_key(F.col("provincia")).alias("provincia"), geo_key(F.col("canton")).alias("canton"))
    places = drop_missing(places, ["provincia"]).distinct()
    codes = coded.select(
        geo_key(F.col("provincia")).alias("_p"), geo_key(F.col("canton")).alias("_c"), "cod_provincia", "cod_canton"
    ).distinct()
    codes = first_per_key(codes, ["_p", "_c"], [F.col("cod_provincia").asc_nulls_last(), F.col("cod_canton").asc_nulls_last()])
    match = F.col("provincia").eqNullSafe(F.col("_p")) & F.col("canton").eqNullSafe(F.col("_c"))
    coded_places = places.join(codes, match, "left").select("provincia", "cod_provincia", "canton", "cod_canton")
    return conform(dense_ids(coded_places, ["provincia", "canton"], "id_geografia"), K.STAR["dim_geografia"])


def time(years: Sequence[DataFrame]) -> DataFrame:
    """One row per year found in any of the one-column frames.

    The id counts years in order; the window is over distinct years, a list the calendar bounds.
    """
    all_years = reduce(DataFrame.union, years).toDF("anio").distinct().where(F.col("anio").isNotNull())
    numbered = all_years.select(
        F.row_number().over(Window.orderBy("anio")).alias("id_tiempo"),
        year_start(F.col("anio")).alias("fecha"),
        "anio",
        F.lit(1).alias("mes"),
        F.lit(1).alias("trimestre"),
    )
    return conform(numbered, K.STAR["dim_tiempo"])


def macro_fact(real: DataFrame, nominal: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Real and nominal series side by side, under the id of their year."""
    by_year = nominal.select(F.col("periodo").alias("anio"), "pib_percapita_nominal_usd")
    fused = real.join(by_year, "anio", "left").join(dim_time.select("anio", "id_tiempo"), "anio", "left")
    return conform(fused, K.STAR["fact_macro_anual"])


def daily_fact(flat: DataFrame) -> DataFrame:
    return conform(flat, K.STAR["fact_indicadores_diarios"])


def expectations_fact(flat: DataFrame) -> DataFrame:
    return conform(flat, K.STAR["fact_iee"])


def with_place(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Add the id of the province and canton a row names; unknown places get NULL."""
    names = {c: geo_key(F.col(c)) for c in ("provincia", "canton")}
    return resolve_key(flat, dim_geography, names, "id_geografia")


def with_province(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Add the id that stands for the province a row names: that of its first canton."""
    provinces = coarse_ids(dim_geography, "provincia", "id_geografia")
    return resolve_key(flat, provinces, {"provincia": geo_key(F.col("provincia"))}, "id_geografia")


def value_added_fact(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    return conform(with_place(flat, dim_geography), K.STAR["fact_vab"])


def census_fact(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    return conform(with_place(flat, dim_geography), K.STAR["fact_ocupacion_censo"])


def school_fact(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    return conform(with_place(flat, dim_geography), K.STAR["fact_oferta_academica"])


def employment_fact(flat: DataFrame, order: Column | None = None) -> DataFrame:
    """Long survey rows back to one row per round and indicator.

    Where surveys overlap, the first in ``order`` (by default the survey name) is taken.
    """
    first = F.coalesce(F.col("encuesta"), F.lit("")) if order is None else order
    wide = to_wide(flat, ["periodo", "anio", "indicador"], "area", "valor", K.AREA_TOTALS, first)
    return conform(wide, K.STAR["fact_empleo"])


def _first_in_files(flat: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row per key: the first in the files where the flat table keeps the place of its rows, else the lowest."""
    target = K.STAR[table]
    place = [flat.schema[K.ORDER]] if K.ORDER in flat.columns else []
    keyed = conform(drop_missing(flat, keys), T.StructType([*place, *target.fields]))
    return first_per_key(keyed, keys, [F.col(c).asc_nulls_last() for c in keyed.columns]).drop(K.ORDER)


def company_dimension(flat: DataFrame) -> DataFrame:
    return _first_in_files(flat, ["ruc"], "dim_empresas")


def industry_dimension(flat: DataFrame) -> DataFrame:
    return _first_in_files(flat, ["ciiu"], "dim_ciiu")


def ranking_fact(flat: DataFrame, dim_geography: DataFrame) -> DataFrame:
    return conform(with_province(flat, dim_geography), K.STAR["fact_ranking_empresarial"])
