"""Refresh of the star schema from newer flat tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.numbers import amount_or_null, integer_or_zero, row_sum
from tamiz.functions.text import geo_key, is_blank
from tamiz.operators.columns import conform, conform_lost, rename
from tamiz.operators.rows import first_per_key
from tamiz.plans import contract as K
from tamiz.plans.star import with_place, with_province
from tamiz.sources.loads import Figures, all_rows, take
from tamiz.sources.tables import update_matched

# Columns of the newer flat tables and what they are called in the star schema.
COMPANY_RENAMES = {"ciiu_nivel1": "ciiu_n1", "ciiu_nivel6": "ciiu_n6", "ultimo_balance_anio": "ultimo_balance"}
SCHOOL_RENAMES = {
    "institucion_amie": "amie",
    "institucion_nombre": "nombre_institucion",
    "institucion_sostenimiento": "sostenimiento",
    "institucion_provincia": "provincia",
    "institucion_canton": "canton",
}
SCHOOL_TOTAL = "estudiantes_resumen_total_estudiantes"
SCHOOL_GRADE = "estudiantes_detallado_bachillerato_{}_ano_{}"
GRADES, SEXES = ("1er", "2do", "3er"), ("m", "h")
PEOPLE_PER_THOUSAND = 1000


def _order(flat: DataFrame, order: str | None) -> list[str]:
    """The column that says which row comes first: the one asked for, or the place in the files if the table keeps it."""
    return [order] if order else [K.ORDER] if K.ORDER in flat.columns else []


def _conform(df: DataFrame, table: str, figures: Figures | None) -> DataFrame:
    """Rows in the types of a table of the star, with what that loses and how many rows it makes."""
    counted = take(figures, df, table, perdidos=conform_lost(df, K.STAR[table]), cargadas=all_rows())
    return conform(counted, K.STAR[table])


def companies(flat: DataFrame, order: str | None = None, figures: Figures | None = None) -> DataFrame:
    """Companies with a tax number, one row each (the first in ``order``); places under normalised names.

    ``operators.audits.duplicate_summary`` tells how many rows a repeated number leaves out."""
    blank = is_blank(F.col("ruc"))
    read = take(figures, flat, "dim_empresas", leidas=all_rows(), excluidas=F.count_if(blank))
    named = rename(read, COMPANY_RENAMES).where(~blank)
    first = _order(flat, order)
    by = [F.col(c).asc_nulls_last() for c in first + [c for c in named.columns if c not in first]]
    kept = first_per_key(named, ["ruc"], by)
    placed = kept.withColumns({c: geo_key(F.col(c)) for c in ("provincia", "canton")})
    return _conform(placed, "dim_empresas", figures)


def directory_lookup(flat: DataFrame, order: str | None = None) -> DataFrame:
    """Tax number and province by file number, the last row of each in ``order``."""
    first = _order(flat, order)
    kept = flat.where(~is_blank(F.col("ruc"))).select("expediente", "ruc", "provincia", *first)
    last = [F.col(c).desc_nulls_last() for c in first + ["ruc", "provincia"]]
    return first_per_key(kept, ["expediente"], last).select("expediente", "ruc", "provincia")


def places(*flat: DataFrame) -> DataFrame:
    """Province and canton that the rows of newer tables name, normalised; of a table without cantons provinces only."""
    named = []
    for df in flat:
        df = rename(df, SCHOOL_RENAMES)
        pair = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("provincia", "canton")]
        raw = df.select(*pair).distinct()
        named.append(raw.select(geo_key(F.col("provincia")).alias("provincia"), geo_key(F.col("canton")).alias("canton")))
    return reduce(DataFrame.union, named).where(F.col("provincia").isNotNull()).distinct()


def ranking_matches(flat: DataFrame, lookup: DataFrame) -> DataFrame:
    """Ranking rows with what the directory knows about the company (left join)."""
    return flat.join(lookup.select("expediente", "ruc", "provincia"), "expediente", "left")


def ranking(flat: DataFrame, lookup: DataFrame, dim_geography: DataFrame, figures: Figures | None = None) -> DataFrame:
    """Ranking rows of known companies, under the id of the company's province."""
    table = "fact_ranking_empresarial"
    # the unmatched are counted on the way and dropped behind the join, which drops them anyway
    matches = ranking_matches(flat, lookup)
    counted = take(figures, matches, table, leidas=all_rows(), sin_expediente=F.count_if(F.col("ruc").isNull()))
    known = counted.where(F.col("ruc").isNotNull())
    amounts = ("anio", "ingresos_totales", "activos", "patrimonio", "utilidad_neta")
    typed = known.withColumns({c: amount_or_null(F.col(c)) for c in amounts if c in known.columns})
    placed = with_province(typed, dim_geography)
    return _conform(take(figures, placed, table, sin_geografia=F.count_if(F.col("id_geografia").isNull())), table, figures)


def macro(target: DataFrame, newer: DataFrame, dim_time: DataFrame, figures: Figures | None = None) -> DataFrame:
    """The yearly fact with the newer values wherever they have the year."""
    table = "fact_macro_anual"
    dated = newer.join(dim_time.select("id_tiempo", F.col("anio").alias("anio_fiscal")), "anio_fiscal", "left")
    dated = take(figures, dated, table, leidas=all_rows(), sin_anio=F.count_if(F.col("id_tiempo").isNull()))
    source = dated.where(F.col("id_tiempo").isNotNull()).select(
        "id_tiempo",
        F.col("pib_real_millones").alias("pib_real_musd"),
        (F.col("poblacion_total") / PEOPLE_PER_THOUSAND).alias("poblacion_miles"),
        F.col("pib_pc_nominal_usd").alias("pib_percapita_nominal_usd"),
        F.col("tasa_variacion_anual").alias("variacion_pib_pct"),
    )
    values = [c for c in source.columns if c != "id_tiempo"]
    updated = update_matched(target, source, "id_tiempo", values, flag="_hit")
    updated = take(figures, updated, table, actualizadas=F.count_if(F.col("_hit")), sin_cambio=F.count_if(~F.col("_hit")))
    return _conform(updated.drop("_hit"), table, figures)


def employment_counts(flat: DataFrame, figures: Figures | None = None) -> DataFrame:
    """Head counts stay in a table of their own: the other one holds rates."""
    table = "fact_empleo_poblacion"
    return _conform(take(figures, flat, table, leidas=all_rows()), table, figures)


def school_year(flat: DataFrame, dim_geography: DataFrame, period: str, figures: Figures | None = None) -> DataFrame:
    """Rows of a new school year, to be appended with ``sources.tables.append_new_periods``."""
    grade = {
        g: row_sum(*[integer_or_zero(F.col(SCHOOL_GRADE.format(g, sex))) for sex in SEXES]) for g in GRADES
    }
    counted = rename(flat, SCHOOL_RENAMES).withColumns(
        {
            "anio_lectivo": F.lit(period),
            "total_estudiantes": integer_or_zero(F.col(SCHOOL_TOTAL)),
            "bachillerato": row_sum(*grade.values()),
            "bachilleres_3er_anio": grade[GRADES[-1]],
        }
    )
    table = "fact_oferta_academica"
    placed = with_place(counted, dim_geography)
    counted = take(figures, placed, table, leidas=all_rows(), sin_geografia=F.count_if(F.col("id_geografia").isNull()), perdidos=conform_lost(placed, K.STAR[table]))
    return conform(counted, K.STAR[table])
