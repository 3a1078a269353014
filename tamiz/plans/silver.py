"""Cleaning of the raw files into flat tables. Each function is one lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.numbers import number_or_null, number_or_zero, year_of_label
from tamiz.functions.periods import period_date, year_start
from tamiz.functions.text import missing_to_null, strip_label
from tamiz.operators.columns import keep_wanted, lower_case_columns, rename, rename_by_position, snake_case_columns
from tamiz.operators.reshape import to_long
from tamiz.operators.rows import clear_missing, drop_missing, first_per_key
from tamiz.plans import contract as K


def _by_all(df: DataFrame, *first: str | Column) -> list[Column]:
    """A total order: the given columns, then all others, so that "first" is repeatable."""
    return [*(F.col(c) if isinstance(c, str) else c for c in first), *[F.col(c).asc_nulls_last() for c in df.columns]]


def gdp_real(sheet: DataFrame) -> DataFrame:
    """Real GDP by year from its sheet (see ``sources.files.read_sheet_below_marker``)."""
    named = rename_by_position(sheet, dict(enumerate(K.GDP_REAL_NAMES)))
    numbers = named.withColumns({c: number_or_null(F.col(c)) for c in K.GDP_REAL_NAMES[1:]})
    return drop_missing(numbers, ["pib_real_musd"]).withColumn("anio", year_of_label(F.col("anio")))


def gdp_nominal(sheet: DataFrame, since: int = K.GDP_NOMINAL_FIRST_YEAR) -> DataFrame:
    """Nominal GDP per head by year; its columns are known by position only."""
    named = rename_by_position(sheet, K.GDP_NOMINAL_POSITIONS)
    value = number_or_null(F.col("pib_percapita_nominal_usd"))
    clean = drop_missing(named.withColumn("pib_percapita_nominal_usd", value), ["pib_percapita_nominal_usd"])
    years = clean.withColumn("periodo", year_of_label(F.col("periodo"))).where(F.col("periodo") >= since)
    return years.select(year_start(F.col("periodo")).alias("fecha"), "periodo", "pib_percapita_nominal_usd")


def daily_indicators(frame: DataFrame) -> DataFrame:
    """Oil price and country risk by day."""
    return rename(frame, {"Período": "fecha"}).withColumn("fecha", F.col("fecha").try_cast("date"))


def expectations_index(frame: DataFrame) -> DataFrame:
    """Business expectations by month."""
    return lower_case_columns(frame).withColumn("fecha", F.col("fecha").try_cast("date"))


def value_added(frame: DataFrame) -> DataFrame:
    return rename(lower_case_columns(frame), {"año": "anio"})


def labour_survey(sheet: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Survey indicators in long form: one row per round, indicator and area."""
    named = sheet.withColumns(
        {"encuesta": missing_to_null(F.col("encuesta")), "indicador": missing_to_null(F.col("indicador"))}
    )
    kept = drop_missing(named, ["indicador", "periodo"])
    long = to_long(kept, ["encuesta", "periodo", "indicador", *keep], K.AREAS, "area", "valor")
    dated = long.withColumn("fecha", period_date(F.col("periodo")))
    return dated.select(
        "encuesta", "periodo", "fecha", F.year("fecha").alias("anio"), "indicador", "area", "valor", *keep
    )


def census_occupation(sheet: DataFrame) -> DataFrame:
    """Census counts in long form: one row per place, sex, age group and branch."""
    named = clear_missing(sheet.drop("indice"), ["provincia", "canton", "sexo", "grupo_edad"])
    typed = drop_missing(named, ["provincia"]).withColumns(
        {
            "provincia": F.upper("provincia"),
            "canton": F.upper("canton"),
            "total_ocupados": number_or_null(F.col("total_ocupados")),
        }
    )
    return to_long(typed, K.CENSUS_KEYS, K.BRANCHES, "rama_actividad", "personas_ocupadas")


def company_directory(sheet: DataFrame, order: str | None = None) -> DataFrame:
    """Companies, one row per tax number: the first in ``order`` (a column of the sheet)."""
    named = rename(snake_case_columns(sheet), K.DIRECTORY_RENAMES)
    texts = [c for c in ("nombre", "situacion_legal", "provincia", "canton") if c in named.columns]
    clean = named.withColumns(
        {
            "ruc": missing_to_null(F.col("ruc")),
            "expediente": number_or_null(F.col("expediente")).try_cast("bigint"),
            **{c: F.upper(missing_to_null(F.col(c))) for c in texts},
        }
    )
    keyed = drop_missing(clean, ["ruc", "expediente"])
    useful = keep_wanted(keyed, [*K.DIRECTORY_COLUMNS, *([order] if order else [])])
    one = first_per_key(useful, ["ruc"], _by_all(useful, *([order] if order else [])))
    return keep_wanted(one, K.DIRECTORY_COLUMNS)


def industry_catalogue(frame: DataFrame, order: str | None = None) -> DataFrame:
    """Industry codes with their description, one row per code."""
    named = snake_case_columns(frame)
    clean = clear_missing(named, ["ciiu", "descripcion"])
    one = first_per_key(drop_missing(clean, ["ciiu"]), ["ciiu"], _by_all(named, *([order] if order else [])))
    return one.drop(*([order] if order else []))


def company_ranking(frame: DataFrame, directory: DataFrame | None = None) -> DataFrame:
    """Financial ranking by company and year, with names from the directory where known.

    A file number the directory repeats would multiply rows, so it is reduced to one first.
    """
    named = keep_wanted(snake_case_columns(frame), list(K.RANKING_TYPES))
    numbers = [c for c, kind in K.RANKING_TYPES.items() if isinstance(kind, T.DoubleType) and c in named.columns]
    clean = named.withColumns(
        {
            c: number_or_null(F.col(c)).try_cast("bigint") if c in K.RANKING_WHOLE else number_or_null(F.col(c))
            for c in numbers
        }
    )
    ranked = drop_missing(clean, ["expediente"])
    if directory is None:
        return ranked
    known = directory.select("expediente", "ruc", "nombre", "situacion_legal", "provincia")
    known = first_per_key(known, ["expediente"], _by_all(known))
    return ranked.join(known, "expediente", "left").select(
        *ranked.columns, "ruc", "nombre", "situacion_legal", "provincia"
    )


def school_history(frame: DataFrame) -> DataFrame:
    """School register over the years: the wanted columns of a wide sheet, cleaned."""
    wanted = keep_wanted(frame, K.SCHOOL_COLUMNS)
    named = rename(snake_case_columns(wanted), K.SCHOOL_RENAMES)
    counts = {c: number_or_zero(F.col(c)) for c in K.SCHOOL_COUNTS if c in named.columns}
    texts = {c: missing_to_null(F.col(c)) for c in ("nombre_institucion", "sostenimiento", "amie") if c in named.columns}
    places = {c: F.upper(missing_to_null(F.col(c))) for c in ("provincia", "canton") if c in named.columns}
    year = {"anio_lectivo": strip_label(F.col("anio_lectivo"), K.SCHOOL_YEAR_LABEL)}
    return drop_missing(named.withColumns({**counts, **texts, **places, **year}), ["amie"])


def school_register(frame: DataFrame, school_year: str | None = None, order: str | None = None) -> DataFrame:
    """Single-year school register, one row per school and year, counts with 0 for missing."""
    named = rename(frame, K.REGISTER_RENAMES)
    counted = named.withColumns({c: number_or_zero(F.col(c)) for c in K.REGISTER_COUNTS})
    one = first_per_key(counted, ["cod_amie", "anio_lectivo"], _by_all(counted, *([order] if order else [])))
    return one if school_year is None else one.where(F.col("anio_lectivo") == school_year)
