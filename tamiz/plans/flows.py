"""End-to-end runs: raw inputs to flat tables, star schema, gold and audits.

A run writes its tables as one release of a layer (see ``sources.layers``), and reads them back
before they are used again: dimensions then have a known size, and no step is computed twice.
Tables that several inputs feed are written in the order of their references.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import is_blank
from tamiz.operators import audits
from tamiz.operators.columns import missing_columns
from tamiz.operators.keys import extend_ids
from tamiz.operators.rows import clear_blank
from tamiz.plans import contract as K
from tamiz.plans import gold, indicators, refresh, silver, star
from tamiz.sources import files, layers
from tamiz.sources.loads import Figures, Loaded, all_rows

Tables = dict[str, DataFrame]
Raw = Callable[[SparkSession, str], DataFrame]

_BAD = "_malo"
#: Rows of files that do not parse, with their place; written by :func:`load_files`.
REJECTED = "filas_rechazadas"
REJECTED_SCHEMA = "tabla string, archivo string, bloque bigint, fila bigint, registro string"


class Layer(layers.Layer):
    """A layer of this library's tables, laid out as ``contract`` says."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        super().__init__(spark, folder, K.PARTITIONS, keep)


@dataclass(frozen=True)
class FileJob:
    """Raw files to one flat table. ``wanted`` are the columns of a wide sheet that the job uses if they are there."""

    read: Raw
    clean: Callable[[DataFrame], DataFrame]
    wanted: tuple[str, ...] = ()


def _text_csv(sep: str = ",", encoding: str = files.UTF8) -> Raw:
    return lambda spark, path: files.read_csv_as_text(spark, path, sep, encoding, order=K.ORDER, corrupt=_BAD)


def _wide_csv(columns: tuple[str, ...]) -> Raw:
    wanted = {c: T.StringType() for c in columns}
    return lambda spark, path: files.read_csv_columns(spark, path, wanted, order=K.ORDER, corrupt=_BAD)


def _ordered(clean: Callable[..., DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """"First" and "last" row mean the order in the files."""
    return lambda raw: clean(raw, order=K.ORDER).drop(K.ORDER)


def _plain(clean: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: clean(raw.drop(K.ORDER))


#: Jobs over raw exports by the name of their flat table, as :func:`build_star` knows them, and the single-year register.
FILE_JOBS: dict[str, FileJob] = {
    "macro_anual": FileJob(lambda spark, path: files.read_sheet_below_marker(spark, path, K.GDP_MARKER), silver.gdp_real),
    "pib_nominal": FileJob(lambda spark, path: files.read_sheet_below_marker(spark, path, K.GDP_MARKER), silver.gdp_nominal),
    "indicadores_diarios": FileJob(_text_csv(), _plain(silver.daily_indicators)),
    "iee": FileJob(_text_csv(), _plain(silver.expectations_index)),
    "vab": FileJob(_text_csv(), _plain(silver.value_added)),
    "empleo": FileJob(
        lambda spark, path: files.read_sheet(spark, path, list(K.SURVEY_NAMES), F.col("periodo").isNotNull()), silver.labour_survey
    ),
    "ocupacion_censo": FileJob(
        lambda spark, path: files.read_sheet(spark, path, list(K.CENSUS_NAMES), F.col("provincia").isNotNull()), silver.census_occupation
    ),
    "empresas": FileJob(_text_csv(), _ordered(silver.company_directory)),
    "ciiu": FileJob(
        lambda spark, path: files.read_csv_any_charset(
            spark, path, T.StructType.fromDDL("CIIU string, DESCRIPCION string"), order=K.ORDER, corrupt=_BAD
        ),
        _ordered(silver.industry_catalogue),
    ),
    "oferta_academica": FileJob(_wide_csv(K.SCHOOL_COLUMNS), _plain(silver.school_history), K.SCHOOL_COLUMNS),
    "registro": FileJob(_text_csv(";", files.LATIN1), _ordered(silver.school_register)),
    "ranking": FileJob(_wide_csv(tuple(K.RANKING_TYPES)), _plain(silver.company_ranking), tuple(K.RANKING_TYPES)),
}


def _staged(job: FileJob, raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """Raw rows, and those that did not parse where the reader finds them (see ``sources.files.set_aside``)."""
    return files.set_aside(raw, _BAD, K.ORDER, name) if _BAD in raw.columns else (raw, None)


def load_files(spark: SparkSession, folders: dict[str, str], layer: Layer) -> Loaded:
    """Raw files to stored flat tables: one folder of files for each job of :data:`FILE_JOBS` that is asked for.

    Rows that do not parse are counted and kept in :data:`REJECTED`; columns that a job would use and no file
    has are counted too. The ranking takes names from the directory, if that is loaded with it."""
    figures = Figures()
    raw, rejected = {}, []
    for name, (rows, bad) in zip(folders, layers.concurrently(lambda name, path: _staged(FILE_JOBS[name], FILE_JOBS[name].read(spark, path), name), folders)):
        raw[name] = rows
        rejected += [bad] if bad is not None else []
        if FILE_JOBS[name].wanted:
            figures.add(name, "columnas_ausentes", len(missing_columns(rows, FILE_JOBS[name].wanted)))
    with layer.release() as new:
        cleaned = {name: FILE_JOBS[name].clean(figures.take(rows, name, leidas=all_rows())) for name, rows in raw.items() if name != "ranking"}
        loaded = new.put_all({name: figures.take(rows, name, cargadas=all_rows()) for name, rows in cleaned.items()})
        if "ranking" in raw:
            rows = figures.take(raw["ranking"], "ranking", leidas=all_rows())
            ranked = silver.company_ranking(rows.drop(K.ORDER), loaded.get("empresas"))
            loaded["ranking"] = new.put("ranking", figures.take(ranked, "ranking", cargadas=all_rows()))
        bad = audits.union_all(rejected) if rejected else spark.createDataFrame([], REJECTED_SCHEMA)
        loaded[REJECTED] = new.put(REJECTED, figures.take(bad, REJECTED, cargadas=all_rows()))
    return Loaded(loaded, figures.report(spark))


def load_envelope(envelope: DataFrame, schemas: dict[str, indicators.Schema], silver: Layer) -> Tables:
    """Envelope to flat tables; an indicator without a schema or records is skipped. Real GDP does without
    the nominal series, whose column is NULL then."""
    made: dict[str, DataFrame] = {}
    if K.GDP_REAL in schemas:
        made["fact_macro_anual"] = indicators.gdp(envelope, schemas[K.GDP_REAL], schemas.get(K.GDP_NOMINAL))
    builders = {
        K.VALUE_ADDED: ("fact_vab_geografico", indicators.value_added),
        K.DIRECTORY: ("fact_directorio_companias", indicators.companies),
        K.RANKING: ("fact_ranking_empresarial", indicators.ranking),
        K.SCHOOLS: ("fact_mineduc_amie", indicators.schools),
        K.EMPLOYMENT: ("fact_empleo_enemdu", indicators.employment),
    }
    for indicator, (name, build) in builders.items():
        if indicator in schemas:
            made[name] = build(envelope, schemas[indicator])
    with silver.release() as new:
        loaded = new.put_filled(made)
        if "fact_mineduc_amie" in loaded:
            loaded["fact_mineduc_bachilleres"] = new.put("fact_mineduc_bachilleres", indicators.graduates(loaded["fact_mineduc_amie"]))
    return loaded


def build_star(flat: Tables, layer: Layer) -> Tables:
    """Flat tables to the star schema, dimensions first, as one release.

    ``flat`` holds the cleaned tables by name: ``macro_anual``, ``pib_nominal``,
    ``indicadores_diarios``, ``iee``, ``vab``, ``empleo``, ``ocupacion_censo``, ``ranking``,
    ``oferta_academica``, ``empresas`` and ``ciiu``. Several facts and dimensions read the
    same one, so they should be stored tables (see :meth:`Layer.put_all`).
    """
    schools = flat["oferta_academica"]
    with layer.release() as new:
        dimensions = new.put_all(
            {
                "dim_geografia": star.geography([flat["vab"], flat["empresas"]], schools),
                "dim_tiempo": star.time([flat["macro_anual"].select("anio"), flat["pib_nominal"].select("periodo")]),
                "dim_ciiu": star.industry_dimension(flat["ciiu"]),
                "dim_empresas": star.company_dimension(flat["empresas"]),
            }
        )
        geography, time = dimensions["dim_geografia"], dimensions["dim_tiempo"]
        facts = new.put_all(
            {
                "fact_macro_anual": star.macro_fact(flat["macro_anual"], flat["pib_nominal"], time),
                "fact_indicadores_diarios": star.daily_fact(flat["indicadores_diarios"]),
                "fact_iee": star.expectations_fact(flat["iee"]),
                "fact_vab": star.value_added_fact(flat["vab"], geography),
                "fact_empleo": star.employment_fact(flat["empleo"]),
                "fact_ocupacion_censo": star.census_fact(flat["ocupacion_censo"], geography),
                "fact_ranking_empresarial": star.ranking_fact(flat["ranking"], geography),
                "fact_oferta_academica": star.school_fact(schools, geography),
            }
        )
    return {**dimensions, **facts}


def files_to_star(spark: SparkSession, folders: dict[str, str], silver_layer: Layer, star_layer: Layer) -> Loaded:
    """Raw files to a stored star schema in one run. ``folders`` has one folder for each table of :func:`build_star`."""
    flat = load_files(spark, folders, silver_layer)
    return Loaded(build_star(flat, star_layer), flat.report)


def refresh_star(newer: Tables, layer: Layer, period: str) -> Loaded:
    """Bring a stored star schema up to date with newer flat tables (those of the envelope).

    Companies and the ranking are replaced, years the newer series has are overwritten, head
    counts get a table of their own, a new school year is appended if it is not there yet, and
    blank industry codes become NULL. Places the star does not know get ids past the ones it gave, which
    stay as they are. A second run changes nothing. All tables change together, in one release.

    The report says for each table what was read, matched, left out, lost and loaded.
    """
    figures = Figures()
    stored = {name: layer.get(name, schema) for name, schema in K.STAR.items() if name != "fact_empleo_poblacion"}
    time = stored["dim_tiempo"]
    directory = newer["fact_directorio_companias"]
    lookup = refresh.directory_lookup(directory)
    macro, value_added = stored["fact_macro_anual"], stored["fact_vab"]
    with layer.release() as new:
        places = refresh.places(directory, newer["fact_mineduc_amie"])
        geography = new.put("dim_geografia", extend_ids(stored["dim_geografia"], places, ["provincia", "canton"], "id_geografia"))
        changed = {
            "dim_empresas": clear_blank(refresh.companies(directory, figures=figures), ["ciiu_n1", "ciiu_n6"]),
            "fact_ranking_empresarial": clear_blank(
                refresh.ranking(newer["fact_ranking_empresarial"], lookup, geography, figures), ["ciiu_n6"]
            ),
            "fact_empleo_poblacion": refresh.employment_counts(newer["fact_empleo_enemdu"], figures),
            "fact_macro_anual": refresh.macro(macro, newer["fact_macro_anual"], time, figures),
        }
        blank = value_added.where(F.col("ciiu").isNotNull() & is_blank(F.col("ciiu"))).count()
        figures.add("fact_vab", "limpiadas", blank)
        if blank:  # else the table stays as it is, unwritten
            changed["fact_vab"] = clear_blank(value_added, ["ciiu"])
        replaced = new.put_all(changed)
        before = stored["fact_oferta_academica"].count()
        school_year = refresh.school_year(newer["fact_mineduc_amie"], geography, period, figures)
        replaced["fact_oferta_academica"] = new.append_periods("fact_oferta_academica", school_year, "anio_lectivo")
        figures.add("fact_oferta_academica", "cargadas", replaced["fact_oferta_academica"].count() - before)
        figures.add("dim_geografia", "nuevas", geography.count() - stored["dim_geografia"].count())
    return Loaded({**stored, "dim_geografia": geography, **replaced}, figures.report(layer.spark))


def audit_star(tables: Tables) -> DataFrame:
    """Referential report over the declared references."""
    return audits.check_references(tables, K.REFERENCES)


def audit_constraints(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """NULLs in required columns, and repeats of unique keys."""
    return audits.check_required(tables, K.STAR), audits.check_unique(tables, K.UNIQUE_KEYS)


def audit_gold(tables: Tables) -> DataFrame:
    """Row counts of the gold views of the star schema."""
    return audits.view_rows(gold.star_views(tables))
