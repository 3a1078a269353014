"""Envelope records to flat tables, one function per indicator.

Payloads are parsed with a declared schema (``sources.envelope.discover_schema`` finds it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.charset import repair_mojibake
from tamiz.functions.numbers import exact_sum, number_or_null, row_sum
from tamiz.functions.text import missing_to_null
from tamiz.operators.columns import flatten, resolve
from tamiz.plans import contract as K
from tamiz.sources.envelope import parse_records, records_of

Schema = T.StructType | str


def _clean_text(df: DataFrame) -> DataFrame:
    """Repair the charset of every text column and turn missing-value texts into NULL."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: missing_to_null(repair_mojibake(F.col(c))) for c in texts})


def flat_records(
    envelope: DataFrame, indicator: str, schema: Schema, prefix: bool = False, last_segment: bool = False, ordered: bool = False
) -> DataFrame:
    """Records of an indicator as a flat table of clean text and numbers, ``ordered`` with their place in the
    envelope if it has one (see ``sources.envelope.read_envelope``)."""
    place = [K.ORDER] if ordered and K.ORDER in envelope.columns else []
    records = parse_records(records_of(envelope, indicator, prefix), schema, place)
    return _clean_text(flatten(records, "record", last_segment, place))


def gdp(envelope: DataFrame, real_schema: Schema, nominal_schema: Schema | None) -> DataFrame:
    """Real GDP with the nominal value of the same year beside it (NULL without the nominal series)."""
    real = flat_records(envelope, K.GDP_REAL, real_schema)
    if nominal_schema is None:
        return real.withColumn("pib_pc_nominal_usd", F.lit(None).cast("double"))
    nominal = flat_records(envelope, K.GDP_NOMINAL, nominal_schema).select("anio_fiscal", "pib_pc_nominal_usd")
    return real.join(nominal, "anio_fiscal", "left")


def value_added(envelope: DataFrame, schema: Schema) -> DataFrame:
    """Value added by place; its amount column is known by a part of its name."""
    flat = flat_records(envelope, K.VALUE_ADDED, schema)
    try:
        amount = resolve(flat.columns, ["vab", "valor", "usd", "miles"], any_of=True)
    except LookupError:
        amount = flat.columns[-1]
    return flat.withColumnRenamed(amount, "valor")


def companies(envelope: DataFrame, schema: Schema) -> DataFrame:
    """The directory; where the envelope says in which order its rows came, they keep their place."""
    return flat_records(envelope, K.DIRECTORY, schema, last_segment=True, ordered=True)


def ranking(envelope: DataFrame, schema: Schema) -> DataFrame:
    return flat_records(envelope, K.RANKING, schema, last_segment=True)


def schools(envelope: DataFrame, schema: Schema) -> DataFrame:
    return flat_records(envelope, K.SCHOOLS, schema, prefix=True)


def graduates(schools_flat: DataFrame) -> DataFrame:
    """Last-year students of both sexes by year and province."""
    columns = schools_flat.columns
    province = resolve(columns, ["provincia"], lacks=["cod"])
    year = resolve(columns, ["anio", "base"], any_of=True)
    both = [resolve(columns, ["bach", f"3er_ano_{sex}"]) for sex in ("m", "h")]
    total = row_sum(*[number_or_null(F.col(c)) for c in both])
    return (
        schools_flat.groupBy(F.col(year).alias("anio"), F.col(province).alias("provincia"))
        .agg(exact_sum(total).cast("double").alias("bachilleres_3ro"))
    )


def employment(envelope: DataFrame, schema: Schema) -> DataFrame:
    """Head counts by round and indicator, one column per area."""
    flat = flat_records(envelope, K.EMPLOYMENT, schema)
    parts = {
        "periodo": "periodo_original", "anio": "anio_fiscal", "indicador": "nombre_indicador",
        "total_nacional": "nacional_total", "total_urbana": "area_urbana", "total_rural": "area_rural",
    }
    found = {name: resolve(flat.columns, [part]) for name, part in parts.items()}
    return flat.select(
        [
            (number_or_null(F.col(source)) if name.startswith("total_") else F.col(source)).alias(name)
            for name, source in found.items()
        ]
    )
