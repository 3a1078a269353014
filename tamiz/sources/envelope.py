"""Record envelopes: one row per record, its indicator name and its JSON payload.

The payload of an indicator is parsed with a declared schema. :func:`discover_schema` finds
that schema once, from the data; it is meant to be stored, not to run with every load.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.sources.files import with_file_order

INDICATOR, PAYLOAD = "INDICADOR", "DATOS_JSON"
ENVELOPE_SCHEMA = T.StructType(
    [T.StructField(INDICATOR, T.StringType()), T.StructField(PAYLOAD, T.StringType())]
)


def read_envelope(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Stored envelope rows; ``order`` names a column for the place of each in its file, which "the last row wins" needs."""
    rows = spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
    return with_file_order(rows, order) if order else rows


def read_envelope_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    indicators: Sequence[str],
    fetch_rows: int = 50_000,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    splits: int = 1,
) -> DataFrame:
    """Envelope rows of a database table. Each indicator is read by ``splits`` tasks, dealt by the whole number
    ``split_on`` (a column or an expression of the database, such as a row id or a hash)."""
    return spark.read.jdbc(
        url,
        table,
        predicates=indicator_predicates(indicators, split_on, splits),
        properties={"fetchsize": str(fetch_rows), **(properties or {})},
    ).select(INDICATOR, PAYLOAD)


def indicator_predicates(indicators: Sequence[str], split_on: str | None = None, splits: int = 1) -> list[str]:
    """One predicate per read task. A name that ends in ``%`` stands for all indicators that begin with the rest."""
    predicates = []
    for name in indicators:
        quoted = name.replace("'", "''")
        if name.endswith("%"):
            start = quoted[:-1].replace("!", "!!").replace("%", "!%").replace("_", "!_")
            predicates.append(f"{INDICATOR} LIKE '{start}%' ESCAPE '!'")
        else:
            predicates.append(f"{INDICATOR} = '{quoted}'")
    if not split_on or splits < 2:
        return predicates
    part = f"MOD(ABS({split_on}), {splits})"
    # rows without a value to split on go with the first part
    return [f"{p} AND {f'({part} = 0 OR {split_on} IS NULL)' if i == 0 else f'{part} = {i}'}" for p in predicates for i in range(splits)]


def records_of(envelope: DataFrame, indicator: str, prefix: bool = False) -> DataFrame:
    """Rows of one indicator, or of all whose name starts with ``indicator``."""
    name = F.col(INDICATOR)
    return envelope.where(name.startswith(indicator) if prefix else name == indicator)


def _readable() -> Column:
    return F.try_parse_json(F.col(PAYLOAD)).isNotNull()


def parse_records(records: DataFrame, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Payload as a struct column ``record``, beside the columns to ``keep``; rows without a payload, or with one that is no JSON, are left
    out (see :func:`unreadable`)."""
    return records.where(F.col(PAYLOAD).isNotNull() & _readable()).select(F.from_json(PAYLOAD, schema).alias("record"), *keep)


def unreadable(envelope: DataFrame) -> DataFrame:
    """Per indicator: records, those without a payload, and those whose payload is no JSON."""
    return envelope.groupBy(INDICATOR).agg(
        F.count("*").alias("registros"),
        F.count_if(F.col(PAYLOAD).isNull()).alias("sin_datos"),
        F.count_if(F.col(PAYLOAD).isNotNull() & ~_readable()).alias("ilegibles"),
    )


def schema_profile(envelope: DataFrame) -> DataFrame:
    """Shape of the payloads per indicator, merged over all its records."""
    return envelope.groupBy(INDICATOR).agg(
        F.count("*").alias("registros"),
        F.schema_of_variant_agg(F.try_parse_json(F.col(PAYLOAD))).alias("esquema"),
    )


def discover_schema(records: DataFrame) -> T.StructType:
    """Schema of the payloads of one indicator, ready for :func:`parse_records`."""
    return _struct_of(records.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(PAYLOAD)))).first()[0])


def _struct_of(shape: str | None, voids: bool = False) -> T.StructType:
    """The type that Spark's text for the shape of variants describes. What was never but NULL is text, unless ``voids``
    says to keep it apart, since a later load may tell."""
    if not shape or shape == "VOID":
        return T.StructType([])
    # types stand after a colon, an opening bracket or at the start; the same letters in a key do not
    ddl = re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", shape)
    return _widened(T.StructType.fromDDL(ddl if voids else re.sub(r"(: |<)VOID(?=[,>]|$)", r"\1STRING", ddl)))


def _widened(kind: T.DataType) -> T.DataType:
    """Decimals of the width seen so far as doubles, since the next record may have wider ones."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _widened(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_widened(kind.elementType), kind.containsNull)
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def _unseen_paths(seen: T.StructType, declared: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    known = {f.name: f.dataType for f in declared.fields}
    for field in seen.fields:
        here = (*path, field.name)
        if field.name not in known:
            yield here
        elif isinstance(field.dataType, T.StructType) and isinstance(known[field.name], T.StructType):
            yield from _unseen_paths(field.dataType, known[field.name], here)


def unseen_keys(records: DataFrame, schema: T.StructType, nested: bool = False) -> DataFrame:
    """Payload keys that ``schema`` does not declare, with the rows that hold them: those of the top level,
    or, ``nested``, those inside declared objects too (``a.b``)."""
    paths = [p for p in _unseen_paths(discover_schema(records), schema) if nested or len(p) == 1]
    if not paths:
        return records.select(F.lit("").alias("clave"), F.lit(0).cast("long").alias("registros")).limit(0)

    def holds(path: tuple[str, ...]) -> Column:
        parent = F.get_json_object(PAYLOAD, "$" + "".join(f"['{p}']" for p in path[:-1])) if path[1:] else F.col(PAYLOAD)
        return F.coalesce(F.array_contains(F.json_object_keys(parent), path[-1]), F.lit(False))

    counted = records.agg(*[F.count_if(holds(p)).alias(f"_{i}") for i, p in enumerate(paths)])
    listed = F.array(*[F.struct(F.lit(".".join(p)).alias("clave"), F.col(f"_{i}").alias("registros")) for i, p in enumerate(paths)])
    return counted.select(F.inline(listed).alias("clave", "registros"))


RECORD = "registro"


def as_variants(envelope: DataFrame) -> DataFrame:
    """(INDICADOR, registro): payloads as VARIANT, which needs no schema to be stored. Payloads that are no JSON are left
    out (see :func:`unreadable`)."""
    return envelope.select(INDICATOR, F.try_parse_json(F.col(PAYLOAD)).alias(RECORD)).where(F.col(RECORD).isNotNull())


def variant_schema(records: DataFrame) -> T.StructType:
    """Schema of the records of one indicator stored as VARIANT, ready for :func:`join_schemas`."""
    return _struct_of(records.agg(F.schema_of_variant_agg(RECORD)).first()[0], voids=True)


def join_schemas(known: T.DataType, newer: T.DataType) -> T.DataType:
    """The schema that holds what both do: keys of either, in the order they were first seen, in the wider type. Whole
    numbers and others make a double; anything else that differs is read as text."""
    if known == newer:
        return known
    if isinstance(known, T.NullType) or isinstance(newer, T.NullType):
        return newer if isinstance(known, T.NullType) else known
    if isinstance(known, T.StructType) and isinstance(newer, T.StructType):
        late = {f.name: f.dataType for f in newer.fields}
        shared = [T.StructField(f.name, join_schemas(f.dataType, late.pop(f.name)) if f.name in late else f.dataType) for f in known.fields]
        return T.StructType([*shared, *[T.StructField(n, kind) for n, kind in late.items()]])
    if isinstance(known, T.ArrayType) and isinstance(newer, T.ArrayType):
        return T.ArrayType(join_schemas(known.elementType, newer.elementType))
    if isinstance(known, T.NumericType) and isinstance(newer, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def read_variants(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records stored as VARIANT as a struct column ``record`` of ``schema``, ready for ``operators.columns.flatten``. A
    value that does not fit its type is NULL."""
    return records.select(_from_variant("$", schema).alias("record"))


def _from_variant(path: str, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StructType) or not kind.fields:
        unknown = isinstance(kind, (T.StructType, T.NullType))
        return F.try_variant_get(RECORD, path, "string" if unknown else kind.simpleString())
    return F.struct(*[_from_variant(f"{path}['{_quoted(f.name)}']", f.dataType).alias(f.name) for f in kind.fields])


def _quoted(name: str) -> str:
    if "'" in name:
        raise ValueError(f"a path cannot name the key {name!r}")
    return name


def variant_leaves(spark: SparkSession, records: DataFrame, schema: T.StructType) -> DataFrame:
    """(INDICADOR, clave, valor) for every value that is no object, in long form: one level of ``variant_explode`` for each
    level of ``schema``. Keys are joined by dots; arrays stay whole, as text."""
    level = records.select(INDICATOR, F.lit("").alias("clave"), F.col(RECORD).alias("v"))
    leaves = []
    for depth in range(_depth(schema)):
        exploded = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        at = F.col("key") if depth == 0 else F.concat_ws(".", "clave", "key")
        found = exploded.where(F.col("key").isNotNull()).select(INDICATOR, at.alias("clave"), F.col("value").alias("v"))
        inner = F.schema_of_variant("v").startswith("OBJECT")
        leaves.append(found.where(~inner).select(INDICATOR, "clave", F.col("v").cast("string").alias("valor")))
        level = found.where(inner)
    return reduce(DataFrame.unionByName, leaves)


def _depth(kind: T.DataType) -> int:
    return 1 + max((_depth(f.dataType) for f in kind.fields), default=0) if isinstance(kind, T.StructType) else 0
