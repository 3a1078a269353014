import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import values
from tamiz.operators import states
from tamiz.operators.keys import extend_ids
from tamiz.session import materialise
from tamiz.sources.envelope import join_schemas
from tamiz.operators import audits, columns, keys, reshape, rows, summary, windows


def test_dense_ids_are_consecutive_over_partitions(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k")).repartition(7)
    got = sorted(values(keys.dense_ids(df, ["k"], "id"), "k", "id"))
    assert got == [(i, i + 1) for i in range(n)]


def test_null_keys_meet_null_keys(frame):
    fact = frame([("AZUAY", None), ("AZUAY", "CUENCA"), ("LOJA", "X")], "p string, c string")
    dim = frame([(1, "AZUAY", None), (2, "AZUAY", "CUENCA")], "id int, provincia string, canton string")
    got = keys.resolve_key(fact, dim, {"provincia": F.col("p"), "canton": F.col("c")}, "id")
    assert sorted(values(got), key=str) == [(1, "AZUAY", None), (2, "AZUAY", "CUENCA"), (None, "LOJA", "X")]


def test_first_per_key_takes_whole_rows(frame):
    df = frame([("a", 2, None), ("a", 1, "x"), ("b", 5, None)], "k string, o int, v string")
    assert sorted(values(rows.first_per_key(df, ["k"], [F.col("o")]))) == [("a", 1, "x"), ("b", 5, None)]


def test_pivot_takes_first_non_null_and_adds_absent_areas(frame):
    df = frame(
        [("r", 1, "i", "nacional", None, "A"), ("r", 1, "i", "nacional", 5.0, "B"), ("r", 1, "i", "nacional", 7.0, "C"), ("r", None, "i", "urbana", 1.0, "A")],
        "p string, y int, i string, area string, v double, o string",
    )
    wide = reshape.to_wide(df, ["p", "y", "i"], "area", "v", {"nacional": "n", "rural": "r"}, F.col("o"))
    assert values(wide) == [("r", 1, "i", 5.0, None)]


def test_long_form_drops_what_is_no_number(frame):
    df = frame([("k", "1.5", "-", None)], "k string, a string, b string, c string")
    assert values(reshape.to_long(df, ["k"], ["a", "b", "c"], "var", "val")) == [("k", "a", 1.5)]


def brute_means(series, n):
    out = []
    for i in range(len(series)):
        window = [v for v in series[max(0, i - n + 1) : i + 1] if v is not None]
        out.append(round(sum(window) / len(window) + 1e-9, 2) if window else None)
    return out


@pytest.mark.parametrize("chunk", [30, 37, 1000])
def test_moving_average_in_chunks_equals_brute_force(spark, chunk):
    rng = random.Random(3)
    series = [None if rng.random() < 0.1 else float(rng.randint(0, 100)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(series)), "d int, v double").repartition(5)
    want = brute_means(series, 30)
    got = [r.m for r in sorted(windows.trailing_mean_of_rows(df, ["d"], "v", "m", 30, chunk=chunk).collect(), key=lambda r: r.d)]
    assert got == want
    plain = [r.m for r in windows.trailing_mean(df, ["d"], "v", "m", 30).orderBy("d").collect()]
    assert plain == want


def test_orphans_are_found_despite_null_in_the_parent(frame):
    child = frame([("a",), ("b",), ("b",), ("  ",), (None,)], "c string")
    parent = frame([("a",), (None,)], "k string")
    assert values(audits.orphan_keys(child, "c", parent, "k")) == [("b", 2)]
    report = audits.reference_check(child, "child", "c", parent, "parent", "k").drop("tabla", "columna", "tabla_referida")
    assert values(report) == [(4, 3, 75.0)]


def test_reports_on_an_empty_table(frame):
    empty = frame([], "k string, v int")
    assert values(audits.blank_share(empty, "k")) == [("k", 0, 0, 0.0)]
    assert values(audits.duplicate_summary(empty, ["k"])) == [(0, 0)]
    assert values(audits.unmatched_share(empty, "v")) == [(0, 0, 0.0)]
    report = audits.reference_check(empty, "e", "k", empty, "p", "k").drop("tabla", "columna", "tabla_referida")
    assert values(report) == [(0, 0, 0.0)]


def test_null_profile_marks_empty_columns(frame):
    df = frame([(1, None, "x"), (None, None, "y")], "a int, b int, c string")
    assert sorted(values(summary.null_counts(df))) == [("a", 1, False), ("b", 2, True), ("c", 0, False)]


def test_conform_and_what_it_loses(frame):
    df = frame([("2023.0", "x"), ("abc", "y")], "anio string, extra string")
    schema = T.StructType.fromDDL("anio DOUBLE, falta STRING")
    assert values(columns.conform(df, schema)) == [(2023.0, None), (None, None)]
    assert values(columns.conform_losses(df, schema)) == [("anio", 1)]


def test_contains_escapes_wildcards(frame):
    df = frame([("100% ok",), ("100 ok",), ("A_B",), ("AxB",)], "s string")
    assert values(df.where(rows.contains_ci(F.col("s"), "100%"))) == [("100% ok",)]
    assert values(df.where(rows.contains_ci(F.col("s"), "a_b"))) == [("A_B",)]


def test_unbalanced_rows(frame):
    df = frame([(3, 1, 2), (4, 1, 2)], "t int, f int, m int")
    assert values(audits.unbalanced(df, "t", ["f", "m"])) == [(4, 1, 2)]


def test_latest_period(frame):
    df = frame([("2009-2010", 1), ("2024-2025", 2), ("2024-2025", 3)], "y string, v int")
    assert sorted(values(rows.latest_period(df, "y"), "v")) == [(2,), (3,)]


def test_sets_of_loads_count_each_key_once(frame):
    first = frame([("a", 1), ("a", 40_000), ("b", 1), ("a", None), ("a", 1)], "g STRING, k BIGINT")
    second = frame([("a", 40_000), ("a", 3), ("c", 0)], "g STRING, k BIGINT")
    kept = [states.distinct_state(df, ["g"], "k") for df in (first, second)]
    merged = states.merge_distinct(kept, ["g"])
    assert sorted(values(states.count_distinct(merged, ["g"], "n"))) == [("a", 3), ("b", 1), ("c", 1)]
    some = states.distinct_state(frame([(1,), (3,), (99,)], "k BIGINT"), [], "k")
    assert sorted(values(states.count_distinct(states.common_distinct(merged, some, ["g"]), ["g"], "n"))) == [("a", 2), ("b", 1)]


def test_schemas_of_loads_are_joined():
    parse = T.StructType.fromDDL
    known = parse("a BIGINT, m STRUCT<x: BIGINT, v: VOID>, l ARRAY<BIGINT>, t STRING, only STRING")
    newer = parse("m STRUCT<v: BOOLEAN, x: DOUBLE, z: STRING>, l ARRAY<DOUBLE>, t BIGINT, a BIGINT, late STRUCT<q: BIGINT>")
    want = parse("a BIGINT, m STRUCT<x: DOUBLE, v: BOOLEAN, z: STRING>, l ARRAY<DOUBLE>, t STRING, only STRING, late STRUCT<q: BIGINT>")
    assert join_schemas(known, newer) == want and join_schemas(want, known) == want


def test_ids_that_were_given_stay(spark, frame):
    known = frame([(1, "A", None), (2, "B", "x"), (7, "C", "y")], "id BIGINT, p STRING, c STRING")
    found = frame([("A", None), ("D", "z"), ("A", "n"), ("D", "z"), ("B", "x"), (None, None)], "p STRING, c STRING")
    grown = extend_ids(known, found, ["p", "c"], "id")
    assert sorted(values(grown), key=str) == sorted([(1, "A", None), (2, "B", "x"), (7, "C", "y"), (8, None, None), (9, "A", "n"), (10, "D", "z")], key=str)
    assert extend_ids(materialise(grown, "grown"), found, ["p", "c"], "id").count() == 6
