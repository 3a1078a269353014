"""Plans that must hold for large tables, and results when one key holds most of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from support import values
from tamiz.functions.numbers import exact_sum
from tamiz.operators import audits, keys, rows
from tamiz.operators.windows import trailing_mean_of_rows
from tamiz.plans import gold, partials
from tamiz.sources.layers import Layer
from tamiz.workload import QUERIES
from tamiz.workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"
WRITES = {"star_flow", "envelope_flow", "table_replace", "period_append_guard", "update_from_source", "chunked_append",
          "company_refresh", "macro_refresh", "school_year_append", "csv_roundtrip", "csv_latin1", "charset_fallback",
          "preamble_scan", "preamble_by_position", "moving_avg_30_rows", "dense_ids_customer", "dim_geography",
          "refresh_flow", "refresh_values", "star_values", "files_to_star", "refresh_report", "places_outlive_refresh",
          "graduates_from_partials", "value_added_from_partials"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_join_and_no_python_worker(large, name):
    text = plan(QUERIES[name](large, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "EvalPython" not in text and "InPandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    text = plan(QUERIES["envelope_by_indicator"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in text
    text = plan(QUERIES["filter_compare"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_custkey" not in text
    text = plan(QUERIES["kpi_totals"](spark, FOLDER))
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>", text)
    assert t.orders is t.orders


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    df = rows.first_per_key(Tables(spark, FOLDER).lineitem, ["l_orderkey"], [F.col("l_shipdate")])
    text = plan(df)
    assert "WindowGroupLimit" in text
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_company_totals_reuse_the_partitioning_of_the_company_key(large, frame):
    """Facts that come partitioned by company are grouped and joined by company in place."""
    placed = large.range(1000).select(F.col("id").alias("ruc"), (F.col("id") % 5).alias("id_geografia"))
    totals = hot(large).groupBy(F.col("k").alias("ruc")).agg(F.sum("v").alias("ingresos_totales"), F.sum("v").alias("activos"))
    companies = large.range(1000).select(F.col("id").alias("ruc"), F.lit("ACTIVA").alias("situacion_legal"))
    places = frame([(i, f"P{i % 2}") for i in range(5)], "id_geografia bigint, provincia string")
    text = plan(gold.companies_by_province(totals.join(placed, "ruc"), companies, places))
    assert not re.search(r"Exchange hashpartitioning\(ruc#\w+, id_geografia", text)
    assert len(re.findall(r"Exchange hashpartitioning\((?:ruc|id)#\w+, ", text)) <= 4


# ---- hot keys: a third of the rows or more under one key


def hot(spark, n=30_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("bigint").alias("k"), (F.col("id") % 97).cast("double").alias("v"), "id"
    )


def test_hot_company_in_the_gold_view(spark, frame):
    facts = hot(spark).select(F.col("k").alias("ruc"), (F.col("k") % 5).alias("id_geografia"), F.col("v").alias("ingresos_totales"), F.col("v").alias("activos"))
    companies = spark.range(1000).select(F.col("id").alias("ruc"), F.when(F.col("id") % 2 == 1, "ACTIVA").otherwise("INACTIVA").alias("situacion_legal"))
    places = frame([(i, f"P{i % 2}") for i in range(5)], "id_geografia bigint, provincia string")
    rows_ = [(r.ruc, r.id_geografia, r.ingresos_totales) for r in facts.collect()]
    want = {}
    for ruc, place, amount in rows_:
        active, total = want.setdefault(f"P{place % 2}", (set(), [0.0]))
        total[0] += amount
        if ruc % 2 == 1:
            active.add(ruc)
    got = {r.provincia: (r.empresas_activas, r.ingresos_totales) for r in gold.companies_by_province(facts, companies, places).collect()}
    assert got == {p: (len(active), total[0]) for p, (active, total) in want.items()}


def test_skewed_lookup_is_split(spark):
    """A join whose left side is mostly one key is split over tasks at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        directory = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
        joined = keys.resolve_key(hot(spark).repartition(6), directory, {"k": F.col("k")}, "name")
        got = joined.groupBy("name").agg(F.count("*").alias("n")).where("name = 'n7'").collect()[0].n
        joined.write.format("noop").mode("overwrite").save()
        collected = joined.collect()
        text = plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == sum(1 for r in collected if r.name == "n7") >= 10_000
    assert "skew=true" in text


def test_hot_key_in_dedup_references_and_duplicates(spark):
    df = hot(spark)
    first = {r.k: r.id for r in rows.first_per_key(df, ["k"], [F.col("id")]).collect()}
    want = {}
    for r in df.collect():
        want[r.k] = min(want.get(r.k, r.id), r.id)
    assert first == want
    parent = spark.range(7).select(F.col("id").alias("p"))
    report = audits.reference_check(df, "hot", "k", parent, "p", "p").collect()[0]
    assert (report.con_valor, report.sin_referencia) == (30_000, df.where("k >= 7").count())
    summary = audits.duplicate_summary(df, ["k"]).collect()[0]
    assert summary.filas_sobrantes == 30_000 - len(want)


def test_long_series_beside_short_ones(spark):
    """One series has a third of the rows and many chunks; frames end where a series does."""
    rows_ = [(None if i % 3 == 0 else i % 50, i, float(i % 97)) for i in range(3000)]
    df = spark.createDataFrame(rows_, "s INT, o INT, v DOUBLE").repartition(7)
    got = {(r.s, r.o): r.m for r in trailing_mean_of_rows(df, ["o"], "v", "m", rows=5, chunk=64, series=["s"]).collect()}
    seen, want = {}, {}
    for s, o, v in rows_:
        last = seen.setdefault(s, [])
        last.append(v)
        want[s, o] = sum(last[-5:]) / len(last[-5:])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.005 + 1e-9 for k in want)


def test_a_new_period_reads_its_partition_only(spark, tmp_path):
    """Partials of one more year, and the view of the newest, open the folders of that year."""
    layer = Layer(spark, "file://" + str(tmp_path), {**partials.PARTITIONS, "schools": ["anio_lectivo"]})
    schools = spark.createDataFrame([(1, "2000-2001", 5), (2, "2001-2002", 7), (1, "2001-2002", 1)], "id_geografia BIGINT, anio_lectivo STRING, bachilleres_3er_anio BIGINT")
    layer.put("schools", schools)
    for year in ("2000-2001", "2001-2002", "2001-2002"):
        part = partials.school_partial(layer.get("schools").where(F.col("anio_lectivo") == year))
        assert re.search(r"PartitionFilters: \[isnotnull\(anio_lectivo#\d+\), \(anio_lectivo#\d+ = " + year, plan(part))
        partials.append(layer, {partials.GRADUATES: part})
    assert len(layer.folders(partials.GRADUATES)) == 2
    places = spark.createDataFrame([(1, "A"), (2, "B")], "id_geografia BIGINT, provincia STRING")
    companies = spark.createDataFrame([("A", 2)], "provincia STRING, empresas_activas BIGINT")
    view = partials.graduates_by_province(layer, places, companies)
    assert values(view) == [("A", 1, 2, 0.5), ("B", 7, 0, None)]
    assert "anio_lectivo" in plan(view) and layer.latest(partials.GRADUATES, "anio_lectivo").inputFiles()


def test_exact_sum_does_not_depend_on_partitions(spark):
    df = spark.range(50_000).select((F.col("id") * 0.1).alias("v"))
    totals = {values(df.repartition(n).agg(exact_sum(F.col("v")).cast("double")))[0] for n in (1, 3, 8)}
    assert len(totals) == 1
