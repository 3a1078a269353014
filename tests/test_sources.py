import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import values
from tamiz import session
from tamiz.plans import contract as K
from tamiz.plans import indicators
from tamiz.sources import envelope, files, tables
from tamiz.sources.layers import Layer
from tamiz.sources.records import csv_records, text_lines, with_effect
from tamiz.streaming.batches import load_in_batches


@pytest.fixture
def records(frame):
    rows = [
        ("A", '{"k": 1, "m": {"x": "CaÃ±ar", "Año": 2}}'),
        ("A", '{"k": 2, "new": true}'),
        ("A", None),
        ("AB", '{"k": 3}'),
        ("B", '{"k": "text"}'),
    ]
    return frame(rows, "INDICADOR string, DATOS_JSON string")


def test_records_by_name_and_prefix(records):
    assert envelope.records_of(records, "A").count() == 3
    assert envelope.records_of(records, "A", prefix=True).count() == 4


def test_flat_records_keep_declared_keys(records):
    schema = "k BIGINT, m STRUCT<x: STRING, `Año`: INT>"
    flat = indicators.flat_records(records, "A", schema)
    assert flat.columns == ["k", "m_x", "m_ano"]
    assert sorted(values(flat), key=str) == [(1, "Cañar", 2), (2, None, None)]
    last = indicators.flat_records(records, "A", schema, last_segment=True)
    assert last.columns == ["k", "x", "ano"]


def test_last_segment_keeps_the_first_of_equal_names(frame):
    df = frame([("A", '{"a": {"id": 1}, "b": {"id": 2}}')], "INDICADOR string, DATOS_JSON string")
    flat = indicators.flat_records(df, "A", "a STRUCT<id: INT>, b STRUCT<id: INT>", last_segment=True)
    assert flat.columns == ["id"] and values(flat) == [(1,)]


def test_unseen_keys_are_reported(records):
    schema = T.StructType.fromDDL("k BIGINT, m STRUCT<x: STRING>")
    assert values(envelope.unseen_keys(envelope.records_of(records, "A"), schema)) == [("new", 1)]


def test_discovered_schema_reads_the_records(records):
    rows = envelope.records_of(records, "A")
    schema = envelope.discover_schema(rows)
    assert {f.name for f in schema.fields} == {"k", "m", "new"}
    assert envelope.parse_records(rows, schema).where("record.k = 2 and record.new").count() == 1


def test_jdbc_predicates_quote_names():
    assert envelope.indicator_predicates(["A", "O'B"]) == ["INDICADOR = 'A'", "INDICADOR = 'O''B'"]


def test_resolve_prefers_first_match_and_reports_none():
    columns = ["cod_provincia", "institucion_provincia", "bachillerato_3er_ano_m", "bachillerato_3er_ano_h"]
    assert indicators.resolve(columns, ["provincia"], lacks=["cod"]) == "institucion_provincia"
    assert indicators.resolve(columns, ["bach", "3er_ano_h"]) == "bachillerato_3er_ano_h"
    with pytest.raises(LookupError):
        indicators.resolve(columns, ["canton"])


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_wide_csv_by_name_with_forced_types(spark, tmp_path):
    path = write(tmp_path / "r.csv", "x,anio,expediente,ciiu_n6,y\n0,2020,007,A01,9\n1,bad,8,,9\n")
    df = files.read_csv_columns(spark, path, {"expediente": T.DoubleType(), "anio": T.DoubleType(), "ciiu_n6": T.StringType(), "z": T.StringType()})
    assert df.columns == ["expediente", "anio", "ciiu_n6"]
    assert values(df) == [(7.0, 2020.0, "A01"), (8.0, None, None)]


def test_csv_charsets(spark, tmp_path):
    schema = T.StructType.fromDDL("ciiu STRING, descripcion STRING")
    write(tmp_path / "a.csv", "CIIU,Descripcion\nA,Enseñanza\n")
    write(tmp_path / "b.csv", "ciiu,descripcion\nB,Construcción\nC,\"Uno, dos\"\n", "latin-1")
    got = sorted(values(files.read_csv_any_charset(spark, str(tmp_path), schema)))
    assert got == [("A", "Enseñanza"), ("B", "Construcción"), ("C", "Uno, dos")]


def test_semicolon_latin1(spark, tmp_path):
    path = write(tmp_path / "s.csv", "Año lectivo;AMIE\n2023;01H\n", "latin-1")
    schema = T.StructType.fromDDL("`Año lectivo` STRING, AMIE STRING")
    assert values(files.read_csv(spark, path, schema, ";", files.LATIN1)) == [("2023", "01H")]


def test_sheet_below_marker(spark, tmp_path):
    path = write(tmp_path / "g.csv", "Banco,,\nSerie,,\nAños,PIB,Población\n1965,10,2\n2024 (p),30,4\nFuente,,\n")
    df = files.read_sheet_below_marker(spark, path, K.GDP_MARKER)
    assert df.columns == ["Años", "PIB", "Población"]
    assert values(df) == [("1965", "10", "2"), ("2024 (p)", "30", "4")]
    with pytest.raises(ValueError):
        files.read_sheet_below_marker(spark, path, "Años fiscales")


def test_file_order_gives_the_first_row(spark, tmp_path):
    path = write(tmp_path / "o.csv", "k,v\na,3\na,1\nb,2\n")
    df = files.with_file_order(files.read_csv(spark, path, T.StructType.fromDDL("k STRING, v INT")))
    assert sorted(values(df.groupBy("k").agg(F.min_by("v", "orden")))) == [("a", 3), ("b", 2)]


def test_replace_append_and_empty_guard(spark, frame, tmp_path):
    path = "file://" + str(tmp_path / "t")
    df = frame([(1, "x"), (2, "y")], "a int, b string")
    for _ in range(2):
        tables.replace_table(df, path)
    assert tables.read_table(spark, path).count() == 2
    assert tables.replace_unless_empty(df.where("a > 9"), path) is False
    tables.append_table(df, path)
    assert tables.read_table(spark, path).count() == 4


def test_new_period_is_appended_once(spark, frame, tmp_path):
    path = "file://" + str(tmp_path / "p")
    tables.replace_table(frame([("2023", 1), ("2024", 2)], "y string, v int"), path, ["y"])
    new = frame([("2024", 9), ("2025", 3)], "y string, v int")
    for _ in range(2):
        tables.append_new_periods(new, path, "y")
    got = tables.read_table(spark, path).select(F.col("y").cast("string"), "v")
    assert sorted(values(got)) == [("2023", 1), ("2024", 2), ("2025", 3)]


def test_update_writes_null_too_and_refreshes_in_place(spark, frame, tmp_path):
    path = "file://" + str(tmp_path / "u")
    tables.replace_table(frame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c")], "k int, v double, w string"), path)
    source = frame([(1, 10.0), (2, None), (9, 9.0)], "k int, v double")
    for _ in range(2):
        tables.refresh_in_place(spark, path, lambda old: tables.update_matched(old, source, "k", ["v"]))
    assert sorted(values(tables.read_table(spark, path))) == [(1, 10.0, "a"), (2, None, "b"), (3, 3.0, "c")]


def test_batches_load_all_files_and_resume(spark, frame, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    frame([(i, f"v{i}") for i in range(40)], "k int, v string").repartition(5).write.parquet(source)
    schema = T.StructType.fromDDL("k INT, v STRING")
    for _ in range(2):
        load_in_batches(spark, source, schema, target, lambda b: b.where("k > 0"), files_per_batch=2, checkpoint=mark)
    assert tables.read_table(spark, target).count() == 39
    frame([(100, "late")], "k int, v string").write.mode("append").parquet(source)
    load_in_batches(spark, source, schema, target, lambda b: b.where("k > 0"), files_per_batch=2, checkpoint=mark)
    assert tables.read_table(spark, target).count() == 40


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_predicates_for_prefixes_and_splits():
    assert envelope.indicator_predicates(["MINEDUC_AMIE%"]) == ["INDICADOR LIKE 'MINEDUC!_AMIE%' ESCAPE '!'"]
    assert envelope.indicator_predicates(["A"], "id", 2) == [
        "INDICADOR = 'A' AND (MOD(ABS(id), 2) = 0 OR id IS NULL)", "INDICADOR = 'A' AND MOD(ABS(id), 2) = 1",
    ]


def test_update_rejects_repeated_source_keys(frame):
    target, source = frame([(1, "a"), (2, "b")], "k INT, v STRING"), frame([(1, "x"), (1, "y")], "k INT, v STRING")
    with pytest.raises(Exception, match="repeats a value"):
        tables.update_matched(target, source, "k", ["v"]).collect()
    assert sorted(values(tables.update_matched(target, source.limit(1), "k", ["v"]), "k", "v"))[1] == (2, "b")


def test_lost_load_leaves_the_table_whole(spark, frame, tmp_path):
    path = "file://" + str(tmp_path / "t")
    tables.replace_table(frame([(1,), (2,)], "k INT"), path)
    broken = frame([(3,), (4,)], "k INT").select(F.when(F.col("k") == 4, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("k")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, path)
    assert sorted(values(tables.read_table(spark, path))) == [(1,), (2,)]
    assert not tables.replace_unless_empty(frame([], "k INT"), path)
    tables.refresh_in_place(spark, path, lambda df: df.select((F.col("k") * 10).alias("k")))
    assert sorted(values(tables.read_table(spark, path))) == [(10,), (20,)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_load_without_checkpoint_replaces(spark, frame, tmp_path):
    source, target = str(tmp_path / "in"), "file://" + str(tmp_path / "out")
    frame([(1,), (2,), (3,)], "k INT").repartition(3).write.parquet(source)
    for _ in range(2):
        load_in_batches(spark, source, T.StructType.fromDDL("k INT"), target, files_per_batch=1)
        assert sorted(values(tables.read_table(spark, target))) == [(1,), (2,), (3,)]


def test_views_without_their_tables_are_left_out(frame):
    from tamiz.plans import gold

    macro = frame([("2020.0", 1.0, 2.0)], "anio_fiscal STRING, pib_real_millones DOUBLE, tasa_variacion_anual DOUBLE")
    views = gold.flat_views({"fact_macro_anual": macro})
    assert list(views) == ["gold_pib_tendencia"] and views["gold_pib_tendencia"].first()["anio"] == 2020


def test_scratch_is_cleared(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: "file://" + str(tmp_path))
    stored = session.materialise(frame([(1,)], "k INT"), "x")
    assert stored.count() == 1 and any(tmp_path.rglob("*.parquet"))
    session.clear_scratch(spark)
    assert not any(tmp_path.rglob("*.parquet"))


@pytest.fixture
def small_splits(spark):
    """Files cut into shares of a few dozen bytes, so that records cross them."""
    settings = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k in settings:
        spark.conf.unset(k)


def parsed(record):
    return next(csv.reader(io.StringIO(record, newline="")))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_across_splits_against_a_sequential_reader(small_splits, tmp_path, ending):
    rng = random.Random(len(ending))
    marks = ["a", "b", '"', ",", "\n", "\r\n", " ", "xyz", '""', '",', '"\n', "é", ";"]
    want = []
    for i in range(120):
        cells = ["".join(rng.choice(marks) for _ in range(rng.randrange(60 if i % 9 == 0 else 7))) for _ in range(2)]
        want.append([str(i), *cells])
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=ending).writerows(want)
    path = tmp_path / "r.csv"
    path.write_bytes(out.getvalue().encode())
    found = csv_records(small_splits, str(path)).collect()
    tasks = text_lines(small_splits, str(path)).select("bloque").distinct().count()
    assert tasks > 20
    in_order = sorted(found, key=lambda r: (r["bloque"], r["fila"]))
    assert [parsed(r["registro"]) for r in in_order] == want
    assert all(r["entero"] for r in found) and [r["primero"] for r in in_order] == [True] + [False] * 119


@pytest.mark.parametrize("charset", ["utf-8", "latin-1"])
def test_line_breaks_are_read_by_more_tasks_than_files(small_splits, tmp_path, charset):
    rows = [(str(i), f'niño "{i}", dijo\nsí', "ó") for i in range(40)]
    for part in range(2):
        out = io.StringIO(newline="")
        csv.writer(out).writerows([("clave", "la\nnota", "fin"), *rows[part::2]])
        (tmp_path / f"{part}.csv").write_bytes(out.getvalue().encode(charset))
    schema = T.StructType.fromDDL("clave INT, `la\nnota` STRING, fin STRING")
    df = files.read_csv_any_charset(small_splits, str(tmp_path), schema, order="orden")
    assert df.select("orden.archivo", "orden.bloque").distinct().count() > 10
    assert sorted(values(df, "clave", "la\nnota", "fin")) == sorted((int(a), b, c) for a, b, c in rows)
    first = df.groupBy("orden.archivo").agg(F.min_by("clave", "orden").alias("k")).collect()
    assert sorted(r.k for r in first) == [0, 1]


def test_rows_that_do_not_parse_are_found_with_their_place(small_splits, tmp_path):
    text = 'k,v,w\n1,a,b\n2,a\n3,a,b,c\nx,a,b\n4,5" pipe,z\n5,"two\nlines",b\n6,"two\nlines"\n7,"never\ncloses\n'
    write(tmp_path / "bad.csv", text)
    write(tmp_path / "plain.csv", "k,v,w\n8,a,b\n9,a\ny,a,b\n10,a,b,c\n")
    schema = T.StructType.fromDDL("k INT, v STRING, w STRING")
    rows = files.read_csv(small_splits, str(tmp_path), schema, order="orden", corrupt="malo")
    kept, bad = files.set_aside(rows, "malo", "orden", "t")
    assert sorted(values(kept, "k"), key=str) == sorted([(k,) for k in (1, 2, 3, None, 4, 5, 6, 7, 8, 9, None, 10)], key=str)
    assert ("4", '5" pipe', "z") in values(kept.select(F.col("k").cast("string"), "v", "w"))
    found = sorted(values(bad.select(F.regexp_extract("archivo", r"(\w+)\.csv", 1).alias("a"), "registro")))
    assert found == [("bad", "2,a"), ("bad", "3,a,b,c"), ("bad", '6,"two\nlines"'), ("bad", '7,"never\ncloses'), ("bad", "x,a,b"), ("plain", "10,a,b,c"), ("plain", "9,a"), ("plain", "y,a,b")]
    assert bad.where("bloque IS NULL OR fila IS NULL").count() == 0
    # a part of the columns finds the same rows
    assert len(files.read_csv(small_splits, str(tmp_path), schema, corrupt="malo").select("k", "malo").where("malo IS NOT NULL").collect()) == 8


def effect_of(line, sep):
    """What a line does to the state "inside of quotes", told quote by quote."""
    after = []
    parts = line.replace('""', "").removesuffix("\r").split('"')
    for inside in (False, True):
        for k in range(1, len(parts)):
            starts = parts[k - 1].endswith(sep) or (k == 1 and parts[0] == "")
            ends = parts[k].startswith(sep) or (k == len(parts) - 1 and parts[k] == "")
            inside = not inside if starts and ends else True if starts else False if ends else inside
        after.append(inside)
    return {(False, True): 0, (True, False): 1, (False, False): 2, (True, True): 3}[tuple(after)]


@pytest.mark.parametrize("sep", [",", ";", "||"])
def test_effect_of_a_line_quote_by_quote(spark, sep):
    rnd = random.Random(3)
    lines = ["".join(rnd.choice(['"', '"', sep, "a", "é", "\r"]) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    frame = spark.createDataFrame([(x,) for x in lines], "linea string")
    found = with_effect(frame, sep).collect()
    assert {r["efecto"] for r in found} == {0, 1, 2, 3}
    assert [(r["linea"], r["efecto"]) for r in found] == [(x, effect_of(x, sep)) for x in lines]


def test_a_line_is_gone_over_once_for_its_effect(spark, tmp_path):
    path = write(tmp_path / "e.csv", 'k,v\n1,"a\nb"\n')
    plan = with_effect(text_lines(spark, path), ",")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") <= 8 and "transform(" not in plan and "split(" not in plan


def test_records_at_edges_are_told_before_lines_are_joined(spark, tmp_path):
    path = write(tmp_path / "b.csv", 'k,v\n1,"a\nb"\n2,c\n')
    plan = csv_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Aggregate [archivo" in line and "collect_list" in line and "array_join" in line and "grupo" in line.split("]")[0]]
    assert keys and all("ultimo" in line.split("]")[0] for line in keys)


def test_lines_of_a_block_are_gone_over_once_where_records_start_is_known(spark, tmp_path):
    path = write(tmp_path / "w.csv", 'k,v\n1,"a\nb"\n2,c\n')
    plan = csv_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    over_lines = [line for line in plan.splitlines() if "Window [" in line and f", [bloque" not in line and "fila" in line.split("windowspec")[-1]]
    # two for the states of all lines, which the plan shows twice and runs once, three inside of blocks, none for the edges
    assert 0 < len(over_lines) <= 7 and "BROADCAST" in plan.upper()


def test_records_where_no_line_or_every_line_of_a_block_opens_one(small_splits, tmp_path):
    for name, text in {"long.csv": 'k,v\n1,"' + "\n".join(["inside of one cell"] * 30) + '"\n2,c\n', "short.csv": 'k,"v\nw"\n' + "".join(f"{i},c\n" for i in range(60))}.items():
        path = write(tmp_path / name, text)
        found = sorted(csv_records(small_splits, path).collect(), key=lambda r: (r["bloque"], r["fila"]))
        assert [parsed(r["registro"]) for r in found] == list(csv.reader(io.StringIO(text, newline="")))
        assert [r["primero"] for r in found] == [True] + [False] * (len(found) - 1) and all(r["entero"] for r in found)


def test_stray_quote_does_not_gather_a_file(small_splits, tmp_path):
    lines = [f"{i},some text of a row" for i in range(50)]
    path = write(tmp_path / "s.csv", "\n".join(["1,a", '2,"open', *lines]) + "\n")
    found = {r["primero"]: r for r in csv_records(small_splits, path, longest=200).collect()}
    assert found[True]["registro"] == "1,a" and found[False]["registro"] is None and not found[False]["entero"]
    schema = T.StructType.fromDDL("a STRING, b STRING")
    assert files.read_csv(small_splits, write(tmp_path / "h.csv", 'a,b\n1,"x\ny"\n'), schema).collect() == [("1", "x\ny")]


def test_sink_doubles_quotes_and_keeps_spaces(spark, frame, tmp_path):
    rows = [(1, 'say "hi", ok'), (2, " outer "), (3, '"'), (4, "a;b\nc"), (5, None), (6, "back\\slash\\"), (7, "cr\rlf\r\n")]
    path = "file://" + str(tmp_path / "out")
    tables.write_csv(frame(rows, "k INT, v STRING").coalesce(1), path)
    written = next((tmp_path / "out").glob("part-*")).read_bytes().decode()
    assert '"say ""hi"", ok"' in written
    assert sorted(values(files.read_csv(spark, path, T.StructType.fromDDL("k INT, v STRING"), ";"))) == rows


def test_each_sheet_has_its_own_header(spark, tmp_path):
    write(tmp_path / "a.csv", "Banco,,\nAños,PIB,Población\n1965,10,2\n")
    write(tmp_path / "b.csv", "Banco,,\n2 hojas,,\nAños,Población,\"PIB, nominal\"\n1970,3,\"9\n9\"\nFuente,,\n")
    write(tmp_path / "c.csv", "1980,11,4\n")
    df = files.read_sheet_below_marker(spark, str(tmp_path), "Años")
    assert sorted(values(df, "Años", "PIB", "Población", "PIB, nominal")) == [("1965", "10", "2", None), ("1970", None, "3", "9\n9"), ("1980", "11", "4", None)]


# ---- layers


def test_release_is_seen_whole_or_not_at_all(spark, frame, tmp_path):
    layer = Layer(spark, "file://" + str(tmp_path / "star"), {"f": ["y"]})
    layer.put_all({"d": frame([(1, "a")], "id INT, v STRING"), "f": frame([(1, "2023")], "id INT, y STRING")})
    broken = frame([(2, "2024")], "id INT, y STRING").select(F.raise_error(F.lit("lost")).cast("int").alias("id"), "y")
    with pytest.raises(Exception, match="lost"), layer.release() as new:
        new.put("d", frame([(9, "z")], "id INT, v STRING"))
        assert values(new.get("d")) == [(9, "z")] and values(layer.get("d")) == [(1, "a")]
        new.put("f", broken)
    assert values(layer.get("d")) == [(1, "a")] and values(layer.get("f"), "id") == [(1,)]
    with layer.release() as new:
        new.put("d", frame([(3, "c")], "id INT, v STRING"))
        new.append_periods("f", frame([(7, "2023"), (8, "2024")], "id INT, y STRING"), "y")
        reader = layer.get("d")  # planned before the release, read after it
    assert values(reader) == [(1, "a")]
    assert values(layer.get("d")) == [(3, "c")]
    schema = T.StructType.fromDDL("id INT, y STRING")
    assert sorted(values(layer.get("f", schema), "id", "y")) == [(1, "2023"), (8, "2024")]
    assert len(layer.folders("f")) == 2
    layer.append_periods("f", frame([(5, "2024")], "id INT, y STRING"), "y")
    assert layer.get("f").count() == 2 and len(layer.folders("f")) == 2
    with pytest.raises(LookupError):
        layer.get("other")


def test_old_releases_go_when_nobody_needs_them(spark, frame, tmp_path):
    layer = Layer(spark, "file://" + str(tmp_path / "l"), keep=2)
    for i in range(4):
        layer.put("t", frame([(i,)], "k INT"))
    layer.put("u", frame([(0,)], "k INT"))
    assert values(layer.get("t")) == [(3,)] and layer.releases() == [4, 5]
    assert sorted(p.name for p in (tmp_path / "l" / "t").iterdir()) == ["carga_n=4"]
    assert not layer.put_filled({"t": frame([], "k INT")}) and values(layer.get("t")) == [(3,)]


def test_latest_period_opens_one_partition(spark, frame, tmp_path):
    layer = Layer(spark, "file://" + str(tmp_path / "l"), {"f": ["y"], "n": ["y"]})
    layer.put("f", frame([(1, "2009-2010 a/b"), (2, "2010-2011 a/b"), (3, None)], "k INT, y STRING"))
    layer.append_periods("f", frame([(4, "2011-2012 a/b")], "k INT, y STRING"), "y")
    newest = layer.latest("f", "y")
    assert values(newest, "k", "y") == [(4, "2011-2012 a/b")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "Subquery" not in plan and "Aggregate" not in plan
    assert len(newest.select(F.input_file_name()).distinct().collect()) == 1
    layer.put("n", frame([(1, 9), (2, 10)], "k INT, y INT"))
    assert values(layer.latest("n", "y"), "k") == [(2,)]
    layer.put("n", frame([(1, None)], "k INT, y INT"))
    assert layer.latest("n", "y").count() == 0
