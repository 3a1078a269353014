"""Every registered query against its SQL counterpart on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


#: Texts of the smallest tables hold no quotes.
WITH_QUOTES = ("charset_fallback", "csv_latin1", "csv_line_breaks", "csv_quotes", "csv_roundtrip", "unparsed_rows")


@pytest.mark.parametrize("name", WITH_QUOTES)
def test_files_with_quotes(spark, name):
    folder = "/root/testdata/sf0.01"
    assert oracle.difference(QUERIES[name](spark, folder), oracle.connect(folder), SQL[name]) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["provincia", "bachilleres_3er_anio", "empresas_activas", "bachilleres_por_empresa"]
    assert df.count() > 0
