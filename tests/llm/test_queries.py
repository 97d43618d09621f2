"""The registered queries of this subpackage on the smallest tables: their SQL where they have one, else their shape."""

import os

import pytest

from leafworks.llm import queries

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sql, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = sql.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_every_document_is_there(spark, name):
    found = queries.QUERIES[name](spark, DATA)
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    assert found.select("doc_id").distinct().count() == documents.select("doc_id").distinct().count()
