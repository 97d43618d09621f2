"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import pytest

from leafworks.plans import catalog

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(found, names, columns):
    at = [names.index(c) for c in columns]
    return sorted((tuple(round(r[k], 9) if isinstance(r[k], float) else r[k] for k in at) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = rows(df.collect(), df.columns, columns)
    if name in catalog.ORACLE_SQL:
        result = sql.execute(catalog.ORACLE_SQL[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        assert found == rows(result.fetchall(), names, columns)


def test_every_sql_has_a_query():
    assert catalog.ORACLE_SQL.keys() <= catalog.QUERIES.keys()
