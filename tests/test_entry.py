"""Every query of the library against its SQL on the smallest tables, and the entry point's contract."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are absent")


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def names():
    from clipwise import catalog

    return sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from clipwise import catalog

    df = catalog.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in catalog.ORACLE_SQL:
        found = duck.execute(catalog.ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert plain(rows, df.columns) == plain(found.fetchall(), columns)
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
