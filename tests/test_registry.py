"""Every query of the library gives the rows of its SQL."""

import duckdb
import pytest


from lamina.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(repr(r) for r in duck.execute(f"SELECT {quoted} FROM ({registry.ORACLE[name]})").fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)
