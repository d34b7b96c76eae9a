"""Every query with an oracle returns the oracle's rows; every other one runs."""

import os

import duckdb
import pytest

from pixelloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES + ["embeddings"]:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "null" if v != v else repr(round(v, 6) + 0.0)
    return "null" if v is None else str(v)


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = rows(df.collect(), df.columns)
    if name not in ORACLES:
        assert got
        return
    said = duck.execute(ORACLES[name])
    columns = [d[0] for d in said.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(said.fetchall(), columns)
