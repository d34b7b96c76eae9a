"""Partitioned reads from a database."""

import uuid

import pytest
from pixelloom.sources import files

MORE = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"


@pytest.mark.parametrize("kind", ["long", "timestamp", "date"])
def test_read_by_ranges_of_a_key(spark, url, kind):
    key = "id" if kind == "long" else "date_add(DATE '1970-01-01', CAST(id AS INT))"
    days = spark.range(-5, 200).selectExpr(f"CAST({key} AS {kind}) AS k", "id AS v")
    table = f"T_{kind}"
    files.jdbc_insert(days.unionByName(spark.createDataFrame([(None, 1000)], f"k {kind}, v long")), url, table, **MORE)
    df = files.jdbc_read(spark, url, table, ["v"], key="k", parts=5, **MORE)
    assert df.rdd.getNumPartitions() == 5
    assert sorted(r.v for r in df.collect()) == [*range(-5, 200), 1000]
    assert max(df.rdd.glom().map(len).collect()) < 60


def test_read_without_keys(spark, url):
    files.jdbc_insert(spark.createDataFrame([(None, 1), (None, 2)], "k long, v long"), url, "T_NONE", **MORE)
    df = files.jdbc_read(spark, url, "T_NONE", ["v"], key="k", parts=5, **MORE)
    assert sorted(r.v for r in df.collect()) == [1, 2]


def test_upsert_by_key(spark, url):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    kind = "id long, a double, b int"
    files.jdbc_insert(spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 2), (3, None, 3)], kind), url, "T_UP", **MORE)
    new = spark.createDataFrame([(2, None, 20), (3, 3.5, None), (4, float("nan"), 4), (None, 9.0, 9)], kind)
    for _ in range(2):
        files.jdbc_upsert(new, url, "T_UP", "id", **MORE)
        assert rows(files.jdbc_read(spark, url, "T_UP", ["id", "a", "b"], **MORE)) == [(1, 1.0, 1), (2, 2.0, 20), (3, 3.5, 3), (4, None, 4)]
    files.jdbc_upsert(new.limit(0), url, "T_UP", "id", **MORE)
    got = files.jdbc_query(spark, url, 'SELECT "id", "b" FROM T_UP WHERE "b" > 1', key="id", parts=3, **MORE)
    assert rows(got) == [(2, 20), (3, 3), (4, 4)] and got.rdd.getNumPartitions() > 1
    left = files.jdbc_query(spark, url, "SELECT count(*) AS n FROM SYS.SYSTABLES WHERE TABLENAME LIKE 'STAGE%'", **MORE)
    assert left.first()[0] == 0
