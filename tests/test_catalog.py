import duckdb
import pytest

import __spark_entry__
from tractloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_says_the_same(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    r = duck.execute(catalog.ORACLE_SQL[name])
    at = [x[0] for x in r.description]
    show = lambda row, get: tuple(round(v, 6) if isinstance(v, float) else v for v in (get(row, k) for k in sorted(at)))
    want = sorted((show(x, lambda x, k: x[at.index(k)]) for x in r.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(at)
    assert sorted((show(x, lambda x, k: x[k]) for x in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_others_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
