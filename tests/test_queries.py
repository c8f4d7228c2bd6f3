"""Each registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from floeframe.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return made


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, DATA)
    want = con.execute(catalog.SQL[name])
    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == sorted(map(repr, want.fetchall()))


def test_samples_are_the_same_each_time(spark):
    a, b = (sorted(map(tuple, catalog.QUERIES["monthly_sample"](spark, DATA).collect())) for _ in range(2))
    assert a == b and a


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
