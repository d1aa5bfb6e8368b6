"""Driver contract: entry smoke check and Spark-vs-DuckDB parity of every key at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.queries import QUERIES
from tools.oracle_check import DUCK_TO_SPARK, TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)  # the library's own keys; the optional operators have their own tests


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "customer_key", "first_name", "last_name", "marital_status", "gender",
                          "birth_date", "country", "created_date"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert {k for k in E.oracle_sql() if k in QUERIES} == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    stypes = dict(zip(sdf.columns, [f.dataType.simpleString() for f in sdf.schema.fields]))
    dtypes = dict(zip(rel.columns, [DUCK_TO_SPARK.get(str(t), str(t)) for t in rel.types]))
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, rel.columns)[0]


def test_bench_headline_keys_are_registered_with_oracles():
    from bench import HEADLINE

    assert set(HEADLINE) <= set(E.queries()) and set(HEADLINE) <= set(E.oracle_sql())
    assert len(HEADLINE) == len(set(HEADLINE))
