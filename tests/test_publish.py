"""Published tables: readers see the old or the new version, and a failed writer leaves the old one."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.sources import publish as P
from strata.sources.catalog import create_table, write_table

from conftest import rows


@pytest.fixture
def name(spark):
    schema = f"pub_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema}")
    yield f"{schema}.t"
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))


def test_versions_replace_each_other(spark, name):
    a = P.publish_table(numbers(spark, 0, 100), name, comment="numbers")
    held = spark.table(name)
    assert held.count() == 100 and P.current_version(spark, name).endswith(a.split("/")[-1])
    b = P.publish_table(numbers(spark, 50, 250).select("v", "id"), name)  # by name, not by place
    assert a != b and spark.table(name).count() == 200 and spark.table(name).columns == ["id", "v"]
    assert spark.read.parquet(a).count() == 100  # a reader that planned the old version still finds its files
    P.publish_table(numbers(spark, 0, 0), name)
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("verify", [True, False])
def test_a_writer_that_dies_midway_leaves_the_old_rows(spark, name, verify):
    P.publish_table(numbers(spark, 0, 100), name)
    bad = numbers(spark, 0, 5000).repartition(8).withColumn("v", F.when(F.col("id") == 4321, F.raise_error("disk gone")).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        P.publish_table(bad, name, verify=verify)
    assert rows(spark.table(name)) == rows(numbers(spark, 0, 100))
    assert P.drop_stale_versions(spark, name) >= 1 and spark.table(name).count() == 100
    P.publish_table(numbers(spark, 7, 9), name)
    assert rows(spark.table(name)) == rows(numbers(spark, 7, 9))


def test_staged_rows_that_differ_are_not_swapped_in(spark, name, monkeypatch):
    P.publish_table(numbers(spark, 0, 10), name)
    monkeypatch.setattr(P, "verified", lambda record, read: ("t", 5, 4, False, False, True))
    with pytest.raises(RuntimeError, match="differ"):
        P.publish_table(numbers(spark, 0, 5), name)
    monkeypatch.undo()
    monkeypatch.setattr(P, "MARKER", "_NO_SUCH_MARKER")
    with pytest.raises(RuntimeError, match="marker"):
        P.publish_table(numbers(spark, 0, 5), name)
    assert spark.table(name).count() == 10


def test_an_existing_managed_table_can_be_published_over(spark, name):
    create_table(spark, name, numbers(spark, 0, 1).schema, "made by DDL")
    write_table(numbers(spark, 0, 3), name)
    P.publish_table(numbers(spark, 10, 14), name)
    assert rows(spark.table(name)) == rows(numbers(spark, 10, 14))


def test_stale_versions_go_and_the_newest_stay(spark, name):
    made = [P.publish_table(numbers(spark, 0, n), name) for n in (1, 2, 3, 4)]
    assert P.drop_stale_versions(spark, name, keep=1) == 2
    assert spark.table(name).count() == 4 and spark.read.parquet(made[2]).count() == 3
    assert P.drop_stale_versions(spark, name, keep=0) == 1 and P.drop_stale_versions(spark, name, keep=0) == 0
    assert P.drop_stale_versions(spark, f"{name}_none") == 0
