"""Verified writes, one-run audits and the gold report."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import audit as A
from strata.operators import enrich as J
from strata.plans import verification as V
from strata.plans.queries import QUERIES
from strata.plans.silver import CUSTOMER
from strata.plans.workspace import Workspace
from strata.schemas import SILVER
from strata.sources import catalog as K
from strata.sources import verify

from conftest import plan_text, rows

SF = "/root/testdata/sf0.001"
SCHEMA = "id int, name string, at date, amount double, tags map<string,int>, parts array<struct<a:int,b:string>>"
ROWS = [(1, "a", dt.date(2024, 1, 1), 1.5, {"x": 1, "y": 2}, [(1, "p")]), (2, None, None, None, None, None), (None, "a", None, 0.0, {}, []), (2, None, None, None, None, None)]


@pytest.fixture
def table(spark):
    name = f"verify_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def digest(df):
    return tuple(df.agg(*verify.content_digest(df.schema.fields)).first())


def test_digest_ignores_order_and_split_and_sees_every_change(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    was = digest(df)
    assert digest(df.orderBy(F.desc("id")).repartition(7)) == was
    other = [ROWS[:3], ROWS + ROWS[1:2], [(2, None, None, None, None, None)] + ROWS[1:], ROWS[:2] + [("a" and None, None, None, 0.0, {}, [])] + ROWS[3:],
             [(1, "a", dt.date(2024, 1, 1), 1.5, {"x": 2, "y": 1}, [(1, "p")])] + ROWS[1:]]
    assert all(digest(spark.createDataFrame(o, SCHEMA)) != was for o in other)
    two = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert digest(two) != digest(two.select(F.col("y").alias("x"), F.col("x").alias("y")))
    maps = spark.sql("SELECT map('x', 1, 'y', 2) AS m"), spark.sql("SELECT map('y', 2, 'x', 1) AS m")
    assert digest(maps[0]) == digest(maps[1])


def test_a_right_write_is_verified(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = (table, 4, 4, True, True, True)
    assert tuple(verify.write_verified(df, table).first()) == want
    assert tuple(verify.write_verified(df.repartition(3), table).first()) == want  # again, over the first
    assert tuple(verify.write_verified(df.where("false"), table).first()) == (table, 0, 0, True, True, True)
    with pytest.raises(ValueError):
        verify.write_verified(df, table, mode="append")


@pytest.mark.parametrize("fault", ["drop", "double", "swap"])
def test_a_faulty_write_turns_the_report_red(spark, table, monkeypatch, fault):
    plain = K.write_table
    df = spark.createDataFrame(ROWS, SCHEMA)

    def faulty(frame, name, observe=None, **kw):
        plain(frame, name, observe=observe, **kw)
        bad = {"drop": frame.where("id = 1 OR id IS NULL"), "double": frame.union(frame.where("id = 1")), "swap": frame.withColumn("name", F.when(F.col("id") == 1, "b").otherwise(F.col("name")))}[fault]
        plain(bad, name)

    monkeypatch.setattr(verify, "write_table", faulty)
    _, wrote, read, same_rows, same, schema = verify.write_verified(df, table).first()
    assert wrote == 4 and schema and not same and same_rows == (wrote == read) == (fault == "swap")


def test_bucketed_writes_observe_the_written_rows(spark):
    ws = Workspace(spark, SF)
    schema = f"verify_{uuid.uuid4().hex[:8]}"
    K.ensure_schema(spark, schema)
    report = verify.write_verified(ws.silver_prd, spec=SILVER["silver_crm_prd_info"], schema_name=schema, buckets=4).first()
    n = ws.silver_prd.count()
    assert tuple(report) == ("silver_crm_prd_info", n, n, True, True, True)
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


def test_a_changed_schema_is_seen(spark, table):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    record = verify.Written(table, df.schema)
    K.write_table(df, table, observe=record.observe)
    assert verify.verified(record, spark.table(table))[3:] == (True, True, True)
    assert verify.verified(record, spark.table(table).select("name", "id"))[3:] == (True, True, False)
    assert verify.verified(record, spark.table(table).select("id"))[3:] == (True, False, False)


def test_audit_counts_one_run_with_one_scan_an_input(spark):
    ws = Workspace(spark, SF)
    counts = A.StepCounts()
    df = spark.read.parquet(f"{SF}/customer.parquet").select(F.col("c_custkey").alias("cst_id"), F.col("c_name").alias("cst_key"), F.col("c_name").alias("cst_firstname"), F.col("c_name").alias("cst_lastname"),
                                                            F.lit("M").alias("cst_marital_status"), F.lit("F").alias("cst_gndr"), F.lit(dt.date(2024, 1, 1)).alias("cst_create_date"))
    plan = A.cleaning_run(df, CUSTOMER, counts)
    assert plan_text(plan).count("Scan parquet") == 2  # the operator and its details: one scan
    A.run_to_end(plan)
    n = df.count()
    assert (counts.of("customer_in"), counts.of("customer_in", "null_keys"), counts.of("customer_out")) == (n, 0, n)
    got = A.cleaning_audit([(CUSTOMER, ws.bronze_cust)])
    bronze = ws.bronze_cust
    keys = bronze.where("cst_id IS NOT NULL")
    assert got == [("customer", bronze.count(), keys.count() - keys.select("cst_id").distinct().count(), bronze.where("cst_id IS NULL").count(), keys.select("cst_id").distinct().count())]
    assert A.cleaning_audit([(CUSTOMER, bronze.where("false"))]) == [("customer", 0, 0, 0, 0)]


def test_table_report_counts_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 1)], "a string, b int")
    got = [tuple(r) for r in V.table_report(df, "t", ["a", "b"]).collect()]
    assert got == [("t", "schema", "a string", 1), ("t", "schema", "b int", 2), ("t", "rows", None, 3), ("t", "a", "x", 2), ("t", "a", None, 1), ("t", "b", "1", 2), ("t", "b", None, 1)]
    assert rows(V.table_report(df.where("false"), "t", ["a"])) == rows(spark.createDataFrame([("t", "schema", "a string", 1), ("t", "schema", "b int", 2), ("t", "rows", None, 0)], "a string, b string, c string, d long"))
    assert V.table_report(df, "t", []).where("section = 'rows'").first()["value"] == 3


def test_gold_report_scans_each_written_table_once(spark):
    out = QUERIES["gold_verification_report"](Workspace(spark, SF))
    assert plan_text(out, "simple").count("FileScan") == 2


def test_known_coverage_leaves_the_sentinel_out(spark):
    df = spark.createDataFrame([("Unknown",), ("x",), (None,), ("y",)], "c string")
    assert tuple(J.known_coverage(df, {"c": "Unknown"}).first()) == ("c", 3, 2, 4, 75.0, 50.0)
    assert tuple(J.known_coverage(df.where("false"), {"c": None}).first()) == ("c", 0, 0, 0, None, None)
