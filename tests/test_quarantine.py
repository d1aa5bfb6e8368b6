"""Corrupt lines in batch and stream, schema merge over files, thresholds as rows, separators."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import segment_key
from strata.operators.dq import THRESHOLDS, judged_history
from strata.plans import dashboard as D
from strata.plans.workspace import Workspace
from strata.sources import csv as S
from strata.streaming import ingest_incremental

from conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("at", T.DateType()), T.StructField("name", T.StringType())])


@pytest.fixture
def schema(spark):
    name = f"quar_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def land(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("id,at,name\n" + "\n".join(lines) + "\n")


GOOD, BAD = ["1,2024-01-01,a", "2,,b", "3,2024-01-03,"], ["x,2024-01-01,c", "4,not-a-date,d"]


def test_a_bad_line_is_quarantined_with_its_file_in_batch(spark, schema, tmp_path):
    land(tmp_path / "in" / "one.csv", GOOD + BAD)
    got = S.ingest_quarantined(spark, str(tmp_path / "in"), SCHEMA, f"{schema}.t", f"{schema}.q")
    assert got == (3, 2) and {r["id"] for r in spark.table(f"{schema}.t").collect()} == {1, 2, 3}
    q = spark.table(f"{schema}.q").collect()
    assert {r["line"] for r in q} == set(BAD) and all(r["source_file"].endswith("one.csv") and r["table_name"] == f"{schema}.t" for r in q)
    land(tmp_path / "clean" / "two.csv", GOOD)
    assert S.ingest_quarantined(spark, str(tmp_path / "clean"), SCHEMA, f"{schema}.t", f"{schema}.q") == (3, 0)
    assert spark.table(f"{schema}.q").count() == 2


def test_a_bad_line_is_quarantined_in_the_stream(spark, schema, tmp_path):
    land(tmp_path / "in" / "one.csv", GOOD + BAD[:1])
    args = (spark, str(tmp_path / "in"), SCHEMA, f"{schema}.t")
    ingest_incremental(*args, checkpoint=str(tmp_path / "ck"), quarantine=f"{schema}.q")
    land(tmp_path / "in" / "two.csv", ["5,2024-02-02,e"] + BAD[1:])
    ingest_incremental(*args, checkpoint=str(tmp_path / "ck"), quarantine=f"{schema}.q")
    ingest_incremental(*args, checkpoint=str(tmp_path / "ck"), quarantine=f"{schema}.q")
    assert sorted(r["id"] for r in spark.table(f"{schema}.t").collect()) == [1, 2, 3, 5]
    assert sorted((r["line"], r["source_file"].split("/")[-1]) for r in spark.table(f"{schema}.q").collect()) == [("4,not-a-date,d", "two.csv"), ("x,2024-01-01,c", "one.csv")]


def test_schemas_of_several_files_merge(spark, tmp_path):
    for name, text in (("a", "id,n,d\n1,2,2024-01-01\n"), ("b", "n,id,extra\n2.5,3000000000,x\n"), ("c", "d,id\nlater,7\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    got = S.merged_schema(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    assert [(f.name, f.dataType.simpleString()) for f in got.fields] == [("id", "bigint"), ("n", "double"), ("d", "string"), ("extra", "string")]


def test_a_changed_threshold_row_changes_the_status(spark):
    ws = Workspace(spark, "/root/testdata/sf0.001")
    history = D.gold_metrics(ws.gold_cust, ws.gold_sales, "2025-01-01").cache()
    rules = D.default_thresholds(dt.date(2020, 1, 1))
    plain = judged_history(history, spark.createDataFrame(rules, THRESHOLDS))
    want = D.dq_checks_gold(ws.gold_cust, ws.gold_sales, "2025-01-01")
    cols = ["table_name", "check_name", "metric_value", "warn_threshold", "fail_threshold", "status"]
    assert rows(plain.select(*cols)) == rows(want.select(*cols))
    loose = [(t, c, m, 1e9, 1e9, a, b) for t, c, m, _, _, a, b in rules]
    assert {r["status"] for r in judged_history(history, spark.createDataFrame(loose, THRESHOLDS)).where("metric_value IS NOT NULL").collect()} == {"PASS"}
    ended = [(*r[:5], r[5], dt.date(2024, 12, 31)) for r in rules]
    assert judged_history(history, spark.createDataFrame(ended, THRESHOLDS)).count() == 0
    days = history.withColumn("measured_on", F.lit(dt.date(2024, 6, 1)))
    assert judged_history(history.unionByName(days), spark.createDataFrame(ended, THRESHOLDS)).select("measured_on").distinct().collect() == [(dt.date(2024, 6, 1),)]


@pytest.mark.parametrize("sep", ["-", ".", "|", "||", "\\", "[a]", "$", "'"])
def test_a_separator_is_plain_text(spark, sep):
    df = spark.createDataFrame([(f"aa{sep}bb{sep}cc",), (f"aa{sep}",), ("none",), (None,)], "k string")
    want = ["aa_bb", "aa_", None, None]
    assert [r.c for r in df.select(segment_key("k", sep).alias("c")).collect()] == want
    assert [r.c for r in df.select(segment_key(F.col("k"), sep).alias("c")).collect()] == want
