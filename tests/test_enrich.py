import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.expr import derived_key, segment_key
from strata.operators import enrich as J
from strata.plans import gold as G

from conftest import plan_text, rows


def test_derived_keys_match_worked_example(spark):
    df = spark.createDataFrame([("AW00011000",), (None,)], "customer_key string")
    out = df.select(derived_key("NASA", "customer_key", 2).alias("a"), derived_key("AW-", "customer_key", 3).alias("b")).collect()
    assert out[0] == ("NASAW00011000", "AW-00011000")
    assert out[1] == (None, None)


def test_segment_key_without_hyphen_is_null(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B",), ("NOHYPHEN12",), ("AB-",), (None,)], "k string")
    assert [r.c for r in df.select(segment_key("k").alias("c")).collect()] == ["CO_RF", None, "AB_", None]


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("b", 20)], "k string, v int")
    return left, right


def test_on_duplicate_fanout_first_error(spark, sides):
    left, right = sides
    assert J.enrich(left, right, "k", on_duplicate="fanout").count() == 4
    first = J.enrich(left, right, "k", on_duplicate="first")
    assert rows(first.select("id", "v")) == [(1, 10), (2, 20), (3, None)]
    with pytest.raises(ValueError, match="duplicate join key"):
        J.enrich(left, right, "k", on_duplicate="error")
    ok = J.enrich(left, right.where("v != 11"), "k", on_duplicate="error")
    assert ok.count() == 3


def test_salted_join_equals_plain_join_with_many_null_keys(spark):
    left = spark.range(0, 3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, None)
                                       .otherwise((F.col("id") % 50).cast("string")).alias("k"))
    right = spark.range(0, 40).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, "k", "left")
    salted = J.salted_join(left, right, "k", "left")
    assert rows(salted.select("id", "k", "v")) == rows(plain.select("id", "k", "v"))
    anti = J.salted_join(left, right, "k", "left_anti")
    assert rows(anti.select("id", "k")) == rows(left.join(right, "k", "left_anti").select("id", "k"))


def test_enrich_builds_without_a_job_and_can_leave_keys_unsalted(spark):
    left, right = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"), spark.createDataFrame([("a", 9)], "k string, w int")
    sc = spark.sparkContext
    sc.setJobGroup("enrich-build", "no job expected")
    salted, plain = J.enrich(left, right, "k"), J.enrich(left, right, "k", spread_null_keys=False)
    assert not sc.statusTracker().getJobIdsForGroup("enrich-build")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert rows(salted) == rows(plain)
    assert "xxhash64" in plan_text(salted) and "xxhash64" not in plan_text(plain)


def test_coverage_zero_rows_gives_null_pct(spark):
    empty = spark.createDataFrame([], "country string")
    out = J.coverage(empty, ["country"]).collect()[0]
    assert (out.matched_rows, out.total_rows, out.coverage_pct) == (0, 0, None)
    df = spark.createDataFrame([("x",), (None,), ("y",)], "country string")
    assert J.coverage(df, ["country"]).collect()[0].coverage_pct == 66.7


def test_gender_fallback_only_on_unknown(spark):
    df = spark.createDataFrame([("Unknown", "Male"), ("Unknown", None), ("", "Female"), (None, "Female"), ("Female", "Male")],
                               "gender string, erp string")
    out = [r.gender for r in J.fallback(df, "gender", "erp").collect()]
    assert out == ["Male", "Unknown", "", None, "Female"]


def test_std_country_and_erp_gender(spark):
    loc = spark.createDataFrame([("US",), ("USA",), ("DE",), ("",), (None,), ("France",)], "country string")
    assert [r.country for r in G.std_country(loc).collect()] == [
        "United States", "United States", "Germany", "Unknown", "Unknown", "France"]
    erp = spark.createDataFrame([("M",), ("F",), ("Male",), ("",), (None,)], "erp_gender string")
    assert [r.erp_gender_clean for r in G.std_erp_gender(erp).collect()] == ["Male", "Female", "Male", None, None]


def test_gold_customer_left_join_keeps_cardinality(spark):
    D = dt.date
    silver = spark.createDataFrame([(1, "AW00000001", "a", "b", "Single", "Unknown", D(2024, 1, 1)),
                                    (2, "AW00000002", "c", "d", "Married", "Male", D(2024, 1, 2)),
                                    (3, None, "e", "f", "Single", "Unknown", None)],
                                   "customer_id int, customer_key string, first_name string, last_name string, "
                                   "marital_status string, gender string, created_date date")
    erp_cust = spark.createDataFrame([("NASAW00000001 ", D(1980, 1, 1), "F")], "CID string, BDATE date, GEN string")
    erp_loc = spark.createDataFrame([("AW-00000002", "DE")], "CID string, CNTRY string")
    out = {r.customer_id: r for r in G.gold_customer(silver, erp_cust, erp_loc).collect()}
    assert len(out) == 3
    assert (out[1].gender, out[1].birth_date, out[1].country) == ("Female", D(1980, 1, 1), "Unknown")
    assert (out[2].gender, out[2].country) == ("Male", "Germany")
    assert (out[3].gender, out[3].country) == ("Unknown", "Unknown")


def test_error_guard_ignores_null_keys_and_fails_before_the_join(spark, sides):
    left, right = sides
    with_nulls = right.where("v != 11").unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k string, v int"))
    assert J.enrich(left, with_nulls, "k", on_duplicate="error").count() == 3
    with pytest.raises(ValueError, match="duplicate join key"):
        J.guard_unique(right, "k", "error")


def test_salting_spreads_a_third_of_rows_with_null_keys(spark):
    """A third of the left rows lack a key: the plain shuffle join puts them all in one partition,
    the salted join spreads them (measured per output partition, AQE and broadcast off)."""
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 30000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 997).cast("string")).alias("k"))
        right = spark.range(0, 997).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))

        def max_share(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / sum(sizes)

        assert max_share(left.join(right, "k", "left")) > 0.33
        salted = J.salted_join(left, right, "k", "left")
        assert max_share(salted) < 0.2
        assert salted.count() == 30000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_gold_customer_cardinality_with_duplicated_erp_keys(spark):
    """Left-join cardinality = left count unless on_duplicate='fanout' (which reproduces the fan-out)."""
    from strata.plans.workspace import Workspace

    ws = Workspace(spark, "/root/testdata/sf0.001")
    dup_cust = ws.erp_cust.unionByName(ws.erp_cust.limit(5))   # five CIDs now appear twice
    n = ws.silver_cust.count()
    first = G.gold_customer(ws.silver_cust, dup_cust, ws.erp_loc, on_duplicate="first")
    assert first.count() == n
    assert first.select("customer_id").distinct().count() == n
    fan = G.gold_customer(ws.silver_cust, dup_cust, ws.erp_loc, on_duplicate="fanout")
    assert n < fan.count() <= n + 5
    with pytest.raises(ValueError, match="duplicate join key"):
        G.gold_customer(ws.silver_cust, dup_cust, ws.erp_loc, on_duplicate="error")


def test_salted_join_with_map_column(spark):
    left = spark.createDataFrame([(1, None, {"a": 1}), (2, "x", {"b": 2})], "id int, k string, m map<string,int>")
    right = spark.createDataFrame([("x", 10)], "k string, v int")
    assert rows(J.salted_join(left, right, "k", "left").select("id", "v")) == [(1, None), (2, 10)]


def test_aqe_splits_a_hot_non_null_key_in_enrich(spark):
    """A third of the left rows share one key: AQE's skew-join split keeps every output
    partition well under that third (thresholds lowered to this test's size)."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "true",
             "spark.sql.adaptive.skewJoin.enabled": "true",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 997).cast("string")).alias("k"))
        right = spark.range(0, 997).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")) \
            .union(spark.createDataFrame([("HOT", 1)], "k string, v long"))
        out = J.enrich(left, right, "k")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 60000
        assert max(sizes) / sum(sizes) < 0.25
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
