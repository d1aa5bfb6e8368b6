"""The split join: heavy keys, rows without a key, bucketed tables."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators.skew import Lookup, enrich_chain, heavy_keys, planner_broadcasts
from strata.plans import gold as G
from strata.plans.workspace import Workspace

from conftest import plan_text, rows

SHUFFLED = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k) for k in SHUFFLED}
    for k, v in SHUFFLED.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def left(spark):
    """30 000 rows: a third are one identical row without any value, a third share a key, the rest have 997 keys."""
    i = F.col("id")
    return spark.range(0, 30000).select(F.when(i % 3 > 0, i).alias("id"), F.when(i % 3 == 1, "HOT").when(i % 3 == 2, (i % 997).cast("string")).alias("k"))


def right(spark, copies=1):
    plain = spark.range(0, 900).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    return plain.union(spark.createDataFrame([("HOT", -j) for j in range(copies)] + [(None, 5)], "k string, v long"))


def test_heavy_keys_are_the_frequent_ones_whatever_the_number_of_others(spark, left):
    assert [r["k"] for r in heavy_keys(left, "k").collect()] == ["HOT"]
    many = spark.range(0, 200_000).select(F.when(F.col("id") % 20 == 0, F.col("id") % 3).otherwise(F.col("id") + 10).alias("k"))
    assert sorted(r["k"] for r in heavy_keys(many, "k").collect()) == [0, 1, 2]
    assert heavy_keys(left.where("k IS NULL"), "k").count() == 0 and heavy_keys(many, "k", share=0.2).count() == 0
    with pytest.raises(ValueError):
        heavy_keys(left, "k", share=0.001, tracked=100)


@pytest.mark.parametrize("copies", [1, 3])
def test_split_join_equals_plain_join(spark, left, shuffled, copies):
    r = right(spark, copies)
    split = enrich_chain(left, "k", [Lookup(r, "k")], split=True)
    assert split.columns == ["k", "id", "v"] or set(split.columns) == {"k", "id", "v"}
    assert Counter(map(tuple, split.select("k", "id", "v").collect())) == Counter(map(tuple, left.join(r, "k", "left").select("k", "id", "v").collect()))


def test_no_partition_holds_much_of_the_hot_rows(spark, left, shuffled):
    def largest(df):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        return max(sizes) / sum(sizes)

    assert largest(left.join(right(spark), "k", "left")) > 0.33
    assert largest(enrich_chain(left, "k", [Lookup(right(spark), "k")], split=True)) < 0.1


def test_tables_bucketed_by_the_key_join_without_an_exchange(spark, left, shuffled):
    names = [f"skew_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    try:
        for name, df in zip(names, (left, right(spark))):
            df.write.bucketBy(8, "k").sortBy("k").saveAsTable(name)
        l, r = (spark.table(n) for n in names)
        out = enrich_chain(l, "k", [Lookup(r, "k")], split=True)
        assert Counter(map(tuple, out.select("k", "id", "v").collect())) == Counter(map(tuple, left.join(right(spark), "k", "left").select("k", "id", "v").collect()))
        plan = out._jdf.queryExecution().executedPlan().toString()
        branches = plan.split("SortMergeJoin")
        # of the two merge joins one is over the buckets: its inputs are scans; the other joins the few heavy rows
        assert len(branches) == 3 and plan.count("Bucketed: true") >= 2
        assert any("Exchange hashpartitioning" not in b for b in branches[1:])
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_building_a_plan_starts_no_job_and_small_sides_stay_plain(spark, left):
    sc = spark.sparkContext
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    small = nation.select(F.when(F.col("n_nationkey") > 0, F.col("n_name")).otherwise("HOT").alias("k"), F.col("n_nationkey").cast("long").alias("v"))
    sc.setJobGroup("skew-build", "no job expected")
    plain, split = enrich_chain(left, "k", [Lookup(small, "k")]), enrich_chain(left, "k", [Lookup(small, "k")], split=True)
    assert not sc.statusTracker().getJobIdsForGroup("skew-build")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert planner_broadcasts(small) and not planner_broadcasts(spark.range(10_000_000)) and "approx_top_k" not in plan_text(plain, "extended")
    assert Counter(map(tuple, plain.select("k", "id", "v").collect())) == Counter(map(tuple, split.select("k", "id", "v").collect()))


def test_gold_customer_is_the_same_split_or_not(spark):
    ws = Workspace(spark, "/root/testdata/sf0.001")
    hot = ws.silver_cust.unionByName(ws.silver_cust.limit(1).select(*ws.silver_cust.columns).crossJoin(spark.range(300)).drop("id"))
    args = (hot, ws.erp_cust.unionByName(ws.erp_cust.limit(5)), ws.erp_loc)
    assert rows(G.gold_customer(*args, split=True)) == rows(G.gold_customer(*args, split=False))
    assert rows(G.join_erp_location(hot, ws.erp_loc, split=True)) == rows(G.join_erp_location(hot, ws.erp_loc, split=False))


def test_empty_sides(spark, left):
    none = left.where("false")
    assert enrich_chain(none, "k", [Lookup(right(spark), "k")], split=True).count() == 0
    assert enrich_chain(left, "k", [Lookup(right(spark).where("false"), "k")], split=True).where("v IS NULL").count() == 30000
