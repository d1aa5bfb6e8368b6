"""Merged profiles against full ones, and bounded distributions against the full distribution."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import sketches as Z

from conftest import plan_text


def test_merged_partitions_equal_one_profile_within_the_error(spark):
    i = F.col("id")
    df = spark.range(60_000).select((i % 30).alias("day"), F.when(i % 7 > 0, i % 20_000).alias("n"), F.when(i % 5 > 0, F.concat(F.lit("s"), (i % 300).cast("string"))).alias("s"), F.lit(None).cast("int").alias("z"))
    parts = Z.partition_profile(df, "day", ["n", "s", "z"])
    assert parts.count() == 90
    got = {r["column_name"]: r for r in Z.merged_profile(parts, {"n": "bigint", "z": "int"}).collect()}
    for c in "nsz":
        want = df.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.min(c).cast("string"), F.max(c).cast("string"), F.count_distinct(c)).first()
        assert tuple(got[c])[1:5] == tuple(want)[:4] and abs(got[c]["distinct_estimate"] - want[4]) <= Z.DISTINCT_ERROR * want[4]
    # a new day is merged from its own rows
    more = df.where("day < 3").withColumn("day", F.lit(99)).withColumn("n", F.col("n") + 1_000_000)
    both = Z.merged_profile(parts.unionByName(Z.partition_profile(more, "day", ["n", "s", "z"])), {"n": "bigint"}).where("column_name = 'n'").first()
    assert both["row_count"] == 60_000 + more.count() and both["max_value"] == str(more.agg(F.max("n")).first()[0])
    assert abs(both["distinct_estimate"] - df.select("n").union(more.select("n")).agg(F.count_distinct("n")).first()[0]) < 0.05 * both["distinct_estimate"]
    assert Z.partition_profile(df.where("false"), "day", ["n"]).count() == 0


def test_top_values_are_exact_while_the_values_are_few(spark):
    i = F.col("id")
    df = spark.range(10_000).select(F.when(i % 10 > 0, F.concat(F.lit("v"), (i % 7).cast("string"))).alias("a"), (i % 50).alias("b"))
    got = Z.top_values(df, ["a", "b"], 10).collect()
    want = Counter(r["a"] for r in df.collect())
    assert {r["value"]: r["count"] for r in got if r["column_name"] == "a" and r["kind"] == "value"} == {k: n for k, n in want.items() if k is not None}
    kinds = {(r["column_name"], r["kind"]): r["count"] for r in got if r["kind"] != "value"}
    assert kinds == {("a", "null"): want[None], ("a", "others"): 0, ("b", "null"): 0, ("b", "others"): 8000}
    assert len([r for r in got if r["column_name"] == "b" and r["kind"] == "value"]) == 10 and {r["count"] for r in got if r["column_name"] == "b" and r["kind"] == "value"} == {200}
    assert all(r["max_error"] == 0 for r in got)


def test_a_wide_column_has_a_bounded_output_and_error(spark):
    i = F.col("id")
    df = spark.range(200_000).select(F.when(i % 4 == 0, i % 5).otherwise(i).cast("string").alias("c"))
    plan = plan_text(Z.top_values(df, ["c"], 8), "simple")
    assert "hashpartitioning" not in plan
    got = Z.top_values(df, ["c"], 8).collect()
    exact = Counter(r["c"] for r in df.groupBy("c").count().where("count > 100").collect())
    full = {r["c"]: r["count"] for r in df.groupBy("c").count().where("count > 100").collect()}
    assert len(got) <= 10 and sum(r["count"] for r in got) >= 200_000 and exact
    top = {r["value"]: r for r in got if r["kind"] == "value"}
    assert set(full) <= set(top) and all(abs(top[v]["count"] - n) <= top[v]["max_error"] for v, n in full.items()) and got[0]["max_error"] < 200
    with pytest.raises(ValueError):
        Z.top_values(df, ["c"], 3000)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert {(r["column_name"], r["kind"], r["count"]) for r in Z.top_values(df, ["a", "b"]).collect()} == {(c, k, 0) for c in "ab" for k in ("null", "others")}
