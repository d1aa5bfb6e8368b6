import datetime as dt

from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import profile as P

from conftest import plan_text, rows

D = dt.date


def test_profile_counts_null_empty_whitespace_in_one_row(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "", " b"), (3, " c", "d")], "id int, s string, t string")
    r = P.profile(df).collect()[0].asDict()
    assert r == {"total_rows": 3, "id_nulls": 1, "s_nulls": 0, "t_nulls": 1, "s_empty": 1, "t_empty": 0,
                 "s_has_whitespace": 1, "t_has_whitespace": 1}


def test_profile_is_one_scan_and_no_job_per_column(spark, tmp_path):
    p = str(tmp_path / "t.parquet")
    spark.range(100).select(F.col("id"), F.col("id").cast("string").alias("s"), F.lit(None).cast("string").alias("u")) \
        .write.parquet(p)
    df = spark.read.parquet(p)
    tree = plan_text(P.profile_long(df)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert len(P.profile_long(df).collect()) == 3


def test_duplicate_check_single_and_composite(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, "b"), (2, None)], "k int, s string")
    out = dict(rows(P.duplicate_check(df, {"k": "k", "s": "s", "ks": ["k", "s"]})))
    assert out == {"k": 1, "s": 2, "ks": 1}


def test_category_distribution_keeps_null_group(spark):
    df = spark.createDataFrame([("M", "F"), ("M", None), (None, "F")], "a string, b string")
    out = rows(P.category_distribution(df, ["a", "b"]))
    assert out == sorted([("a", "M", 2), ("a", None, 1), ("b", "F", 2), ("b", None, 1)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_date_profile_future_and_pre_1900(spark):
    df = spark.createDataFrame([(D(1899, 12, 31),), (D(2025, 1, 2),), (D(2024, 5, 5),), (None,)], "d date")
    r = P.date_profile(df, "d", as_of="2025-01-01").collect()[0]
    assert (r.earliest_date, r.latest_date, r.distinct_dates, r.future_dates, r.pre_1900_dates) == (
        D(1899, 12, 31), D(2025, 1, 2), 3, 1, 1)


def test_duplicate_rows_and_column_diff(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (2, "b", "y"), (2, "c", "y"), (3, "z", "z")],
                               "k int, s string, t string")
    assert sorted(r.k for r in P.duplicate_rows(df, "k").collect()) == [1, 1, 2, 2]
    assert dict(rows(P.duplicate_column_diff(df, "k"))) == {"s": 1, "t": 1}
    assert P.dup_summary(df, "k").collect()[0] == (4, 2)


def test_null_summary_long_form(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "a int, b string")
    assert rows(P.null_summary(df)) == [("a", 2), ("b", 1)]


def test_dedupe_plan_has_window_group_limit_and_one_window(spark, tmp_path):
    p = str(tmp_path / "li.parquet")
    spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v")).write.parquet(p)
    plan = plan_text(C.dedupe_latest(spark.read.parquet(p), ["k"], "v"))
    assert "WindowGroupLimit" in plan
    physical = plan.split("\n\n")[0]
    assert physical.count("Window (") == 1
    assert physical.count("Scan parquet") == 1
    assert "PushedFilters: [IsNotNull(k)]" in plan


def test_whitespace_check_after_trim_is_zero(spark):
    df = spark.createDataFrame([(" a", "b "), (None, " ")], "a string, b string")
    assert P.whitespace_rows_count(df).collect()[0][0] == 2
    assert P.whitespace_rows_count(C.trim_strings(df)).collect()[0][0] == 0


def test_date_profile_approx_distinct_is_close_and_single_stage(spark):
    df = spark.range(5000).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("d"))
    exact = P.date_profile(df, "d", as_of="2025-01-01").collect()[0].distinct_dates
    approx = P.date_profile(df, "d", as_of="2025-01-01", approx_distinct=0.02).collect()[0].distinct_dates
    assert exact == 700 and abs(approx - 700) / 700 < 0.08
    assert "Expand" not in plan_text(P.date_profile(df, "d", approx_distinct=0.02, end_col="d"))


def test_dedupe_shuffles_at_most_one_row_per_map_task_for_a_hot_key(spark):
    """A third of the rows share one key across 8 map tasks: after execution, AQE's final plan
    reports the rows that crossed the shuffle — the other keys' 20 000 plus <= 8 for the hot key."""
    import re

    src = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    df = C.dedupe_latest(src, ["k"], "v")
    assert df.count() == 20001
    df.collect()
    shuffled = [float(x) for x in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\([^)]*rowCount=([0-9.E+]+)",
                                             plan_text(df))]
    assert shuffled and max(shuffled) < 20100      # not 30 000: the hot key was cut map-side


def test_duplicate_check_pre_aggregates_a_hot_key_before_the_shuffle(spark):
    import re

    src = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"))
    df = P.duplicate_check(src, {"k": "k"})
    assert df.collect()[0].dup_count == 1
    shuffled = [float(x) for x in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\([^)]*rowCount=([0-9.E+]+)",
                                             plan_text(df))]
    assert shuffled and max(shuffled) < 20100      # one partial row per key per map task


def test_reshaped_reports_accept_awkward_column_names(spark):
    df = spark.createDataFrame([(None, "a "), (1, None)], "`it's` int, `odd name` string")
    assert rows(P.null_summary(df)) == [("it's", 1), ("odd name", 1)]
    long = {r.column_name: (r.nulls, r.whitespace) for r in P.profile_long(df).collect()}
    assert long == {"it's": (1, None), "odd name": (1, 1)}
    assert [r.column_name for r in P.schema_profile(df).collect()] == ["it's", "odd name"]
