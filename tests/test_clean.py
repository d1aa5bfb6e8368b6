import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.plans.silver import CUSTOMER, PRODUCT
from strata.specs import recode

from conftest import rows

D = dt.date
CUST_SCHEMA = ("cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
               "cst_marital_status string, cst_gndr string, cst_create_date date")


def test_trim_strips_spaces_only_and_keeps_other_types(spark):
    df = spark.createDataFrame([(1, "  a ", "\tb\t", D(2024, 1, 1))], "id int, s string, t string, d date")
    out = C.trim_strings(df)
    assert out.dtypes == df.dtypes
    assert out.collect()[0] == (1, "a", "\tb\t", D(2024, 1, 1))


def test_rows_with_whitespace_or_over_columns_null_safe(spark):
    df = spark.createDataFrame([(1, None, " x"), (2, None, "y"), (3, "a ", None), (4, "a", "b")], "id int, a string, b string")
    assert sorted(r.id for r in C.rows_with_whitespace(df).collect()) == [1, 3]


def test_dedupe_latest_then_most_complete_then_deterministic(spark):
    data = [
        (1, "k", "old", "x", "M", "M", D(2024, 1, 1)),
        (1, "k", "new", None, "M", "M", D(2024, 2, 1)),        # latest wins even with a NULL
        (2, "k2", "a", "b", "S", None, D(2024, 3, 1)),
        (2, "k2", "a", "b", "S", "F", D(2024, 3, 1)),          # same date: fewest NULLs wins
        (3, "k3", "z", "b", "S", "F", None),                   # NULL date sorts last
        (3, "k3", "y", "b", "S", "F", D(2020, 1, 1)),
        (4, "k4", "b", "b", "S", "F", D(2024, 1, 1)),          # full tie on date and score:
        (4, "k4", "a", "b", "S", "F", D(2024, 1, 1)),          # smallest remaining values win
    ]
    df = spark.createDataFrame(data, CUST_SCHEMA)
    out = {r.cst_id: r for r in C.dedupe_latest(df, ["cst_id"], "cst_create_date").collect()}
    assert out[1].cst_firstname == "new"
    assert out[2].cst_gndr == "F"
    assert out[3].cst_firstname == "y"
    assert out[4].cst_firstname == "a"


def test_dedupe_is_order_independent_and_idempotent(spark):
    base = [(i % 7, f"k{i % 3}", f"n{i % 5}", None if i % 4 == 0 else "l", "M", "F", D(2024, 1, 1 + i % 3))
            for i in range(200)]
    outs = []
    for seed in (1, 2, 3):
        shuffled = base[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, CUST_SCHEMA).repartition(5)
        outs.append(rows(C.dedupe_latest(df, ["cst_id"], "cst_create_date")))
    assert outs[0] == outs[1] == outs[2]
    once = C.dedupe_latest(spark.createDataFrame(base, CUST_SCHEMA), ["cst_id"], "cst_create_date")
    assert rows(C.dedupe_latest(once, ["cst_id"], "cst_create_date")) == rows(once)


def test_dedupe_null_keys_dropped_or_kept(spark):
    df = spark.createDataFrame([(None, "a", None, None, None, None, None), (None, "b", None, None, None, None, None),
                                (1, "c", None, None, None, None, None)], CUST_SCHEMA)
    assert [r.cst_id for r in C.dedupe_latest(df, ["cst_id"], "cst_create_date").collect()] == [1]
    kept = C.dedupe_latest(df, ["cst_id"], "cst_create_date", keep_null_keys=True)
    assert kept.count() == 3


def test_dedupe_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, 6.0), (1, 2, 1.0), (None, 1, 2.0)], "a long, b int, v double")
    assert rows(C.dedupe_latest(df, ["a", "b"])) == [(1, 1, 5.0), (1, 2, 1.0)]


def test_row_conservation_in_equals_kept_plus_removed_plus_null_keys(spark):
    from strata.operators.profile import key_audit
    data = [(i % 11 if i % 13 else None, f"k{i}", None, None, None, None, D(2024, 1, 1)) for i in range(300)]
    df = C.trim_strings(spark.createDataFrame(data, CUST_SCHEMA))
    a = key_audit(df, ["cst_id"]).collect()[0]
    kept = C.dedupe_latest(df, ["cst_id"], "cst_create_date").count()
    assert kept == a.distinct_keys
    assert a.rows_in == kept + (a.rows_in - a.null_key_rows - kept) + a.null_key_rows


def test_fill_keeps_types_and_only_fills_null(spark):
    df = spark.createDataFrame([(None, None, ""), (3, "x", " ")], "prd_cost int, prd_nm string, prd_line string")
    out = C.fill_nulls(df, {"prd_cost": 0, "prd_nm": "Unknown", "prd_line": "Unknown"})
    assert dict(out.dtypes)["prd_cost"] == "int"
    assert rows(out) == [(0, "Unknown", ""), (3, "x", " ")]


def test_recode_first_match_null_blank_and_passthrough(spark):
    df = spark.createDataFrame([("M",), ("S",), ("X",), (None,), ("",), (" US ",)], "c string")
    out = C.recode(df, {"c": recode({"Married": "M", "Single": "S"})})
    assert [r.c for r in out.collect()] == ["Married", "Single", "X", None, "", " US "]
    country = recode({"United States": ["USA", "US"]}, null_default="Unknown", blank_default="Unknown", otherwise="trim")
    out2 = C.recode(df, {"c": country})
    assert [r.c for r in out2.collect()] == ["M", "S", "X", "Unknown", "Unknown", "US"]


def test_silver_cleaning_is_idempotent_on_its_own_rules(spark):
    data = [(1, " k ", "a", None, " M", None, D(2024, 1, 1)), (1, "k", "b", "x", "S", "F ", D(2024, 1, 2)),
            (2, "k2", None, None, None, None, None)]
    df = spark.createDataFrame(data, CUST_SCHEMA)
    once = C.recode(C.fill_nulls(C.dedupe_latest(C.trim_strings(df), ["cst_id"], "cst_create_date"),
                                 dict(CUSTOMER.fills)), dict(CUSTOMER.recodes))
    twice = C.recode(C.fill_nulls(C.dedupe_latest(C.trim_strings(once), ["cst_id"], "cst_create_date"),
                                  dict(CUSTOMER.fills)), dict(CUSTOMER.recodes))
    assert rows(once) == rows(twice)
    assert {r.cst_id: r.cst_gndr for r in once.collect()} == {1: "Female", 2: "Unknown"}


def test_clean_entity_product_end_to_end(spark):
    data = [(1, "AB-C-1", " bike", None, "R ", D(2011, 7, 1), None),
            (1, "AB-C-1", "old", 5, "S", D(2010, 1, 1), None),
            (None, "x", "junk", 1, "M", D(2011, 1, 1), None)]
    df = spark.createDataFrame(data, "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
                                     "prd_start_dt date, prd_end_dt date")
    out = C.clean_entity(df, PRODUCT).collect()
    assert len(out) == 1
    assert out[0].asDict() == {"product_id": 1, "product_key": "AB-C-1", "product_name": "bike", "cost": 0,
                               "product_line": "Road", "start_date": D(2011, 7, 1), "end_date": None}


def test_date_order_violations(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 10), D(2020, 1, 1)), (2, D(2020, 1, 1), None), (3, D(2020, 1, 1), D(2020, 2, 1))],
                               "id int, s date, e date")
    out = C.date_order_violations(df, "s", "e", order_by="id").collect()
    assert [(r.id, r.days_end_before_start) for r in out] == [(1, 9)]


def test_strict_variant_fills_names_and_blank(spark):
    from strata.plans.silver import CUSTOMER_STRICT
    data = [(1, "k", "", None, None, " ", D(2024, 1, 1))]
    out = C.clean_entity(spark.createDataFrame(data, CUST_SCHEMA), CUSTOMER_STRICT).collect()[0]
    assert (out.first_name, out.last_name, out.marital_status, out.gender) == ("Unknown",) * 4
    default = C.clean_entity(spark.createDataFrame(data, CUST_SCHEMA), CUSTOMER).collect()[0]
    assert (default.first_name, default.last_name, default.marital_status, default.gender) == ("", None, None, "")
