"""Tiles from the cubes equal the tiles from the gold tables, for all kinds of selections."""

import itertools

import pytest
from pyspark.sql import functions as F

from strata.plans import cube as Q
from strata.plans import dashboard as D
from strata.plans.workspace import Workspace

from conftest import plan_text, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark):
    ws = Workspace(spark, SF)
    cust = ws.gold_cust.unionByName(ws.gold_cust.limit(40).withColumns({"country": F.lit(None).cast("string"), "gender": F.when(F.col("customer_id") % 2 == 0, F.col("gender")), "customer_id": F.lit(None).cast("int")}))
    return [df.cache() for df in (cust, ws.gold_sales)]


@pytest.fixture(scope="module")
def cubes(gold):
    return [Q.customer_cube(gold[0]).cache(), Q.product_cube(gold[1]).cache()]


COUNTRIES, GENDERS = [None, [], ["Germany"], ["United States", "Unknown"], ["Nowhere"]], [None, ["Female"], ["Male", "Unknown"], ["x"]]


@pytest.mark.parametrize("countries,genders", list(itertools.product(COUNTRIES, GENDERS)))
def test_tiles_equal_direct_tiles(gold, cubes, countries, genders):
    selections = {k: v for k, v in (("country", countries), ("gender", genders)) if v is not None}
    direct = D.widgets(*gold, selections)
    got = Q.tiles(*cubes, selections)
    for name in got if genders is None else [n for n in got if "product" not in n]:  # the products know no filter
        assert got[name].columns == direct[name].columns and rows(got[name]) == rows(direct[name]), name


def test_cube_levels_hold_every_subset_once(gold, cubes):
    levels = {r["level"]: r["n"] for r in cubes[0].groupBy("level").agg(F.sum("row_count").alias("n")).collect()}
    n = gold[0].count()
    assert set(levels) == {",".join(sorted(s)) for k in range(4) for s in itertools.combinations(Q.CUSTOMER_DIMS, k)} and set(levels.values()) == {n}


def test_tiles_read_the_cube_and_empty_tables_give_zero(spark, gold, tmp_path):
    paths = [f"{tmp_path}/c", f"{tmp_path}/p"]
    for make, df, path in zip((Q.customer_cube, Q.product_cube), gold, paths):
        make(df.where("false")).write.parquet(path)
    tiles = Q.tiles(*(spark.read.parquet(p) for p in paths))
    assert tiles["kpi_total_customers"].first()[0] == 0 and tiles["kpi_average_cost"].first()[0] is None and tiles["customers_by_country"].count() == 0
    assert plan_text(tiles["customers_by_gender"], "simple").count("FileScan") == 1
