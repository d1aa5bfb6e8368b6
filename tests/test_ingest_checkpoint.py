"""A checkpoint that is made anew at the path of an old one is a new stream."""

import shutil

from conftest import rows
from strata.schemas import BRONZE
from strata.sources import csv as S
from strata.streaming import ingest_incremental


def test_a_checkpoint_recreated_at_its_path_ingests_the_whole_folder(spark, tmp_path):
    schema = BRONZE["bronze_erp_loc_a101"].schema
    land, ck, table = str(tmp_path / "landing"), str(tmp_path / "ck"), "recreated_checkpoint"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    S.write_csv(spark.createDataFrame([("a", None), ("b", "DE")], schema), f"{land}/drop1")
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    assert rows(spark.table(table)) == [("a", None), ("b", "DE")]
    shutil.rmtree(ck)
    S.write_csv(spark.createDataFrame([("c", "US")], schema), f"{land}/drop2")
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    assert rows(spark.table(table)) == [("a", None), ("a", None), ("b", "DE"), ("b", "DE"), ("c", "US")]
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    assert spark.table(table).count() == 5
    spark.sql(f"DROP TABLE {table}")
