import os
import datetime as dt
import uuid

import pytest

from strata.schemas import BRONZE, SILVER
from strata.sources import catalog as K
from strata.sources import csv as S
from strata.specs import IngestConfig, IngestSource

from conftest import rows

D = dt.date


@pytest.fixture
def layers(spark):
    return K.ensure_layers(spark, f"t{uuid.uuid4().hex[:8]}_")


def test_csv_round_trip_keeps_null_empty_and_padding(spark, tmp_path):
    schema = BRONZE["bronze_erp_loc_a101"].schema
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", " x "), ("d", "a,b\"c")], schema)
    path = str(tmp_path / "loc.csv")
    S.write_csv(df, path)
    assert rows(S.read_csv(spark, path, schema)) == rows(df)


def test_bad_date_is_visible_as_corrupt_record(spark, tmp_path):
    p = tmp_path / "cust.csv"
    p.write_text("CID,BDATE,GEN\nA,1980-01-01,M\nB,not-a-date,F\n")
    df = S.read_csv(spark, str(p), BRONZE["bronze_erp_cust_az12"].schema, keep_corrupt=True).cache()
    bad = df.where(df[S.CORRUPT_COL].isNotNull()).collect()
    assert [(r.CID, r.BDATE) for r in bad] == [("B", None)]
    inferred = S.read_csv(spark, str(p), infer_schema=True)
    assert dict(inferred.dtypes)["BDATE"] == "string"


def test_ingest_reports_corrupt_rows(spark, tmp_path, layers):
    p = tmp_path / "cust.csv"
    p.write_text("CID,BDATE,GEN\nA,1980-01-01,M\nB,not-a-date,F\nC,\\N,\n")
    table = f"{layers['bronze']}.bronze_erp_cust_az12"
    n, bad = S.ingest(spark, str(p), BRONZE["bronze_erp_cust_az12"].schema, table, with_corrupt=True)
    assert (n, bad) == (3, 1)
    # an unquoted empty field is NULL on read (the landing writer quotes empty strings)
    assert rows(spark.table(table)) == [("A", D(1980, 1, 1), "M"), ("B", None, "F"), ("C", None, None)]


def test_ingest_config_reports_observed_counts(spark, tmp_path, layers):
    schema = BRONZE["bronze_erp_px_cat_g1v2"].schema
    S.write_csv(spark.createDataFrame([("AC_BR", "Acc", "Bikes", "Yes"), ("AC_HE", "Acc", None, "No")], schema),
                str(tmp_path / "PX_CAT_G1V2.csv"))
    cfg = IngestConfig.from_dict({"base_path": str(tmp_path), "target_schema": layers["bronze"], "sources": [
        {"file_name": "PX_CAT_G1V2.csv", "table_name": "bronze_erp_px_cat_g1v2", "description": "categories"}]})
    report = S.ingest_config(spark, cfg, {"bronze_erp_px_cat_g1v2": schema})
    assert [(r.table_name, r.row_count) for r in report.collect()] == [("bronze_erp_px_cat_g1v2", 2)]
    assert spark.table(f"{layers['bronze']}.bronze_erp_px_cat_g1v2").count() == 2


def test_overwrite_keeps_ddl_comments_and_is_idempotent(spark, layers):
    spec = SILVER["silver_crm_cust_info"]
    df = spark.createDataFrame([(1, "AW1", "a", "b", "Single", "Male", D(2024, 1, 1))], spec.schema)
    name = K.write_spec_table(df, layers["silver"], spec)
    K.write_spec_table(df, layers["silver"], spec)
    assert spark.table(name).count() == 1
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    assert comments["customer_id"] == "Unique customer identifier"
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Comment") == spec.comment


def test_create_all_layer_tables_and_rename_replace(spark, layers):
    made = K.create_layer_tables(spark, layers)
    assert len(made) == 11 and all(spark.catalog.tableExists(t) for t in made)
    raw, final = f"{layers['bronze']}.raw_x", f"{layers['bronze']}.final_x"
    for _ in range(2):  # a rerun must not fail on an existing target
        spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable(raw)
        K.rename_table(spark, raw, final, replace=True)
    assert spark.table(final).count() == 1 and not spark.catalog.tableExists(raw)


def test_schema_report(spark):
    spec = SILVER["silver_crm_prd_info"]
    df = spark.createDataFrame([], spec.schema)
    rep = K.schema_report(df)
    assert rep[0] == ("product_id", "int", True, "Unique product identifier")
    assert [r[1] for r in rep] == ["int", "string", "string", "int", "string", "date", "date"]


def test_run_from_csv_end_to_end(spark, tmp_path):
    """Landing CSVs (written from the derived inputs) -> bronze -> silver -> gold equals the in-memory plan."""
    from strata.plans import layered
    from strata.plans.workspace import Workspace
    from strata.specs import IngestConfig

    ws = Workspace(spark, "/root/testdata/sf0.001")
    frames = {"cust_info.csv": ws.bronze_cust, "prd_info.csv": ws.bronze_prd, "sales_details.csv": ws.bronze_sales,
              "CUST_AZ12.csv": ws.erp_cust, "LOC_A101.csv": ws.erp_loc, "PX_CAT_G1V2.csv": ws.erp_cat}
    configs = []
    for name in ("crm_ingest.json", "erp_ingest.json"):
        cfg = IngestConfig.from_json(f"{os.path.dirname(os.path.dirname(__file__))}/configs/{name}")
        base = str(tmp_path / cfg.base_path)
        for src in cfg.sources:
            S.write_csv(frames[src.file_name], f"{base}/{src.file_name}")
        configs.append(IngestConfig(base, cfg.target_schema, cfg.sources))
    lay, audit = layered.run_from_csv(spark, configs, f"t{uuid.uuid4().hex[:8]}_")
    got = spark.table(f"{lay['gold']}.gold_customer_enriched")
    assert rows(got) == rows(ws.gold_cust)
    assert rows(spark.table(f"{lay['gold']}.gold_sales_denormalized")) == rows(ws.gold_sales)
    counts = {(r.layer, r.table_name): r.rows_written for r in audit.collect()}
    assert counts[("bronze", "bronze_crm_cust_info")] == ws.bronze_cust.count()
    assert counts[("gold", "gold_customer_enriched")] == ws.gold_cust.count()


def test_incremental_ingest_is_exactly_once_across_drops(spark, tmp_path, layers):
    from strata.streaming import ingest_incremental

    schema = BRONZE["bronze_erp_loc_a101"].schema
    land = str(tmp_path / "landing")
    table = f"{layers['bronze']}.bronze_erp_loc_a101"
    S.write_csv(spark.createDataFrame([("a", None), ("b", " x ")], schema), f"{land}/drop1")
    ck = ingest_incremental(spark, land, schema, table, checkpoint=str(tmp_path / "ck"))
    ingest_incremental(spark, land, schema, table, checkpoint=ck)          # rerun: nothing new
    assert spark.table(table).count() == 2
    S.write_csv(spark.createDataFrame([("c", "DE")], schema), f"{land}/drop2")
    ingest_incremental(spark, land, schema, table, checkpoint=ck)          # only the new drop
    assert rows(spark.table(table)) == [("a", None), ("b", " x "), ("c", "DE")]


def test_stream_and_batch_writers_share_a_table(spark, tmp_path, layers):
    from strata.streaming import ingest_incremental

    schema = BRONZE["bronze_erp_loc_a101"].schema
    land, ck = str(tmp_path / "landing"), str(tmp_path / "ck")
    table = f"{layers['bronze']}.bronze_erp_loc_a101"
    S.write_csv(spark.createDataFrame([("a", None), ("b", "DE")], schema), f"{land}/drop1")
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    counts = [spark.table(table).count()]
    spark.createDataFrame([("c", "US")], schema).write.insertInto(table)
    counts.append(spark.table(table).count())
    spark.createDataFrame([("x", "US"), ("y", "US"), ("z", None)], schema).write.insertInto(table, overwrite=True)
    counts.append(spark.table(table).count())
    S.write_csv(spark.createDataFrame([("d", "FR")], schema), f"{land}/drop2")
    ingest_incremental(spark, land, schema, table, checkpoint=ck)
    counts.append(spark.table(table).count())
    assert counts == [2, 3, 3, 4]


def test_bucketed_silver_tables_make_the_product_join_shuffle_free(spark):
    """Layered run: silver product and sales are bucketed on product_id; gold's product-master join
    then reads co-located buckets (no exchange under that join)."""
    from strata.plans import layered
    from strata.plans.gold import gold_sales
    from strata.plans.workspace import Workspace
    from conftest import plan_text

    ws = Workspace(spark, "/root/testdata/sf0.001")
    lay, _ = layered.run_layers(spark, {
        "bronze_crm_cust_info": ws.bronze_cust, "bronze_crm_prd_info": ws.bronze_prd,
        "bronze_crm_sales_details": ws.bronze_sales, "bronze_erp_cust_az12": ws.erp_cust,
        "bronze_erp_loc_a101": ws.erp_loc, "bronze_erp_px_cat_g1v2": ws.erp_cat}, f"t{uuid.uuid4().hex[:8]}_")
    s = lambda n: spark.table(f"{lay['silver']}.{n}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(s("silver_crm_sales_details").join(s("silver_crm_prd_info"), "product_id", "left"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan.split("\n\n")[0]
        assert K.table_buckets(spark, f"{lay['silver']}.silver_crm_prd_info") == int(
            spark.conf.get("spark.sql.shuffle.partitions"))
        gs = gold_sales(s("silver_crm_sales_details"), s("silver_crm_prd_info"), spark.table(f"{lay['bronze']}.bronze_erp_px_cat_g1v2"))
        assert rows(gs) == rows(ws.gold_sales)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dashboard_widgets_over_written_gold_tables(spark):
    """Production path: layered run writes gold; every dashboard tile reads the written tables
    and equals the same tile computed from the in-memory plan."""
    from strata.plans import dashboard as D
    from strata.plans import layered
    from strata.plans.workspace import Workspace

    ws = Workspace(spark, "/root/testdata/sf0.001")
    lay, _ = layered.run_layers(spark, {
        "bronze_crm_cust_info": ws.bronze_cust, "bronze_crm_prd_info": ws.bronze_prd,
        "bronze_crm_sales_details": ws.bronze_sales, "bronze_erp_cust_az12": ws.erp_cust,
        "bronze_erp_loc_a101": ws.erp_loc, "bronze_erp_px_cat_g1v2": ws.erp_cat}, f"t{uuid.uuid4().hex[:8]}_")
    sel = {"country": ["Germany", "Unknown"], "gender": ["Male", "Female"]}
    written = D.widgets(spark.table(f"{lay['gold']}.gold_customer_enriched"),
                        spark.table(f"{lay['gold']}.gold_sales_denormalized"), sel, as_of="2025-01-01")
    planned = D.widgets(ws.gold_cust, ws.gold_sales, sel, as_of="2025-01-01")
    assert set(written) == set(D.TILE_NAMES)
    for name in ("kpi_total_customers", "customers_by_gender", "filter_values_country", "products_by_category",
                 "top10_products_by_cost", "dq_checks_gold"):
        assert rows(written[name]) == rows(planned[name]), name


def test_cli_layered_and_dq(spark, tmp_path, capsys):
    """``python -m strata layered`` then ``dq`` on the same session (getOrCreate reuses it)."""
    import json as _json

    from strata.__main__ import main
    from strata.plans.workspace import Workspace

    ws = Workspace(spark, "/root/testdata/sf0.001")
    root = tmp_path / "landing"
    frames = {"cust_info.csv": ws.bronze_cust, "prd_info.csv": ws.bronze_prd, "sales_details.csv": ws.bronze_sales,
              "CUST_AZ12.csv": ws.erp_cust, "LOC_A101.csv": ws.erp_loc, "PX_CAT_G1V2.csv": ws.erp_cat}
    cfg_dir = os.path.join(os.path.dirname(os.path.dirname(__file__)), "configs")
    for name in ("crm_ingest.json", "erp_ingest.json"):
        cfg = IngestConfig.from_json(f"{cfg_dir}/{name}")
        for src in cfg.sources:
            S.write_csv(frames[src.file_name], str(root / cfg.base_path / src.file_name))
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    assert main(["layered", "--config", f"{cfg_dir}/crm_ingest.json", "--config", f"{cfg_dir}/erp_ingest.json",
                 "--landing-root", str(root), "--prefix", prefix, "--parallel", "3"]) == 0
    out = [_json.loads(line) for line in capsys.readouterr().out.splitlines()]
    written = {o["table_name"]: o["rows_written"] for o in out if "table_name" in o}
    assert written["gold_customer_enriched"] == ws.gold_cust.count()
    code = main(["dq", "--gold-schema", f"{prefix}gold", "--as-of", "2025-01-01"])
    checks = [_json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert len(checks) == 11 and code in (0, 2)
    assert code == (2 if any(c["status"] == "FAIL" for c in checks) else 0)


def test_list_and_use_schema(spark, layers):
    assert {layers["bronze"], layers["silver"], layers["gold"]} <= set(K.list_schemas(spark))
    before = spark.catalog.currentDatabase()
    try:
        K.use_schema(spark, layers["silver"])
        assert spark.catalog.currentDatabase() == layers["silver"]
    finally:
        K.use_schema(spark, before)
    comments = {r[0]: r[1] for r in spark.sql(f"DESCRIBE SCHEMA EXTENDED {layers['gold']}").collect()}
    assert comments.get("Comment") == "Gold layer: Denormalized, enriched, analytics-ready tables"


def test_ingest_config_parallel_matches_sequential(spark, tmp_path):
    from strata.plans.workspace import Workspace

    ws = Workspace(spark, "/root/testdata/sf0.001")
    files = {"bronze_erp_cust_az12": ("CUST_AZ12.csv", ws.erp_cust), "bronze_erp_loc_a101": ("LOC_A101.csv", ws.erp_loc),
             "bronze_erp_px_cat_g1v2": ("PX_CAT_G1V2.csv", ws.erp_cat)}
    for t, (f, df) in files.items():
        S.write_csv(df, str(tmp_path / f))
    reports = []
    for par in (1, 3):
        lay = K.ensure_layers(spark, f"t{uuid.uuid4().hex[:8]}_")
        cfg = IngestConfig(str(tmp_path), lay["bronze"], tuple(IngestSource(f, t) for t, (f, _) in files.items()))
        rep = S.ingest_config(spark, cfg, {t: BRONZE[t].schema for t in files}, parallel=par)
        reports.append([(r.table_name, r.row_count, r.corrupt_rows) for r in rep.collect()])
        for t in files:
            assert rows(spark.table(f"{lay['bronze']}.{t}")) == rows(files[t][1])
    assert reports[0] == reports[1]


def test_layered_parallel_writes_match_sequential(spark):
    from strata.plans import layered
    from strata.plans.workspace import Workspace

    ws = Workspace(spark, "/root/testdata/sf0.001")
    inputs = {"bronze_crm_cust_info": ws.bronze_cust, "bronze_crm_prd_info": ws.bronze_prd,
              "bronze_crm_sales_details": ws.bronze_sales, "bronze_erp_cust_az12": ws.erp_cust,
              "bronze_erp_loc_a101": ws.erp_loc, "bronze_erp_px_cat_g1v2": ws.erp_cat}
    lay, audit = layered.run_layers(spark, inputs, f"t{uuid.uuid4().hex[:8]}_", parallel=3)
    assert rows(spark.table(f"{lay['gold']}.gold_customer_enriched")) == rows(ws.gold_cust)
    assert rows(spark.table(f"{lay['gold']}.gold_sales_denormalized")) == rows(ws.gold_sales)
    assert len(audit.collect()) == 11


def test_reordered_source_columns_fail_instead_of_shifting_values(spark, tmp_path):
    p = tmp_path / "swapped.csv"
    p.write_text("CID,GEN,BDATE\nA,M,1980-01-01\n")
    with pytest.raises(Exception):
        S.read_csv(spark, str(p), BRONZE["bronze_erp_cust_az12"].schema).collect()
