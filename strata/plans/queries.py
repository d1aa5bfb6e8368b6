"""Registry of every query / operator key: ``name -> fn(Workspace) -> DataFrame``.

Each key is one operator (or pipeline) of the inventory applied to the derived
bronze inputs or to the driver tables; the matching DuckDB SQL lives in
``sql_oracles.py`` under the same key.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import segment_key
from ..operators import audit as A
from ..operators import clean as C
from ..operators import enrich as J
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import sketches as Z
from ..operators.dq import THRESHOLDS, judged_history
from ..schemas import BRONZE, GOLD, SILVER
from ..session import scratch_path
from ..sources import catalog as K
from ..sources import csv as S
from ..sources.fixtures import BRONZE_OF
from ..sources.publish import publish_table
from ..sources.verify import write_verified
from ..specs import IngestConfig, IngestSource
from . import cube as Q
from . import dashboard as D
from . import gold as G
from . import layered, verification
from .silver import CUSTOMER, CUSTOMER_RENAMES, LINEITEM, PRODUCT, PRODUCT_RENAMES, SALES
from .workspace import Workspace

QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}

# Parameters of the registered queries (the oracle SQL uses the same literals).
AS_OF = "2025-01-01"                       # "today" for future-date checks; current_date() would rot
COUNTRY_SELECTION = ["United States", "Germany", "Unknown"]
GENDER_SELECTION = ["Female"]


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _q(name: str, fn: Callable[[Workspace], DataFrame]) -> None:
    QUERIES[name] = fn


# ---------------------------------------------------------------- helpers
def _cust_trim(ws: Workspace) -> DataFrame:
    return C.trim_strings(ws.bronze_cust)


def _prd_trim(ws: Workspace) -> DataFrame:
    return C.trim_strings(ws.bronze_prd)


def _cust_dedup_keep_null(ws: Workspace) -> DataFrame:
    return C.dedupe_latest(_cust_trim(ws), CUSTOMER.key, CUSTOMER.order_col, keep_null_keys=True)


def _prd_dedup(ws: Workspace) -> DataFrame:
    return C.dedupe_latest(_prd_trim(ws), PRODUCT.key, PRODUCT.order_col)


def _cust_filled(ws: Workspace) -> DataFrame:
    return C.fill_nulls(C.drop_null_key(_cust_dedup_keep_null(ws), CUSTOMER.key), dict(CUSTOMER.fills))


# ---------------------------------------------------------------- profiling
_q("profile_customer", lambda ws: P.profile(ws.bronze_cust))
_q("profile_product", lambda ws: P.profile(ws.bronze_prd))
_q("profile_sales", lambda ws: P.profile(ws.bronze_sales))
_q("profile_long_customer", lambda ws: P.profile_long(ws.bronze_cust))
_q("dup_check_customer", lambda ws: P.duplicate_check(
    ws.bronze_cust, {"cst_id duplicates": "cst_id", "cst_key duplicates": "cst_key"}))
_q("dup_check_product", lambda ws: P.duplicate_check(
    ws.bronze_prd, {"prd_id duplicates": "prd_id", "prd_key duplicates": "prd_key"}))
_q("dup_check_lineitem", lambda ws: P.duplicate_check(
    ws.lineitem, {"l_orderkey, l_linenumber duplicates": list(LINEITEM.key)}))
_q("category_dist_customer", lambda ws: P.category_distribution(ws.bronze_cust, list(CUSTOMER.categorical)))
_q("category_dist_product", lambda ws: P.category_distribution(ws.bronze_prd, list(PRODUCT.categorical)))
_q("date_range_customer", lambda ws: P.date_profile(ws.bronze_cust, "cst_create_date", as_of=AS_OF))
_q("date_range_product", lambda ws: P.date_profile(ws.bronze_prd, "prd_start_dt", as_of=AS_OF, end_col="prd_end_dt"))
_q("end_before_start_rows", lambda ws: C.date_order_violations(ws.bronze_prd, "prd_start_dt", "prd_end_dt", order_by="prd_id"))
_q("rows_with_whitespace", lambda ws: C.rows_with_whitespace(ws.bronze_cust).select(
    "cst_id", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"))
_q("verify_no_whitespace", lambda ws: P.whitespace_rows_count(_cust_trim(ws)))
_q("duplicate_rows_customer", lambda ws: P.duplicate_rows(_cust_trim(ws), "cst_id", ["cst_id", "cst_create_date"]))
_q("duplicate_rows_product", lambda ws: P.duplicate_rows(_prd_trim(ws), "prd_id", ["prd_id", "prd_start_dt"]))
_q("dup_summary", lambda ws: P.dup_summary(_cust_trim(ws), "cst_id"))
_q("duplicate_column_diff", lambda ws: P.duplicate_column_diff(_cust_trim(ws), "cst_id"))
_q("null_summary", lambda ws: P.null_summary(_cust_dedup_keep_null(ws)))
_q("null_summary_silver_product", lambda ws: P.null_summary(ws.silver_prd))
_q("verify_no_dups", lambda ws: P.duplicate_check(ws.silver_cust, {"customer_id duplicates": "customer_id"}))
_q("schema_report", lambda ws: P.schema_profile(ws.silver_cust))
# the same operators on the driver's fact table (composite key, timestamps, 600 000 rows at sf0.1)
_q("profile_lineitem", lambda ws: P.profile(ws.lineitem))
_q("category_dist_lineitem", lambda ws: P.category_distribution(ws.lineitem, list(LINEITEM.categorical)))
_q("date_range_lineitem", lambda ws: P.date_profile(ws.lineitem, "l_shipdate", as_of=AS_OF))
_q("duplicate_rows_lineitem", lambda ws: P.duplicate_rows(ws.lineitem, list(LINEITEM.key)))
_LINEITEM_TYPES = {"ship_date": "date", "l_quantity": "double", "l_extendedprice": "double", "l_partkey": "bigint"}


@query("profile_merged_lineitem")
def _profile_merged_lineitem(ws: Workspace) -> DataFrame:
    """The fact table's profile merged from written per-month sketches, with the distinct estimate against the exact count."""
    cols = [*_LINEITEM_TYPES, "l_returnflag"]
    lines = ws.lineitem.withColumn("ship_date", F.col("l_shipdate").cast("date"))
    path = scratch_path(ws.spark, "profiles")
    Z.partition_profile(lines, F.trunc("ship_date", "month"), cols).write.parquet(path)
    merged = Z.merged_profile(ws.spark.read.parquet(path), _LINEITEM_TYPES)
    exact = lines.agg(*(F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)))
    stack = ", ".join(f"'{c}', d{i}" for i, c in enumerate(cols))
    known = exact.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, distinct_values)")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.greatest(F.lit(1.0), F.col("distinct_values") * Z.DISTINCT_ERROR)
    return merged.join(known, "column_name").select("column_name", "row_count", "nulls", "min_value", "max_value", "distinct_values", near.alias("estimate_within_bound"))


_q("top_values_lineitem", lambda ws: Z.top_values(ws.lineitem, ["l_returnflag", "l_linestatus", "l_quantity", "l_linenumber"], 50))
_q("sample_customer", lambda ws: ws.bronze_cust.orderBy(
    *[F.col(c).asc_nulls_last() for c in ws.bronze_cust.columns]).limit(20))

# ---------------------------------------------------------------- cleaning
_q("trim_strings", _cust_trim)
_q("null_count_score", lambda ws: C.with_null_count(_cust_trim(ws), [c for c in ws.bronze_cust.columns if c != "cst_id"]))
_q("dedupe_customer", lambda ws: C.dedupe_latest(_cust_trim(ws), CUSTOMER.key, CUSTOMER.order_col))
_q("dedupe_keep_null_keys", _cust_dedup_keep_null)
_q("dedupe_product", _prd_dedup)
_q("dedupe_sales", lambda ws: C.dedupe_latest(C.trim_strings(ws.bronze_sales), SALES.key, SALES.order_col))
_q("dedupe_lineitem", lambda ws: C.dedupe_latest(ws.lineitem, LINEITEM.key, LINEITEM.order_col))
_q("silver_lineitem", lambda ws: C.clean_entity(ws.lineitem, LINEITEM))   # the whole silver step, fact-table spec
_q("null_key_rows", lambda ws: C.null_key_rows(_cust_trim(ws), CUSTOMER.key))
_q("null_rows_by_column", lambda ws: _cust_dedup_keep_null(ws).where(F.col("cst_lastname").isNull()))
_q("null_overlap", lambda ws: _cust_dedup_keep_null(ws).where(
    F.col("cst_id").isNull() & F.col("cst_create_date").isNull()))
_q("drop_null_key", lambda ws: C.drop_null_key(_cust_dedup_keep_null(ws), CUSTOMER.key))
_q("fill_gender", _cust_filled)
_q("fill_product", lambda ws: C.fill_nulls(_prd_dedup(ws), dict(PRODUCT.fills)))
_q("std_marital", lambda ws: C.recode(_cust_filled(ws), {"cst_marital_status": dict(CUSTOMER.recodes)["cst_marital_status"]}))
_q("std_gender", lambda ws: C.recode(_cust_filled(ws), {"cst_gndr": dict(CUSTOMER.recodes)["cst_gndr"]}))
_q("std_product_line", lambda ws: C.recode(C.fill_nulls(_prd_dedup(ws), dict(PRODUCT.fills)), dict(PRODUCT.recodes)))
_q("rename_customer", lambda ws: C.rename(ws.bronze_cust, dict(CUSTOMER_RENAMES)))
_q("rename_product", lambda ws: C.rename(ws.bronze_prd, dict(PRODUCT_RENAMES)))


@query("dedupe_audit")
def _dedupe_audit(ws: Workspace) -> DataFrame:
    """Rows before / after / removed by the customer dedupe (NULL keys kept), counted on its input and its output within one run."""
    counts = A.StepCounts()
    came = counts.through(_cust_trim(ws), "dedupe_in")
    A.run_to_end(counts.through(C.dedupe_latest(came, CUSTOMER.key, CUSTOMER.order_col, keep_null_keys=True), "dedupe_out"))
    before, after = counts.of("dedupe_in"), counts.of("dedupe_out")
    return ws.spark.createDataFrame([(before, after, before - after)], "rows_before bigint, rows_after bigint, rows_removed bigint")


@query("pipeline_audit")
def _pipeline_audit(ws: Workspace) -> DataFrame:
    """Per entity: rows in, duplicates removed, NULL-key rows dropped, rows out, observed within one run of the three cleanings."""
    audit = A.cleaning_audit([(CUSTOMER, ws.bronze_cust), (PRODUCT, ws.bronze_prd), (SALES, ws.bronze_sales)])
    return ws.spark.createDataFrame(audit, "entity string, rows_in bigint, duplicates_removed bigint, null_keys_dropped bigint, rows_out bigint")


# ---------------------------------------------------------------- silver pipelines
_q("silver_customer", lambda ws: ws.silver_cust)
_q("silver_product", lambda ws: ws.silver_prd)
_q("silver_sales", lambda ws: ws.silver_sls)

# ---------------------------------------------------------------- ERP cleaning and joins
_q("erp_cust_clean", lambda ws: G.erp_cust_clean(ws.erp_cust))
_q("erp_loc_clean", lambda ws: G.erp_loc_clean(ws.erp_loc))
_q("erp_cat_clean", lambda ws: G.erp_cat_clean(ws.erp_cat))
_q("std_country", lambda ws: G.std_country(G.erp_loc_clean(ws.erp_loc)))
_q("std_erp_gender", lambda ws: G.std_erp_gender(G.erp_cust_clean(ws.erp_cust)))
_q("join_erp_customer", lambda ws: G.join_erp_customer(ws.silver_cust, ws.erp_cust))
_q("join_erp_location", lambda ws: G.join_erp_location(ws.silver_cust, ws.erp_loc))
_q("unmatched_erp_customers", lambda ws: J.unmatched(
    ws.silver_cust, G.erp_cust_clean(ws.erp_cust), "erp_cust_cid",
    left_key=G.derived_key(G.CUST_KEY_PREFIX, "customer_key", G.CUST_KEY_FROM)))


@query("join_product_master")
def _join_product_master(ws: Workspace) -> DataFrame:
    sls, prd = ws.silver_sls.alias("sls"), ws.silver_prd.alias("prd")
    j = sls.join(prd, on="product_id", how="left")
    return j.select("product_id", *[F.col(f"sls.{c}").alias(c) for c in ws.silver_sls.columns if c != "product_id"],
                    *[F.col(f"prd.{c}").alias(f"master_{c}") for c in ws.silver_prd.columns if c != "product_id"])


@query("join_category")
def _join_category(ws: Workspace) -> DataFrame:
    return J.enrich(ws.silver_sls, G.erp_cat_clean(ws.erp_cat), "category_id",
                    left_key=segment_key("product_key"), spread_null_keys=False)


@query("gender_fallback")
def _gender_fallback(ws: Workspace) -> DataFrame:
    j = G.std_erp_gender(G.join_erp_customer(ws.silver_cust, ws.erp_cust))
    j = j.withColumn("crm_gender", F.col("gender"))
    return J.fallback(j, "gender", "erp_gender_clean").select("customer_id", "crm_gender", "erp_gender_clean", "gender")


# ---------------------------------------------------------------- gold
_q("gold_customer_enriched", lambda ws: ws.gold_cust)
_q("gold_sales_denormalized", lambda ws: ws.gold_sales)
_q("coverage_customer", lambda ws: J.coverage(ws.gold_cust, ["country", "birth_date"]))
_q("coverage_category", lambda ws: J.coverage(ws.gold_sales, ["category"]))
_q("dist_gold_country", lambda ws: P.value_counts(ws.gold_cust, "country"))
_q("dist_gold_gender", lambda ws: P.value_counts(ws.gold_cust, "gender"))
_q("dist_gold_line", lambda ws: P.value_counts(ws.gold_sales, "product_line"))
_q("dist_gold_category", lambda ws: P.value_counts(ws.gold_sales, "category"))


@query("gold_verification")
def _gold_verification(ws: Workspace) -> DataFrame:
    c = ws.gold_cust.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("gold_customer_enriched").alias("table_name"), "row_count")
    s = ws.gold_sales.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("gold_sales_denormalized").alias("table_name"), "row_count")
    return c.unionByName(s)


@query("coverage_known")
def _coverage_known(ws: Workspace) -> DataFrame:
    """Enrichment coverage with the rows whose value is known: the standardised country is never NULL, so its plain coverage says nothing."""
    return J.known_coverage(ws.gold_cust, {"country": "Unknown", "gender": "Unknown", "birth_date": None})


# ---------------------------------------------------------------- dashboard
def _cust(ws: Workspace) -> DataFrame:
    return D.gold_customers_dataset(ws.gold_cust)


def _prod(ws: Workspace) -> DataFrame:
    return D.gold_products_dataset(ws.gold_sales)


_q("ds_gold_customers", _cust)
_q("ds_gold_products", _prod)
_SELECTION = {"country": COUNTRY_SELECTION, "gender": GENDER_SELECTION}


def _widget(name: str, selections: dict | None = None) -> Callable[[Workspace], DataFrame]:
    return lambda ws: D.widget(name, lambda: ws.gold_cust, lambda: ws.gold_sales, selections)


for _name in ("kpi_total_customers", "kpi_total_products", "kpi_product_categories", "kpi_countries_covered",
              "kpi_average_cost", "customers_by_country", "customers_by_gender", "customers_by_marital",
              "products_by_category", "products_by_line", "products_by_subcategory", "products_by_maintenance",
              "customer_detail", "product_detail", "top10_products_by_cost"):
    _q(_name, _widget(_name))
_q("customers_filtered", _widget("customer_detail", _SELECTION))
_q("filter_values_country", _widget("filter_values_country", _SELECTION))
_q("filter_values_gender", _widget("filter_values_gender", _SELECTION))
@query("dq_history_gold")
def _dq_history_gold(ws: Workspace) -> DataFrame:
    """The day's metrics of the gold tables under the thresholds valid that day: one that has ended and one yet to begin play no part."""
    day = dt.date.fromisoformat(AS_OF)
    rows = D.default_thresholds(dt.date(2024, 1, 1))
    rows += [("gold_customer_enriched", "country_known", "country_unknown_pct", 0.0, 0.0, dt.date(2020, 1, 1), dt.date(2024, 1, 1)),
             ("gold_customer_enriched", "country_known", "country_unknown_pct", 100.0, 100.0, day + dt.timedelta(1), None)]
    return judged_history(D.gold_metrics(ws.gold_cust, ws.gold_sales, AS_OF), ws.spark.createDataFrame(rows, THRESHOLDS))


_q("dq_checks_gold", lambda ws: D.dq_checks_gold(ws.gold_cust, ws.gold_sales, AS_OF))


# ---------------------------------------------------------------- sources, sinks, catalog
# These keys write to the session's shared folders (checkpoint dir for landing
# files, warehouse for tables) under names unique per call, then read back.


def _prefix() -> str:
    return f"strata_{uuid.uuid4().hex[:10]}_"


def _fixture_frames(ws: Workspace) -> dict[str, DataFrame]:
    return {BRONZE_OF[n]: getattr(ws, a) for n, a in (
        ("fx_cust_info", "bronze_cust"), ("fx_prd_info", "bronze_prd"), ("fx_sales_details", "bronze_sales"),
        ("fx_erp_cust", "erp_cust"), ("fx_erp_loc", "erp_loc"), ("fx_px_cat", "erp_cat"))}


@query("ingest_csv")
def _ingest_csv(ws: Workspace) -> DataFrame:
    """Land the CRM customer file as CSV, read it back with the bronze schema (NULL, '' and padding survive)."""
    path = scratch_path(ws.spark, "landing", "crm", "cust_info.csv")
    S.write_csv(ws.bronze_cust, path)
    return S.read_csv(ws.spark, path, BRONZE["bronze_crm_cust_info"].schema)


@query("ingest_config")
def _ingest_config(ws: Workspace) -> DataFrame:
    """Config-driven ERP ingest: three landed CSVs -> three bronze tables; report of observed row counts."""
    base = scratch_path(ws.spark, "landing", "erp")
    files = {"bronze_erp_cust_az12": ("CUST_AZ12.csv", ws.erp_cust), "bronze_erp_loc_a101": ("LOC_A101.csv", ws.erp_loc),
             "bronze_erp_px_cat_g1v2": ("PX_CAT_G1V2.csv", ws.erp_cat)}
    for table, (fname, df) in files.items():
        S.write_csv(df, f"{base}/{fname}")
    layers = K.ensure_layers(ws.spark, _prefix())
    cfg = IngestConfig(base, layers["bronze"], tuple(IngestSource(f, t, BRONZE[t].comment) for t, (f, _) in files.items()))
    report = S.ingest_config(ws.spark, cfg, {t: BRONZE[t].schema for t in files})
    return report.select("table_name", "row_count")


@query("ingest_config_crm")
def _ingest_config_crm(ws: Workspace) -> DataFrame:
    """Config-driven CRM ingest: three landed CSVs -> three bronze tables; report of observed row counts."""
    base = scratch_path(ws.spark, "landing", "crm")
    files = {"bronze_crm_cust_info": ("cust_info.csv", ws.bronze_cust), "bronze_crm_prd_info": ("prd_info.csv", ws.bronze_prd),
             "bronze_crm_sales_details": ("sales_details.csv", ws.bronze_sales)}
    for fname, df in files.values():
        S.write_csv(df, f"{base}/{fname}")
    layers = K.ensure_layers(ws.spark, _prefix())
    cfg = IngestConfig(base, layers["bronze"], tuple(IngestSource(f, t, BRONZE[t].comment) for t, (f, _) in files.items()))
    return S.ingest_config(ws.spark, cfg, {t: BRONZE[t].schema for t in files}).select("table_name", "row_count", "corrupt_rows")


@query("ingest_quarantine")
def _ingest_quarantine(ws: Workspace) -> DataFrame:
    """A CRM file in which some dates do not parse: the other rows are loaded, those lines are quarantined with their file."""
    spec = BRONZE["bronze_crm_cust_info"]
    path = scratch_path(ws.spark, "landing", "crm", "cust_info.csv")
    text = ws.bronze_cust.select(*(F.col(c).cast("string").alias(c) for c in spec.schema.fieldNames()))
    S.write_csv(text.withColumn("cst_create_date", F.when(F.col("cst_id").cast("int") % 10 == 3, "n/a").otherwise(F.col("cst_create_date"))), path)
    layers = K.ensure_layers(ws.spark, _prefix())
    table, bad = K.qualified(layers["bronze"], spec.name), K.qualified(layers["bronze"], "quarantine")
    S.ingest_quarantined(ws.spark, path, spec.schema, table, bad, table_comment=spec.comment)
    loaded = ws.spark.table(table).select(F.lit("loaded").alias("kind"), F.col("cst_id"))
    lines = ws.spark.table(bad).where(F.col("source_file").contains("cust_info.csv")).select(F.lit("quarantined").alias("kind"), F.split("line", ",")[0].cast("int").alias("cst_id"))
    return loaded.unionByName(lines)


@query("create_tables_catalog")
def _create_tables_catalog(ws: Workspace) -> DataFrame:
    """Create the three layer schemas and all eleven typed tables, load the six bronze inputs;
    report rows written per bronze table (observed during the writes)."""
    layers = K.ensure_layers(ws.spark, _prefix())
    K.create_layer_tables(ws.spark, layers)
    audit: list = []
    layered.load_bronze(ws.spark, _fixture_frames(ws), layers, audit)
    return ws.spark.createDataFrame([(t, n) for _, t, n in audit], "table_name string, row_count bigint")


@query("write_overwrite_roundtrip")
def _write_overwrite_roundtrip(ws: Workspace) -> DataFrame:
    """Overwrite the silver customer table twice (idempotent) and read it back."""
    layers = K.ensure_layers(ws.spark, _prefix())
    spec = SILVER["silver_crm_cust_info"]
    name = K.write_spec_table(ws.silver_cust, layers["silver"], spec)
    K.write_spec_table(ws.silver_cust, layers["silver"], spec)
    return ws.spark.table(name)


def _written_gold(ws: Workspace) -> tuple[dict[str, DataFrame], DataFrame]:
    """The gold tables as written, and the report of their verified writes."""
    layers = K.ensure_layers(ws.spark, _prefix())
    report = None
    for name, df in (("gold_customer_enriched", ws.gold_cust), ("gold_sales_denormalized", ws.gold_sales)):
        one = write_verified(df, name, spec=GOLD[name], schema_name=layers["gold"])
        report = one if report is None else report.unionByName(one)
    return {n: ws.spark.table(K.qualified(layers["gold"], n)) for n in GOLD}, report


@query("write_verification")
def _write_verification(ws: Workspace) -> DataFrame:
    """Every silver and gold table written, read back and compared by rows, content digest and schema."""
    layers = K.ensure_layers(ws.spark, _prefix())
    report = _written_gold(ws)[1]
    for name, df in (("silver_crm_cust_info", ws.silver_cust), ("silver_crm_prd_info", ws.silver_prd), ("silver_crm_sales_details", ws.silver_sls)):
        report = report.unionByName(write_verified(df, name, spec=SILVER[name], schema_name=layers["silver"]))
    return report


@query("gold_verification_report")
def _gold_verification_report(ws: Workspace) -> DataFrame:
    """Schema, row count and distributions of both written gold tables, one scan each."""
    gold, _ = _written_gold(ws)
    return verification.gold_report(gold["gold_customer_enriched"], gold["gold_sales_denormalized"])


_q("cube_customers", lambda ws: Q.customer_cube(D.gold_customers_dataset(ws.gold_cust)))
_q("cube_products", lambda ws: Q.product_cube(D.gold_products_dataset(ws.gold_sales)))


@query("cube_tiles_filtered")
def _cube_tiles_filtered(ws: Workspace) -> DataFrame:
    """Every tile under the filter selection, answered from the written cubes."""
    layers = K.ensure_layers(ws.spark, _prefix())
    names = [K.qualified(layers["gold"], n) for n in ("cube_customers", "cube_products")]
    for name, df in zip(names, (QUERIES["cube_customers"](ws), QUERIES["cube_products"](ws))):
        K.write_table(df, name, comment="Dashboard measures of every subset of the dimensions")
    return Q.tiles_long(*(ws.spark.table(n) for n in names), _SELECTION)


@query("publish_roundtrip")
def _publish_roundtrip(ws: Workspace) -> DataFrame:
    """Publish a few customers, then all of them in their place; the table reads the second version."""
    layers = K.ensure_layers(ws.spark, _prefix())
    name = K.qualified(layers["silver"], "silver_crm_cust_info")
    publish_table(ws.silver_cust.limit(3), name)
    publish_table(ws.silver_cust, name)
    return ws.spark.table(name)


@query("rename_table_roundtrip")
def _rename_table_roundtrip(ws: Workspace) -> DataFrame:
    """Write under a raw name, rename to the layer convention (replace-safe), read back."""
    layers = K.ensure_layers(ws.spark, _prefix())
    raw = K.qualified(layers["bronze"], "cust_info")
    final = K.qualified(layers["bronze"], "bronze_crm_cust_info")
    ws.bronze_cust.write.mode("overwrite").saveAsTable(raw)
    K.rename_table(ws.spark, raw, final, replace=True)
    return ws.spark.table(final)


@query("ingest_stream")
def _ingest_stream(ws: Workspace) -> DataFrame:
    """Incremental (streaming, availableNow) ingest of a landed CSV drop; a second run adds nothing."""
    from ..streaming import ingest_incremental

    land = scratch_path(ws.spark, "landing", "stream", "crm_cust")
    S.write_csv(ws.bronze_cust, f"{land}/drop_0001")
    layers = K.ensure_layers(ws.spark, _prefix())
    table = K.qualified(layers["bronze"], "bronze_crm_cust_info")
    spec = BRONZE["bronze_crm_cust_info"]
    ck = scratch_path(ws.spark, "stream-checkpoints")
    ingest_incremental(ws.spark, land, spec.schema, table, checkpoint=ck, table_comment=spec.comment)
    ingest_incremental(ws.spark, land, spec.schema, table, checkpoint=ck)
    return ws.spark.table(table)


@query("layered_pipeline")
def _layered_pipeline(ws: Workspace) -> DataFrame:
    """Full bronze -> silver -> gold run through written tables; returns the gold customer table."""
    layers, _audit = layered.run_layers(ws.spark, _fixture_frames(ws), _prefix())
    return ws.spark.table(K.qualified(layers["gold"], "gold_customer_enriched"))


@query("layered_pipeline_audit")
def _layered_pipeline_audit(ws: Workspace) -> DataFrame:
    """Rows written per table by a full layered run (from ``observe`` metrics of the writes)."""
    _layers, audit = layered.run_layers(ws.spark, _fixture_frames(ws), _prefix())
    return audit
