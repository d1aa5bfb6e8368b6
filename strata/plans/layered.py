"""End-to-end layered run: bronze tables -> silver tables -> gold tables.

Each table is one write job.  Silver and gold read the *written* tables of the
previous layer, which cuts the lineage at every layer boundary (a lost executor
re-reads a table instead of recomputing the whole chain).  Row counts for the
audit are collected with ``observe`` during the writes: no extra count jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, GOLD, SILVER
from ..sources.catalog import ensure_layers, qualified, write_spec_table
from ..sources.csv import ingest_config
from ..session import observed
from ..specs import IngestConfig
from . import gold, silver

BRONZE_INPUTS = ["bronze_crm_cust_info", "bronze_crm_prd_info", "bronze_crm_sales_details",
                 "bronze_erp_cust_az12", "bronze_erp_loc_a101", "bronze_erp_px_cat_g1v2"]


def _write(df: DataFrame, schema_name: str, spec, audit: list) -> str:
    obs = Observation(f"w_{schema_name}_{spec.name}")
    name = write_spec_table(df, schema_name, spec, observe=(obs, [F.count(F.lit(1)).alias("rows")]))
    audit.append((spec.layer, spec.name, int(observed(obs).get("rows", 0))))
    return name


def load_bronze(spark: SparkSession, inputs: dict[str, DataFrame], layers: dict[str, str], audit: list,
                parallel: int = 1) -> None:
    _run_all([(lambda n=name: _write(inputs[n], layers["bronze"], BRONZE[n], audit)) for name in BRONZE_INPUTS],
             parallel)


def _run_all(tasks, parallel: int) -> None:
    """Run independent table writes, optionally as concurrent Spark jobs from driver threads."""
    if parallel > 1 and len(tasks) > 1:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for f in [pool.submit(t) for t in tasks]:
                f.result()
    else:
        for t in tasks:
            t()


def run_silver(spark: SparkSession, layers: dict[str, str], audit: list, parallel: int = 1) -> None:
    b = lambda n: spark.table(qualified(layers["bronze"], n))
    w = lambda build, src, dst: lambda: _write(build(b(src)), layers["silver"], SILVER[dst], audit)
    _run_all([w(silver.silver_customer, "bronze_crm_cust_info", "silver_crm_cust_info"),
              w(silver.silver_product, "bronze_crm_prd_info", "silver_crm_prd_info"),
              w(silver.silver_sales, "bronze_crm_sales_details", "silver_crm_sales_details")], parallel)


def run_gold(spark: SparkSession, layers: dict[str, str], audit: list,
             parallel: int = 1) -> None:
    b = lambda n: spark.table(qualified(layers["bronze"], n))
    s = lambda n: spark.table(qualified(layers["silver"], n))

    def customer():
        gc = gold.gold_customer(s("silver_crm_cust_info"), b("bronze_erp_cust_az12"), b("bronze_erp_loc_a101"))
        _write(gc, layers["gold"], GOLD["gold_customer_enriched"], audit)

    def sales():
        gs = gold.gold_sales(s("silver_crm_sales_details"), s("silver_crm_prd_info"), b("bronze_erp_px_cat_g1v2"))
        _write(gs, layers["gold"], GOLD["gold_sales_denormalized"], audit)

    _run_all([customer, sales], parallel)


def run_layers(spark: SparkSession, inputs: dict[str, DataFrame], prefix: str = "",
               parallel: int = 1) -> tuple[dict[str, str], DataFrame]:
    """Run bronze -> silver -> gold; returns the schema names and an audit DataFrame
    (layer, table_name, rows_written).  ``parallel`` writes the independent tables of a
    layer as concurrent jobs."""
    layers = ensure_layers(spark, prefix)
    audit: list = []
    load_bronze(spark, inputs, layers, audit, parallel=parallel)
    run_silver(spark, layers, audit, parallel=parallel)
    run_gold(spark, layers, audit, parallel=parallel)
    return layers, spark.createDataFrame(audit, "layer string, table_name string, rows_written bigint")


def run_from_csv(spark: SparkSession, configs: list[IngestConfig], prefix: str = "",
                 parallel: int = 1) -> tuple[dict[str, str], DataFrame]:
    """Landing CSVs -> bronze (config-driven) -> silver -> gold.  Each config's ``target_schema``
    is replaced by this run's bronze schema; returns schema names and the ingest + write audit."""
    layers = ensure_layers(spark, prefix)
    audit: list = []
    for cfg in configs:
        cfg = IngestConfig(cfg.base_path, layers["bronze"], cfg.sources)
        schemas = {src.table_name: BRONZE[src.table_name].schema for src in cfg.sources}
        comments = {src.table_name: BRONZE[src.table_name].comment for src in cfg.sources}
        for r in ingest_config(spark, cfg, schemas, comments, parallel=parallel).collect():  # one row per source
            audit.append(("bronze", r.table_name, r.row_count))
    run_silver(spark, layers, audit, parallel=parallel)
    run_gold(spark, layers, audit, parallel=parallel)
    return layers, spark.createDataFrame(audit, "layer string, table_name string, rows_written bigint")
