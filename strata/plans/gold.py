"""Gold layer: ERP cleaning, derived-key enrichment and the two denormalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import derived_key, recode_expr, segment_key
from ..operators.enrich import enrich, fallback
from ..operators.skew import Lookup, enrich_chain
from ..specs import recode

# ---- fixed values: enrichment rules of the layered sales model ----
CUST_KEY_PREFIX, CUST_KEY_FROM = "NASA", 2     # 'NASA' || substring(customer_key, 2)
LOC_KEY_PREFIX, LOC_KEY_FROM = "AW-", 3        # 'AW-'  || substring(customer_key, 3)
COUNTRY_RULE = recode({"United States": ["USA", "US"], "Germany": ["DE"]},
                      null_default="Unknown", blank_default="Unknown", otherwise="trim")
ERP_GENDER_RULE = recode({"Male": ["M"], "Female": ["F"]},
                         handle_null=True, handle_blank=True, otherwise="trim")
GOLD_CUSTOMER_COLUMNS = ["customer_id", "customer_key", "first_name", "last_name", "marital_status",
                         "gender", "birth_date", "country", "created_date"]
# ---- end of fixed values ----


def erp_cust_clean(df: DataFrame) -> DataFrame:
    return df.selectExpr("trim(CID) AS erp_cust_cid", "BDATE AS birth_date", "trim(GEN) AS erp_gender")


def erp_loc_clean(df: DataFrame) -> DataFrame:
    return df.selectExpr("trim(CID) AS erp_loc_cid", "trim(CNTRY) AS country")


def erp_cat_clean(df: DataFrame) -> DataFrame:
    return df.selectExpr("trim(ID) AS category_id", "trim(CAT) AS category", "trim(SUBCAT) AS subcategory",
                         "trim(MAINTENANCE) AS maintenance_required")


def std_country(df: DataFrame, col: str = "country") -> DataFrame:
    return df.withColumn(col, recode_expr(col, COUNTRY_RULE))


def std_erp_gender(df: DataFrame, col: str = "erp_gender", out: str = "erp_gender_clean") -> DataFrame:
    return df.withColumn(out, recode_expr(col, ERP_GENDER_RULE))


def erp_customer_lookup(erp_cust: DataFrame, on_duplicate: str = "fanout") -> Lookup:
    return Lookup(erp_cust_clean(erp_cust), "erp_cust_cid", derived_key(CUST_KEY_PREFIX, "customer_key", CUST_KEY_FROM), on_duplicate)


def erp_location_lookup(erp_loc: DataFrame, on_duplicate: str = "fanout") -> Lookup:
    return Lookup(erp_loc_clean(erp_loc), "erp_loc_cid", derived_key(LOC_KEY_PREFIX, "customer_key", LOC_KEY_FROM), on_duplicate)


def join_erp_customer(silver_cust: DataFrame, erp_cust: DataFrame, *, on_duplicate="fanout", split: bool | None = None) -> DataFrame:
    return enrich_chain(silver_cust, "customer_key", [erp_customer_lookup(erp_cust, on_duplicate)], split=split)


def join_erp_location(df: DataFrame, erp_loc: DataFrame, *, on_duplicate="fanout", split: bool | None = None) -> DataFrame:
    return enrich_chain(df, "customer_key", [erp_location_lookup(erp_loc, on_duplicate)], split=split)


def gold_customer(silver_cust: DataFrame, erp_cust: DataFrame, erp_loc: DataFrame, *,
                  on_duplicate: str = "fanout", split: bool | None = None) -> DataFrame:
    """Customer dimension enriched with ERP birth date, gender fallback and country.

    Both ERP sides are customer-sized (they grow with the customer base).  Where the planner would not broadcast them, rows are split once for
    both joins: customers without a key go past them, keys that many rows share are salted, all others take two plain joins.
    """
    df = enrich_chain(silver_cust, "customer_key", [erp_customer_lookup(erp_cust, on_duplicate), erp_location_lookup(erp_loc, on_duplicate)], split=split)
    df = std_country(df)
    df = std_erp_gender(df)
    df = fallback(df, "gender", "erp_gender_clean")
    return df.select(GOLD_CUSTOMER_COLUMNS)


def gold_sales(silver_sls: DataFrame, silver_prd: DataFrame, erp_cat: DataFrame, *,
               on_duplicate: str = "fanout") -> DataFrame:
    """Sales lines ⟕ product master (by id) ⟕ ERP category (by derived key).

    The product master is fact-sized: sort-merge join on ``product_id``.  The
    category dimension is broadcast by the planner while its bytes allow; beyond that AQE splits the
    few heavy values of the derived ``category_id``.
    """
    sls, prd = silver_sls.alias("sls"), silver_prd.alias("prd")
    j = sls.join(prd, on="product_id", how="left")
    j = j.withColumn("category_id", segment_key("sls.product_key"))
    cat = erp_cat_clean(erp_cat)
    j = enrich(j, cat, "category_id", on_duplicate=on_duplicate, spread_null_keys=False)
    return j.selectExpr(
        "product_id",
        "sls.product_key AS product_key", "sls.product_name AS product_name", "sls.cost AS cost",
        "sls.product_line AS product_line", "sls.start_date AS product_start_date",
        "sls.end_date AS product_end_date",
        "category", "subcategory", "maintenance_required",
        "prd.product_name AS master_product_name", "prd.cost AS master_cost",
        "prd.product_line AS master_product_line",
    )
