"""Silver layer: entity specs and the spec-driven cleaning pipeline."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ..operators.clean import clean_entity
from ..specs import EntitySpec, recode

# ---- fixed values: cleaning rules of the layered sales model ----
MARITAL_CODES = {"Married": "M", "Single": "S"}
GENDER_CODES = {"Male": "M", "Female": "F"}
PRODUCT_LINE_CODES = {"Road": "R", "Sport": "S", "Mountain": "M", "Touring": "T"}
UNKNOWN = "Unknown"

CUSTOMER_RENAMES = (
    ("cst_id", "customer_id"), ("cst_key", "customer_key"), ("cst_firstname", "first_name"),
    ("cst_lastname", "last_name"), ("cst_marital_status", "marital_status"), ("cst_gndr", "gender"),
    ("cst_create_date", "created_date"),
)
PRODUCT_RENAMES = (
    ("prd_id", "product_id"), ("prd_key", "product_key"), ("prd_nm", "product_name"),
    ("prd_cost", "cost"), ("prd_line", "product_line"), ("prd_start_dt", "start_date"),
    ("prd_end_dt", "end_date"),
)
# ---- end of fixed values ----

CUSTOMER = EntitySpec(
    name="customer",
    key=("cst_id",),
    natural_key=("cst_key",),
    order_col="cst_create_date",
    categorical=("cst_marital_status", "cst_gndr"),
    date_cols=("cst_create_date",),
    fills=(("cst_gndr", UNKNOWN),),
    recodes=(("cst_marital_status", recode(MARITAL_CODES)), ("cst_gndr", recode(GENDER_CODES))),
    renames=CUSTOMER_RENAMES,
)

PRODUCT = EntitySpec(
    name="product",
    key=("prd_id",),
    natural_key=("prd_key",),
    order_col="prd_start_dt",
    end_col="prd_end_dt",
    categorical=("prd_line",),
    date_cols=("prd_start_dt", "prd_end_dt"),
    fills=(("prd_nm", UNKNOWN), ("prd_cost", 0), ("prd_line", UNKNOWN)),
    recodes=(("prd_line", recode(PRODUCT_LINE_CODES)),),
    renames=PRODUCT_RENAMES,
)

# Variant that also applies the documented (but uncoded) fills: NULL names and
# marital status become Unknown, and blank strings count as missing.
CUSTOMER_STRICT = replace(
    CUSTOMER, name="customer_strict", blank_as_null=True,
    fills=(("cst_firstname", UNKNOWN), ("cst_lastname", UNKNOWN), ("cst_marital_status", UNKNOWN),
           ("cst_gndr", UNKNOWN)),
)

# Sales lines share the product-shaped bronze schema; same rules.
SALES = replace(PRODUCT, name="sales")

# A true fact table with a composite key: driver ``lineitem`` (no renames, no fills).
LINEITEM = EntitySpec(
    name="lineitem",
    key=("l_orderkey", "l_linenumber"),
    order_col="l_shipdate",
    categorical=("l_returnflag", "l_linestatus"),
    date_cols=("l_shipdate",),
)

SPECS = {s.name: s for s in (CUSTOMER, CUSTOMER_STRICT, PRODUCT, SALES, LINEITEM)}


def silver(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """bronze -> silver for one entity: trim, dedupe (NULL keys dropped), fill, recode, rename."""
    return clean_entity(df, spec)


def silver_customer(bronze_cust: DataFrame) -> DataFrame:
    return silver(bronze_cust, CUSTOMER)


def silver_product(bronze_prd: DataFrame) -> DataFrame:
    return silver(bronze_prd, PRODUCT)


def silver_sales(bronze_sales: DataFrame) -> DataFrame:
    return silver(bronze_sales, SALES)
