"""Typed table definitions (the single source of truth for bronze / silver / gold schemas).

Column and table comments are kept as field metadata so ``create_table`` can
emit them as DDL comments.  NOT NULL in gold is recorded (``nullable=False``)
but enforced as a data-quality rule, not at write time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: table layout, types and comments of the layered model ----
_BRONZE = {
    "bronze_crm_cust_info": ("Customer information from CRM source system", [
        ("cst_id", "int", "Unique identifier assigned to each customer"),
        ("cst_key", "string", "Alphanumeric key for additional customer identification"),
        ("cst_firstname", "string", "First name of the customer"),
        ("cst_lastname", "string", "Last name of the customer"),
        ("cst_marital_status", "string", "Marital status for demographic analysis"),
        ("cst_gndr", "string", "Gender of the customer"),
        ("cst_create_date", "date", "Date when the customer record was created"),
    ]),
    "bronze_crm_prd_info": ("Product information from CRM source system", [
        ("prd_id", "int", "Unique numeric product identifier"),
        ("prd_key", "string", "Natural product key from CRM system"),
        ("prd_nm", "string", "Product display name"),
        ("prd_cost", "int", "Standard product cost in currency units"),
        ("prd_line", "string", "Product line or category classification"),
        ("prd_start_dt", "date", "Date the product became available"),
        ("prd_end_dt", "date", "Date the product was discontinued (NULL if active)"),
    ]),
    "bronze_crm_sales_details": ("Sales line items from CRM source system", [
        ("prd_id", "int", None), ("prd_key", "string", None), ("prd_nm", "string", None),
        ("prd_cost", "int", None), ("prd_line", "string", None),
        ("prd_start_dt", "date", None), ("prd_end_dt", "date", None),
    ]),
    "bronze_erp_cust_az12": ("Customer birth date and gender from ERP system", [
        ("CID", "string", "Customer ID for ERP join"),
        ("BDATE", "date", "Customer birth date"),
        ("GEN", "string", "Customer gender"),
    ]),
    "bronze_erp_loc_a101": ("Customer country from ERP system", [
        ("CID", "string", "Customer ID for ERP join"),
        ("CNTRY", "string", "Customer country"),
    ]),
    "bronze_erp_px_cat_g1v2": ("Product category and subcategory from ERP system", [
        ("ID", "string", "Product ID for ERP join"),
        ("CAT", "string", "Product category"),
        ("SUBCAT", "string", "Product subcategory"),
        ("MAINTENANCE", "string", "Maintenance required flag"),
    ]),
}

_SILVER = {
    "silver_crm_cust_info": ("Cleaned and standardized customer information", [
        ("customer_id", "int", "Unique customer identifier"),
        ("customer_key", "string", "Customer key from source system"),
        ("first_name", "string", "Customer first name (cleaned)"),
        ("last_name", "string", "Customer last name (cleaned)"),
        ("marital_status", "string", "Marital status (standardized)"),
        ("gender", "string", "Gender (standardized)"),
        ("created_date", "date", "Customer creation date"),
    ]),
    "silver_crm_prd_info": ("Cleaned and standardized product information", [
        ("product_id", "int", "Unique product identifier"),
        ("product_key", "string", "Product key from source system"),
        ("product_name", "string", "Product name (cleaned)"),
        ("cost", "int", "Product cost"),
        ("product_line", "string", "Product line (standardized)"),
        ("start_date", "date", "Product availability start date"),
        ("end_date", "date", "Product discontinuation date (NULL if active)"),
    ]),
    "silver_crm_sales_details": ("Cleaned and standardized sales line items", [
        ("product_id", "int", None), ("product_key", "string", None), ("product_name", "string", None),
        ("cost", "int", None), ("product_line", "string", None),
        ("start_date", "date", None), ("end_date", "date", None),
    ]),
}

_GOLD = {
    "gold_customer_enriched": ("Customer data enriched with ERP birth date and country information", [
        ("customer_id", "int!", "Unique customer identifier"),
        ("customer_key", "string", "Customer key from source system"),
        ("first_name", "string", "Customer first name"),
        ("last_name", "string", "Customer last name"),
        ("marital_status", "string", "Marital status"),
        ("gender", "string!", "Gender"),
        ("birth_date", "date", "Birth date (from ERP)"),
        ("country", "string", "Country (from ERP)"),
        ("created_date", "date!", "Customer creation date"),
    ]),
    "gold_sales_denormalized": ("Sales data enriched with ERP category and subcategory information", [
        ("product_id", "int", "Unique product identifier"),
        ("product_key", "string", "Product key from source system"),
        ("product_name", "string", "Product name"),
        ("cost", "int", "Product cost"),
        ("product_line", "string", "Product line"),
        ("product_start_date", "date", "Product availability start date"),
        ("product_end_date", "date", "Product discontinuation date"),
        ("category", "string", "Product category (from ERP)"),
        ("subcategory", "string", "Product subcategory (from ERP)"),
        ("maintenance_required", "string", "Maintenance required flag (from ERP)"),
        ("master_product_name", "string", "Master product name"),
        ("master_cost", "int", "Master product cost"),
        ("master_product_line", "string", "Master product line"),
    ]),
}

LAYER_COMMENTS = {
    "bronze": "Bronze layer: Raw data ingested from CRM and ERP source systems",
    "silver": "Silver layer: Cleaned, deduplicated, and standardized data",
    "gold": "Gold layer: Denormalized, enriched, analytics-ready tables",
}
# ---- end of fixed values ----

_TYPES = {"int": T.IntegerType(), "string": T.StringType(), "date": T.DateType()}


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    comment: str
    schema: T.StructType
    bucket_by: tuple[str, ...] = ()   # written bucketed on these columns (co-located joins)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _struct(cols) -> T.StructType:
    fields = []
    for name, typ, comment in cols:
        not_null = typ.endswith("!")
        meta = {"comment": comment} if comment else {}
        fields.append(T.StructField(name, _TYPES[typ.rstrip("!")], not not_null, meta))
    return T.StructType(fields)


def _specs(layer: str, defs: dict) -> dict[str, TableSpec]:
    return {n: TableSpec(layer, n, c, _struct(cols)) for n, (c, cols) in defs.items()}


BRONZE = _specs("bronze", _BRONZE)
SILVER = _specs("silver", _SILVER)
# Sales lines and the product master are both fact-sized and joined on product_id in gold:
# bucketing both on that key lets the join read co-located buckets instead of shuffling both sides.
for _n in ("silver_crm_prd_info", "silver_crm_sales_details"):
    SILVER[_n] = TableSpec("silver", _n, SILVER[_n].comment, SILVER[_n].schema, bucket_by=("product_id",))
GOLD = _specs("gold", _GOLD)
ALL_TABLES: dict[str, TableSpec] = {**BRONZE, **SILVER, **GOLD}


def schema_of(table: str, nullable: bool = False) -> T.StructType:
    """Schema of a table; ``nullable=True`` relaxes NOT NULL for reading raw files."""
    s = ALL_TABLES[table].schema
    if not nullable:
        return s
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in s.fields])
