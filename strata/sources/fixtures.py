"""Dirty bronze-shaped inputs derived from the driver tables.

The driver tables are clean (no NULL, blank or padded value), so the cleaning
operators would pass vacuously on them.  These SELECTs plant every defect the
cleaning rules handle.  The text is valid in Spark SQL (ANSI) and in DuckDB and is
the single definition used on both sides: Spark binds ``{name}`` placeholders to
DataFrames, the SQL oracle binds them to view / CTE names.

Each body grows linearly with its source table: derivation, not sampling.  Keys are padded, never cut, and planted
sales ids are negative, so neither collides at any size.  Ids stay INT as in the typed tables: a larger id fails the cast loudly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .tables import TableSet

FX_CUST_INFO = """
SELECT CAST(CASE WHEN c_custkey % 97 = 13 THEN NULL ELSE c_custkey END AS INT) AS cst_id,
  'AW' || lpad(CAST(c_custkey AS VARCHAR(20)), CAST(greatest(8, length(CAST(c_custkey AS VARCHAR(20)))) AS INT), '0') AS cst_key,
  CASE WHEN c_custkey % 11 = 3 THEN NULL WHEN c_custkey % 5 = 0 THEN ' ' || c_name || ' ' WHEN c_custkey % 13 = 1 THEN '' ELSE c_name END AS cst_firstname,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_mktsegment || '  ' ELSE c_mktsegment END AS cst_lastname,
  CASE WHEN c_custkey % 5 = 0 THEN 'M' WHEN c_custkey % 5 = 1 THEN 'S' WHEN c_custkey % 5 = 2 THEN ' M' WHEN c_custkey % 5 = 3 THEN NULL ELSE 'S' END AS cst_marital_status,
  CASE WHEN c_custkey % 4 = 0 THEN 'M' WHEN c_custkey % 4 = 1 THEN 'F ' WHEN c_custkey % 4 = 2 THEN NULL ELSE 'F' END AS cst_gndr,
  CASE WHEN c_custkey % 101 = 5 THEN NULL WHEN c_custkey % 103 = 9 THEN DATE '1899-11-30' + CAST(c_custkey % 20 AS INT) ELSE DATE '2024-01-01' + CAST(c_custkey % 365 AS INT) END AS cst_create_date
FROM {customer}
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || lpad(CAST(c_custkey AS VARCHAR(20)), CAST(greatest(8, length(CAST(c_custkey AS VARCHAR(20)))) AS INT), '0'), c_name, NULL, 'S', 'F',
  DATE '2024-01-01' + CAST(c_custkey % 365 + 30 AS INT)
FROM {customer} WHERE c_custkey % 7 = 0
UNION ALL
SELECT CAST(c_custkey AS INT), 'AW' || lpad(CAST(c_custkey AS VARCHAR(20)), CAST(greatest(8, length(CAST(c_custkey AS VARCHAR(20)))) AS INT), '0'), c_name, c_mktsegment, 'S', 'F',
  DATE '2024-01-01' + CAST(c_custkey % 365 + 30 AS INT)
FROM {customer} WHERE c_custkey % 21 = 0
"""

FX_PRD_INFO = """
SELECT CAST(CASE WHEN p_partkey % 211 = 7 THEN NULL ELSE p_partkey END AS INT) AS prd_id,
  CASE WHEN p_partkey % 50 = 49 THEN 'NOHYPHEN' || CAST(p_partkey AS VARCHAR(20)) ELSE substring(p_type, 1, 2) || '-' || substring(p_brand, 7, 10) || '-' || CAST(p_partkey AS VARCHAR(20)) END AS prd_key,
  CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN ' ' || p_name ELSE p_name END AS prd_nm,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) END AS prd_cost,
  CASE WHEN p_partkey % 6 = 0 THEN 'R ' WHEN p_partkey % 6 = 1 THEN 'S' WHEN p_partkey % 6 = 2 THEN 'M' WHEN p_partkey % 6 = 3 THEN 'T' WHEN p_partkey % 6 = 4 THEN NULL ELSE 'X' END AS prd_line,
  CASE WHEN p_partkey % 107 = 11 THEN DATE '2030-01-01' + CAST(p_size AS INT) ELSE DATE '2011-07-01' + CAST(p_size AS INT) END AS prd_start_dt,
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN DATE '2011-07-01' + CAST(p_size + 100 AS INT) ELSE DATE '2011-07-01' + CAST(p_size - 20 AS INT) END AS prd_end_dt
FROM {part}
UNION ALL
SELECT CAST(p_partkey AS INT), substring(p_type, 1, 2) || '-' || substring(p_brand, 7, 10) || '-' || CAST(p_partkey AS VARCHAR(20)), p_name, 1, 'R', DATE '2011-07-01' + CAST(p_size - 5 AS INT), NULL
FROM {part} WHERE p_partkey % 9 = 0
"""

FX_SALES_DETAILS = """
SELECT prd_id, prd_key, prd_nm, prd_cost + 1 AS prd_cost, prd_line, prd_start_dt, prd_end_dt
FROM {fx_prd_info} WHERE prd_id IS NULL OR prd_id % 3 <> 0
UNION ALL
SELECT -1 - prd_id, prd_key, prd_nm || ' x', prd_cost, 'T', prd_start_dt, prd_end_dt
FROM {fx_prd_info} WHERE prd_id % 5 = 0
"""

FX_ERP_CUST = """
SELECT 'NASAW' || lpad(CAST(c_custkey AS VARCHAR(20)), CAST(greatest(8, length(CAST(c_custkey AS VARCHAR(20)))) AS INT), '0') || CASE WHEN c_custkey % 8 = 0 THEN ' ' ELSE '' END AS CID,
  DATE '1950-01-01' + CAST(c_custkey % 15000 AS INT) AS BDATE,
  CASE WHEN c_custkey % 6 = 0 THEN 'M' WHEN c_custkey % 6 = 1 THEN 'F' WHEN c_custkey % 6 = 2 THEN 'Male ' WHEN c_custkey % 6 = 3 THEN ' ' WHEN c_custkey % 6 = 4 THEN NULL ELSE 'Female' END AS GEN
FROM {customer} WHERE c_custkey % 10 <> 9
"""

FX_ERP_LOC = """
SELECT 'AW-' || lpad(CAST(c_custkey AS VARCHAR(20)), CAST(greatest(8, length(CAST(c_custkey AS VARCHAR(20)))) AS INT), '0') AS CID,
  CASE WHEN c_nationkey % 7 = 0 THEN 'US' WHEN c_nationkey % 7 = 1 THEN 'USA' WHEN c_nationkey % 7 = 2 THEN 'DE' WHEN c_nationkey % 7 = 3 THEN ' ' WHEN c_nationkey % 7 = 4 THEN NULL ELSE ' ' || n_name END AS CNTRY
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_custkey % 12 <> 11
"""

FX_PX_CAT = """
SELECT DISTINCT substring(p_type, 1, 2) || '_' || substring(p_brand, 7, 10) AS ID, p_type || ' ' AS CAT, p_brand AS SUBCAT,
  CASE WHEN substring(p_brand, 7, 1) = '1' THEN 'Yes' ELSE 'No ' END AS MAINTENANCE
FROM {part} WHERE p_brand <> 'Brand#4'
"""

# name -> (body, placeholders); placeholders are driver tables or earlier fixtures.
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_cust_info": (FX_CUST_INFO, ("customer",)),
    "fx_prd_info": (FX_PRD_INFO, ("part",)),
    "fx_sales_details": (FX_SALES_DETAILS, ("fx_prd_info",)),
    "fx_erp_cust": (FX_ERP_CUST, ("customer",)),
    "fx_erp_loc": (FX_ERP_LOC, ("customer", "nation")),
    "fx_px_cat": (FX_PX_CAT, ("part",)),
}

# Which bronze table each fixture stands for.
BRONZE_OF = {
    "fx_cust_info": "bronze_crm_cust_info",
    "fx_prd_info": "bronze_crm_prd_info",
    "fx_sales_details": "bronze_crm_sales_details",
    "fx_erp_cust": "bronze_erp_cust_az12",
    "fx_erp_loc": "bronze_erp_loc_a101",
    "fx_px_cat": "bronze_erp_px_cat_g1v2",
}


def fixture(tables: TableSet, name: str) -> DataFrame:
    """Spark DataFrame of one derived input (lazy; reads only the columns it uses).
    Built once per table set, so a fixture used by another one is not re-planned."""
    return tables.derived(name, lambda: _build(tables, name))


def _build(tables: TableSet, name: str) -> DataFrame:
    body, deps = FIXTURES[name]
    bound = {d: (fixture(tables, d) if d in FIXTURES else tables[d]) for d in deps}
    return tables.spark.sql(body, **bound)


def fixture_ctes(names: list[str] | tuple[str, ...]) -> list[tuple[str, str]]:
    """``(name, sql)`` pairs, dependencies first, for a WITH clause over plain table names."""
    out: list[tuple[str, str]] = []

    def add(n: str) -> None:
        if any(n == m for m, _ in out):
            return
        body, deps = FIXTURES[n]
        for d in deps:
            if d in FIXTURES:
                add(d)
        out.append((n, body.format(**{d: d for d in deps}).strip()))

    for n in names:
        add(n)
    return out
