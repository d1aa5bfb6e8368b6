"""Independent ANSI-SQL formulations of every registered query (run by DuckDB).

Written by hand as plain SQL over the driver tables; only the fixture SELECTs
are shared with the Spark side (one definition of the test inputs).  Rules that
keep types equal to Spark's: CAST integer sums / counts to BIGINT, write NULL
placement explicitly, use ``||`` (NULL-propagating) instead of ``concat``.
"""

from __future__ import annotations

from strata.sources.fixtures import fixture_ctes

AS_OF = "DATE '2025-01-01'"

_NC = lambda cols: " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
_CUST_REST = ["cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"]
_PRD_REST = ["prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]


def _dedupe_order(order_col, rest):
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in rest if c != order_col)
    return f"{order_col} DESC NULLS LAST, {_NC(rest)} ASC, {ties}"


def _prd_chain(prefix: str, src: str) -> list[tuple[str, str]]:
    """trim -> dedupe -> fill -> recode -> rename for a product-shaped input."""
    return [
        (f"{prefix}_trim", f"""SELECT prd_id, trim(prd_key) AS prd_key, trim(prd_nm) AS prd_nm, prd_cost,
            trim(prd_line) AS prd_line, prd_start_dt, prd_end_dt FROM {src}"""),
        (f"{prefix}_dedup", f"""SELECT prd_id, prd_key, prd_nm, prd_cost, prd_line, prd_start_dt, prd_end_dt FROM (
            SELECT *, row_number() OVER (PARTITION BY prd_id ORDER BY {_dedupe_order('prd_start_dt', _PRD_REST)}) AS rn
            FROM {prefix}_trim WHERE prd_id IS NOT NULL) t WHERE rn = 1"""),
        (f"silver_{prefix}", f"""SELECT prd_id AS product_id, prd_key AS product_key,
            COALESCE(prd_nm, 'Unknown') AS product_name, COALESCE(prd_cost, 0) AS cost,
            CASE WHEN COALESCE(prd_line, 'Unknown') = 'R' THEN 'Road' WHEN COALESCE(prd_line, 'Unknown') = 'S' THEN 'Sport'
                 WHEN COALESCE(prd_line, 'Unknown') = 'M' THEN 'Mountain' WHEN COALESCE(prd_line, 'Unknown') = 'T' THEN 'Touring'
                 ELSE COALESCE(prd_line, 'Unknown') END AS product_line,
            prd_start_dt AS start_date, prd_end_dt AS end_date FROM {prefix}_dedup"""),
    ]


PIPELINE_CTES: list[tuple[str, str]] = [
    ("cust_trim", """SELECT cst_id, trim(cst_key) AS cst_key, trim(cst_firstname) AS cst_firstname,
        trim(cst_lastname) AS cst_lastname, trim(cst_marital_status) AS cst_marital_status,
        trim(cst_gndr) AS cst_gndr, cst_create_date FROM fx_cust_info"""),
    ("cust_dedup", f"""SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, cst_create_date FROM (
        SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY {_dedupe_order('cst_create_date', _CUST_REST)}) AS rn
        FROM cust_trim WHERE cst_id IS NOT NULL) t WHERE rn = 1"""),
    ("silver_cust", """SELECT cst_id AS customer_id, cst_key AS customer_key, cst_firstname AS first_name,
        cst_lastname AS last_name,
        CASE WHEN cst_marital_status = 'M' THEN 'Married' WHEN cst_marital_status = 'S' THEN 'Single'
             ELSE cst_marital_status END AS marital_status,
        CASE WHEN COALESCE(cst_gndr, 'Unknown') = 'M' THEN 'Male' WHEN COALESCE(cst_gndr, 'Unknown') = 'F' THEN 'Female'
             ELSE COALESCE(cst_gndr, 'Unknown') END AS gender,
        cst_create_date AS created_date FROM cust_dedup"""),
    ("cust_dedup_all", "SELECT * FROM cust_dedup UNION ALL SELECT * FROM cust_trim WHERE cst_id IS NULL"),
    *_prd_chain("prd", "fx_prd_info"),
    *_prd_chain("sls", "fx_sales_details"),
    ("erp_cust", "SELECT trim(CID) AS erp_cust_cid, BDATE AS birth_date, trim(GEN) AS erp_gender FROM fx_erp_cust"),
    ("erp_loc", "SELECT trim(CID) AS erp_loc_cid, trim(CNTRY) AS country FROM fx_erp_loc"),
    ("erp_cat", """SELECT trim(ID) AS category_id, trim(CAT) AS category, trim(SUBCAT) AS subcategory,
        trim(MAINTENANCE) AS maintenance_required FROM fx_px_cat"""),
    ("cust_erp_joined", """SELECT s.*, e.birth_date, e.erp_gender, l.country AS raw_country
        FROM silver_cust s
        LEFT JOIN erp_cust e ON e.erp_cust_cid = 'NASA' || substring(s.customer_key, 2)
        LEFT JOIN erp_loc l ON l.erp_loc_cid = 'AW-' || substring(s.customer_key, 3)"""),
    ("cust_std", """SELECT *,
        CASE WHEN raw_country IN ('USA', 'US') THEN 'United States' WHEN raw_country = 'DE' THEN 'Germany'
             WHEN raw_country IS NULL THEN 'Unknown' WHEN trim(raw_country) = '' THEN 'Unknown'
             ELSE trim(raw_country) END AS country_std,
        CASE WHEN erp_gender = 'M' THEN 'Male' WHEN erp_gender = 'F' THEN 'Female'
             WHEN erp_gender IS NULL THEN NULL WHEN trim(erp_gender) = '' THEN NULL
             ELSE trim(erp_gender) END AS erp_gender_clean
        FROM cust_erp_joined"""),
    ("gold_cust", """SELECT customer_id, customer_key, first_name, last_name, marital_status,
        CASE WHEN gender = 'Unknown' AND erp_gender_clean IS NOT NULL THEN erp_gender_clean ELSE gender END AS gender,
        birth_date, country_std AS country, created_date FROM cust_std"""),
    ("sales_joined", """SELECT s.product_id, s.product_key, s.product_name, s.cost, s.product_line,
        s.start_date AS product_start_date, s.end_date AS product_end_date,
        string_split(s.product_key, '-')[1] || '_' || string_split(s.product_key, '-')[2] AS category_id,
        p.product_name AS master_product_name, p.cost AS master_cost, p.product_line AS master_product_line
        FROM silver_sls s LEFT JOIN silver_prd p ON s.product_id = p.product_id"""),
    ("gold_sales", """SELECT j.product_id, j.product_key, j.product_name, j.cost, j.product_line,
        j.product_start_date, j.product_end_date, c.category, c.subcategory, c.maintenance_required,
        j.master_product_name, j.master_cost, j.master_product_line
        FROM sales_joined j LEFT JOIN erp_cat c ON c.category_id = j.category_id"""),
]

_ALL_FX = ["fx_cust_info", "fx_prd_info", "fx_sales_details", "fx_erp_cust", "fx_erp_loc", "fx_px_cat"]


def with_pipeline(select_sql: str) -> str:
    """``WITH <fixtures>, <pipeline CTEs> <select>`` — DuckDB evaluates only what the select references."""
    ctes = fixture_ctes(_ALL_FX) + PIPELINE_CTES
    body = ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes)
    return f"WITH {body}\n{select_sql}"


ORACLES: dict[str, str] = {}


def oracle(name: str, select_sql: str) -> None:
    ORACLES[name] = with_pipeline(select_sql)




# ------------------------------------------------------------------ helpers for generated column lists
CUST_COLS = ["cst_id", *_CUST_REST]
PRD_COLS = ["prd_id", *_PRD_REST]
CUST_STR = ["cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"]
PRD_STR = ["prd_key", "prd_nm", "prd_line"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _profile(src: str, cols: list[str], strings: list[str]) -> str:
    parts = ["COUNT(*) AS total_rows"]
    parts += [f"{_cnt(f'{c} IS NULL')} AS {c}_nulls" for c in cols]
    parts += [f"{_cnt(f'{c} = {chr(39)}{chr(39)}')} AS {c}_empty" for c in strings]
    parts += [f"{_cnt(f'{c} != trim({c})')} AS {c}_has_whitespace" for c in strings]
    return f"SELECT {', '.join(parts)} FROM {src}"


def _dup_check(src: str, checks: dict[str, list[str]]) -> str:
    parts = []
    for name, keys in checks.items():
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        parts.append(f"SELECT '{name}' AS check_name, COUNT(*) AS dup_count FROM (SELECT {', '.join(keys)} FROM {src} "
                     f"WHERE {nn} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1) t")
    return " UNION ALL ".join(parts)


def _null_summary(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {_cnt(f'{c} IS NULL')} AS nulls FROM {src}" for c in cols)


def _pct(cond: str, digits: int, src_total: str = "COUNT(*)") -> str:
    return (f"round(CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) / CAST({src_total} AS DOUBLE) "
            f"* CAST(100 AS DOUBLE), {digits})")


_CUST_GNDR_STD = "CASE WHEN cst_gndr = 'M' THEN 'Male' WHEN cst_gndr = 'F' THEN 'Female' ELSE cst_gndr END"
_CUST_MAR_STD = ("CASE WHEN cst_marital_status = 'M' THEN 'Married' WHEN cst_marital_status = 'S' THEN 'Single' "
                 "ELSE cst_marital_status END")
_FILL_CUST = ("SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, "
              "COALESCE(cst_gndr, 'Unknown') AS cst_gndr, cst_create_date FROM cust_dedup_all WHERE cst_id IS NOT NULL")
_FILL_PRD = ("SELECT prd_id, prd_key, COALESCE(prd_nm, 'Unknown') AS prd_nm, COALESCE(prd_cost, 0) AS prd_cost, "
             "COALESCE(prd_line, 'Unknown') AS prd_line, prd_start_dt, prd_end_dt FROM prd_dedup")
_WS_ANY = " OR ".join(f"{c} != trim({c})" for c in CUST_STR)

# ------------------------------------------------------------------ profiling
oracle("profile_customer", _profile("fx_cust_info", CUST_COLS, CUST_STR))
oracle("profile_product", _profile("fx_prd_info", PRD_COLS, PRD_STR))
oracle("profile_sales", _profile("fx_sales_details", PRD_COLS, PRD_STR))
oracle("profile_long_customer", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, total_rows, {c}_nulls AS nulls, "
    + (f"{c}_empty AS empties, {c}_has_whitespace AS whitespace" if c in CUST_STR
       else "CAST(NULL AS BIGINT) AS empties, CAST(NULL AS BIGINT) AS whitespace")
    + f" FROM ({_profile('fx_cust_info', CUST_COLS, CUST_STR)}) w" for c in CUST_COLS))
oracle("dup_check_customer", _dup_check("fx_cust_info", {"cst_id duplicates": ["cst_id"], "cst_key duplicates": ["cst_key"]}))
oracle("dup_check_product", _dup_check("fx_prd_info", {"prd_id duplicates": ["prd_id"], "prd_key duplicates": ["prd_key"]}))
oracle("dup_check_lineitem", _dup_check("lineitem", {"l_orderkey, l_linenumber duplicates": ["l_orderkey", "l_linenumber"]}))
oracle("category_dist_customer", """
SELECT 'cst_marital_status' AS column_name, cst_marital_status AS value, COUNT(*) AS "count" FROM fx_cust_info GROUP BY cst_marital_status
UNION ALL
SELECT 'cst_gndr' AS column_name, cst_gndr AS value, COUNT(*) AS "count" FROM fx_cust_info GROUP BY cst_gndr""")
oracle("category_dist_product", """
SELECT 'prd_line' AS column_name, prd_line AS value, COUNT(*) AS "count" FROM fx_prd_info GROUP BY prd_line""")
oracle("date_range_customer", f"""
SELECT MIN(cst_create_date) AS earliest_date, MAX(cst_create_date) AS latest_date,
  COUNT(DISTINCT cst_create_date) AS distinct_dates,
  {_cnt(f"cst_create_date > {AS_OF}")} AS future_dates,
  {_cnt("cst_create_date < DATE '1900-01-01'")} AS pre_1900_dates
FROM fx_cust_info""")
oracle("date_range_product", f"""
SELECT MIN(prd_start_dt) AS earliest_start, MAX(prd_start_dt) AS latest_start,
  COUNT(DISTINCT prd_start_dt) AS distinct_start_dates,
  {_cnt(f"prd_start_dt > {AS_OF}")} AS future_start_dates,
  {_cnt("prd_start_dt < DATE '1900-01-01'")} AS pre_1900_start_dates,
  MIN(prd_end_dt) AS earliest_end, MAX(prd_end_dt) AS latest_end,
  COUNT(DISTINCT prd_end_dt) AS distinct_end_dates,
  {_cnt("prd_end_dt IS NOT NULL AND prd_end_dt < prd_start_dt")} AS end_before_start
FROM fx_prd_info""")
oracle("end_before_start_rows", """
SELECT prd_id, prd_key, prd_nm, prd_cost, prd_line, prd_start_dt, prd_end_dt,
  CAST(datediff('day', prd_end_dt, prd_start_dt) AS INTEGER) AS days_end_before_start
FROM fx_prd_info WHERE prd_end_dt IS NOT NULL AND prd_end_dt < prd_start_dt ORDER BY prd_id""")
oracle("rows_with_whitespace", f"""
SELECT cst_id, cst_firstname, cst_lastname, cst_marital_status, cst_gndr FROM fx_cust_info WHERE {_WS_ANY}""")
oracle("verify_no_whitespace", f"SELECT {_cnt(_WS_ANY)} AS rows_with_whitespace FROM cust_trim")
oracle("duplicate_rows_customer", """
SELECT * FROM cust_trim WHERE cst_id IN (
  SELECT cst_id FROM cust_trim WHERE cst_id IS NOT NULL GROUP BY cst_id HAVING COUNT(*) > 1)""")
oracle("duplicate_rows_product", """
SELECT * FROM prd_trim WHERE prd_id IN (
  SELECT prd_id FROM prd_trim WHERE prd_id IS NOT NULL GROUP BY prd_id HAVING COUNT(*) > 1)""")
oracle("dup_summary", """
SELECT CAST(COALESCE(SUM(c), 0) AS BIGINT) AS duplicate_rows, COUNT(*) AS distinct_duplicate_keys
FROM (SELECT cst_id, COUNT(*) AS c FROM cust_trim WHERE cst_id IS NOT NULL GROUP BY cst_id HAVING COUNT(*) > 1) t""")
_diff_cols = ", ".join(
    f"(COUNT(DISTINCT {c}) + CASE WHEN COUNT({c}) < COUNT(*) THEN 1 ELSE 0 END) > 1 AS d_{c}" for c in _CUST_REST)
oracle("duplicate_column_diff", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COALESCE(SUM(CASE WHEN d_{c} THEN 1 ELSE 0 END), 0) AS BIGINT) "
    f"AS groups_with_mismatch FROM (SELECT cst_id, {_diff_cols} FROM cust_trim WHERE cst_id IS NOT NULL "
    f"GROUP BY cst_id HAVING COUNT(*) > 1) g" for c in _CUST_REST))
oracle("null_summary", _null_summary("cust_dedup_all", CUST_COLS))
oracle("null_summary_silver_product", _null_summary(
    "silver_prd", ["product_id", "product_key", "product_name", "cost", "product_line", "start_date", "end_date"]))
oracle("verify_no_dups", _dup_check("silver_cust", {"customer_id duplicates": ["customer_id"]}))
oracle("schema_report", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, {n} AS nullable, "
    f"COUNT({c}) AS non_null_rows FROM silver_cust"
    # gender cannot be NULL after the 'Unknown' fill, and Spark's schema says so
    for i, (c, t, n) in enumerate([("customer_id", "int", "true"), ("customer_key", "string", "true"),
                                   ("first_name", "string", "true"), ("last_name", "string", "true"),
                                   ("marital_status", "string", "true"), ("gender", "string", "false"),
                                   ("created_date", "date", "true")])))
_LI_STR = ["l_returnflag", "l_linestatus"]
oracle("profile_lineitem", _profile("lineitem", LINEITEM_COLS, _LI_STR))
oracle("category_dist_lineitem", " UNION ALL ".join(
    f'SELECT {chr(39)}{c}{chr(39)} AS column_name, {c} AS value, COUNT(*) AS "count" FROM lineitem GROUP BY {c}'
    for c in _LI_STR))
oracle("date_range_lineitem", f"""
SELECT MIN(l_shipdate) AS earliest_date, MAX(l_shipdate) AS latest_date, COUNT(DISTINCT l_shipdate) AS distinct_dates,
  {_cnt(f"l_shipdate > {AS_OF}")} AS future_dates, {_cnt("l_shipdate < DATE '1900-01-01'")} AS pre_1900_dates
FROM lineitem""")
oracle("duplicate_rows_lineitem", """
SELECT l.* FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""")
oracle("sample_customer", "SELECT * FROM fx_cust_info ORDER BY "
       + ", ".join(f"{c} ASC NULLS LAST" for c in CUST_COLS) + " LIMIT 20")

# ------------------------------------------------------------------ cleaning
oracle("trim_strings", "SELECT * FROM cust_trim")
oracle("null_count_score", f"SELECT *, {_NC(_CUST_REST)} AS null_count FROM cust_trim")
oracle("dedupe_customer", "SELECT * FROM cust_dedup")
oracle("dedupe_keep_null_keys", "SELECT * FROM cust_dedup_all")
oracle("dedupe_product", "SELECT * FROM prd_dedup")
oracle("dedupe_sales", "SELECT * FROM sls_dedup")
_LI_REST = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]
oracle("dedupe_lineitem", f"""
SELECT {', '.join(LINEITEM_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_dedupe_order('l_shipdate', _LI_REST)}) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) t WHERE rn = 1""")
oracle("silver_lineitem", f"""
SELECT {', '.join(LINEITEM_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_dedupe_order('l_shipdate', _LI_REST)}) AS rn
  FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               trim(l_returnflag) AS l_returnflag, trim(l_linestatus) AS l_linestatus, l_shipdate FROM lineitem) t
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) r WHERE rn = 1""")
oracle("null_key_rows", "SELECT * FROM cust_trim WHERE cst_id IS NULL")
oracle("null_rows_by_column", "SELECT * FROM cust_dedup_all WHERE cst_lastname IS NULL")
oracle("null_overlap", "SELECT * FROM cust_dedup_all WHERE cst_id IS NULL AND cst_create_date IS NULL")
oracle("drop_null_key", "SELECT * FROM cust_dedup_all WHERE cst_id IS NOT NULL")
oracle("fill_gender", _FILL_CUST)
oracle("fill_product", _FILL_PRD)
oracle("std_marital", f"""SELECT cst_id, cst_key, cst_firstname, cst_lastname, {_CUST_MAR_STD} AS cst_marital_status,
  cst_gndr, cst_create_date FROM ({_FILL_CUST}) f""")
oracle("std_gender", f"""SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status,
  {_CUST_GNDR_STD} AS cst_gndr, cst_create_date FROM ({_FILL_CUST}) f""")
oracle("std_product_line", f"""SELECT prd_id, prd_key, prd_nm, prd_cost,
  CASE WHEN prd_line = 'R' THEN 'Road' WHEN prd_line = 'S' THEN 'Sport' WHEN prd_line = 'M' THEN 'Mountain'
       WHEN prd_line = 'T' THEN 'Touring' ELSE prd_line END AS prd_line, prd_start_dt, prd_end_dt FROM ({_FILL_PRD}) f""")
oracle("rename_customer", """SELECT cst_id AS customer_id, cst_key AS customer_key, cst_firstname AS first_name,
  cst_lastname AS last_name, cst_marital_status AS marital_status, cst_gndr AS gender, cst_create_date AS created_date
  FROM fx_cust_info""")
oracle("rename_product", """SELECT prd_id AS product_id, prd_key AS product_key, prd_nm AS product_name,
  prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date, prd_end_dt AS end_date FROM fx_prd_info""")
oracle("dedupe_audit", """SELECT COUNT(*) AS rows_before, (SELECT COUNT(*) FROM cust_dedup_all) AS rows_after,
  COUNT(*) - (SELECT COUNT(*) FROM cust_dedup_all) AS rows_removed FROM cust_trim""")
oracle("pipeline_audit", " UNION ALL ".join(
    f"""SELECT '{ent}' AS entity, (SELECT COUNT(*) FROM {src}) AS rows_in,
      (SELECT COUNT(*) FROM {src}) - (SELECT COUNT(*) FROM {src} WHERE {key} IS NULL) - (SELECT COUNT(*) FROM {out})
        AS duplicates_removed,
      (SELECT COUNT(*) FROM {src} WHERE {key} IS NULL) AS null_keys_dropped,
      (SELECT COUNT(*) FROM {out}) AS rows_out"""
    for ent, src, key, out in (("customer", "fx_cust_info", "cst_id", "silver_cust"),
                               ("product", "fx_prd_info", "prd_id", "silver_prd"),
                               ("sales", "fx_sales_details", "prd_id", "silver_sls"))))

# ------------------------------------------------------------------ silver / gold pipelines
oracle("silver_customer", "SELECT * FROM silver_cust")
oracle("silver_product", "SELECT * FROM silver_prd")
oracle("silver_sales", "SELECT * FROM silver_sls")
oracle("gold_customer_enriched", "SELECT * FROM gold_cust")
oracle("gold_sales_denormalized", "SELECT * FROM gold_sales")
oracle("erp_cust_clean", "SELECT * FROM erp_cust")
oracle("erp_loc_clean", "SELECT * FROM erp_loc")
oracle("erp_cat_clean", "SELECT * FROM erp_cat")
oracle("std_country", """SELECT erp_loc_cid,
  CASE WHEN country IN ('USA', 'US') THEN 'United States' WHEN country = 'DE' THEN 'Germany'
       WHEN country IS NULL THEN 'Unknown' WHEN trim(country) = '' THEN 'Unknown' ELSE trim(country) END AS country
  FROM erp_loc""")
oracle("std_erp_gender", """SELECT erp_cust_cid, birth_date, erp_gender,
  CASE WHEN erp_gender = 'M' THEN 'Male' WHEN erp_gender = 'F' THEN 'Female' WHEN erp_gender IS NULL THEN NULL
       WHEN trim(erp_gender) = '' THEN NULL ELSE trim(erp_gender) END AS erp_gender_clean FROM erp_cust""")
oracle("join_erp_customer", """SELECT 'NASA' || substring(s.customer_key, 2) AS erp_cust_cid, s.*, e.birth_date, e.erp_gender
  FROM silver_cust s LEFT JOIN erp_cust e ON e.erp_cust_cid = 'NASA' || substring(s.customer_key, 2)""")
oracle("join_erp_location", """SELECT 'AW-' || substring(s.customer_key, 3) AS erp_loc_cid, s.*, l.country
  FROM silver_cust s LEFT JOIN erp_loc l ON l.erp_loc_cid = 'AW-' || substring(s.customer_key, 3)""")
oracle("unmatched_erp_customers", """SELECT s.*, 'NASA' || substring(s.customer_key, 2) AS erp_cust_cid FROM silver_cust s
  WHERE NOT EXISTS (SELECT 1 FROM erp_cust e WHERE e.erp_cust_cid = 'NASA' || substring(s.customer_key, 2))""")
oracle("join_product_master", """SELECT s.product_id, s.product_key, s.product_name, s.cost, s.product_line,
  s.start_date, s.end_date, p.product_key AS master_product_key, p.product_name AS master_product_name,
  p.cost AS master_cost, p.product_line AS master_product_line, p.start_date AS master_start_date,
  p.end_date AS master_end_date
  FROM silver_sls s LEFT JOIN silver_prd p ON s.product_id = p.product_id""")
oracle("join_category", """SELECT j.*, c.category, c.subcategory, c.maintenance_required FROM (
  SELECT *, string_split(product_key, '-')[1] || '_' || string_split(product_key, '-')[2] AS category_id
  FROM silver_sls) j LEFT JOIN erp_cat c ON c.category_id = j.category_id""")
oracle("gender_fallback", """SELECT customer_id, crm_gender, erp_gender_clean,
  CASE WHEN crm_gender = 'Unknown' AND erp_gender_clean IS NOT NULL THEN erp_gender_clean ELSE crm_gender END AS gender
  FROM (SELECT s.customer_id, s.gender AS crm_gender,
          CASE WHEN e.erp_gender = 'M' THEN 'Male' WHEN e.erp_gender = 'F' THEN 'Female' WHEN e.erp_gender IS NULL THEN NULL
               WHEN trim(e.erp_gender) = '' THEN NULL ELSE trim(e.erp_gender) END AS erp_gender_clean
        FROM silver_cust s LEFT JOIN erp_cust e ON e.erp_cust_cid = 'NASA' || substring(s.customer_key, 2)) t""")
oracle("coverage_customer", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS matched_rows, COUNT(*) AS total_rows,
      round(CAST(COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE), 1) AS coverage_pct FROM gold_cust"""
    for c in ("country", "birth_date")))
oracle("coverage_category", """SELECT 'category' AS column_name, COUNT(category) AS matched_rows, COUNT(*) AS total_rows,
  round(CAST(COUNT(category) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE), 1) AS coverage_pct FROM gold_sales""")
for _k, _t, _c in (("dist_gold_country", "gold_cust", "country"), ("dist_gold_gender", "gold_cust", "gender"),
                   ("dist_gold_line", "gold_sales", "product_line"), ("dist_gold_category", "gold_sales", "category")):
    oracle(_k, f'SELECT {_c}, COUNT(*) AS "count" FROM {_t} GROUP BY {_c}')
oracle("gold_verification", """SELECT 'gold_customer_enriched' AS table_name, COUNT(*) AS row_count FROM gold_cust
  UNION ALL SELECT 'gold_sales_denormalized' AS table_name, COUNT(*) AS row_count FROM gold_sales""")

_PCT = lambda c: f"round(CAST({c} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE), 1)"
oracle("coverage_known", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT({c}) AS matched_rows, COUNT({k}) AS known_rows, COUNT(*) AS total_rows,
      {_PCT(f'COUNT({c})')} AS coverage_pct, {_PCT(f'COUNT({k})')} AS known_pct FROM gold_cust"""
    for c, k in (("country", "NULLIF(country, 'Unknown')"), ("gender", "NULLIF(gender, 'Unknown')"), ("birth_date", "birth_date"))))
_GOLD_TYPES = {
    "gold_customer_enriched": ["customer_id int", "customer_key string", "first_name string", "last_name string", "marital_status string", "gender string",
                               "birth_date date", "country string", "created_date date"],
    "gold_sales_denormalized": ["product_id int", "product_key string", "product_name string", "cost int", "product_line string", "product_start_date date",
                                "product_end_date date", "category string", "subcategory string", "maintenance_required string", "master_product_name string",
                                "master_cost int", "master_product_line string"]}
oracle("gold_verification_report", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, 'schema' AS section, '{c}' AS item, CAST({i} AS BIGINT) AS value" for t, cs in _GOLD_TYPES.items() for i, c in enumerate(cs, 1)]
    + [f"SELECT '{t}', 'rows', NULL, COUNT(*) FROM {v}" for t, v in (("gold_customer_enriched", "gold_cust"), ("gold_sales_denormalized", "gold_sales"))]
    + [f"SELECT '{t}', '{c}', {c}, COUNT(*) FROM {v} GROUP BY {c}" for t, v, c in (
        ("gold_customer_enriched", "gold_cust", "country"), ("gold_customer_enriched", "gold_cust", "gender"),
        ("gold_sales_denormalized", "gold_sales", "product_line"), ("gold_sales_denormalized", "gold_sales", "category"))]))
oracle("write_verification", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, COUNT(*) AS rows_written, COUNT(*) AS rows_read, true AS rows_equal, true AS digest_equal, true AS schema_equal FROM {v}"""
    for t, v in (("gold_customer_enriched", "gold_cust"), ("gold_sales_denormalized", "gold_sales"), ("silver_crm_cust_info", "silver_cust"),
                 ("silver_crm_prd_info", "silver_prd"), ("silver_crm_sales_details", "silver_sls"))))

# ------------------------------------------------------------------ dashboard
_GC = "customer_id, customer_key, first_name, last_name, marital_status, gender, birth_date, country, created_date"
_SEL_COUNTRY = "('United States', 'Germany', 'Unknown')"
_SEL_GENDER = "('Female')"
oracle("ds_gold_customers", f"SELECT {_GC} FROM gold_cust")
oracle("ds_gold_products", "SELECT * FROM gold_sales")
oracle("kpi_total_customers", "SELECT COUNT(customer_id) AS total_customers FROM gold_cust")
oracle("kpi_total_products", "SELECT COUNT(product_id) AS total_products FROM gold_sales")
oracle("kpi_product_categories", "SELECT COUNT(DISTINCT category) AS product_categories FROM gold_sales")
oracle("kpi_countries_covered", "SELECT COUNT(DISTINCT country) AS countries_covered FROM gold_cust WHERE country != 'Unknown'")
oracle("kpi_average_cost", "SELECT AVG(cost) AS average_cost FROM gold_sales")
for _k, _t, _d, _m, _n in (
        ("customers_by_country", "gold_cust", "country", "customer_id", "customer_count"),
        ("customers_by_gender", "gold_cust", "gender", "customer_id", "customer_count"),
        ("customers_by_marital", "gold_cust", "marital_status", "customer_id", "customer_count"),
        ("products_by_category", "gold_sales", "category", "product_id", "product_count"),
        ("products_by_line", "gold_sales", "product_line", "product_id", "product_count"),
        ("products_by_subcategory", "gold_sales", "subcategory", "product_id", "product_count"),
        ("products_by_maintenance", "gold_sales", "maintenance_required", "product_id", "product_count")):
    oracle(_k, f"SELECT {_d}, COUNT({_m}) AS {_n} FROM {_t} GROUP BY {_d}")
oracle("customer_detail", f"SELECT {_GC} FROM gold_cust")
oracle("product_detail", """SELECT product_id, product_key, product_name, cost, product_line, category, subcategory,
  maintenance_required FROM gold_sales""")
oracle("customers_filtered", f"SELECT * FROM gold_cust WHERE country IN {_SEL_COUNTRY} AND gender IN {_SEL_GENDER}")
oracle("filter_values_country", f"SELECT country, {_cnt(f'gender IN {_SEL_GENDER}')} AS country_associativity FROM gold_cust GROUP BY country")
oracle("filter_values_gender", f"SELECT gender, {_cnt(f'country IN {_SEL_COUNTRY}')} AS gender_associativity FROM gold_cust GROUP BY gender")
_CUSTOMER_DIMS, _PRODUCT_DIMS = ["country", "gender", "marital_status"], ["category", "subcategory", "product_line", "maintenance_required"]


def _cube(view: str, dims: list[str], measures: str) -> str:
    """Every subset of the dimensions as a grouping of its own."""
    parts = []
    for bits in range(1 << len(dims)):
        own = [d for i, d in enumerate(dims) if bits >> i & 1]
        cols = ", ".join(d if d in own else f"CAST(NULL AS VARCHAR) AS {d}" for d in dims)
        parts.append(f"SELECT '{','.join(sorted(own))}' AS level, {cols}, {measures} FROM {view}" + (f" GROUP BY {', '.join(own)}" if own else ""))
    return " UNION ALL ".join(parts)


oracle("cube_customers", _cube("gold_cust", _CUSTOMER_DIMS, "COUNT(customer_id) AS customer_count, COUNT(*) AS row_count"))
oracle("cube_products", _cube("gold_sales", _PRODUCT_DIMS, "COUNT(product_id) AS product_count, COUNT(*) AS row_count, CAST(SUM(cost) AS BIGINT) AS cost_sum, COUNT(cost) AS cost_count"))
_FILTER = f"country IN {_SEL_COUNTRY} AND gender IN {_SEL_GENDER}"
_tile = lambda name, item, value, rest: f"SELECT '{name}' AS tile, {item} AS item, CAST({value} AS DOUBLE) AS value FROM {rest}"
oracle("cube_tiles_filtered", " UNION ALL ".join([
    _tile("kpi_total_customers", "CAST(NULL AS VARCHAR)", "COUNT(customer_id)", f"gold_cust WHERE {_FILTER}"),
    _tile("kpi_total_products", "NULL", "COUNT(product_id)", "gold_sales"),
    _tile("kpi_product_categories", "NULL", "COUNT(DISTINCT category)", "gold_sales"),
    _tile("kpi_countries_covered", "NULL", "COUNT(DISTINCT country)", f"gold_cust WHERE {_FILTER} AND country <> 'Unknown'"),
    _tile("kpi_average_cost", "NULL", "AVG(cost)", "gold_sales"),
    *(_tile(f"customers_by_{n}", d, "COUNT(customer_id)", f"gold_cust WHERE {_FILTER} GROUP BY {d}") for n, d in (("country", "country"), ("gender", "gender"), ("marital", "marital_status"))),
    *(_tile(f"products_by_{n}", d, "COUNT(product_id)", f"gold_sales GROUP BY {d}") for n, d in (("category", "category"), ("line", "product_line"), ("subcategory", "subcategory"), ("maintenance", "maintenance_required"))),
    _tile("filter_values_country", "country", _cnt(f"gender IN {_SEL_GENDER}"), "gold_cust GROUP BY country"),
    _tile("filter_values_gender", "gender", _cnt(f"country IN {_SEL_COUNTRY}"), "gold_cust GROUP BY gender")]))
oracle("top10_products_by_cost", """SELECT product_id, product_key, product_name, cost, category FROM gold_sales
  ORDER BY cost DESC NULLS LAST, product_id ASC NULLS LAST LIMIT 10""")


def _dq(table: str, src: str, metrics: dict[str, str], rules) -> str:
    inner = ", ".join(f"CAST({e} AS DOUBLE) AS {m}" for m, e in metrics.items())
    rows = " UNION ALL ".join(
        f"SELECT '{r.check_name}' AS check_name, {r.metric} AS metric_value, CAST({float(r.warn)!r} AS DOUBLE) AS warn_threshold, "
        f"CAST({float(r.fail)!r} AS DOUBLE) AS fail_threshold FROM m" for r in rules)
    return (f"SELECT '{table}' AS table_name, check_name, metric_value, warn_threshold, fail_threshold, "
            "CASE WHEN metric_value IS NULL THEN 'WARN' WHEN metric_value > fail_threshold THEN 'FAIL' "
            "WHEN metric_value > warn_threshold THEN 'WARN' ELSE 'PASS' END AS status "
            f"FROM (WITH m AS (SELECT {inner} FROM {src}) {rows}) r")


def _dq_oracle() -> str:
    from strata.plans.dashboard import CUSTOMER_RULES, PRODUCT_RULES  # thresholds are parameters, shared
    cust = {
        "customer_id_nulls": _cnt("customer_id IS NULL"),
        "gender_nulls": _cnt("gender IS NULL"),
        "created_date_nulls": _cnt("created_date IS NULL"),
        "duplicate_customer_rows": "COUNT(customer_id) - COUNT(DISTINCT customer_id)",
        "birth_date_null_pct": _pct("birth_date IS NULL", 2),
        "country_unknown_pct": _pct("country = 'Unknown'", 2),
        "gender_unknown_pct": _pct("gender = 'Unknown'", 2),
        "days_since_last_customer": f"datediff('day', MAX(created_date), {AS_OF})",
    }
    prod = {
        "category_null_pct": _pct("category IS NULL", 2),
        "master_missing_pct": _pct("master_product_name IS NULL", 2),
        "product_line_unknown_pct": _pct("product_line = 'Unknown'", 2),
    }
    return (_dq("gold_customer_enriched", "gold_cust", cust, CUSTOMER_RULES) + " UNION ALL "
            + _dq("gold_sales_denormalized", "gold_sales", prod, PRODUCT_RULES))


oracle("dq_checks_gold", _dq_oracle())
oracle("dq_history_gold", f"SELECT table_name, check_name, {AS_OF} AS measured_on, metric_value, warn_threshold, fail_threshold, status FROM ({_dq_oracle()}) q")

# ------------------------------------------------------------------ sources, sinks, catalog (round trips)
oracle("ingest_csv", "SELECT * FROM fx_cust_info")
oracle("ingest_config", """SELECT 'bronze_erp_cust_az12' AS table_name, COUNT(*) AS row_count FROM fx_erp_cust
  UNION ALL SELECT 'bronze_erp_loc_a101', COUNT(*) FROM fx_erp_loc
  UNION ALL SELECT 'bronze_erp_px_cat_g1v2', COUNT(*) FROM fx_px_cat""")
oracle("ingest_config_crm", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS corrupt_rows FROM {v}"
    for t, v in (("bronze_crm_cust_info", "fx_cust_info"), ("bronze_crm_prd_info", "fx_prd_info"), ("bronze_crm_sales_details", "fx_sales_details"))))
oracle("ingest_quarantine", """SELECT CASE WHEN cst_id % 10 = 3 THEN 'quarantined' ELSE 'loaded' END AS kind, cst_id FROM fx_cust_info""")
oracle("create_tables_catalog", """SELECT 'bronze_crm_cust_info' AS table_name, COUNT(*) AS row_count FROM fx_cust_info
  UNION ALL SELECT 'bronze_crm_prd_info', COUNT(*) FROM fx_prd_info
  UNION ALL SELECT 'bronze_crm_sales_details', COUNT(*) FROM fx_sales_details
  UNION ALL SELECT 'bronze_erp_cust_az12', COUNT(*) FROM fx_erp_cust
  UNION ALL SELECT 'bronze_erp_loc_a101', COUNT(*) FROM fx_erp_loc
  UNION ALL SELECT 'bronze_erp_px_cat_g1v2', COUNT(*) FROM fx_px_cat""")
oracle("write_overwrite_roundtrip", "SELECT * FROM silver_cust")
oracle("publish_roundtrip", "SELECT * FROM silver_cust")
oracle("profile_merged_lineitem", " UNION ALL ".join(
    f"""SELECT '{n}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS nulls, CAST(MIN({c}) AS VARCHAR) AS min_value,
      CAST(MAX({c}) AS VARCHAR) AS max_value, COUNT(DISTINCT {c}) AS distinct_values, true AS estimate_within_bound FROM lineitem"""
    for n, c in (("ship_date", "CAST(l_shipdate AS DATE)"), ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
                 ("l_partkey", "l_partkey"), ("l_returnflag", "l_returnflag"))))
oracle("top_values_lineitem", " UNION ALL ".join(
    part for c in ("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber") for part in (
        f"SELECT '{c}' AS column_name, 'value' AS kind, CAST({c} AS VARCHAR) AS value, COUNT(*) AS \"count\", CAST(0 AS BIGINT) AS max_error FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}",
        f"SELECT '{c}', 'null', NULL, COUNT(*) - COUNT({c}), CAST(0 AS BIGINT) FROM lineitem",
        f"SELECT '{c}', 'others', NULL, CAST(0 AS BIGINT), CAST(0 AS BIGINT)")))
oracle("ingest_stream", "SELECT * FROM fx_cust_info")
oracle("rename_table_roundtrip", "SELECT * FROM fx_cust_info")
oracle("layered_pipeline", "SELECT * FROM gold_cust")
oracle("layered_pipeline_audit", """
  SELECT 'bronze' AS layer, 'bronze_crm_cust_info' AS table_name, COUNT(*) AS rows_written FROM fx_cust_info
  UNION ALL SELECT 'bronze', 'bronze_crm_prd_info', COUNT(*) FROM fx_prd_info
  UNION ALL SELECT 'bronze', 'bronze_crm_sales_details', COUNT(*) FROM fx_sales_details
  UNION ALL SELECT 'bronze', 'bronze_erp_cust_az12', COUNT(*) FROM fx_erp_cust
  UNION ALL SELECT 'bronze', 'bronze_erp_loc_a101', COUNT(*) FROM fx_erp_loc
  UNION ALL SELECT 'bronze', 'bronze_erp_px_cat_g1v2', COUNT(*) FROM fx_px_cat
  UNION ALL SELECT 'silver', 'silver_crm_cust_info', COUNT(*) FROM silver_cust
  UNION ALL SELECT 'silver', 'silver_crm_prd_info', COUNT(*) FROM silver_prd
  UNION ALL SELECT 'silver', 'silver_crm_sales_details', COUNT(*) FROM silver_sls
  UNION ALL SELECT 'gold', 'gold_customer_enriched', COUNT(*) FROM gold_cust
  UNION ALL SELECT 'gold', 'gold_sales_denormalized', COUNT(*) FROM gold_sales""")
