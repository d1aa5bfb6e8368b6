"""The gold dashboard: datasets, KPI tiles, distributions, filters, detail tables and DQ checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import try_pct
from ..operators import metrics as M
from ..operators.dq import dq_checks, metric_rows
from ..specs import DqRule
from .gold import GOLD_CUSTOMER_COLUMNS

# ---- fixed values: dashboard datasets and widgets ----
GOLD_PRODUCT_COLUMNS = ["product_id", "product_key", "product_name", "cost", "product_line", "product_start_date",
                        "product_end_date", "category", "subcategory", "maintenance_required",
                        "master_product_name", "master_cost", "master_product_line"]
PRODUCT_DETAIL_COLUMNS = ["product_id", "product_key", "product_name", "cost", "product_line", "category",
                          "subcategory", "maintenance_required"]
UNKNOWN = "Unknown"
# ---- end of fixed values ----

# Our thresholds (the reference documents the checks but publishes neither names nor limits).
CUSTOMER_RULES = [
    DqRule("customer_id_not_null", "customer_id_nulls", 0, 0),
    DqRule("gender_not_null", "gender_nulls", 0, 0),
    DqRule("created_date_not_null", "created_date_nulls", 0, 0),
    DqRule("customer_id_unique", "duplicate_customer_rows", 0, 0),
    DqRule("birth_date_completeness", "birth_date_null_pct", 5, 20),
    DqRule("country_known", "country_unknown_pct", 5, 20),
    DqRule("gender_known", "gender_unknown_pct", 5, 20),
    DqRule("customer_freshness", "days_since_last_customer", 30, 90),
]
PRODUCT_RULES = [
    DqRule("category_completeness", "category_null_pct", 5, 20),
    DqRule("product_master_match", "master_missing_pct", 5, 20),
    DqRule("product_line_known", "product_line_unknown_pct", 5, 20),
]


def gold_customers_dataset(gold_cust: DataFrame) -> DataFrame:
    return gold_cust.select(GOLD_CUSTOMER_COLUMNS)


def gold_products_dataset(gold_sales: DataFrame) -> DataFrame:
    return gold_sales.select(GOLD_PRODUCT_COLUMNS)


def customer_metrics(as_of) -> dict:
    total = F.count(F.lit(1))
    as_of = F.to_date(F.lit(as_of.isoformat() if isinstance(as_of, dt.date) else as_of))
    return {
        "customer_id_nulls": F.count_if(F.col("customer_id").isNull()),
        "gender_nulls": F.count_if(F.col("gender").isNull()),
        "created_date_nulls": F.count_if(F.col("created_date").isNull()),
        "duplicate_customer_rows": F.count(F.col("customer_id")) - F.count_distinct(F.col("customer_id")),
        "birth_date_null_pct": try_pct(F.count_if(F.col("birth_date").isNull()), total, 2),
        "country_unknown_pct": try_pct(F.count_if(F.col("country") == UNKNOWN), total, 2),
        "gender_unknown_pct": try_pct(F.count_if(F.col("gender") == UNKNOWN), total, 2),
        "days_since_last_customer": F.datediff(as_of, F.max("created_date")),
    }


def product_metrics() -> dict:
    total = F.count(F.lit(1))
    return {
        "category_null_pct": try_pct(F.count_if(F.col("category").isNull()), total, 2),
        "master_missing_pct": try_pct(F.count_if(F.col("master_product_name").isNull()), total, 2),
        "product_line_unknown_pct": try_pct(F.count_if(F.col("product_line") == UNKNOWN), total, 2),
    }


def customer_dq(gold_cust: DataFrame, as_of) -> DataFrame:
    return dq_checks(gold_cust, customer_metrics(as_of), CUSTOMER_RULES, "gold_customer_enriched")


def product_dq(gold_sales: DataFrame) -> DataFrame:
    return dq_checks(gold_sales, product_metrics(), PRODUCT_RULES, "gold_sales_denormalized")


def gold_metrics(gold_cust: DataFrame, gold_sales: DataFrame, as_of) -> DataFrame:
    """The day's rows of the metrics history of both gold tables: append them to a table, day by day."""
    day = F.to_date(F.lit(as_of.isoformat() if isinstance(as_of, dt.date) else as_of))
    return metric_rows(gold_cust, customer_metrics(as_of), "gold_customer_enriched", day).unionByName(metric_rows(gold_sales, product_metrics(), "gold_sales_denormalized", day))


def default_thresholds(valid_from: dt.date | None = None) -> list[tuple]:
    """The rules above as rows of a threshold table."""
    return [(table, r.check_name, r.metric, float(r.warn), float(r.fail), valid_from, None)
            for table, rules in (("gold_customer_enriched", CUSTOMER_RULES), ("gold_sales_denormalized", PRODUCT_RULES)) for r in rules]


def dq_checks_gold(gold_cust: DataFrame, gold_sales: DataFrame, as_of) -> DataFrame:
    return customer_dq(gold_cust, as_of).unionByName(product_dq(gold_sales))



def _df(x) -> DataFrame:
    """A DataFrame, or a zero-argument callable producing one (built only when a tile needs it)."""
    return x() if callable(x) else x


def _tiles(gold_cust, gold_sales, selections: dict[str, list] | None, as_of):
    """name -> builder of each dashboard tile (built only when asked for)."""
    cust_all = lambda: gold_customers_dataset(_df(gold_cust))
    cust = lambda: M.filtered(cust_all(), selections)
    prod = lambda: gold_products_dataset(_df(gold_sales))
    by_cust = lambda dim: lambda: M.group_count(cust(), dim, "customer_id", "customer_count")
    by_prod = lambda dim: lambda: M.group_count(prod(), dim, "product_id", "product_count")
    tiles = {
        "kpi_total_customers": lambda: M.kpi(cust(), {"total_customers": F.count("customer_id")}),
        "kpi_total_products": lambda: M.kpi(prod(), {"total_products": F.count("product_id")}),
        "kpi_product_categories": lambda: M.kpi(prod(), {"product_categories": F.count_distinct("category")}),
        "kpi_countries_covered": lambda: M.kpi(cust(), {"countries_covered": F.count_distinct("country")},
                                               where=F.col("country") != F.lit(UNKNOWN)),
        "kpi_average_cost": lambda: M.kpi(prod(), {"average_cost": F.avg("cost")}),
        "customers_by_country": by_cust("country"),
        "customers_by_gender": by_cust("gender"),
        "customers_by_marital": by_cust("marital_status"),
        "products_by_category": by_prod("category"),
        "products_by_line": by_prod("product_line"),
        "products_by_subcategory": by_prod("subcategory"),
        "products_by_maintenance": by_prod("maintenance_required"),
        "customer_detail": lambda: M.detail(cust(), GOLD_CUSTOMER_COLUMNS),
        "product_detail": lambda: M.detail(prod(), PRODUCT_DETAIL_COLUMNS),
        "top10_products_by_cost": lambda: M.top_k(
            prod(), [F.col("cost").desc_nulls_last(), F.col("product_id").asc_nulls_last()], 10,
            ["product_id", "product_key", "product_name", "cost", "category"]),
        "filter_values_country": lambda: M.filter_values(cust_all(), "country", selections),
        "filter_values_gender": lambda: M.filter_values(cust_all(), "gender", selections),
    }
    if as_of is not None:
        tiles["dq_checks_gold"] = lambda: dq_checks_gold(_df(gold_cust), _df(gold_sales), as_of)
    return tiles


TILE_NAMES = tuple(_tiles(None, None, None, "2000-01-01"))


def widget(name: str, gold_cust, gold_sales, selections: dict[str, list] | None = None,
           as_of=None) -> DataFrame:
    """One dashboard tile as a lazy DataFrame (see :func:`widgets`); the gold inputs may be
    DataFrames or zero-argument callables, so a customer tile never plans the sales side."""
    return _tiles(gold_cust, gold_sales, selections, as_of)[name]()


def widgets(gold_cust: DataFrame, gold_sales: DataFrame, selections: dict[str, list] | None = None,
            as_of=None) -> dict[str, DataFrame]:
    """Every tile of the gold dashboard as a lazy DataFrame.

    In production pass the *written* gold tables (``spark.table(...)``): each
    tile is then one scan of a gold table plus one small aggregate.  The global
    multi-select filters (country, gender) apply to the customer dataset only,
    as in the dashboard definition; the filter lists themselves count rows that
    satisfy the *other* active filter.
    """
    return {name: build() for name, build in _tiles(gold_cust, gold_sales, selections, as_of).items()}
