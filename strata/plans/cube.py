"""The dashboard's tiles from precomputed cubes.

A cube holds the measures of one gold dataset for every combination of its dimensions, and for every subset of them, marked by ``level``: the
sorted names of the dimensions that a row is grouped by.  Its size follows the number of distinct combinations, not of rows, so a tile
under any filter selection reads a few rows instead of scanning the dataset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dashboard import UNKNOWN

# ---- fixed values: dimensions of the two dashboard datasets ----
CUSTOMER_DIMS = ["country", "gender", "marital_status"]
PRODUCT_DIMS = ["category", "subcategory", "product_line", "maintenance_required"]
# ---- end of fixed values ----


def cube(df: DataFrame, dims: list[str], measures: dict[str, Column]) -> DataFrame:
    """``level``, the dimensions and the measures of every subset of ``dims``; a NULL in a dimension of the level is a value of its own.

    Measures must add up over groups (counts, sums), as tiles sum them over the cells of a selection.
    """
    marks = [F.grouping(d).alias(f"__{d}") for d in dims]
    all_sets = df.cube(*dims).agg(*marks, *(m.alias(k) for k, m in measures.items()))
    level = F.concat_ws(",", *(F.when(F.col(f"__{d}") == 0, F.lit(d)) for d in sorted(dims)))
    return all_sets.select(level.alias("level"), *dims, *measures)


def customer_cube(gold_cust: DataFrame) -> DataFrame:
    return cube(gold_cust, CUSTOMER_DIMS, {"customer_count": F.count("customer_id"), "row_count": F.count(F.lit(1))})


def product_cube(gold_sales: DataFrame) -> DataFrame:
    return cube(gold_sales, PRODUCT_DIMS, {"product_count": F.count("product_id"), "row_count": F.count(F.lit(1)),
                                           "cost_sum": F.sum(F.col("cost").cast("bigint")), "cost_count": F.count("cost")})


def cells(cube_df: DataFrame, dims: list[str], selections: dict[str, list] | None = None) -> DataFrame:
    """The cells grouped by ``dims`` and the filtered dimensions, within the selection (a NULL value is in no selection).

    An empty list of values selects all, as in the dashboard's filters.
    """
    chosen = {d: v for d, v in (selections or {}).items() if v}
    out = cube_df.where(F.col("level") == ",".join(sorted({*dims, *chosen})))
    for d, values in chosen.items():
        out = out.where(F.col(d).isin(values))
    return out


def group_tile(cube_df: DataFrame, dim: str, measure: str, selections: dict[str, list] | None = None) -> DataFrame:
    """Rows of a distribution tile: ``dim`` and the measure, under a selection."""
    return cells(cube_df, [dim], selections).groupBy(dim).agg(F.sum(measure).alias(measure))


def total_tile(cube_df: DataFrame, measure: str, name: str, selections: dict[str, list] | None = None) -> DataFrame:
    """A total as one row, 0 where nothing is selected."""
    return cells(cube_df, [], selections).agg(F.coalesce(F.sum(measure), F.lit(0)).alias(name))


def distinct_tile(cube_df: DataFrame, dim: str, name: str, selections: dict[str, list] | None = None, without: str | None = None) -> DataFrame:
    """How many values of ``dim`` (NULL and ``without`` not counted) the selection holds: exact, as the cube lists them."""
    out = cells(cube_df, [dim], selections)
    return out.agg(F.count_distinct(F.col(dim) if without is None else F.when(F.col(dim) != without, F.col(dim))).alias(name))


def tiles(customers: DataFrame, products: DataFrame, selections: dict[str, list] | None = None) -> dict[str, DataFrame]:
    """Every KPI and distribution tile of the dashboard from the two cubes; the filters apply to the customers, as in the dashboard."""
    selections = {d: v for d, v in (selections or {}).items() if d in CUSTOMER_DIMS}
    average = cells(products, []).agg(F.try_divide(F.sum("cost_sum").cast("double"), F.sum("cost_count").cast("double")).alias("average_cost"))
    out = {
        "kpi_total_customers": total_tile(customers, "customer_count", "total_customers", selections),
        "kpi_total_products": total_tile(products, "product_count", "total_products"),
        "kpi_product_categories": distinct_tile(products, "category", "product_categories"),
        "kpi_countries_covered": distinct_tile(customers, "country", "countries_covered", selections, without=UNKNOWN),
        "kpi_average_cost": average,
    }
    for name, dim in (("customers_by_country", "country"), ("customers_by_gender", "gender"), ("customers_by_marital", "marital_status")):
        out[name] = group_tile(customers, dim, "customer_count", selections)
    for name, dim in (("products_by_category", "category"), ("products_by_line", "product_line"), ("products_by_subcategory", "subcategory"), ("products_by_maintenance", "maintenance_required")):
        out[name] = group_tile(products, dim, "product_count")
    for dim in ("country", "gender"):
        out[f"filter_values_{dim}"] = filter_values_tile(customers, dim, selections)
    return out


def filter_values_tile(cube_df: DataFrame, dim: str, selections: dict[str, list] | None = None) -> DataFrame:
    """The list of a filter: every value of ``dim`` with the rows that the other filters leave of it; values without any stay listed."""
    others = {d: v for d, v in (selections or {}).items() if v and d != dim}
    kept = F.lit(True)
    for d, values in others.items():
        kept = kept & F.coalesce(F.col(d).isin(values), F.lit(False))
    level = cube_df.where(F.col("level") == ",".join(sorted({dim, *others})))
    return level.groupBy(dim).agg(F.sum(F.when(kept, F.col("row_count")).otherwise(0)).alias(f"{dim}_associativity"))


def tiles_long(customers: DataFrame, products: DataFrame, selections: dict[str, list] | None = None) -> DataFrame:
    """``tile, item, value`` of every tile: a KPI has the item NULL, a distribution one row for each value of its dimension."""
    out = None
    for name, tile in tiles(customers, products, selections).items():
        *item, value = tile.columns
        one = tile.select(F.lit(name).alias("tile"), (F.col(item[0]) if item else F.lit(None)).cast("string").alias("item"), F.col(value).cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out
