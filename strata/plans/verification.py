"""Verification report of a table: schema, row count and distributions, from one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the distributions that are shown for each gold table ----
GOLD_DISTRIBUTIONS = {"gold_customer_enriched": ["country", "gender"], "gold_sales_denormalized": ["product_line", "category"]}
# ---- end of fixed values ----


def schema_lines(df: DataFrame, name: str) -> DataFrame:
    """One row a column: ``item`` is ``<column> <type>``, ``value`` its place from 1.  Metadata only."""
    rows = [(name, "schema", f"{f.name} {f.dataType.simpleString()}", i) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "table_name string, section string, item string, value bigint")


def table_report(df: DataFrame, name: str, dims: list[str], ordered: bool = True) -> DataFrame:
    """``table_name, section, item, value``: schema lines, the row count (section ``rows``) and the rows of every value of each of ``dims``.

    Counts come from one pass with grouping sets: one for the total and one for each dimension, partly counted before the shuffle.  A NULL
    value is an item of its own (NULL); a table without rows has its schema and a count of 0.  Ordered by section, then value descending,
    then item.
    """
    keys = [f"d{i}" for i in range(len(dims))]
    cut = df.select(F.lit(1).alias("one"), *(F.col(f"`{d}`").cast("string").alias(k) for d, k in zip(dims, keys)))
    # grouping() is 0 in the rows of the set that a column stands in; the first set is the total
    marks = [F.grouping(k).alias(f"g{k}") for k in keys]
    counted = cut.groupingSets([["one"], *([k] for k in keys)], "one", *keys).agg(F.count(F.lit(1)).alias("value"), *marks)
    section, item = F.lit("rows"), F.lit(None).cast("string")
    for d, k in zip(dims, keys):
        section, item = F.when(F.col(f"g{k}") == 0, d).otherwise(section), F.when(F.col(f"g{k}") == 0, F.col(k)).otherwise(item)
    counts = counted.select(F.lit(name).alias("table_name"), section.alias("section"), item.alias("item"), "value")
    # a table without rows has no group: its count of 0 comes from the schema's side of the union
    zero = df.sparkSession.createDataFrame([(name, "rows", None, 0)], "table_name string, section string, item string, value bigint")
    counts = counts.unionByName(zero).groupBy("table_name", "section", "item").agg(F.max("value").alias("value"))
    out = schema_lines(df, name).unionByName(counts)
    if ordered:
        lead = F.when(F.col("section") == "schema", 0).when(F.col("section") == "rows", 1).otherwise(2)
        out = out.orderBy(lead, "section", F.when(F.col("section") == "schema", F.col("value")), F.col("value").desc(), F.col("item").asc_nulls_first())
    return out


def gold_report(gold_cust: DataFrame, gold_sales: DataFrame) -> DataFrame:
    """The reports of both gold tables; pass the written tables, so that each is one scan."""
    out = None
    for (name, dims), df in zip(GOLD_DISTRIBUTIONS.items(), (gold_cust, gold_sales)):
        one = table_report(df, name, dims, ordered=False)
        out = one if out is None else out.unionByName(one)
    return out
