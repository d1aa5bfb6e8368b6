"""A lazily built view of one data folder through the layers.

``Workspace`` hands out bronze-shaped inputs (derived from the driver tables),
silver and gold DataFrames.  Nothing is computed until an action runs; the
objects are cached only as *plans*, so every query is still a single Spark job
graph that Catalyst optimises end to end.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import fixture
from ..sources.tables import TableSet
from . import gold, silver


class Workspace:
    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.tables = TableSet(spark, data_dir)

    # ---- bronze-shaped inputs
    @cached_property
    def bronze_cust(self) -> DataFrame:
        return fixture(self.tables, "fx_cust_info")

    @cached_property
    def bronze_prd(self) -> DataFrame:
        return fixture(self.tables, "fx_prd_info")

    @cached_property
    def bronze_sales(self) -> DataFrame:
        return fixture(self.tables, "fx_sales_details")

    @cached_property
    def erp_cust(self) -> DataFrame:
        return fixture(self.tables, "fx_erp_cust")

    @cached_property
    def erp_loc(self) -> DataFrame:
        return fixture(self.tables, "fx_erp_loc")

    @cached_property
    def erp_cat(self) -> DataFrame:
        return fixture(self.tables, "fx_px_cat")

    @property
    def lineitem(self) -> DataFrame:
        return self.tables["lineitem"]

    # ---- silver
    @cached_property
    def silver_cust(self) -> DataFrame:
        return silver.silver_customer(self.bronze_cust)

    @cached_property
    def silver_prd(self) -> DataFrame:
        return silver.silver_product(self.bronze_prd)

    @cached_property
    def silver_sls(self) -> DataFrame:
        return silver.silver_sales(self.bronze_sales)

    # ---- gold
    @cached_property
    def gold_cust(self) -> DataFrame:
        return gold.gold_customer(self.silver_cust, self.erp_cust, self.erp_loc)

    @cached_property
    def gold_sales(self) -> DataFrame:
        return gold.gold_sales(self.silver_sls, self.silver_prd, self.erp_cat)
