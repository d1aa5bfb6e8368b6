"""Parquet table access for a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TableSet:
    """Lazily opened parquet tables of one folder; each read is a pruned, pushed-down scan."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")
        self._dfs: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.parquet(f"{self.base_dir}/{name}.parquet")
        return self._dfs[name]

    def derived(self, name: str, build) -> DataFrame:
        """A DataFrame derived from these tables, planned once per table set."""
        key = f"derived:{name}"
        if key not in self._dfs:
            self._dfs[key] = build()
        return self._dfs[key]
