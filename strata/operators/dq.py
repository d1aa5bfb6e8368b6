"""Threshold-based data-quality checks with PASS / WARN / FAIL status.

All metrics of one table come from a single aggregate; the one-row result is
reshaped with ``stack`` and the thresholds are attached as literals, so a DQ
report is one scan per table and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import sql_str
from ..specs import DqRule


def status(value: Column, warn: Column, fail: Column) -> Column:
    """FAIL above ``fail``, WARN above ``warn``, PASS otherwise; an undefined metric is WARN."""
    return (F.when(value.isNull(), F.lit("WARN"))
            .when(value > fail, F.lit("FAIL"))
            .when(value > warn, F.lit("WARN"))
            .otherwise(F.lit("PASS")))


def dq_checks(df: DataFrame, metrics: dict[str, Column], rules: list[DqRule], table: str) -> DataFrame:
    """(table_name, check_name, metric_value, warn_threshold, fail_threshold, status)."""
    names = {m: f"m{i}" for i, m in enumerate(metrics)}
    wide = df.agg(*[e.cast("double").alias(names[m]) for m, e in metrics.items()])
    parts = ", ".join(
        f"{sql_str(r.check_name)}, {names[r.metric]}, CAST({float(r.warn)!r} AS DOUBLE), CAST({float(r.fail)!r} AS DOUBLE)"
        for r in rules)
    long = wide.selectExpr(
        f"stack({len(rules)}, {parts}) AS (check_name, metric_value, warn_threshold, fail_threshold)")
    return long.select(
        F.lit(table).alias("table_name"), "check_name", "metric_value", "warn_threshold", "fail_threshold",
        status(F.col("metric_value"), F.col("warn_threshold"), F.col("fail_threshold")).alias("status"))


THRESHOLDS = "table_name string, check_name string, metric string, warn_threshold double, fail_threshold double, valid_from date, valid_to date"


def metric_rows(df: DataFrame, metrics: dict[str, Column], table: str, measured_on: Column) -> DataFrame:
    """(table_name, metric, metric_value, measured_on): the metrics of one table as rows of a history, from one aggregate."""
    wide = df.agg(*[e.cast("double").alias(f"m{i}") for i, e in enumerate(metrics.values())])
    stack = ", ".join(f"{sql_str(m)}, m{i}" for i, m in enumerate(metrics))
    return wide.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, metric_value)").select(F.lit(table).alias("table_name"), "metric", "metric_value", measured_on.alias("measured_on"))


def judged_history(history: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every measurement under the thresholds that were valid on its day: (table_name, check_name, measured_on, metric_value, warn_threshold, fail_threshold, status).

    ``thresholds`` (see ``THRESHOLDS``) are rows, valid from ``valid_from`` until the day before ``valid_to`` (NULL: open).  A measurement without a valid
    threshold is in no check.  The join is on table and metric with the validity as a range within it: both sides are small, as a history has a row for
    each metric and day.
    """
    t = thresholds.select("table_name", "check_name", "metric", "warn_threshold", "fail_threshold", "valid_from", "valid_to")
    valid = (F.col("measured_on") >= F.coalesce("valid_from", "measured_on")) & (F.col("valid_to").isNull() | (F.col("measured_on") < F.col("valid_to")))
    return history.join(t, ["table_name", "metric"]).where(valid).select(
        "table_name", "check_name", "measured_on", "metric_value", "warn_threshold", "fail_threshold",
        status(F.col("metric_value"), F.col("warn_threshold"), F.col("fail_threshold")).alias("status"))
