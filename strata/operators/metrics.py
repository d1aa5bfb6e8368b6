"""Dashboard-style metrics over gold tables: KPIs, grouped counts, filters, top-k, detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kpi(df: DataFrame, measures: dict[str, Column], where: Column | None = None) -> DataFrame:
    """One-row KPI tile(s): ``measures`` evaluated over the (filtered) rows in one aggregate."""
    if where is not None:
        df = df.where(where)
    return df.agg(*[m.alias(n) for n, m in measures.items()])


def group_count(df: DataFrame, dim: str, measure: str, name: str) -> DataFrame:
    """Bar / pie widget: ``dim, COUNT(measure)`` (NULL measure values are not counted)."""
    return df.groupBy(dim).agg(F.count(F.col(measure)).alias(name))


def selection_predicate(selections: dict[str, list] | None) -> Column:
    """AND of ``col IN (values)`` over the active multi-select filters; an empty selection means all."""
    pred = F.lit(True)
    for c, values in (selections or {}).items():
        if values:
            pred = pred & F.col(c).isin(*values)
    return pred


def filtered(df: DataFrame, selections: dict[str, list] | None) -> DataFrame:
    return df.where(selection_predicate(selections))


def filter_values(df: DataFrame, col: str, selections: dict[str, list] | None = None,
                  name: str | None = None) -> DataFrame:
    """Values offered by a multi-select filter with the rows each keeps under the *other*
    active filters (``COUNT_IF(predicate)``); values with zero matches stay listed."""
    others = {c: v for c, v in (selections or {}).items() if c != col}
    pred = F.coalesce(selection_predicate(others), F.lit(False))
    return df.groupBy(col).agg(F.count_if(pred).alias(name or f"{col}_associativity"))


def top_k(df: DataFrame, order: list[Column], k: int, cols: list[str] | None = None) -> DataFrame:
    """Top-k rows by a total order (planned as ``TakeOrderedAndProject``: per-partition heaps, k rows shuffled)."""
    out = df.orderBy(*order).limit(k)
    return out.select(cols) if cols else out


def detail(df: DataFrame, cols: list[str]) -> DataFrame:
    """Disaggregated table widget: a plain projection."""
    return df.select(cols)
