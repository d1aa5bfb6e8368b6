"""Data-quality profiling: every report is one scan (plus one shuffle where it groups).

The reference pattern of one job per printed number (a loop of ``count()``
calls per column) is replaced by single wide aggregates that are reshaped with
``stack`` afterwards; reshaping one row costs nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import has_whitespace, quote_ident, sql_str, string_columns

DATE_FLOOR = "1900-01-01"


def _date_lit(d) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.to_date(F.lit(d))


def _count_if(cond: Column | str) -> Column:
    """count_if with NULL treated as false; a SQL-text condition is built in one call."""
    if isinstance(cond, str):
        return F.expr(f"count_if(coalesce({cond}, false))")
    return F.count_if(F.coalesce(cond, F.lit(False)))


def profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Wide one-row profile: total_rows, <c>_nulls for every column, <c>_empty and
    <c>_has_whitespace for every string column (one global aggregate, one scan)."""
    cols = df.columns if cols is None else cols
    strings = [c for c in string_columns(df) if c in cols]
    q = quote_ident
    exprs = ["count(1) AS total_rows"]
    exprs += [f"count_if({q(c)} IS NULL) AS {q(c + '_nulls')}" for c in cols]
    exprs += [f"count_if(coalesce({q(c)} = '', false)) AS {q(c + '_empty')}" for c in strings]
    exprs += [f"count_if(coalesce({q(c)} != trim({q(c)}), false)) AS {q(c + '_has_whitespace')}" for c in strings]
    return df.selectExpr(*exprs)


def profile_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Same single pass, one row per column: (column_name, total_rows, nulls, empties, whitespace)."""
    cols = df.columns if cols is None else cols
    strings = set(string_columns(df))
    wide = profile(df, cols)
    q = quote_ident
    parts = []
    for c in cols:
        e = q(c + "_empty") if c in strings else "CAST(NULL AS BIGINT)"
        w = q(c + "_has_whitespace") if c in strings else "CAST(NULL AS BIGINT)"
        parts.append(f"{sql_str(c)}, {q(c + '_nulls')}, {e}, {w}")
    return wide.selectExpr(
        f"stack({len(cols)}, {', '.join(parts)}) AS (column_name, nulls, empties, whitespace)", "total_rows"
    ).select("column_name", "total_rows", "nulls", "empties", "whitespace")


def null_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, nulls) for every column in one pass."""
    cols = df.columns if cols is None else cols
    wide = df.selectExpr(*[f"count_if({quote_ident(c)} IS NULL) AS n{i}" for i, c in enumerate(cols)])
    stack = ", ".join(f"{sql_str(c)}, n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, nulls)")


def _not_null(keys) -> Column:
    return F.expr(" AND ".join(f"{quote_ident(k)} IS NOT NULL" for k in keys))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """(keys..., copies) for every non-NULL key value occurring more than once.

    ``groupBy`` runs a map-side partial count, so a hot key is pre-aggregated
    before the shuffle (one row per map task), never gathered in one reducer.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.where(_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def duplicate_check(df: DataFrame, checks: dict[str, list[str] | str]) -> DataFrame:
    """(check_name, dup_count): number of key values occurring more than once, per key.

    Each check is its own pruned scan of just its key column(s) and one
    pre-aggregated shuffle; the checks are unioned.
    """
    out = None
    for name, keys in checks.items():
        one = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("dup_count")).select(
            F.lit(name).alias("check_name"), "dup_count")
        out = one if out is None else out.unionByName(one)
    return out


def category_distribution(df: DataFrame, cols: list[str], ordered: bool = True) -> DataFrame:
    """(column_name, value, count) over several columns: one scan, unpivot, one grouped count.
    NULL is its own group."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column_name", "kv.value")
    out = stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    if ordered:
        out = out.orderBy(F.col("column_name"), F.col("count").desc(), F.col("value").asc_nulls_first())
    return out


def value_counts(df: DataFrame, col: str, count_col: str = "count", ordered: bool = True) -> DataFrame:
    """(col, count) descending by count; value breaks ties."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    if ordered:
        out = out.orderBy(F.col(count_col).desc(), F.col(col).asc_nulls_first())
    return out


def date_range(df: DataFrame, col: str, *, label: str = "date", plural: str | None = None,
               as_of=None, floor: str | None = DATE_FLOOR, future: bool = True,
               approx_distinct: float | None = None) -> list[Column]:
    """Aggregate columns describing one date column (to be combined in one ``agg``).

    ``approx_distinct`` (a relative standard deviation, e.g. 0.01) swaps the exact
    distinct count, which needs its own distinct aggregation, for a HyperLogLog++
    sketch that merges map-side in fixed memory."""
    plural = plural or f"{label}s"
    c = F.col(col)
    distinct = (F.approx_count_distinct(c, approx_distinct) if approx_distinct else F.count_distinct(c))
    aggs = [F.min(c).alias(f"earliest_{label}"), F.max(c).alias(f"latest_{label}"),
            distinct.alias(f"distinct_{plural}")]
    if future:
        aggs.append(_count_if(c > _date_lit(as_of)).alias(f"future_{plural}"))
    if floor is not None:
        aggs.append(_count_if(c < _date_lit(floor)).alias(f"pre_1900_{plural}"))
    return aggs


def date_profile(df: DataFrame, col: str, *, as_of=None, end_col: str | None = None,
                 approx_distinct: float | None = None) -> DataFrame:
    """One-row date-range report; with ``end_col`` also the end column and end-before-start count."""
    if end_col is None:
        return df.agg(*date_range(df, col, as_of=as_of, approx_distinct=approx_distinct))
    aggs = date_range(df, col, label="start", plural="start_dates", as_of=as_of, approx_distinct=approx_distinct)
    aggs += date_range(df, end_col, label="end", plural="end_dates", future=False, floor=None,
                       approx_distinct=approx_distinct)
    aggs.append(_count_if(F.col(end_col).isNotNull() & (F.col(end_col) < F.col(col))).alias("end_before_start"))
    return df.agg(*aggs)


def duplicate_rows(df: DataFrame, keys, order_by: list[str] | None = None) -> DataFrame:
    """Every copy of every duplicated key.

    Duplicated keys come from a pre-aggregated ``groupBy`` and are matched back
    with a left-semi join (AQE splits a skewed key on the probe side); a
    whole-group window would gather a hot key's rows in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    dups = duplicate_keys(df, keys).select(*keys)
    out = df.join(dups, on=keys, how="left_semi")
    if order_by:
        out = out.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return out


def dup_summary(df: DataFrame, keys) -> DataFrame:
    """(duplicate_rows, distinct_duplicate_keys): all copies of duplicated keys and their key count."""
    return duplicate_keys(df, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_duplicate_keys"))


def duplicate_column_diff(df: DataFrame, keys) -> DataFrame:
    """(column_name, groups_with_mismatch): in how many duplicate-key groups each column differs.

    A column differs inside a group when min != max, or when it is NULL in some
    copies and not in others.  All algebraic aggregates: partial aggregation
    before the shuffle, so group size does not matter.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    q = quote_ident
    per_group = [F.expr(f"CAST(coalesce(min({q(c)}) != max({q(c)}) OR (count({q(c)}) > 0 AND count({q(c)}) < count(1)),"
                        f" false) AS INT)").alias(f"d{i}") for i, c in enumerate(rest)]
    groups = (df.where(_not_null(keys)).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("__copies"), *per_group).where(F.col("__copies") > 1))
    wide = groups.selectExpr(*[f"CAST(coalesce(sum(d{i}), 0) AS BIGINT) AS d{i}" for i in range(len(rest))])
    stack = ", ".join(f"{sql_str(c)}, d{i}" for i, c in enumerate(rest))
    return wide.selectExpr(f"stack({len(rest)}, {stack}) AS (column_name, groups_with_mismatch)")


def whitespace_rows_count(df: DataFrame, cols: list[str] | None = None, name: str = "rows_with_whitespace") -> DataFrame:
    """One-row count of rows with leading/trailing spaces in any of ``cols`` (default: all strings)."""
    cols = string_columns(df) if cols is None else cols
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(has_whitespace(c), F.lit(False))
    return df.agg(_count_if(cond).alias(name))


def key_audit(df: DataFrame, keys) -> DataFrame:
    """One pass: rows, NULL-key rows and distinct non-NULL keys of an input.

    From these three numbers every row count that the cleaning pipeline should have
    follows (dedupe keeps one row per distinct key, NULL-key rows are dropped).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    nn = _not_null(keys)
    return df.agg(F.count(F.lit(1)).alias("rows_in"),
                  _count_if(~nn).alias("null_key_rows"),
                  F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"))


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable, non_null_rows): the schema joined with one
    pass of per-column non-NULL counts (a ``printSchema`` that also says how full each column is)."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])
    parts = ", ".join(
        f"{i + 1}, {sql_str(f.name)}, {sql_str(f.dataType.simpleString())}, {str(f.nullable).lower()}, n{i}"
        for i, f in enumerate(fields))
    return wide.selectExpr(
        f"stack({len(fields)}, {parts}) AS (position, column_name, data_type, nullable, non_null_rows)")
