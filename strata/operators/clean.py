"""Cleaning operators: trim, dedupe, NULL handling, code standardisation, renaming.

Order used by the silver pipelines: trim -> dedupe -> NULL handling -> recode -> rename.
Each step is a projection or one window; Catalyst collapses consecutive
projections, so a whole silver table is one scan, one shuffle (the dedupe) and
one write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import has_whitespace, null_flag_count, quote_ident, recode_expr, string_columns
from ..specs import EntitySpec, Recode


def trim_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trim every string column (or ``cols``), pass other columns through, keep order."""
    targets = set(string_columns(df) if cols is None else cols)
    return df.selectExpr(*[f"trim({quote_ident(c)}) AS {quote_ident(c)}" if c in targets else quote_ident(c)
                           for c in df.columns])


def rows_with_whitespace(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows where any string column has leading/trailing spaces (OR over columns)."""
    cols = string_columns(df) if cols is None else cols
    cond = None
    for c in cols:
        # NULL-safe: a NULL column must not turn the whole OR into NULL
        term = F.coalesce(has_whitespace(c), F.lit(False))
        cond = term if cond is None else (cond | term)
    return df.where(cond) if cond is not None else df.limit(0)


def with_null_count(df: DataFrame, cols, name: str = "null_count") -> DataFrame:
    return df.withColumn(name, null_flag_count(cols))


def dedupe_order(df: DataFrame, key: tuple[str, ...], order_col: str | None,
                 score_cols: tuple[str, ...] | None = None) -> list[Column]:
    """Total order inside a key group: latest ``order_col`` (NULLs last), fewest NULLs,
    then every remaining column ascending (NULLs last) so ties never depend on
    input order or partitioning."""
    rest = [c for c in df.columns if c not in key]
    score = list(score_cols) if score_cols is not None else rest
    order: list[Column] = []
    if order_col is not None:
        order.append(F.desc_nulls_last(order_col))
    order.append(null_flag_count(score).asc())
    order += [F.asc_nulls_last(c) for c in rest if c != order_col]
    return order


def dedupe_latest(df: DataFrame, key, order_col: str | None = None, score_cols=None,
                  keep_null_keys: bool = False) -> DataFrame:
    """One row per key: latest ``order_col``, then most complete, then deterministic tie-break.

    NULL keys are filtered *before* the window (they would all hash to one
    reducer); with ``keep_null_keys`` they are re-attached from the input, not
    from the ranked set, so the plan keeps a single window.  The ``rn = 1``
    filter sits directly on the window, which lets Catalyst insert a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most one
    row per key, so a key holding a third of the table costs one row per task in
    the exchange, not a third of the table in one reducer.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    not_null = F.expr(" AND ".join(f"{quote_ident(k)} IS NOT NULL" for k in key))
    w = Window.partitionBy(*key).orderBy(*dedupe_order(df, key, order_col, score_cols))
    kept = (
        df.where(not_null)
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__rn")
    )
    if keep_null_keys:
        kept = kept.unionByName(df.where(~not_null))
    return kept


def null_key_rows(df: DataFrame, key) -> DataFrame:
    key = (key,) if isinstance(key, str) else tuple(key)
    cond = None
    for k in key:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def drop_null_key(df: DataFrame, key) -> DataFrame:
    key = (key,) if isinstance(key, str) else tuple(key)
    for k in key:
        df = df.where(F.col(k).isNotNull())
    return df


def fill_nulls(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """NULL -> value per column, types kept (an INT column filled with 0 stays INT)."""
    return df.na.fill(fills) if fills else df


def blank_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """'' -> NULL in string columns (run after trim, so blank-only values are caught too)."""
    cols = string_columns(df) if cols is None else cols
    return df.withColumns({c: F.when(F.col(c) == F.lit(""), F.lit(None).cast("string")).otherwise(F.col(c))
                           for c in cols})


def recode(df: DataFrame, rules: dict[str, Recode]) -> DataFrame:
    if not rules:
        return df
    return df.withColumns({c: recode_expr(c, r) for c, r in rules.items()})


def rename(df: DataFrame, renames: dict[str, str], keep_others: bool = False) -> DataFrame:
    """Rename and order columns as listed in ``renames``."""
    cols = [f"{quote_ident(old)} AS {quote_ident(new)}" for old, new in renames.items()]
    if keep_others:
        cols += [quote_ident(c) for c in df.columns if c not in renames]
    return df.selectExpr(*cols)


def date_order_violations(df: DataFrame, start_col: str, end_col: str,
                          order_by: str | None = None, distance_name: str = "days_end_before_start") -> DataFrame:
    """Rows whose end date is before the start date, with the distance in days."""
    out = df.where(F.col(end_col).isNotNull() & (F.col(end_col) < F.col(start_col))).withColumn(
        distance_name, F.datediff(F.col(start_col), F.col(end_col)))
    return out.orderBy(order_by) if order_by else out


def clean_entity(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The full silver cleaning of one entity, driven by its spec."""
    trimmed = trim_strings(df)
    if spec.blank_as_null:
        trimmed = blank_to_null(trimmed)
    deduped = dedupe_latest(trimmed, spec.key, spec.order_col, spec.score_cols,
                            keep_null_keys=spec.keep_null_keys)
    filled = fill_nulls(deduped, dict(spec.fills))
    coded = recode(filled, dict(spec.recodes))
    return rename(coded, spec.rename_map) if spec.renames else coded
