"""Enrichment: guarded left joins on derived keys, fallbacks and coverage.

Join strategy is the planner's: it broadcasts a side by its size in bytes, and AQE converts or splits
shuffle joins at run time.  Nothing is hinted, and building a plan starts no job.

Hot keys: in a shuffle join every row whose join key is NULL hashes to the
same reducer.  Such rows can never match, so they are spread with a salt that
is part of the equi-join key: a hash of the row for rows without a key, a hash
of the key itself for rows with one (on both sides, so salts agree exactly when
keys do, and the salt never folds to a constant that Catalyst would demote to a
residual filter).  Same result, no single hot task, whatever share of rows
lacks a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import quote_ident, sql_str, try_pct

def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    return True


def null_key_salt(df: DataFrame, key: str) -> Column:
    """Hash of the key for rows with one; hash of the row's hashable columns for rows without
    (spreads them; map columns cannot be hashed and are left out)."""
    cols = ", ".join(quote_ident(f.name) for f in df.schema.fields if _hashable(f.dataType))
    k = quote_ident(key)
    return F.expr(f"CASE WHEN {k} IS NULL THEN xxhash64({cols}) ELSE xxhash64({k}) END")


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """``left <how> right`` on ``key`` (USING semantics: the key column is the left one),
    with NULL left keys salted so they do not gather in one shuffle partition."""
    l = left.withColumn("__salt", null_key_salt(left, key))
    r = right.withColumnRenamed(key, "__rkey")
    r = r.withColumn("__rsalt", null_key_salt(r, "__rkey"))
    out = l.join(r, F.expr(f"{quote_ident(key)} = __rkey AND __salt = __rsalt"), how)
    return out.drop("__salt", "__rkey", "__rsalt") if how not in ("left_anti", "left_semi") else out.drop("__salt")


def guard_unique(right: DataFrame, key: str, on_duplicate: str) -> DataFrame:
    """Right-side key uniqueness policy.

    * ``fanout`` — plain join; a duplicated key multiplies left rows (reference behaviour).
    * ``first``  — keep one row per key (smallest by all columns: deterministic).
    * ``error``  — raise before the join runs if any key repeats (one pre-aggregated
      ``groupBy`` on the right side; its NULL keys never match and are ignored).
    """
    if on_duplicate == "fanout":
        return right
    if on_duplicate == "first":
        rest = [F.col(c).asc_nulls_last() for c in right.columns if c != key]
        w = Window.partitionBy(key).orderBy(*rest) if rest else Window.partitionBy(key).orderBy(key)
        return (right.where(F.col(key).isNotNull()).withColumn("__rn", F.row_number().over(w))
                .where("__rn = 1").drop("__rn"))
    if on_duplicate == "error":
        # Fail fast, before the (large) join runs: one pre-aggregated count per key on the
        # right side (map-side combine, so a key with a third of the rows is no hot task).
        dups = (right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
                .where(F.col("copies") > 1))
        sample = dups.select(key).take(5)
        if sample:
            raise ValueError(f"duplicate join key in {key}: {[r[0] for r in sample]}")
        return right
    raise ValueError(f"on_duplicate must be fanout, first or error, not {on_duplicate!r}")


def enrich(left: DataFrame, right: DataFrame, key: str, *, left_key: Column | None = None,
           on_duplicate: str = "fanout", spread_null_keys: bool = True, drop_key: bool = False) -> DataFrame:
    """``left ⟕ right USING (key)``; ``left_key`` derives the key column on the left first.

    ``spread_null_keys`` salts rows without a key (see the module text); off, tables bucketed by the key join without an exchange.
    """
    if left_key is not None:
        left = left.withColumn(key, left_key)
    right = guard_unique(right, key, on_duplicate)
    out = salted_join(left, right, key, "left") if spread_null_keys else left.join(right, on=key, how="left")
    return out.drop(key) if drop_key else out


def unmatched(left: DataFrame, right: DataFrame, key: str, *, left_key: Column | None = None) -> DataFrame:
    """Left rows whose (derived) key has no partner on the right (NULL keys included)."""
    if left_key is not None:
        left = left.withColumn(key, left_key)
    return salted_join(left, right.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def fallback(df: DataFrame, target: str, source: str, when_value: str = "Unknown") -> DataFrame:
    """``target := source`` when target is the sentinel and source is known; NULL target stays NULL."""
    t, src = quote_ident(target), quote_ident(source)
    return df.withColumn(target, F.expr(
        f"CASE WHEN {t} = {sql_str(when_value)} AND {src} IS NOT NULL THEN {src} ELSE {t} END"))


def coverage(df: DataFrame, cols: list[str], digits: int = 1) -> DataFrame:
    """Per column: non-NULL rows, total rows and the percentage (one pass, long form)."""
    total = F.count(F.lit(1)).alias("total_rows")
    aggs = [total] + [F.count(F.col(c)).alias(f"m_{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{sql_str(c)}, m_{i}" for i, c in enumerate(cols))
    return (wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, matched_rows)", "total_rows")
            .withColumn("coverage_pct", try_pct(F.col("matched_rows"), F.col("total_rows"), digits)))


def known_coverage(df: DataFrame, unknown: dict[str, str | None], digits: int = 1) -> DataFrame:
    """Per column: non-NULL rows, rows whose value is known (not NULL and not the column's sentinel), all rows and both percentages (one pass)."""
    total = F.count(F.lit(1)).alias("total_rows")
    known = [F.count_if(F.col(c).isNotNull() & (F.lit(True) if mark is None else F.col(c) != F.lit(mark))).alias(f"k_{i}") for i, (c, mark) in enumerate(unknown.items())]
    wide = df.agg(total, *(F.count(F.col(c)).alias(f"m_{i}") for i, c in enumerate(unknown)), *known)
    stack = ", ".join(f"{sql_str(c)}, m_{i}, k_{i}" for i, c in enumerate(unknown))
    long = wide.selectExpr(f"stack({len(unknown)}, {stack}) AS (column_name, matched_rows, known_rows)", "total_rows")
    return long.select("column_name", "matched_rows", "known_rows", "total_rows", try_pct(F.col("matched_rows"), F.col("total_rows"), digits).alias("coverage_pct"),
                       try_pct(F.col("known_rows"), F.col("total_rows"), digits).alias("known_pct"))
