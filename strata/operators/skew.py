"""Left joins that survive hot keys: a frequency sketch finds them, one split keeps them out of the ordinary join.

``enrich_chain`` runs a chain of left joins whose keys all derive from one source column.  Rows without a source value go past the joins;
rows of the few heavy values are dealt over ``salts`` tasks against as many copies of their few matches; all others take the plain joins,
which read tables bucketed by the key without an exchange.  The heavy values come from a mergeable sketch that is part of the same plan, so
nothing runs while a plan is built and no count reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import quote_ident
from .enrich import guard_unique

SHARE = 0.01     # of all rows with a key: at this share a value is heavy, so there are 1 / SHARE heavy values at most
TRACKED = 4096   # items of the frequency sketch; its counts are short by less than rows / (0.75 * TRACKED)
SALTS = 32


@dataclass(frozen=True)
class Lookup:
    """One left join of a chain: ``right`` on column ``key``, which ``left_key`` derives on the left.

    ``left_key`` must be NULL exactly where the source column is, and a function of it; ``on_duplicate`` as in :func:`enrich.guard_unique`.
    """

    right: DataFrame
    key: str
    left_key: Column | None = None
    on_duplicate: str = "fanout"


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> DataFrame:
    """The values of ``key`` that at least ``share`` of the rows with one hold, as one column: at most ``1 / share`` rows.

    Counts are those of a mergeable frequent-items sketch: partial per task, then merged, whatever the number of distinct values.
    A value that is passed over by the sketch's error is joined like any other.
    """
    if not 0 < share < 1 or tracked * share < 4:
        raise ValueError("the sketch must track several times as many items as there can be heavy ones")
    k = quote_ident(key)
    most = int(1 / share)
    top = df.where(F.col(key).isNotNull()).selectExpr(f"{k} AS k").agg(F.count("*").alias("n"), F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top"))
    return top.select("n", F.explode("top").alias("t")).where(F.col("t.count") >= F.col("n") * share).select(F.col("t.item").alias(key))


def planner_broadcasts(df: DataFrame) -> bool:
    """Whether the planner's own size estimate lets it broadcast ``df`` (no job runs); unknown sizes count as large."""
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except AttributeError:  # a session without a JVM handle
        return False
    return 0 <= size <= limit


def _plain(left: DataFrame, lookups: list[Lookup], rights: list[DataFrame]) -> DataFrame:
    for look, right in zip(lookups, rights):
        left = left if look.left_key is None else left.withColumn(look.key, look.left_key)
        left = left.join(right, look.key, "left")
    return left


def enrich_chain(left: DataFrame, source: str, lookups: list[Lookup], *, drop_keys: bool = False, split: bool | None = None,
                 share: float = SHARE, tracked: int = TRACKED, salts: int = SALTS) -> DataFrame:
    """``left ⟕ right`` for each lookup, in turn.

    Without ``split`` the joins are plain where the planner broadcasts every right side anyway, as no row of ``left`` is shuffled then.
    Rows come back in no order; NULL sources keep all their rows with NULL right columns; NULL right keys never match.
    """
    rights = [guard_unique(look.right, look.key, look.on_duplicate) for look in lookups]
    derived = [look.key for look in lookups if look.left_key is not None]
    if split is None:
        split = not all(planner_broadcasts(r) for r in rights)
    if not split:
        out = _plain(left, lookups, rights)
    else:
        heavy = heavy_keys(left, source, share, tracked)
        has = F.col(source).isNotNull()
        rest = _plain(left.where(has).join(F.broadcast(heavy), source, "left_anti"), lookups, rights)
        # the heavy rows: each row takes one of ``salts`` copies of its matches, in turn within a task
        hot = left.where(has).join(F.broadcast(heavy), source, "left_semi").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        for look, right in zip(lookups, rights):
            key_of = F.col(look.key) if look.left_key is None else look.left_key
            wanted = heavy.select(key_of.alias(look.key)).distinct()
            copies = right.join(F.broadcast(wanted), look.key, "left_semi").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            hot = hot if look.left_key is None else hot.withColumn(look.key, look.left_key)
            hot = hot.join(copies, [look.key, "__salt"], "left")
        none = left.where(~has)
        columns = _plain(left, lookups, rights).columns
        missing = {c: F.lit(None).cast(rest.schema[c].dataType) for c in columns if c not in left.columns}
        out = rest.select(*columns).union(hot.select(*columns)).union(none.withColumns(missing).select(*columns))
    return out.drop(*derived) if drop_keys else out
