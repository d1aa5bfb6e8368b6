"""Token counts: an exact length histogram whose suffix sums answer every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .tokens import TOKENIZER, token_counts

BLOCK = 1024


def length_table(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """From one row per document (``length``) one row per distinct length, with suffix sums.

    Columns: ``length``, ``n_docs`` and ``n_tokens`` of that length; ``docs_ge`` and ``tokens_ge``, the documents at least so
    long and their tokens; ``docs_lt`` shorter ones; ``truncated_tokens``, what remains when every document is cut at
    ``length``.  NULL lengths are ignored; an empty table gives no row.  Sums run in two steps, over blocks of lengths
    and within each, so no task sees the whole histogram.
    """
    # written, as both uses below would else encode every document
    hist = (written(lengths.where(F.col("length").isNotNull()).groupBy("length").agg(F.count("*").alias("n_docs")), "lengths")
            .withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / block)))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    zero = F.lit(0).cast("bigint")
    edges = totals.select("block", F.coalesce(F.sum("d").over(above), zero).alias("d_above"), F.coalesce(F.sum("t").over(above), zero).alias("t_above"),
                          F.coalesce(F.sum("d").over(below), zero).alias("d_below"), F.coalesce(F.sum("t").over(below), zero).alias("t_below"))
    down = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    docs_ge = F.sum("n_docs").over(down) + F.col("d_above")
    return (hist.join(edges, "block")
            .select("length", "n_docs", "n_tokens", docs_ge.alias("docs_ge"), (F.sum("n_tokens").over(down) + F.col("t_above")).alias("tokens_ge"),
                    (F.coalesce(F.sum("n_docs").over(up), zero) + F.col("d_below")).alias("docs_lt"),
                    (F.coalesce(F.sum("n_tokens").over(up), zero) + F.col("t_below") + F.col("length") * docs_ge).alias("truncated_tokens")))


def token_length_table(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``length_table`` of the encoded lengths of all documents (NULL text: 0 tokens)."""
    return length_table(token_counts(docs, tokenizer))


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, docs_over, truncated_tokens`` for any limits, also between the lengths of ``table``."""
    spark = table.sparkSession
    asked = spark.createDataFrame([(int(n),) for n in limits], "context_limit long")
    cut = F.least("length", "context_limit") * F.col("n_docs")
    return (table.select("length", "n_docs").crossJoin(F.broadcast(asked)).groupBy("context_limit")
            .agg(F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"), F.sum(cut).alias("truncated_tokens")))


def quantile(table: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share ``q`` of the documents does not exceed."""
    upto = F.col("docs_lt") + F.col("n_docs")
    total = F.col("docs_lt") + F.col("docs_ge")
    row = table.where((upto >= F.lit(q) * total)).agg(F.min("length").alias("n")).first()
    return row["n"]
