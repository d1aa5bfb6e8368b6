"""Connected components of a link table by alternating star contractions, with written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, written

HEAVY_SHARE = 1000  # a node with at least one in so many links is a hub, so there are HEAVY_SHARE hubs at most
LEAST_HUB = 1000  # links


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (``a``, ``b``): ``root`` is the smallest node that links reach.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours; the rounds end when the
    links are stars.  A node that many others hang on is the smaller end of their links; its links are dealt over many tasks where
    they meet its smallest neighbour.  No link reaches the driver, only the hubs of a round.
    """
    e = written(_clean(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    state, hubs = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _clean(spread_join(both.where("v > u"), low, "u", hubs, "v").select(F.col("v").alias("u"), F.col("m").alias("v")))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(down, low, "u", hubs, "v").select("u", "v", "m")
        e = written(_clean(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))), "links")
        before, (state, hubs) = state, _state(e)
        if before == state:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple[tuple, list[int]]:
    """Number and content hash of the links, and their hubs."""
    ends = e.groupBy("v").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    ends = written(ends, "ends")
    n, h = ends.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("h")).first()
    hubs = ends.where(F.col("n") * HEAVY_SHARE >= max(n, LEAST_HUB * HEAVY_SHARE)).select("v").collect() if n else []
    return (n, h), [r["v"] for r in hubs]


def _clean(e: DataFrame) -> DataFrame:
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
