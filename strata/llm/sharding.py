"""Sharding by a permutation-filled lookup table (consistent hashing with constant-time placement).

Every shard has its own order of preference over the slots of a prime-sized table; the shards take turns
claiming their next free slot until the table is full.  Each shard holds almost the same number of slots, and when
a shard leaves, few slots change hands besides its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65537
SHARDS = [f"shard-{i:04d}" for i in range(256)]


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> np.ndarray:
    """The shard index of every slot.  ``size`` must be a prime above the number of shards; a shard of weight w takes w turns a round."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if size <= len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime larger than the number of shards")
    turns = [i for i, name in enumerate(shards) for _ in range((weights or {}).get(name, 1))]
    if not turns:
        raise ValueError("at least one shard needs a positive weight")
    at = [_number(name, "offset") % size for name in shards]
    step = [_number(name, "skip") % (size - 1) + 1 for name in shards]
    table, free = [-1] * size, size
    while True:
        for i in turns:
            slot = at[i]
            while table[slot] >= 0:
                slot = (slot + step[i]) % size
            table[slot], at[i] = i, (slot + step[i]) % size
            free -= 1
            if not free:
                return np.array(table, dtype=np.int32)


def slot_of(*keys: str, size: int = TABLE_SIZE):
    """The slot of a row: a hash of its keys as text (NULL and the empty string differ), modulo the table size."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.pmod(F.xxhash64(*parts), F.lit(size)).cast("int")


def place(df: DataFrame, keys: list[str], shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (columns of these names are replaced).

    Equal keys share a shard; a NULL key has its own slot; an empty table stays empty.  The broadcast table has exactly
    ``size`` rows, whatever the data.  The placement itself shuffles nothing.
    """
    spark: SparkSession = df.sparkSession
    rows = list(enumerate(np.array(shards)[lookup_table(shards, size, weights)].tolist()))
    kept = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    table = spark.createDataFrame(rows, "slot int, shard string")
    return df.select(*[F.col(f"`{c}`") for c in kept], slot_of(*keys, size=size).alias("slot")).join(F.broadcast(table), "slot").select(*[F.col(f"`{c}`") for c in kept], "slot", "shard")


def write_shards(df: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write placed rows as one folder a shard; ``files_per_shard`` spreads a heavy shard over as many tasks by its slots' rows."""
    part = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if t in ("bigint", "int", "string")]), F.lit(files_per_shard))
    df.withColumn("_part", part).repartition("shard", "_part").drop("_part").write.partitionBy("shard").parquet(path)
