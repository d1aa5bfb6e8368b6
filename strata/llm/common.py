"""Helpers shared by the operators: input columns, shared scratch tables, bounded blocks, hashing."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` with NULL read as the empty text; every other column is dropped."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read back: lineage ends at files every executor sees."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: sizes bucket counts by the data, with one aggregate."""
    return docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def worker_cache() -> dict:
    """Objects that live as long as the Python worker (tokenizers, decoded models), by key.

    The package travels by value, so its own module globals are new in every task.
    """
    return sys.modules.setdefault("_strata_llm_worker", types.ModuleType("_strata_llm_worker")).__dict__


SHARED = ("powers",)  # entries of the worker's cache that are small and of use to several operators


def give_back() -> None:
    """Memory that this process has freed goes back to the system; allocators keep it otherwise, as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux") and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def own_task(operator: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as the function of an operator's tasks: they share a worker's cache with one another, not with those of other operators.

    A worker outlives its stage.  What another operator keeps there is dropped before the first batch, and what a task has freed goes
    back to the system after its last.
    """

    def task(batches):
        cache = worker_cache()
        if cache.get("owner") != operator:
            for key in [k for k in cache if not k.startswith("__") and k not in SHARED]:
                del cache[key]
            cache["owner"] = operator
            give_back()
        yield from run(batches)
        give_back()

    return task


def spread_join(left: DataFrame, right: DataFrame, key: str, heavy: list[int], by: str, salts: int = 32) -> DataFrame:
    """``left`` joined with ``right`` on ``key``, where the few keys ``heavy`` are dealt over ``salts`` tasks.

    ``heavy`` must have a fixed bound, as the keys with at least a given share of all rows do.  Rows of ``left`` with a heavy key are dealt by a
    hash of the column ``by``; the rows of ``right`` with that key, which should be few, go to every salt.  Without heavy keys this is a plain join.
    """
    if not heavy:
        return left.join(right.hint("merge"), key)
    hot = F.col(key).isin(heavy)
    dealt = left.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0))
    copies = right.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copies.hint("merge"), [key, "_salt"]).drop("_salt")


def blocks(batches: Iterable[pa.RecordBatch], max_bytes: int, max_rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``max_bytes`` of ``text`` (one row at least) and at most ``max_rows``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and (total + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold_crc32(column, modulus: int):
    """``crc32(doc_id as text) mod n`` in the engine: the fold of a document."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)
