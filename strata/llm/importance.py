"""Importance resampling towards a target distribution, over hashed word n-grams.

A document's weight is the log likelihood ratio of its n-grams under the target's and the corpus's bucket
frequencies.  Each block of texts interns its n-grams in an open-addressed table (``intern.py``): a slot holds the n-gram's
bucket and its count, so a bucket is computed once for each distinct n-gram, and the slots of the occurrences gather the gains.
The draw adds Gumbel noise from a hash of the id to the weights and keeps the highest sums.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, id_text, shuffle_partitions, written
from .intern import intern
from .term_scan import folded_bytes, joined_terms, term_places

BUCKETS = 10_000
MAX_N = 1
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
BLOCK_BYTES = 2 << 20
OCCURRENCES = 1 << 19  # n-grams that one table interns
NO_ID = (1 << 63) - 1


def interned(texts: pa.Array, max_n: int, buckets: int):
    """``(n_words, parts)`` of a block: words of each text, and for each part of its n-grams (row and slot of every
    occurrence; bucket and count of every slot, which only mean something where the count is not 0)."""
    data, ends = folded_bytes(texts)
    start, size, row = term_places(data, ends)
    if max_n > 1:
        data, start = joined_terms(data, start, size)
    raw = data.tobytes()

    def parts():
        for n in range(1, max_n + 1):
            first = np.arange(max(0, len(start) - n + 1))
            first = first[row[first] == row[first + n - 1]]
            for a in range(0, len(first), OCCURRENCES):
                i = first[a:a + OCCURRENCES]
                at, length = start[i], start[i + n - 1] + size[i + n - 1] - start[i]
                slot, owner = intern(data, at, length)
                taken = np.flatnonzero(owner >= 0)
                bucket = np.zeros(len(owner), dtype=np.int64)
                bucket[taken] = [zlib.crc32(raw[s:s + k]) % buckets for s, k in zip(at[owner[taken]].tolist(), length[owner[taken]].tolist())]
                yield row[i], slot, bucket, np.bincount(slot, minlength=len(owner))

    return np.bincount(row, minlength=len(texts)), parts()


def bucket_counts(docs: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many n-grams of all texts fall into each bucket that any falls into."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in blocks(batches, BLOCK_BYTES):
            for _, _, bucket, count in interned(batch.column("text"), max_n, buckets)[1]:
                some = np.flatnonzero(count)
                np.add.at(total, bucket[some], count[some])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Every bucket's gain in thousandths: the logarithm of its smoothed share of the target's n-grams over that of the corpus's.

    The driver sees one number for each bucket.
    """
    def side(table, name):
        return bucket_counts(table, max_n, buckets).select("bucket", F.col("n").alias(name))

    joined = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(side(target, "t"), "bucket", "left").join(side(docs, "s"), "bucket", "left").fillna(0, ["t", "s"])
    counts = {r["bucket"]: (r["s"], r["t"]) for r in joined.collect()}
    s, t = (np.array([counts[b][k] for b in range(buckets)], dtype=np.float64) for k in (0, 1))
    return np.floor(1000.0 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document: its words, its n-grams and the sum of their gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        gain = shared.value
        for batch in blocks(batches, BLOCK_BYTES):
            n_words, parts = interned(batch.column("text"), max_n, len(gain))
            n_features, weight = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for row, slot, bucket, _ in parts:
                n_features += np.bincount(row, minlength=batch.num_rows)
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                if len(begin):
                    weight[row[begin]] += np.add.reduceat(gain[bucket][slot], begin)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: str = SEED):
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; drawn ones have a rank from 1, others NULL.

    Of the documents with at least ``min_words`` words, ``percent`` percent (rounded down) with the highest scores are drawn, ties to the
    smaller ``doc_id``.  NULL and empty texts have no n-grams and weight 0; a NULL ``doc_id`` takes the noise of the empty id
    and loses ties to every id; repeated rows are ranked one after the other; without target text all gains favour rare buckets alike; an
    empty table gives no row.  Ranks come from a range partitioning of (score, id, row), so no task holds all documents and a
    repeated row, however frequent, is spread over tasks.
    """
    spark = docs.sparkSession
    scored = weighted(docs, bucket_gains(docs, target, max_n, buckets), max_n).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "resample")  # written, so a row keeps its number
    able = scored.where(F.col("n_words") >= min_words).withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    order = [F.col("score").desc(), F.col("key").asc(), F.col("row").asc()]
    dealt = written(able.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id()), "resample-ranges")
    sizes = sorted(map(tuple, dealt.groupBy("part").count().collect()))  # one row a range
    drawn, base, bases = percent * sum(n for _, n in sizes) // 100, 0, []
    for part, n in sizes:
        bases.append((part, base))
        base += n
    bases = spark.createDataFrame(bases, "part int, base long")
    rank = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = dealt.join(F.broadcast(bases), "part").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns and their ``rank``; rows of one ``doc_id`` are drawn alike, by their best rank."""
    best = resampled(docs, target, **options).where("rank is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("rank").alias("_rank"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "rank"]
    return docs.join(best, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id"))).select(*kept, F.col("_rank").alias("rank"))
