"""Ranked lexical search by scanning documents with an Aho-Corasick automaton; no index of the documents is kept.

The automaton holds every distinct term of a block of items, guarded by a blank on both sides, so that it
finds whole terms only.  A first scan of all documents counts document frequencies and lengths, a second one scores: the automaton's outputs are term
numbers, which a table maps to the items that hold the term.  Each task keeps the best documents of every item among its
own, and these few rows are merged.
"""

from __future__ import annotations

import pickle
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, id_text, worker_cache, written
from .term_scan import FOLD, TERM_PATTERN, folded_bytes, term_places

TOP = 10
ITEM_BYTES = 8 << 20  # text of distinct items whose automaton is broadcast at once
SCAN_BYTES = 1 << 20
CELLS = 1 << 22  # scores that are held at once
EXACT = 1 << 53  # sums of integers below it are exact in doubles
NO_ID = (1 << 63) - 1
MERGE_PARTS = 64


def automaton(terms: list[str]):
    """Finds every whole term, given its number, in text that is folded and wrapped in blanks."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        a.add_word(f" {term} ", i)
    a.make_automaton()
    return a


def term_counts(texts: pa.Array, finder, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(length, row, term, tf)``: the number of terms of each text, and how often each known term occurs in it, in order of row and term."""
    data, ends = folded_bytes(texts)
    length = np.bincount(term_places(data, ends)[2], minlength=len(texts))
    folded = [(t or "").encode().translate(FOLD).decode() for t in texts.to_pylist()]
    line = f" {' '.join(folded)} "
    found = np.fromiter(chain.from_iterable(finder.iter(line)) if n_terms else (), dtype=np.int64).reshape(-1, 2)
    stops = np.cumsum([len(t) + 1 for t in folded])  # a term of text i ends, blank included, at stops[i] or before
    pair, tf = np.unique(np.searchsorted(stops, found[:, 0], side="left") * max(1, n_terms) + found[:, 1], return_counts=True)
    return length, pair // max(1, n_terms), pair % max(1, n_terms), tf


def _finder(shared):
    """The broadcast automaton, unpickled once a worker."""
    cache = worker_cache()
    if cache.get("automaton", (None,))[0] != shared.id:
        cache["automaton"] = (shared.id, pickle.loads(shared.value))
    return cache["automaton"][1]


class Broadcast:
    """A broadcast value with a name that tells it from every other one."""

    def __init__(self, spark, value):
        self.shared, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self):
        return self.shared.value


def document_counts(docs: DataFrame, finder: Broadcast, n_terms: int) -> tuple[int, int, np.ndarray]:
    """``(N, L, df)``: documents with a term, terms of all documents, and the documents that hold each known term."""

    def run(batches):
        a, df, n, total = _finder(finder), np.zeros(n_terms, dtype=np.int64), 0, 0
        for batch in blocks(batches, SCAN_BYTES):
            length, _, term, _ = term_counts(batch.column("text"), a, n_terms)
            df += np.bincount(term, minlength=n_terms)
            n, total = n + int((length > 0).sum()), total + int(length.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int64()), pa.array([total, n, *df[some].tolist()], pa.int64())], names=["term", "n"])

    found = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(n_terms, dtype=np.int64)
    for t, n in found.items():
        if t >= 0:
            df[t] = n
    return found.get(-1, 0), found.get(-2, 0), df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


class Items:
    """The items of a block as a table from terms to items: term ``t`` counts ``times[k]`` times in ``item[k]`` for ``first[t] <= k < first[t + 1]``."""

    def __init__(self, bags: list[tuple[str, dict[str, int]]]):
        self.keys = [key for key, _ in bags]
        self.terms = sorted({t for _, bag in bags for t in bag})
        number = {t: i for i, t in enumerate(self.terms)}
        rows = sorted((number[t], i, n) for i, (_, bag) in enumerate(bags) for t, n in bag.items())
        term, self.item, self.times = (np.array(x, dtype=np.int64) for x in (zip(*rows) if rows else ((), (), ())))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.terms)))]).astype(np.int64)


def scores_of(length, row, term, tf, n_rows: int, items: dict, weight: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Scores of ``n_rows`` documents for every item, one row a document."""
    n_items = len(items["keys"])
    m = 25 + (75 * length * n_docs) // max(1, total)
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    first, fan = items["first"][term], items["first"][term + 1] - items["first"][term]
    out = np.zeros(n_rows * n_items, dtype=items["kind"])
    ends = np.cumsum(fan)
    a = 0
    while a < len(term):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CELLS, side="right")))
        k = np.arange(int(fan[a:b].sum())) + np.repeat(first[a:b] - (np.cumsum(fan[a:b]) - fan[a:b]), fan[a:b])
        cell, gain = np.repeat(row[a:b], fan[a:b]) * n_items + items["item"][k], np.repeat(part[a:b], fan[a:b]) * items["times"][k]
        if items["kind"] is np.float64:
            out += np.bincount(cell, weights=gain, minlength=len(out))
        else:
            np.add.at(out, cell, gain)
        a = b
    return out.reshape(n_rows, n_items)


def best_of(item: np.ndarray, score: np.ndarray, doc: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each item the ``top`` rows of highest score, then smallest document."""
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    begin = np.flatnonzero(np.diff(item, prepend=-1))
    place = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
    return item[place < top], score[place < top], doc[place < top]


def _block_best(docs: DataFrame, bags: list[tuple[str, dict[str, int]]], top: int) -> DataFrame:
    """``body, doc_id, score``: the best documents of the items of a block, from the best of each task; written."""
    spark = docs.sparkSession
    items = Items(bags)
    finder = Broadcast(spark, pickle.dumps(automaton(items.terms)))
    n_docs, total, df = document_counts(docs, finder, len(items.terms))
    weight = term_weights(n_docs, df)
    most = np.zeros(max(1, len(items.keys)), dtype=np.float64)  # no score is larger
    np.add.at(most, items.item, np.repeat(weight, np.diff(items.first)) * items.times * 1e6)
    table = spark.sparkContext.broadcast({"keys": items.keys, "first": items.first, "item": items.item, "times": items.times,
                                          "kind": np.float64 if most.max() < EXACT else np.int64, "weight": weight})
    n_terms = len(items.terms)

    def run(batches):
        a, own = _finder(finder), table.value
        n_items = len(own["keys"])
        best = tuple(np.empty(0, dtype=np.int64) for _ in range(3))
        floor = np.ones(n_items, dtype=np.int64)  # what a document must reach to be among an item's best
        for batch in blocks(batches, SCAN_BYTES, max(1, CELLS // n_items)):
            docs_here = batch.column("doc_id").to_numpy(zero_copy_only=False)
            length, row, term, tf = term_counts(batch.column("text"), a, n_terms)
            score = scores_of(length, row, term, tf, batch.num_rows, own, own["weight"], n_docs, total).astype(np.int64)
            least = floor if len(score) <= top else np.maximum(floor, np.partition(score, len(score) - top, axis=0)[len(score) - top])
            r, i = np.nonzero(score >= least)
            best = best_of(*(np.concatenate(x) for x in zip(best, (i, score[r, i], docs_here[r]))), top)
            full = np.bincount(best[0], minlength=n_items) == top
            last = np.flatnonzero(np.diff(best[0], append=n_items))
            floor[best[0][last]] = np.where(full[best[0][last]], best[1][last], 1)
        yield pa.RecordBatch.from_arrays([pa.array([own["keys"][k] for k in best[0].tolist()], pa.string()), pa.array(best[2]), pa.array(best[1])], names=["body", "doc_id", "score"])

    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").mapInArrow(run, "body string, doc_id long, score long")
    out = written(rows, "lexical")
    finder.shared.unpersist()
    table.unpersist()
    return out


def item_blocks(bodies: DataFrame, block_bytes: int):
    """The distinct items as lists of ``(body, term counts)``, each list of at most ``block_bytes`` of text or one item.

    Items are dealt into parts by hash, into more of them until every part keeps the bound; one part at a time reaches the driver.
    """
    n_parts = 1
    while True:
        dealt = bodies.withColumn("part", F.pmod(F.xxhash64("body"), F.lit(n_parts)))
        sizes = dealt.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        if n_parts >= 1 << 20 or not sizes.where((F.col("bytes") > block_bytes) & (F.col("n") > 1)).limit(1).count():
            break
        n_parts *= 2
    for part in range(n_parts):
        rows = dealt.where(F.col("part") == part).select("body", "terms").collect()
        bags = []
        for r in sorted(rows, key=lambda r: r["body"]):
            bag: dict[str, int] = {}
            for t in r["terms"]:
                bag[t] = bag.get(t, 0) + 1
            bags.append((r["body"], bag))
        if bags:
            yield bags


def top_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item (``item_id``, ``text``) the ``top`` documents of highest score above 0, equal scores by ascending id.

    Terms are folded runs of letters and digits.  NULL and empty texts have none: such documents count nowhere and such items find nothing.  A
    NULL ``doc_id`` comes after every id; repeated document rows are ranked one by one; each row of ``items``, repeated or with a
    NULL id, gets its own ranking; empty tables give no row.  Items are searched in blocks of bounded text, so what is broadcast and
    what reaches the driver at once has a fixed bound; scores are exact integers.
    """
    named = items.select("item_id", F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("text"))
    asked = written(named.select("item_id", F.sha2("text", 256).alias("body"), F.regexp_extract_all("text", F.lit(TERM_PATTERN), F.lit(0)).alias("terms"))
                    .where(F.size("terms") > 0), "items")
    bodies = asked.groupBy("body").agg(F.min("terms").alias("terms")).withColumn("bytes", F.octet_length(F.array_join("terms", " ")))
    found = None
    for bags in item_blocks(written(bodies, "items"), block_bytes):
        part = _block_best(id_text(docs), bags, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).where("false")
    order = [F.col("score").desc(), F.col("doc_id")]
    half = F.row_number().over(Window.partitionBy("body", "half").orderBy(*order))  # in two steps: an item gets rows from every task
    few = found.withColumn("half", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS))).withColumn("rank", half).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("body").orderBy(*order))
    ranked = few.withColumn("rank", rank).where(F.col("rank") <= top).select("body", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id"), "score")
    return asked.select("item_id", "body").join(ranked, "body").select("item_id", "rank", "doc_id", "score")
