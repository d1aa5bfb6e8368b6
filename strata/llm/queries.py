"""The registered queries of the operators, each over its whole tables, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, disclosure, importance, language, lengths, lexical_scan, near_join, packing, quality_neighbours, quality_rules, repeats, secrets, sharding
from .common import fold_crc32, read_table
from .sql import SQL


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, slot, shard``: every document's place in the lookup table and its shard."""
    return sharding.place(read_table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], sharding.SHARDS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 4096 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that smaller documents hold."""
    out = repeats.without_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document at a 5-word Jaccard similarity of 0.8."""
    return near_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of all documents with its suffix sums."""
    return lengths.token_length_table(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; fold 1 of 3 is held out of training."""
    docs = read_table(spark, sf_dir, "documents")
    fold = F.coalesce(fold_crc32(F.col("doc_id"), 3), F.lit(1))
    model = language.train(docs.where(fold != 1).select("doc_id", "text", F.col("lang").alias("label")))
    return language.identify(docs, model).select("doc_id", (F.coalesce(fold_crc32(F.col("doc_id"), 3), F.lit(1)) == 1).alias("held_out"), "lang_pred", "score")


def op7_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour vote for quality 1 of every document; fold 0 of 5 is held out of training."""
    docs = read_table(spark, sf_dir, "documents")
    fold = F.coalesce(fold_crc32(F.col("doc_id"), 5), F.lit(0))
    space = quality_neighbours.train(docs, read_table(spark, sf_dir, "labels").where(fold != 0))
    return quality_neighbours.score(docs, space).select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark windows, and the items they come from."""
    found = decontaminate.with_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the quality rules for every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the fixed patterns, and all spans."""
    docs = read_table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *map(_count, ("assign", "access", "hex")), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document by fixed patterns, and the terms beside it that give it away."""
    found = disclosure.personal_spans(read_table(spark, sf_dir, "documents"))
    every = F.concat_ws(",", F.nullif(_joined(F.col("spans")), F.lit("")), F.nullif(_joined(F.array_sort("more")), F.lit("")))
    return found.select("doc_id", *map(_count, disclosure.KINDS), F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), every.alias("spans"))


def op12_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that match each benchmark item best."""
    return lexical_scan.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, noisy score and rank of every document in a draw of a tenth towards the benchmark's words."""
    out = importance.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def _joined(spans):
    """Spans as ``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_packing, op3_suffix_dedup, op4_ngram_jaccard, op5_token_counts, op6_language_id, op7_quality_neighbours,
                                   op8_decontamination, op9_quality_rules, op10_secret_scan, op11_personal_data, op12_lexical_scan, op13_importance_resampling)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op4_ngram_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM g),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY 1, 2""",
    "op8_decontamination": rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS g
       FROM (SELECT *, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
p AS (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lens WHERE len(ws) >= n),
f AS (SELECT p.doc_id, p.n, p.i, bw.item_id FROM p JOIN bw ON bw.n = p.n AND bw.g = array_to_string(p.ws[p.i:p.i + p.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM f) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM f) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
ORACLES |= SQL
