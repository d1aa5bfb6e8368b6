"""A benchmark of many blocks: one block at a time is broadcast, and a window of very many items is one window."""

from pyspark.sql import functions as F

from strata.llm import decontaminate

from .test_operators import text


def test_blocks_are_small_however_large_the_benchmark(spark, monkeypatch):
    sizes = []
    plain = decontaminate.Block.__init__

    def counted(self, grams, window):
        plain(self, grams, window)
        sizes.append(sum(words.nbytes for words, _ in self.shared.value[0].values()))

    monkeypatch.setattr(decontaminate.Block, "__init__", counted)
    bench = spark.createDataFrame([(i, text(1000 + i, 200)) for i in range(60)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, text(1007, 200)), (2, text(5)), (3, "a " + " ".join(text(1050, 200).split()[20:40]))], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.with_hits(docs, bench, block_bytes=100_000).collect()}
    assert {k: (sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for k, r in got.items()} == {1: (200, ["7"]), 2: (0, []), 3: (20, ["50"])}
    assert len(sizes) > 5 and max(sizes) < 150_000  # eight bytes a word, dealt out by hash
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench, block_bytes=100_000).collect()] == [2]


def test_a_window_of_many_items_and_documents(spark):
    line = text(77, 10)
    bench = spark.range(3000).select(F.col("id").alias("item_id"), F.concat(F.lit(line + " "), F.col("id").cast("string")).alias("text"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, line).otherwise("x y z").alias("text"))
    got = decontaminate.with_hits(docs, bench).select("doc_id", F.size("items").alias("n"), "spans").collect()
    assert {r["doc_id"]: r["n"] for r in got} == {i: 3000 if i % 3 == 0 else 0 for i in range(300)}
    assert all([(s["start"], s["end"]) for s in r["spans"]] == ([(0, 10)] if r["doc_id"] % 3 == 0 else []) for r in got)
