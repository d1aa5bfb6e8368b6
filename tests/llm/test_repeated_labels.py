"""A labelled id that many rows share is one row of the training samples."""

from pyspark.sql import functions as F

from strata.llm import features, language, quality_neighbours, quality_rules

from .test_operators import labelled


def test_repeated_rows_of_an_id_are_one_sample(spark, monkeypatch):
    df, labels, truth = labelled(spark, 24)
    many = df.unionByName(df.where("doc_id = 1").crossJoin(spark.range(300)).select("doc_id", F.concat("text", F.lit(" "), F.col("id").cast("string")).alias("text")))
    many = many.unionByName(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"))
    sizes, plain = [], features.collected_features

    def seen(rows, dims, vectors):
        x, y = plain(rows, dims, vectors)
        sizes.append((len(x), float((abs(x).sum(axis=1) == 0).sum())))
        return x, y

    for module in (quality_neighbours, quality_rules, language):
        monkeypatch.setattr(module, "collected_features", seen)
    quality_neighbours.train(many, labels)
    quality_rules.train(many, labels)
    language.train(many.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de").alias("label")))
    assert sizes == [(len(truth), 0.0)] * 3
