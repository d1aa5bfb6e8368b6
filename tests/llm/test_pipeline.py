"""The pipeline's stages against what their operators say, and the registered queries' schemas."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from strata.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_ten_queries_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def outputs(spark):
    out, df = [], spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        nxt = cp.written(stage(spark, df, SF), "test")
        out.append((df, nxt))
        df = nxt
    return out


def test_each_stage_keeps_what_its_operator_keeps(spark, outputs):
    from strata.llm import decontaminate, near_join, quality_rules

    ids = [(Counter(r[0] for r in a.select("doc_id").collect()), Counter(r[0] for r in b.select("doc_id").collect())) for a, b in outputs]
    docs = outputs[0][0]
    assert all(b.columns == docs.columns for _, b in outputs[:-1])
    kept = quality_rules.judged(docs, quality_rules.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("kept")
    assert ids[0][1] == Counter(r[0] for r in kept.collect())
    near = near_join.near_duplicates(outputs[1][0]).collect()
    assert ids[1][1] == Counter({r["component_id"]: 1 for r in near})
    clean = decontaminate.with_hits(outputs[2][0], spark.read.parquet(f"{SF}/benchmark.parquet")).where("size(spans) = 0")
    assert ids[2][1] == Counter(r["doc_id"] for r in clean.collect())
    assert ids[3][1] == ids[3][0] and set(ids[4][1]) == set(ids[4][0])


def test_the_pipeline_takes_an_empty_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        df = cp.written(stage(spark, df, SF), "test-empty")
        assert df.count() == 0
