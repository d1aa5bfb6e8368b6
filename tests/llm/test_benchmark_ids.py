"""Benchmark items without an id are searched like the others."""

from collections import Counter

import pytest

from strata.llm import decontaminate
from strata.llm.queries import op8_decontamination

from .test_operators import SCHEMA, brute_hits, text


@pytest.mark.parametrize("block", [1 << 20, 1600])
def test_items_without_an_id_are_found(spark, tmp_path, block):
    rows = [(1, text(1)), (2, text(2)), (3, text(3) + " " + text(2)), (4, None), (None, text(1)), (5, text(5))]
    bench = [(None, " ".join(text(1).split()[5:30])), (None, " ".join(text(2).split()[5:30])), (7, " ".join(text(3).split()[:20])), (8, text(2)), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", 1.5) for i, t in rows], SCHEMA)
    b = spark.createDataFrame(bench, "item_id bigint, text string")
    want = brute_hits([(d, t or "") for d, t in rows], bench)  # its name for a NULL id is the text None
    got = decontaminate.with_hits(docs, b, block_bytes=block).collect()
    assert Counter((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(sorted(map(str, r["items"])))) for r in got) == Counter((d, n, h, tuple(i)) for d, n, h, i in want)
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, b, block_bytes=block).collect()) == [4, 5]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    b.write.parquet(str(tmp_path / "benchmark.parquet"))
    counted = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in op8_decontamination(spark, str(tmp_path)).collect()}
    assert counted == {d: (h, len(i)) for d, _, h, i in want}
