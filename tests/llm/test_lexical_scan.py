"""Ranked lexical search against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import lexical_scan
from strata.llm import queries as Q

from .edge_rows import frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items, top=10):
    bags = [(doc, Counter(TERM.findall(lower(t or "")))) for doc, t in rows]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        found = []
        for doc, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // max(1, total)
            s = sum(w[t] * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in TERM.findall(lower(text or "")) if t in b)
            if s > 0:
                found.append((-s, doc is None, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["Straße", "ÉCOLE", "naïve", "日本", "😀", "x1", "A", "a"]
    out = [(i, " ".join(rng.choice(words, rng.integers(1, 60)))) for i in range(80)]
    out += [(100 + i, "same copy w1 w2 w2") for i in range(25)] + [(7, "same copy w1 w2 w2"), (None, "same copy w1 w2 w2"), (200, None), (201, ""), (202, " ,;\n"), (203, "w1," * 30_000), (204, "q" * 50_000)]
    return out


ITEMS = [(1, "same copy"), (2, "W1 w1 w2, w5"), (3, None), (4, ""), (5, "nothing here at all"), (6, "straße École naïve 日本 😀"), (2, "W1 w1 w2, w5"), (None, "w3 A"), (9, "q" * 50_000 + " w9")]


@pytest.mark.parametrize("block,cells,exact", [(8 << 20, 1 << 22, 1 << 53), (30, 300, 1 << 53), (8 << 20, 64, 1)])
def test_rankings_equal_brute_force(spark, rows, monkeypatch, block, cells, exact):
    monkeypatch.setattr(lexical_scan, "CELLS", cells)
    monkeypatch.setattr(lexical_scan, "EXACT", exact)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = lexical_scan.top_documents(frame(spark, rows).repartition(7), items, block_bytes=block)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == brute(rows, ITEMS)


def test_empty_tables_and_the_query(spark, rows, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical_scan.top_documents(frame(spark, []), items).count() == 0
    assert lexical_scan.top_documents(frame(spark, rows), items.where("false")).count() == 0
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert Counter(map(tuple, Q.op12_lexical_scan(spark, str(tmp_path)).collect())) == brute(rows, ITEMS)


def test_the_automaton_finds_whole_terms_only():
    import pyarrow as pa

    finder = lexical_scan.automaton(["a", "ab", "b"])
    length, row, term, tf = lexical_scan.term_counts(pa.array(["a ab abc b-a a", None, "", "ab", "B"]), finder, 3)
    assert length.tolist() == [6, 0, 0, 1, 1]
    assert list(zip(row.tolist(), term.tolist(), tf.tolist())) == [(0, 0, 3), (0, 1, 1), (0, 2, 1), (3, 1, 1), (4, 2, 1)]
