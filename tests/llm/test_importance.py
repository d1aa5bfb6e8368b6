"""Importance resampling: the interning table, and weights, scores and ranks against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from strata.llm import importance, intern
from strata.llm import queries as Q

from .edge_rows import frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def strings(seed, n, longest):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    start, size = rng.integers(0, 3900, n), rng.integers(0, longest, n)
    return data, start, size, [data[a:a + k].tobytes() for a, k in zip(start, size)]


def test_keys_are_xxh64():
    data, start, size, raw = strings(1, 2000, 90)
    got = intern.xxh64(data, intern.numbers_at(data), start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(x) for x in raw]


@pytest.mark.parametrize("keys", [intern.xxh64, lambda d, n, s, z: np.zeros(len(s), dtype=np.uint64), lambda d, n, s, z: (z % 3).astype(np.uint64)])
@pytest.mark.parametrize("longest", [4, 9, 70])
def test_strings_share_a_slot_exactly_if_their_bytes_are_equal(keys, longest):
    data, start, size, raw = strings(longest, 400, longest)
    slot, owner = intern.intern(data, start, size, keys)
    by = {}
    for i, (s, x) in enumerate(zip(slot.tolist(), raw)):
        assert by.setdefault(x, s) == s and raw[owner[s]] == x
    assert len(set(by.values())) == len(by) and set(np.flatnonzero(owner >= 0)) == set(by.values())
    assert all(len(x) == n for x, n in zip(intern.intern(data, start[:0], size[:0]), (0, 16)))


def brute(rows, target, percent=10, min_words=20, max_n=1, buckets=10_000, seed="2024"):
    def grams(t):
        w = TERM.findall(lower(t or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    mine, theirs = [grams(t) for _, t in rows], [g for _, t in target for g in grams(t)[1]]
    s, t = Counter(g for _, gs in mine for g in gs), Counter(theirs)
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)]
    out = []
    for (doc, _), (n, gs) in zip(rows, mine):
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[g] for g in gs)
        out.append((doc, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    draw = percent * len(able) // 100
    return Counter([(*r, k + 1 if k < draw else None) for k, r in enumerate(able)] + [(*r, None) for r in out if r[1] < min_words])


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)] + ["Straße", "ÉCOLE", "naïve", "日本", "😀", "x" * 40, "x" * 41, "A", "a"]
    out = [(i, " ".join(rng.choice(words, rng.integers(1, 80)))) for i in range(150)]
    copy = " ".join(["w1", "w2"] * 15)
    return out + [(500, copy)] * 60 + [(None, copy)] * 3 + [(200, None), (201, ""), (202, " ,;\n"), (203, "w1," * 40_000), (204, "q" * 50_000), (7, copy)]


TARGET = [(1, "w1 w2 w3 straße"), (2, None), (3, ""), (4, "W5 w6 only-here école")]


@pytest.mark.parametrize("options", [{}, {"max_n": 3, "buckets": 97, "percent": 33, "min_words": 5}, {"percent": 100, "min_words": 0}])
def test_scores_and_ranks_equal_brute_force(spark, rows, monkeypatch, options):
    monkeypatch.setattr(importance, "OCCURRENCES", 10_000)
    got = importance.resampled(frame(spark, rows).repartition(5), spark.createDataFrame(TARGET, "item_id bigint, text string"), **options)
    assert Counter(map(tuple, got.collect())) == brute(rows, TARGET, **options)


def test_empty_tables_and_the_query(spark, rows, tmp_path):
    target = spark.createDataFrame(TARGET, "item_id bigint, text string")
    assert importance.resampled(frame(spark, []), target).count() == 0
    assert Counter(map(tuple, importance.resampled(frame(spark, rows), target.where("false")).collect())) == brute(rows, [])
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    target.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = Q.op13_importance_resampling(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    assert Counter(map(tuple, got.collect())) == Counter({(r[0], *r[2:]): 0 for r in brute(rows, TARGET)}) + Counter([(r[0], *r[2:]) for r in brute(rows, TARGET).elements()])


def test_drawn_documents_keep_their_columns(spark, rows):
    df = frame(spark, rows)
    got = importance.drawn_documents(df, spark.createDataFrame(TARGET, "item_id bigint, text string")).collect()
    drawn = {r[0] for r in brute(rows, TARGET) if r[5] is not None}
    assert {r["doc_id"] for r in got} == drawn and all(r["tags"] == {"a": "b"} and r["rank"] > 0 for r in got)
