"""Repeated windows around frequent strings: same results, and no group holds much of what is shuffled."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import repeats

from .test_operators import brute_repeats


def small_hash():
    """An eight-byte string of so small a hash that it is the anchor of nearly every window that holds it."""
    words = np.array([f"k{i:07d}" for i in range(200_000)])
    numbers = np.frombuffer("".join(words).encode(), dtype="<u8").astype(np.uint64)
    return str(words[np.argmin(repeats.mix64(numbers))])


def lines(n, seed=0, size=60):
    """Documents whose lines all hold one frequent string, with other bytes around it."""
    share = small_hash()
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    return [(i, "\n".join("".join(rng.choice(letters, size // 2)) + share + "".join(rng.choice(letters, size // 2)) for _ in range(4))) for i in range(n)]


def mixed():
    rows = lines(60)
    rows += [(100 + i, rows[i][1][10 * i:10 * i + 130] + "own tail %d" % i) for i in range(12)]
    rows += [(200 + i, "x" * (45 + i)) for i in range(12)] + [(300, "ab" * 90), (301, "ab" * 90), (302, "ba" * 80), (7, rows[7][1]), (400, rows[3][1][1:]), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("width", [50, 20, 24, 33])
@pytest.mark.parametrize("heavy", ["none", "some", "all"])
def test_dealing_by_context_changes_no_result(spark, monkeypatch, width, heavy):
    def anchors(texts, width):
        every = np.unique(np.concatenate([np.array([int.from_bytes(t.encode()[k:k + 8].ljust(8, b"\0"), "little") for k in range(len(t.encode()))], dtype=np.uint64) for _, t in mixed()]))
        return {"none": every[:0], "some": every[::3], "all": every}[heavy]

    monkeypatch.setattr(repeats, "frequent_anchors", anchors)
    df = spark.createDataFrame(mixed(), "doc_id bigint, text string").repartition(3)
    got = repeats.without_repeats(df, width).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(mixed(), width))


def spans_in(text, width=50):
    buffer = np.frombuffer(text, dtype=np.uint8)
    words = repeats.words_at(buffer)
    one = np.zeros(1, dtype=np.int64)
    return repeats.spans_of(buffer, one, np.array([len(buffer)]), one, one, one, words, width), words


@pytest.mark.parametrize("width,levels", [(50, 1), (50, 2), (50, 4), (24, 2), (33, 2), (20, 2)])
def test_equal_windows_have_equal_contexts(width, levels):
    rng = np.random.default_rng(width + levels)
    text = b"".join(rng.choice([b"abcdefgh", b"hello world ", b"zz", b"the same long string again and again ", b"q"], 400).tolist())
    s, words = spans_in(text, width)
    span, first, end, key = repeats.contexts(s, words, width, np.arange(len(s)), levels)
    keys = {}
    for i, a, b, k in zip(span.tolist(), first.tolist(), end.tolist(), key.tolist()):
        for j in range(a, b):
            at = int(s.at[i]) + j
            assert at not in keys  # every window is in one run
            keys[at] = k
    assert len(keys) == len(text) - width + 1
    by = {}
    for at, k in keys.items():
        assert by.setdefault(text[at:at + width], k) == k


def test_no_group_holds_much_of_the_windows_around_a_frequent_string(spark):
    df = spark.createDataFrame(lines(9000, 1), "doc_id bigint, text string")
    texts = repeats.id_text(df).withColumn("row", F.xxhash64("doc_id", "text"))
    heavy = repeats.frequent_anchors(texts, 50)
    assert len(heavy) >= 1

    def sizes(anchors):
        def run(batches):
            yield from repeats.span_rows(batches, 50, 400, 8, anchors)

        rows = texts.mapInArrow(run, "side int, part long, blob binary").where("side = 0").groupBy("part").agg(F.sum(F.length("blob")).alias("n")).collect()
        return sorted(r["n"] for r in rows)

    plain, dealt = sizes(heavy[:0]), sizes(heavy)
    assert plain[-1] / sum(plain) > 0.3 and dealt[-1] / sum(dealt) < 0.01


def test_tables_without_windows(spark):
    for rows in ([], [(1, None)], [(1, "short"), (2, "short")]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert [(r["doc_id"], r["n_removed"]) for r in repeats.without_repeats(df).collect()] == [(i, 0) for i, _ in rows] or len(rows) > 1
