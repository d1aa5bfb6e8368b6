"""The near-duplicate join on templates, large groups of copies, hubs, bands and clashing columns."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import components, near_join

from .edge_rows import frame
from .test_operators import brute_near, text


def sets(seed, n, own, shared, common):
    """``n`` sets of ``own`` elements of their own and ``shared`` of ``common`` ones."""
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 63, common).astype(np.uint64)
    return [np.unique(np.concatenate([rng.integers(0, 1 << 63, own).astype(np.uint64), rng.choice(pool, shared, replace=False)])) for _ in range(n)]


def all_tiles(found, freq, percent):
    records = [near_join.prefix_records(s, freq, percent) for s in found]
    key, cid, size, place = [], [], [], []
    for i, (s, (element, band, p)) in enumerate(zip(found, records)):
        key += [hash((int(e), int(b))) for e, b in zip(element, band)]
        cid += [i] * len(element)
        size += [len(s)] * len(element)
        place += p.tolist()
    order = np.lexsort((cid, size, key))
    return tuple(np.array(x)[order] for x in (key, cid, size, place))


def frequencies(found):
    return np.bincount((np.concatenate(found) & np.uint64((1 << near_join.SKETCH_BITS) - 1)).astype(np.int64), minlength=1 << near_join.SKETCH_BITS)


@pytest.mark.parametrize("percent", [80, 50, 100])
def test_every_linking_pair_meets_in_a_tile(percent):
    rng = np.random.default_rng(percent)
    found = []
    for seed in range(60):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 120))).astype(np.uint64)
        for _ in range(4):
            keep = base[rng.random(len(base)) > 0.15 * rng.random()]
            found.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, int(rng.integers(0, 9))).astype(np.uint64)])))
    found = [s for s in found if len(s)]
    tile, cid, size, place = all_tiles(found, frequencies(found), percent)
    sig = np.stack([np.frombuffer(near_join.signature(found[c]), dtype=np.uint64) for c in cid])
    flat = np.zeros(len(tile), dtype=np.int64)
    pairs = near_join.cross_pairs(tile, flat, cid, size, place, np.arange(len(tile)), sig, flat.astype(bool), percent)
    got = {(min(a, b), max(a, b)) for x, y in pairs for a, b in zip(x.tolist(), y.tolist()) if a != b}
    for i, a in enumerate(found):
        for j in range(i):
            k = len(np.intersect1d(a, found[j]))
            if 100 * k >= percent * (len(a) + len(found[j]) - k):
                assert (j, i) in got, (len(a), len(found[j]), k)


def test_documents_of_one_template_share_no_tile():
    """Common words just below the link: the members of a common element's tile are not paired at all."""
    found = sets(1, 2000, 30, 170, 170)
    tile, cid, size, place = all_tiles(found, frequencies(found), 80)
    index = place >= near_join.INDEX
    begin = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
    members, indexed = np.diff(np.append(begin, len(tile))), np.add.reduceat(index.astype(np.int64), begin)
    assert (members > 1000).sum() > 5  # the probe prefixes do meet
    assert int((indexed * (members - 1)).sum()) < 4 * len(found)  # pairs that are looked at, of two million


def test_a_template_and_its_near_copies(spark):
    words = text(3, 200).split()
    rng = np.random.default_rng(0)
    rows = []
    for i in range(120):
        w = list(words)
        for j in rng.choice(200, 9, replace=False):
            w[j] = f"u{i}x{j}"
        rows.append((i, " ".join(w)))
        if i % 4 == 0:
            rows.append((1000 + i, " ".join(w[:-1] + ["end"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, near_join.near_duplicates(df).collect())) == Counter(brute_near(rows))


def test_hot_tiles_are_read_in_parts(spark, monkeypatch):
    """With a low limit every shared element is hot, its tile is cut, and pairs of parts meet apart; the result is the same."""
    rows = []
    for g in range(6):
        base = text(30 + g, 60).split()
        for i in range(20):
            w = list(base)
            w[(7 * i) % 60] = f"g{g}i{i}"
            rows.append((100 * g + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(near_join, "HEAVY_ELEMENT", 3)
    monkeypatch.setattr(near_join, "TILE_ROWS", 4)
    monkeypatch.setattr(near_join, "ORDERS", 0)
    assert Counter(map(tuple, near_join.near_duplicates(df).collect())) == Counter(brute_near(rows))


def test_one_body_of_a_large_class_is_fetched(spark):
    a, b = text(1, 90), " ".join(text(1, 90).split()[:-1] + ["other"])
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, b).otherwise(a).alias("text"))
    rows = near_join.shingled(df)
    members = rows.where("doc_id IS NOT NULL")
    cids = [r["cid"] for r in members.select("cid").distinct().collect()]
    bodies = near_join.bodies_of(spark.createDataFrame([tuple(sorted(cids))], "a long, b long"), members, 5)
    assert bodies.count() == 2
    got = near_join.near_duplicates(df)
    assert {r["component_id"] for r in got.collect()} == {0} and got.count() == 20_000


def test_components_of_a_large_hub(spark):
    hub = spark.range(1, 30_000).select(F.lit(5).cast("long").alias("a"), (F.col("id") + 10).alias("b"))
    path = spark.range(50_000, 50_040).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(hub.unionByName(path).unionByName(spark.createDataFrame([(3, 20_000)], "a long, b long")))
    assert got.groupBy("root").count().orderBy("root").collect() == [(3, 30_001), (50_000, 41)]
    assert components.components(hub.where("false")).count() == 0


def test_one_of_each_keeps_bare_rows_and_map_columns(spark):
    rows = [(None, None)] * 3 + [(1, ""), (1, ""), (2, " \n"), (3, text(1)), (4, text(1)), (4, text(1)), (None, text(2)), (5, " ")]
    df = frame(spark, rows)
    got = near_join.one_of_each(df)
    assert got.columns == df.columns
    assert Counter((r["doc_id"], r["text"], r["tags"]["a"]) for r in got.collect()) == Counter((i, t, "b") for i, t in rows if not (t or "").strip(" \n") or i in (3, None, 5))
