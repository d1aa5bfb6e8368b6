"""N-gram Jaccard join: tiles by size band and rare shingle, bitmap signatures, exact sorted-array intersection.

Every document is its set of distinct word n-grams as 64-bit hashes.  Of two similar sets, the first element that they share, from rare to common,
lies in the short index prefix of the smaller one and in the probe prefix of the larger, so a *tile* is the sets that hold one
element in their prefix, of one size band; there index members meet the larger ones of compatible size.  The element's places and then the
signatures bound a pair's overlap from above; pairs that the bounds leave are compared exactly.  Equal sets are one class throughout, and the result is components, so a pair whose ends are already
connected is never built: large groups of near copies cost a few partners per member, not all pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix64, own_task, shuffle_partitions, spread_join, written
from .components import components
from .word_hash import split_hashes

WORDS = 5
PERCENT = 80
SIGNATURE_BITS = 1024
WIDE_BITS = 4096  # of the second signature, which only the classes that a pair names get
SKETCH_BITS = 16
BLOCK_BYTES = 1 << 20
ORDERS = 2
BUCKET_BYTES = 8 << 20
TILE_ROWS = 4096
BAND_STEPS = 4  # factors of 100 / percent that a size band spans
HEAVY_ELEMENT = 1 << 16  # occurrences from which on an element's tile is read in parts
HEAVY_SHARE = 1000  # a class or a tile with at least one in so many rows is heavy, so there are HEAVY_SHARE heavy ones at most
LEAST_HEAVY = 200  # rows below which no class is heavy
PAIRS_AT_ONCE = 1 << 18
NO_ID = (1 << 63) - 1


def shingle_hashes(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams, from the words' hashes; fewer words are one n-gram as a whole."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    k = min(n, len(words))
    m = len(words) - k + 1
    h = words[:m].copy()
    for j in range(1, k):
        h = mix64(h) + words[j:m + j]
    return np.unique(mix64(h ^ np.uint64(n - k)))


def sets_of(texts: list[bytes], n: int) -> list[np.ndarray]:
    return [shingle_hashes(words, n) for words in split_hashes([t.lower() for t in texts])]  # bytes fold A-Z only


def class_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(hashes: np.ndarray, bits: int = SIGNATURE_BITS) -> bytes:
    """One bit a slot: whether an odd number of elements fall there.  An element of one set only flips one bit, so differing bits never outnumber differing elements."""
    return np.packbits(np.bincount((hashes >> np.uint64(20)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1).tobytes()


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with which sets of sizes ``a`` and ``b`` link: 100 * overlap >= percent * (a + b - overlap)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def index_length(size: int, percent: int) -> int:
    """How many of a set's rarest elements hold the first one that it shares with any set that links and is no smaller."""
    return size - -(-percent * 2 * size // (100 + percent)) + 1


def band_of(size: int, percent: int) -> int:
    return int(math.log(size) / math.log(100 / percent) / BAND_STEPS + 1e-9) if percent < 100 else size


def row_key():
    """``doc_id`` as bigint, a NULL one as ``NO_ID``."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))


def content_hash():
    """64-bit hash of ``text``, in which NULL and the empty text differ."""
    return F.xxhash64("text")


def shingled(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """Written rows of two kinds: documents (``doc_id, content, size, cid, sig, body``) and, per task, counts of hashed shingle slots (``slot, freq``).

    ``content`` is the hash of the text as it came, so a row can be found again by it and its ``doc_id``; ``row`` numbers the rows.
    """

    def run(batches):
        freq = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        comp = zstandard.ZstdCompressor(level=6)
        for batch in blocks(batches, BLOCK_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            sets = sets_of(texts, n)
            for s in sets:
                freq += np.bincount((s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=len(freq)) if len(s) > 4096 else 0
            few = [s for s in sets if len(s) <= 4096]
            if few:
                freq += np.bincount((np.concatenate(few) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=len(freq))
            rows = len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_id(s) for s in sets], pa.int64()),
                 pa.array([signature(s) for s in sets], pa.binary()), pa.array([comp.compress(t) for t in texts], pa.binary()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())], names=["doc_id", "content", "size", "cid", "sig", "body", "slot", "freq"])
        slots = np.flatnonzero(freq)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(slots), pa.int64())] * 4 + [pa.nulls(len(slots), pa.binary())] * 2 + [pa.array(slots, pa.int32()), pa.array(freq[slots], pa.int64())],
                                         names=["doc_id", "content", "size", "cid", "sig", "body", "slot", "freq"])

    named = docs.select(row_key().alias("doc_id"), content_hash().alias("content"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = named.mapInArrow(own_task("near_join", run), "doc_id long, content long, size long, cid long, sig binary, body binary, slot int, freq long")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "shingles")


def frequency_sketch(rows: DataFrame) -> np.ndarray:
    """Occurrences of shingles by hashed slot, over all documents: a table of fixed size that only orders shingles from rare to common."""
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for r in rows.where(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("freq").alias("freq")).collect():
        out[r["slot"]] = r["freq"]
    return out


def prefix_records(s: np.ndarray, freq: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``element, band, place`` of a set's prefix, once for each size band that a set of it may meet in.

    ``place`` is that in the set's order from rare to common (or a smaller one: bounds stay right), with ``INDEX`` added within the index prefix,
    which counts in the set's own band alone.
    """
    f = freq[(s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
    k = prefix_length(len(s), percent)
    element = s[np.lexsort((s, f))[:k]]
    own, least = band_of(len(s), percent), band_of(-(-percent * len(s) // 100), percent)
    place = np.minimum(np.arange(k), INDEX - 1).astype(np.uint16)
    flagged = place + np.where(np.arange(k) < index_length(len(s), percent), INDEX, 0).astype(np.uint16)
    if own == least:
        return element, np.full(k, own), flagged
    return np.concatenate([element, element]), np.repeat([own, least], k), np.concatenate([flagged, place])


INDEX = 1 << 15


def tile_blobs(rows: DataFrame, sketch: np.ndarray, n: int, percent: int, buckets: int) -> DataFrame:
    """``bucket, blob``: prefix elements with the class and size that hold them, packed per block and bucket of elements.

    Tiles of elements that occur often are dealt, by class, over buckets from ``buckets`` on, so no bucket holds a whole hot tile.
    """
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        freq = shared.value
        renamed = (b.rename_columns(["cid", "text"]) for b in batches)
        for batch in blocks(renamed, BLOCK_BYTES // 2):
            by_class = dict(zip(batch.column("cid").to_pylist(), batch.column("text").to_pylist()))  # a block's copies count once
            sets = sets_of([zstandard.ZstdDecompressor().decompress(x) for x in by_class.values()], n)
            found = [prefix_records(s, freq, percent) for s in sets]
            count = np.array([len(x[0]) for x in found], dtype=np.int64)
            element, band, place = (np.concatenate(x) for x in zip(*found))
            cid, size = np.repeat(np.array(list(by_class), dtype=np.int64), count), np.repeat(np.array([len(s) for s in sets], dtype=np.int64), count)
            key = mix64(element ^ mix64(band.astype(np.uint64) + np.uint64(1)))
            parts = freq[(element & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)] // HEAVY_ELEMENT + 1
            part = (mix64(cid.view(np.uint64)) % parts.astype(np.uint64)).astype(np.uint64)
            bucket = ((mix64(key + part) if (parts > 1).any() else key) >> np.uint64(17)) % np.uint64(buckets)
            bucket = np.where(parts > 1, bucket + np.uint64(buckets), (key >> np.uint64(17)) % np.uint64(buckets))
            order = np.argsort(bucket, kind="stable")
            out = []
            for idx in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                table, local = np.unique(cid[idx], return_inverse=True)
                size_of = np.zeros(len(table), dtype=np.int64)
                size_of[local] = size[idx]
                raw = np.array([len(idx), len(table)], dtype=np.int64).tobytes() + key[idx].tobytes() + table.tobytes() + size_of.astype(np.int32).tobytes() + local.astype(np.int32).tobytes() + place[idx].tobytes()
                out.append((int(bucket[idx[0]]), zstandard.ZstdCompressor(level=1).compress(raw)))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["bucket", "blob"])

    return rows.where("size > 0").select("cid", "body").mapInArrow(own_task("near_join", run), "bucket long, blob binary")


def read_tiles(blobs: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(key, cid, size, place)`` of one bucket, in order of key, size and cid.

    Where the tiles are ``whole``, those that only one class holds, or that have no index member, are dropped.
    """
    keys, cids, sizes, places = [], [], [], []
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        m, t = (int(x) for x in np.frombuffer(raw, dtype=np.int64, count=2))
        at = 16
        keys.append(np.frombuffer(raw, dtype=np.uint64, count=m, offset=at))
        table = np.frombuffer(raw, dtype=np.int64, count=t, offset=at + 8 * m)
        size = np.frombuffer(raw, dtype=np.int32, count=t, offset=at + 8 * (m + t))
        local = np.frombuffer(raw, dtype=np.int32, count=m, offset=at + 8 * (m + t) + 4 * t)
        cids.append(table[local])
        sizes.append(size[local].astype(np.int64))
        places.append(np.frombuffer(raw, dtype=np.uint16, count=m, offset=at + 12 * (m + t)))
    key, cid, size, place = (np.concatenate(x) for x in (keys, cids, sizes, places))
    if whole:  # most elements are one record's alone: out with them before anything else is sorted
        order = np.argsort(key, kind="stable")
        same = np.zeros(len(key), dtype=bool)
        eq = key[order][1:] == key[order][:-1]
        same[1:] |= eq
        same[:-1] |= eq
        order = order[same]
        key, cid, size, place = key[order], cid[order], size[order], place[order]
    order = np.lexsort((cid, size, key))
    key, cid, size, place = key[order], cid[order], size[order], place[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
    key, cid, size, place = key[first], cid[first], size[first], place[first]
    if whole and len(key):
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        members = np.diff(np.append(begin, len(key)))
        live = np.repeat((members > 1) & (np.add.reduceat((place >= INDEX).astype(np.int64), begin) > 0), members)
        key, cid, size, place = key[live], cid[live], size[live], place[live]
    return key, cid, size, place


def compatible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sizes lie in one band: the smaller at least ``percent`` of the larger."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def neighbour_pairs(key, cid, size, percent: int, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """A few pairs a tile member: neighbours in ``orders`` hashed orders of the tile, and in order of size."""
    pairs = []
    for k in range(orders + 1):
        by = np.lexsort((cid, size, key)) if k == orders else np.lexsort((mix64(cid.view(np.uint64) ^ mix64(key % np.uint64(4) + np.uint64(k * 7919))), key))
        a, b = by[:-1], by[1:]
        ok = (key[a] == key[b]) & compatible(size[a], size[b], percent)
        pairs.append((cid[a[ok]], cid[b[ok]]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def tiles(blobs: DataFrame, percent: int, orders: int, buckets: int) -> DataFrame:
    """Written rows of two kinds: first pairs (``a, b``) and the members of shared tiles (``key, cid, size, place``)."""

    def run(table: pa.Table) -> pa.Table:
        key, cid, size, place = read_tiles(table.column("blob").to_pylist(), table.column("bucket")[0].as_py() < buckets)
        a, b = neighbour_pairs(key, cid, size, percent, orders) if len(key) else (cid, cid)
        none = pa.nulls(len(a), pa.int64())
        return pa.table({"a": pa.concat_arrays([pa.array(a), pa.nulls(len(key), pa.int64())]), "b": pa.concat_arrays([pa.array(b), pa.nulls(len(key), pa.int64())]),
                         "key": pa.concat_arrays([none, pa.array(key.view(np.int64))]), "cid": pa.concat_arrays([none, pa.array(cid)]),
                         "size": pa.concat_arrays([none, pa.array(size)]), "place": pa.concat_arrays([pa.nulls(len(a), pa.int32()), pa.array(place.astype(np.int32))])})

    return written(blobs.groupBy("bucket").applyInArrow(run, "a long, b long, key long, cid long, size long, place int"), "tiles")


def may_link(na: np.ndarray, nb: np.ndarray, sa: np.ndarray, sb: np.ndarray, percent: int) -> np.ndarray:
    """Whether the differing bits of two signatures leave an overlap that links."""
    differ = np.bitwise_count(sa ^ sb).sum(axis=1, dtype=np.int64)
    return (na + nb - differ) // 2 >= least_overlap(na, nb, percent)


def signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(len(column), -1)


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures leave a large enough overlap possible."""
    side = [classes.select(F.col("cid").alias(c), F.col("size").alias(f"n{c}"), F.col("sig").alias(f"s{c}")) for c in "ab"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
                yield batch.filter(pa.array(may_link(na, nb, signatures(batch.column("sa")), signatures(batch.column("sb")), percent))).select(["a", "b"])

    return pairs.join(side[0].hint("merge"), "a").join(side[1].hint("merge"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(own_task("near_join", run), "a long, b long")


def cross_pairs(tile, part, cid, size, place, root, sig, across, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unconnected classes within each run of equal ``tile``, in order of size and class: every index member with the members behind
    it that the size band, the element's places and the signatures leave; with ``across`` set, of unlike ``part`` only."""
    n = len(tile)
    begin = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])) if n else np.empty(0, dtype=np.int64)
    tile_end = np.repeat(np.append(begin[1:], n), np.diff(np.append(begin, n)))
    index, at = place >= INDEX, place & (INDEX - 1)
    # sizes rise within a tile, so the members that are not too large for one end at a place that a sorted search finds
    rank = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
    span = int(size.max(initial=0)) + 1
    reach = np.searchsorted(rank * span + size, rank * span + np.minimum(100 * size // percent, span - 1), side="right")
    x = np.flatnonzero(index)
    count = np.minimum(reach, tile_end)[x] - x - 1
    x, count = x[count > 0], count[count > 0]
    ends = np.cumsum(count)
    out, a = [], 0
    while a < len(x):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS_AT_ONCE, side="right")))
        p = np.repeat(x[a:b], count[a:b])
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
        ok = (root[p] != root[q]) & (~across[p] | (part[p] != part[q])) & (np.minimum(size[p] - at[p], size[q] - at[q]) >= least_overlap(size[p], size[q], percent))
        p, q = p[ok], q[ok]
        ok = may_link(size[p], size[q], sig[p], sig[q], percent)
        out.append((cid[p[ok]], cid[q[ok]]))
        a = b
    return out


def remaining_pairs(members: DataFrame, classes: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Distinct pairs ``a, b`` of members ``key, cid, size, place, root, n_parts, part`` that share a tile and are not connected yet.

    A tile of more than ``TILE_ROWS`` members is cut into parts and each pair of parts meets in a task of its own, so no task
    holds a whole hot tile; pairs are bounded by their places and signatures where they meet and only those left become rows.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    t = (members.select("key", "cid", "place", "root", "part", other.alias("other"))
         .select("cid", "place", "root", "part", (F.col("part") != F.col("other")).alias("across"), F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("tile"))
         .join(classes.hint("merge"), "cid").withColumn("bucket", F.pmod("tile", F.lit(buckets))))

    def run(table: pa.Table) -> pa.Table:
        tile, part, cid, size, place, root, across = (table.column(c).to_numpy() for c in ("tile", "part", "cid", "size", "place", "root", "across"))
        sig = signatures(table.column("sig"))
        order = np.lexsort((cid, size, tile))
        found = cross_pairs(*(x[order] for x in (tile, part, cid, size, place, root, sig, across)), percent)
        a, b = (np.concatenate([*x, np.empty(0, dtype=np.int64)]) for x in (zip(*found) if found else ((), ())))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return t.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def bodies_of(pairs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Written ``cid, size, sig, body``: a wide signature and one compressed text of each class that a pair names.

    A class's text is that of one row, chosen before any text moves, so a text of a million copies is fetched once.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    chosen = members.groupBy("cid").agg(F.min("row").alias("row")).join(named.hint("merge"), "cid", "left_semi")
    one = members.select("row", "size", F.col("body").alias("text")).join(chosen.hint("merge"), "row").select("cid", "size", "text")

    def run(batches):
        comp = zstandard.ZstdDecompressor()
        for batch in blocks(batches, BLOCK_BYTES // 2):
            wide = [signature(s, WIDE_BITS) for s in sets_of([comp.decompress(x) for x in batch.column("text").to_pylist()], n)]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("size"), pa.array(wide, pa.binary()), batch.column("text")], names=["cid", "size", "sig", "body"])

    return written(one.mapInArrow(own_task("near_join", run), "cid long, size long, sig binary, body binary"), "bodies")


def linked(pairs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link, by exact intersection of their sorted sets, recomputed from the texts; written.

    Wide signatures bound the pairs once more, so only texts of pairs that are likely to link travel.
    """
    bodies = bodies_of(pairs, members, n)
    pairs = written(bounded(pairs, bodies, percent), "pairs")
    side = [bodies.select(F.col("cid").alias(c), F.col("body").alias(f"t{c}")) for c in "ab"]

    def run(batches):
        comp = zstandard.ZstdDecompressor()
        for batch in batches:
            keep = []
            for i in range(0, batch.num_rows, 64):
                some = list(zip(batch.column("ta").slice(i, 64).to_pylist(), batch.column("tb").slice(i, 64).to_pylist()))
                texts = list({x for pair in some for x in pair})
                own = dict(zip(texts, sets_of([comp.decompress(x) for x in texts], n)))
                for x, y in ((own[a], own[b]) for a, b in some):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return written(pairs.join(side[0].hint("merge"), "a").join(side[1].hint("merge"), "b").select("a", "b", "ta", "tb").mapInArrow(own_task("near_join", run), "a long, b long"), "links")


def grouped(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The documents as :func:`shingled` has them, and a written ``cid, low, row, size, n, root`` of every class: its
    smallest ``doc_id``, a row of this id, its set's size, its rows, and the class that names its component."""
    spark = docs.sparkSession
    rows = shingled(docs, n)
    members = rows.where(F.col("doc_id").isNotNull())
    classes = members.where("size > 0").groupBy("cid").agg(F.min(F.struct("size", "sig")).alias("r")).select("cid", "r.size", "r.sig")
    stored = members.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    buckets = max(2 * shuffle_partitions(spark), stored // BUCKET_BYTES + 1)
    table = tiles(tile_blobs(members, frequency_sketch(rows), n, percent, buckets), percent, ORDERS, buckets)
    first = table.where(F.col("a").isNotNull()).select("a", "b").distinct()
    links = linked(written(bounded(first, classes, percent), "pairs"), members, n, percent)
    roots = written(components(links), "roots")
    # whatever is not connected yet meets in full, tile by tile
    t = table.where(F.col("key").isNotNull()).select("key", "cid", "size", "place").join(roots.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    n_parts = F.ceil(F.count("*") / TILE_ROWS).cast("int")
    open_tiles = t.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), n_parts.alias("n_parts"), F.count("*").alias("n")).where("lo < hi").select("key", "n_parts", "n")
    open_tiles = written(open_tiles, "open-tiles")
    n_members = open_tiles.agg(F.sum("n").alias("n")).first()["n"] or 0
    heavy = [r["key"] for r in open_tiles.where(F.col("n") * HEAVY_SHARE >= max(n_members, TILE_ROWS * HEAVY_SHARE)).select("key").collect()]
    members_left = spread_join(t, open_tiles.select("key", "n_parts"), "key", heavy, "cid")
    rest = remaining_pairs(members_left.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("n_parts")).cast("int")), classes, percent, buckets)
    more = linked(written(rest, "pairs"), members, n, percent)
    # links between groups that are connected already: their roots are the nodes
    r = [roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
    joined = more.join(r[0], "a", "left").join(r[1], "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    again = components(joined).select(F.col("node").alias("root"), F.col("root").alias("top"))
    low = members.groupBy("cid").agg(F.min(F.struct("doc_id", "row", "size")).alias("r"), F.count("*").alias("n")).select("cid", F.col("r.doc_id").alias("low"), F.col("r.row").alias("row"), "r.size", "n")
    low = low.join(roots.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    return members, written(low.join(again.hint("merge"), "root", "left").select("cid", "low", "row", "size", "n", F.coalesce("top", "root").alias("root")), "classes")


def near_duplicates(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document: its set's size, and the smallest ``doc_id`` that links of similarity
    of at least ``percent`` percent reach from it.

    Texts without words, and NULL texts, are empty sets that link with nothing.  Repeated rows and equal sets are one class.  A NULL
    ``doc_id`` counts as larger than every id (and is the component id only among such rows).  An empty table gives no row.
    """
    members, low = grouped(docs, n, percent)
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    final = low.join(least.hint("merge"), "root").select("cid", "component_id")
    n_rows = low.agg(F.sum("n").alias("n")).first()["n"] or 0
    heavy = [r["cid"] for r in low.where(F.col("n") * HEAVY_SHARE >= max(n_rows, LEAST_HEAVY * HEAVY_SHARE)).select("cid").collect()]
    named = spread_join(members.select("doc_id", F.col("size").alias("n_shingles"), "cid", "row"), final, "cid", heavy, "row")
    return named.select(_shown("doc_id"), "n_shingles", _shown(F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")), "component_id"))


def one_of_each(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies, with all their columns: of every component the one of the smallest ``doc_id``.

    A row is known by its ``doc_id`` and its text, so rows without an id, and rows that share one, stay unless their texts link; an id
    that a component's rows share, or NULL (larger than every id), leaves the choice to class and row; rows of one id and text that differ
    elsewhere leave it to a hash of their columns.  Texts without words, and NULL texts, link with nothing: all their rows stay, repeated
    ones too.
    """
    members, low = grouped(docs, n, percent)
    first = low.where("size > 0").groupBy("root").agg(F.min(F.struct("low", "cid", "row")).alias("r")).select("r.row")
    kept = members.select("row", F.col("doc_id").alias("k"), F.col("content").alias("h")).join(first.hint("merge"), "row", "left_semi").select("k", "h")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields]
    order = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))
    # copies of one row become one row in each map task, so a hot key is a row a task
    rows = docs.where(has_words).groupBy(row_key().alias("k"), content_hash().alias("h")).agg(F.min_by(F.struct(*columns), order).alias("r"))
    return rows.join(kept.hint("merge"), ["k", "h"], "left_semi").select("r.*").unionByName(docs.where(~has_words))


def _shown(column, name: str | None = None):
    column, name = (F.col(column), column) if isinstance(column, str) else (column, name)
    return F.when(column < F.lit(NO_ID), column).alias(name)
