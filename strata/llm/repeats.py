"""Repeated byte windows across documents, by a depth-limited radix sort of suffixes.

A suffix is ordered only through its first ``width`` bytes, most significant digit first; a group that stays equal
through all digits is exactly one repeated window, and a group in which only one document is left stops early.

Digit 0 is chosen to make the first pass cheap to shuffle: the window's *anchor*, its leftmost ``ANCHOR``-byte string
of smallest hash.  Equal windows have the same anchor at the same place, and neighbouring windows mostly share
theirs, so a run of windows travels as one span of bytes instead of one string each.  The remaining passes
take eight bytes at a time within the bucket of the anchor.  All comparisons are of bytes; hashes only deal out.

The digits after the anchor's are its *context*: the eight bytes before what is known already where all of a span's windows reach that far, else
the eight bytes behind it; a span is cut where this changes, in three at most for two digits.  Spans without an equal context in another
document end there, before any window is looked at.  Anchors that are frequent in the whole table, which one pass counts, are
dealt out by their context, so no bucket holds all windows around a frequent string.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_text, mix64, shuffle_partitions, text_bytes, written

WIDTH = 50
ANCHOR = 8
POSITION_BITS = 24  # a block of bytes is shorter than 2 ** 24
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
LEVEL = 7  # of the compression of what is shuffled: spans overlap, so this shuffle is the largest
WINDOWS = 1 << 19  # windows that are ordered at once
CONTEXT = 2  # digits of context
HEAVY_SHARE = 1000  # an anchor of one in so many spans is heavy,
HEAVY_SPANS = 200_000  # and one of so many; of these the most frequent HEAVY_MOST
HEAVY_MOST = 1 << 16
HEAVY_IN_BLOCK = 4  # spans of an anchor that a block reports
C1 = np.uint64(0x9E3779B97F4A7C15)


def words_at(buffer: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit number at every byte offset (zero bytes follow the end)."""
    n = len(buffer)
    out = np.empty((n + 7) // 8 * 8, dtype=np.uint64)
    padded = np.zeros(len(out) + 8, dtype=np.uint8)
    padded[:n] = buffer
    for o in range(8):
        out[o::8] = padded[o:o + len(out)].view("<u8")
    return out[:n]


def window_anchors(words: np.ndarray, width: int) -> np.ndarray:
    """For every window start the offset of its anchor: the leftmost smallest hash among its ``ANCHOR``-byte strings."""
    grams = width - ANCHOR + 1
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    key = mix64(words[:n + grams - 1])
    key &= ~np.uint64((1 << POSITION_BITS) - 1)
    key |= np.arange(len(key), dtype=np.uint64)
    reach = 1
    while 2 * reach <= grams:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    key = np.minimum(key[:n], key[grams - reach:grams - reach + n])
    return (key & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)


class Spans:
    """Runs of windows that share an anchor: where they lie, and their bytes within ``buffer``."""

    FIELDS = ("doc", "row", "pos", "count", "anchor", "at")  # at: offset in buffer; anchor: offset within the span

    def __init__(self, buffer: np.ndarray, **fields: np.ndarray):
        self.buffer = buffer
        self.__dict__.update(fields)

    def take(self, index: np.ndarray) -> "Spans":
        return Spans(self.buffer, **{f: getattr(self, f)[index] for f in self.FIELDS})

    def __len__(self) -> int:
        return len(self.doc)


def spans_of(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, row: np.ndarray, base: np.ndarray, words: np.ndarray, width: int) -> Spans:
    """Spans of all windows that lie within one document; ``base`` is the position of a document's part within its text."""
    anchors = window_anchors(words, width)
    part = np.repeat(np.arange(len(starts)), np.maximum(0, ends - starts - width + 1))
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(np.maximum(0, ends - starts - width + 1))[:-1]]), np.maximum(0, ends - starts - width + 1))
    window = np.arange(len(part)) + first
    if not len(window):
        empty = np.empty(0, dtype=np.int64)
        return Spans(buffer, **dict.fromkeys(Spans.FIELDS, empty))
    a = anchors[window]
    new = np.empty(len(window), dtype=bool)
    new[0] = True
    new[1:] = (a[1:] != a[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(new)
    at, p = window[begin], part[begin]
    return Spans(buffer, doc=doc[p], row=row[p], pos=at - starts[p] + base[p], count=np.diff(np.append(begin, len(window))), anchor=a[begin] - at, at=at)


def repeated_spans(s: Spans, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(gone, kept)``: indexes of spans that equal, byte for byte, a span of a smaller document, and of all others.

    The smaller document's span stays, so every window keeps an occurrence in its smallest document.
    """
    size = s.count + width - 1
    columns, h = [], mix64((size * 256 + s.anchor).astype(np.uint64))
    for j in range(0, int(size.max(initial=0)), 8):
        word = words[s.at + np.minimum(j, size - 8)]
        columns.append(word)
        h = (h ^ word) * C1
        h ^= h >> np.uint64(29)
    order = np.lexsort((s.doc, h))
    sorted_h = h[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_h[1:] != sorted_h[:-1]
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    equal = (s.doc[lead] < s.doc[order]) & (size[lead] == size[order]) & (s.anchor[lead] == s.anchor[order])
    some = np.flatnonzero(equal)
    for c in columns:
        some = some[c[lead[some]] == c[order[some]]]
    gone = order[some]
    mask = np.ones(len(s), dtype=bool)
    mask[gone] = False
    return gone, np.flatnonzero(mask)


def contexts(s: Spans, words: np.ndarray, width: int, which: np.ndarray, levels: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``span, first, end, key``: the spans ``which`` cut into runs ``[first, end)`` of windows with the same context, and the context as a hash.

    Equal windows have equal keys.  Of a run, ``left`` and ``right`` bytes around the anchor are known to lie in all of its windows.
    """
    span, first, end = which, np.zeros(len(which), dtype=np.int64), s.count[which]
    left, right, key = np.zeros(len(which), dtype=np.int64), np.zeros(len(which), dtype=np.int64), mix64(words[s.at[which] + s.anchor[which]])
    for _ in range(min(levels, max(0, (width - 15) // 8))):
        cut = np.clip(s.anchor[span] - left - 7, first, end)  # windows before it hold eight bytes more to the left
        anchor = s.at[span] + s.anchor[span]
        a, b = np.flatnonzero(first < cut), np.flatnonzero(cut < end)
        key = np.concatenate([mix64((key[a] ^ words[anchor[a] - left[a] - 8]) * C1 + np.uint64(1)), mix64((key[b] ^ words[anchor[b] + ANCHOR + right[b]]) * C1 + np.uint64(2))])
        span, first, end = np.concatenate([span[a], span[b]]), np.concatenate([first[a], cut[b]]), np.concatenate([cut[a], end[b]])
        left, right = np.concatenate([left[a] + 8, left[b]]), np.concatenate([right[a], right[b] + 8])
    return span, first, end, key


def group_starts(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def shared_groups(new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which members of consecutive groups are in one that holds two documents or more."""
    begin = np.flatnonzero(new)
    if not len(begin):
        return new
    mixed = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
    return np.repeat(mixed, np.diff(np.append(begin, len(new))))


def repeated_windows(s: Spans, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(span, window)``: windows that also start in a smaller document.  Digit 0 is the anchor; the others follow for a run of anchors at a time."""
    digit = words[s.at + s.anchor]
    order = np.argsort(digit, kind="stable")
    digit = digit[order]
    new = group_starts(digit)
    alive = shared_groups(new, s.doc[order])
    # the context's digits are compared as one hash, which may only join groups, not part them; bytes follow below
    span, first, end, key = contexts(s, words, width, order[alive])
    order = np.argsort(key, kind="stable")
    span, first, end, key = span[order], first[order], end[order], key[order]
    new = group_starts(key)
    alive = shared_groups(new, s.doc[span])
    span, first, end, group = span[alive], first[alive], end[alive], np.cumsum(new)[alive]
    begin = np.flatnonzero(group_starts(group))
    windows = np.concatenate([[0], np.cumsum(end - first)])
    found, a = [], 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(windows[begin], windows[begin[a]] + WINDOWS, side="right")) - 1)
        lo, hi = begin[a], begin[b] if b < len(begin) else len(span)
        found.append(_digit_passes(s, words, width, span[lo:hi], first[lo:hi], end[lo:hi], group[lo:hi]))
        a = b
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _digit_passes(s: Spans, words: np.ndarray, width: int, span: np.ndarray, first: np.ndarray, end: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = end - first
    j = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    group = np.repeat(group, n) * width + np.repeat(s.anchor[span], n) - j  # equal windows have their anchor at the same place
    span = np.repeat(span, n)
    order = np.argsort(group, kind="stable")
    span, j, group = span[order], j[order], group[order]
    for digit in [*range(0, width - 8, 8), width - 8]:
        alive = shared_groups(group_starts(group), s.doc[span])
        span, j, group = span[alive], j[alive], group[alive]
        if not len(span):
            return span, j
        value = words[s.at[span] + j + digit]
        begin = np.flatnonzero(group_starts(group))
        size = np.diff(np.append(begin, len(group)))
        differ = np.repeat(np.add.reduceat(value != np.repeat(value[begin], size), begin) > 0, size)
        mixed = np.flatnonzero(differ)  # only groups that this digit splits are sorted
        if len(mixed):
            order = mixed[np.lexsort((value[mixed], group[mixed]))]
            span[mixed], j[mixed], value[mixed] = span[order], j[order], value[order]
        group = np.cumsum(group_starts(group, value))
    begin = np.flatnonzero(group_starts(group))
    least = np.repeat(np.minimum.reduceat(s.doc[span], begin), np.diff(np.append(begin, len(group))))
    hit = s.doc[span] > least
    return span[hit], j[hit]


def packed_spans(s: Spans, raw: bytes) -> bytes:
    """A blob of spans in order of document and position: a table of documents, then small numbers by byte plane, then the bytes."""
    new = group_starts(s.doc, s.row)
    table = np.concatenate([s.doc[new], s.row[new]]).astype("<i8").tobytes()
    local = np.diff(np.cumsum(new) - 1, prepend=0).astype(np.uint8)  # 0 or 1: the next document
    step = np.diff(s.pos.astype("<u4"), prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    head = struct.pack("<qq", len(s), int(new.sum())) + table + local.tobytes() + step + s.count.astype(np.uint8).tobytes() + s.anchor.astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(head + raw)


def unpacked_spans(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """``doc, row, pos, count, anchor`` of each span, and the bytes of all."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, docs = (int(x) for x in data[:16].view("<i8"))
    at = 16 + 16 * docs
    table = data[16:at].view("<i8").astype(np.int64)
    local = np.cumsum(data[at:at + n].astype(np.int64))
    step = np.ascontiguousarray(data[at + n:at + 5 * n].reshape(4, n).T).view("<u4").reshape(-1)
    pos = np.cumsum(step, dtype=np.uint32).astype(np.int64)
    count, anchor = (data[at + k * n:at + (k + 1) * n].astype(np.int64) for k in (5, 6))
    return [table[:docs][local], table[docs:][local], pos, count, anchor], data[at + 7 * n:]


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.astype("<i8").tobytes() for a in arrays))


def unpacked(blob: bytes, n_arrays: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<i8").reshape(n_arrays, -1)


def gathered(buffer: np.ndarray, at: np.ndarray, size: np.ndarray) -> bytes:
    """The concatenated ``buffer[at:at + size]``."""
    ends = np.cumsum(size)
    index = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    index += np.repeat(at - (ends - size), size)
    return buffer[index].tobytes()


def range_rows(doc: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """One blob of removed ranges for each part of the documents (``row`` modulo ``parts``)."""
    part = np.mod(row, parts)
    order = np.lexsort((start, row, part))
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for idx in np.split(order, cuts):
        if len(idx):
            yield int(part[idx[0]]), packed(doc[idx], row[idx], start[idx], end[idx] - start[idx])


def text_groups(batches, width: int):
    """Blocks of texts as ``(pieces, doc_ids, rows)``; a piece is ``(row of the batch, offset, bytes)``."""
    for batch in blocks(batches, BLOCK_BYTES):
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        docs, rows = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("row").to_numpy(zero_copy_only=False)
        order = np.argsort(docs, kind="stable")
        pieces = [(i, k, texts[i][k:k + BLOCK_BYTES + width - 1]) for i in order.tolist() for k in range(0, max(1, len(texts[i]) - width + 1), BLOCK_BYTES)]
        groups, total = [[]], 0  # a text longer than a block becomes several, overlapping by width - 1 bytes
        for piece in pieces:
            if groups[-1] and total + len(piece[2]) > BLOCK_BYTES + width:
                groups.append([])
                total = 0
            groups[-1].append(piece)
            total += len(piece[2])
        for group in groups:
            if group:
                yield group, docs, rows


def block_spans(group, docs, rows, width: int) -> tuple[Spans, np.ndarray]:
    """The spans of a block, and the number at each of its bytes."""
    which = np.array([i for i, _, _ in group], dtype=np.int64)
    base = np.array([k for _, k, _ in group], dtype=np.int64)
    sizes = np.array([len(t) for _, _, t in group], dtype=np.int64)
    buffer = np.frombuffer(b"".join(t for _, _, t in group), dtype=np.uint8)
    ends = np.cumsum(sizes)
    words = words_at(buffer)
    return spans_of(buffer, ends - sizes, ends, docs[which], rows[which], base, words, width), words


def frequent_anchors(texts: DataFrame, width: int) -> np.ndarray:
    """The anchors of so many spans that they are dealt out by their context, sorted: ``HEAVY_MOST`` at most.

    Blocks report every anchor that they hold a few times with its exact number of spans.  Which anchors are heavy never affects results.
    """

    def run(batches):
        for group, docs, rows in text_groups(batches, width):
            s, words = block_spans(group, docs, rows, width)
            anchor, n = np.unique(words[s.at + s.anchor].view(np.int64), return_counts=True)
            some = n >= HEAVY_IN_BLOCK
            yield pa.RecordBatch.from_arrays([pa.array([None, *anchor[some].tolist()], pa.int64()), pa.array([len(s), *n[some].tolist()], pa.int64())], names=["anchor", "n"])

    counts = written(texts.select("doc_id", "row", "text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")), "anchors")
    total = counts.where(F.col("anchor").isNull()).agg(F.max("n").alias("n")).first()["n"] or 0
    least = max(64, min(HEAVY_SPANS, total // HEAVY_SHARE))
    heavy = counts.where(F.col("anchor").isNotNull() & (F.col("n") >= least)).orderBy(F.col("n").desc(), "anchor").limit(HEAVY_MOST)
    return np.sort(np.array([r["anchor"] for r in heavy.collect()], dtype=np.int64).view(np.uint64))


def span_rows(batches, width: int, buckets: int, parts: int, heavy: np.ndarray):
    """Map side: spans by bucket of their anchor, or of its context where it is heavy (side 0), and ranges found already within a block (side 1)."""
    for group, docs, rows in text_groups(batches, width):
        s, words = block_spans(group, docs, rows, width)
        if len(s):
            yield _block_rows(s, words, width, buckets, parts, heavy)


def _block_rows(s: Spans, words: np.ndarray, width: int, buckets: int, parts: int, heavy: np.ndarray) -> pa.RecordBatch:
    gone, kept = repeated_spans(s, words, width)
    out = [(1, part, blob) for part, blob in range_rows(s.doc[gone], s.row[gone], s.pos[gone], s.pos[gone] + s.count[gone] + width - 1, parts)]
    s = s.take(kept)
    anchor = words[s.at + s.anchor]
    key = mix64(anchor ^ C1)
    hot = heavy[np.minimum(np.searchsorted(heavy, anchor), len(heavy) - 1)] == anchor if len(heavy) else np.zeros(len(s), dtype=bool)
    if hot.any():
        span, first, end, context = contexts(s, words, width, np.flatnonzero(hot))
        cold = np.flatnonzero(~hot)
        key = np.concatenate([key[cold], mix64(context)])
        cuts = Spans(s.buffer, doc=s.doc[span], row=s.row[span], pos=s.pos[span] + first, count=end - first, anchor=s.anchor[span] - first, at=s.at[span] + first)
        s = Spans(s.buffer, **{f: np.concatenate([getattr(s, f)[cold], getattr(cuts, f)]) for f in Spans.FIELDS})
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((s.pos, s.row, s.doc, bucket)) if hot.any() else np.argsort(bucket, kind="stable")
    for idx in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        t = s.take(idx)
        out.append((0, int(bucket[idx[0]]), packed_spans(t, gathered(s.buffer, t.at, t.count + width - 1))))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()),
                                      pa.array([x[2] for x in out], pa.binary())], names=["side", "part", "blob"])


def bucket_ranges(blobs: list[bytes], width: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """Reduce side: the removed ranges of all windows of one bucket."""
    fields, raws, offset = [], [], 0
    for blob in blobs:
        arrays, raw = unpacked_spans(blob)
        size = arrays[3] + width - 1
        fields.append([*arrays, offset + np.cumsum(size) - size])
        raws.append(raw)
        offset += len(raw)
    s = Spans(np.concatenate(raws), **{f: np.concatenate([x[i] for x in fields]) for i, f in enumerate(Spans.FIELDS)})
    del fields, raws
    words = words_at(s.buffer)
    gone, kept = repeated_spans(s, words, width)
    found = [(s.doc[gone], s.row[gone], s.pos[gone], s.pos[gone] + s.count[gone] + width - 1)]
    s = s.take(kept)
    span, j = repeated_windows(s, words, width)
    if len(span):
        order = np.lexsort((j, span))
        span, j = span[order], j[order]
        new = np.ones(len(span), dtype=bool)
        new[1:] = (span[1:] != span[:-1]) | (j[1:] != j[:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(span)) - 1
        k = span[begin]
        found.append((s.doc[k], s.row[k], s.pos[k] + j[begin], s.pos[k] + j[last] + width))
    yield from range_rows(*(np.concatenate(x) for x in zip(*found)), parts)


def removed_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as maximal runs."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    begin = np.flatnonzero(new)
    return start[begin], end[np.append(begin[1:], len(start)) - 1]


def repeated_ranges(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """``(texts, ranges)``: the documents with a ``part``, and blobs of removed ranges (``part``, ``blob``)."""
    if not ANCHOR < width < 256:
        raise ValueError("the width must lie between the anchor's and 256 bytes")
    spark = docs.sparkSession
    texts = id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1))).withColumn("row", F.xxhash64("doc_id", "text"))
    total = text_bytes(texts)
    least = shuffle_partitions(spark)
    buckets, parts = max(4 * least, total // BUCKET_BYTES + 1), max(2 * least, total // (2 * BUCKET_BYTES) + 1)

    heavy = spark.sparkContext.broadcast(frequent_anchors(texts, width))

    def mapped(batches):
        yield from span_rows(batches, width, buckets, parts, heavy.value)

    def reduced(table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        if table.column("side")[0].as_py():
            rows = list(zip(table.column("target").to_pylist(), blobs))
        else:
            rows = list(bucket_ranges(blobs, width, parts))
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())})

    # ranges found on the map side pass through the same shuffle, dealt out by the part of their documents
    keyed = (texts.mapInArrow(mapped, "side int, part long, blob binary")
             .select("side", F.col("part").alias("target"), "blob"))
    ranges = keyed.groupBy("side", "target").applyInArrow(reduced, "part long, blob binary")
    return texts.withColumn("part", F.pmod("row", F.lit(parts))), ranges


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document what is left once every byte covered by a ``width``-byte string that also starts in a document with
    a smaller ``doc_id`` is removed, judged on the input: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: removal may cut a character),
    ``starts`` and ``ends`` of the removed runs.

    NULL text is empty; texts shorter than ``width`` stay; a NULL ``doc_id`` counts as larger than every id; rows with the same
    ``doc_id`` do not remove each other's bytes; an empty table gives no row.
    """
    texts, ranges = repeated_ranges(docs, width)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        removed: dict[tuple[int, int], list] = {}
        for blob in right.column("blob").to_pylist():
            doc, row, start, size = unpacked(blob, 4)
            new = group_starts(doc, row)
            begin = np.flatnonzero(new)
            for b, e in zip(begin.tolist(), [*begin[1:].tolist(), len(doc)]):
                removed.setdefault((int(doc[b]), int(row[b])), []).append((start[b:e], start[b:e] + size[b:e]))
        out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept", "starts", "ends")}
        for doc, row, blob in zip(left.column("doc_id").to_pylist(), left.column("row").to_pylist(), left.column("body").to_pylist()):
            data = zstandard.ZstdDecompressor().decompress(blob)
            found = removed.get((doc, row))
            if found:
                starts, ends = removed_runs(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
                starts, ends = starts.tolist(), ends.tolist()
            else:
                starts, ends = [], []
            edges = zip([0, *ends], [*starts, len(data)])
            for k, v in zip(out, (doc if doc < (1 << 63) - 1 else None, len(data), sum(ends) - sum(starts), len(starts), b"".join(data[a:b] for a, b in edges), starts, ends)):
                out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    def squeezed(batches):
        for batch in batches:
            comp = zstandard.ZstdCompressor(level=LEVEL)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("part"), pa.array([comp.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())],
                                             names=["doc_id", "row", "part", "body"])

    # texts travel compressed: this shuffle is the size of the input
    bodies = texts.select("doc_id", "row", "part", "text").mapInArrow(squeezed, "doc_id long, row long, part long, body binary")
    return (bodies.groupBy("part").cogroup(ranges.groupBy("part"))
            .applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, ends array<long>"))
