"""Benchmark decontamination with an FM-index per shard of the training text.

Windows of ten words of every benchmark item are searched backwards in the index of each shard; occurrences are
located by sampled suffix positions and their spans are merged per document.

The distinct windows are a table made by Spark, dealt into blocks of bounded size.  One block at a time is broadcast, searched in a
written pass over the documents and released, so neither the driver nor a worker ever holds more of a benchmark than one block.  A hit
carries the number of its window; the items that hold a window are joined to it afterwards.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, own_task, worker_cache, written
from .fm_index import FMIndex
from .term_scan import FOLD
from .word_hash import split_hashes

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_BYTES = 8 << 20  # of windows (eight bytes a word) that are broadcast and searched at once
WINDOWS_OUT = 1 << 14  # windows that a batch hands over
SALTS = 16

BREAK, OTHER = 1, 2  # symbols of the end of a document's part, and of a word that no window holds


def words_of(texts: list[str]) -> list[np.ndarray]:
    """The words of each text, as 64-bit hashes: lower-cased runs of digits, a-z and characters beyond ASCII."""
    return split_hashes([t.encode().translate(FOLD) for t in texts])


class Phrases:
    """A block of distinct windows by length, as symbols of the index, and their numbers."""

    def __init__(self, windows: dict[int, tuple[np.ndarray, np.ndarray]], window: int):
        """``windows``: for each length the word hashes, one row a window, and the windows' numbers."""
        self.window = window
        self.vocabulary = np.unique(np.concatenate([*(w.ravel() for w, _ in windows.values()), np.empty(0, dtype=np.uint64)]))
        self.by_length = {n: (self.symbols(words.ravel()).reshape(words.shape), numbers) for n, (words, numbers) in sorted(windows.items())}
        self.n_symbols = len(self.vocabulary) + 3

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Words as symbols of the index: their place in the vocabulary, or ``OTHER``."""
        if not len(self.vocabulary):
            return np.full(len(words), OTHER, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 3, OTHER)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of several runs."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def search_shard(parts: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``part, start, length, window`` of every occurrence of every window in the parts of one shard."""
    sizes = np.array([len(p) + 1 for p in parts])
    text = np.full(int(sizes.sum()), BREAK, dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    for b, p in zip(begin.tolist(), parts):
        text[b:b + len(p)] = p
    # words that no window holds, and runs of others shorter than every window, match nothing: one symbol stands for each such run
    foreign = text <= OTHER
    edge = np.flatnonzero(np.diff(foreign, prepend=True, append=True))
    short = np.diff(edge)[0::2] < min(phrases.by_length)
    text[np.repeat(edge[0::2][short], np.diff(edge)[0::2][short]) + _within(np.diff(edge)[0::2][short])] = OTHER
    foreign = text <= OTHER
    keep = np.ones(len(text), dtype=bool)
    keep[1:] = ~(foreign[1:] & foreign[:-1])
    place = np.flatnonzero(keep)
    index = FMIndex(text[place], phrases.n_symbols)
    found = []
    for n, (patterns, numbers) in phrases.by_length.items():
        lo, hi = index.search(patterns)
        count = hi - lo
        rows = _within(count) + np.repeat(lo, count)
        at = place[index.locate(rows)] if len(rows) else rows
        part = np.searchsorted(begin, at, side="right") - 1
        found.append((part, at - begin[part], np.full(len(at), n), np.repeat(numbers, count)))
    return tuple(np.concatenate(x) for x in zip(*found))


def occurrences(documents: list[np.ndarray], phrases: Phrases, shard_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``document, start, end, window`` of every occurrence, places in words."""
    found: list[tuple[np.ndarray, ...]] = [tuple(np.empty(0, dtype=np.int64) for _ in range(4))]
    parts, owners, total = [], [], 0

    def flush():
        nonlocal parts, owners, total
        if parts:
            part, start, n, number = search_shard(parts, phrases)
            doc, base = np.array(owners, dtype=np.int64)[part].T
            found.append((doc, base + start, base + start + n, number))
        parts, owners, total = [], [], 0

    for i, words in enumerate(documents):
        if len(words) < min(phrases.by_length, default=len(words) + 1):
            continue
        ids = phrases.symbols(words)
        # a document longer than a shard is indexed in parts that overlap by a window less one word
        for a in range(0, max(1, len(ids) - phrases.window + 1), shard_words):
            part = ids[a:a + shard_words + phrases.window - 1]
            if total and total + len(part) > shard_words:
                flush()
            parts.append(part)
            owners.append((i, a))
            total += len(part)
    flush()
    return tuple(np.concatenate(x) for x in zip(*found))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of each document as one, in order."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    base = doc * (int(end.max()) + 2)  # documents lie apart, so one running maximum serves all
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = base[1:] + start[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return doc[begin], start[begin], (reach - base)[np.append(begin[1:], len(doc)) - 1]


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """The values of each of ``n`` owners, which are in order, as lists."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values)


def windows_of(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Written ``gram, number`` of the distinct windows of all items, and ``number, item`` of the items that hold each.

    A gram is the hashes of its words, eight bytes each.  A window of very many items is one row of the first and many of the second.
    """

    def run(batches):
        for batch in batches:
            for item, words in zip(batch.column("item").to_pylist(), words_of(batch.column("text").to_pylist())):
                n = min(window, len(words))
                for a in range(0, len(words) - n + 1 if n else 0, WINDOWS_OUT):
                    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(words, n)[a:a + WINDOWS_OUT])
                    raw = grams.astype("<u8").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(grams), pa.string()), pa.array([raw[8 * n * i:8 * n * (i + 1)] for i in range(len(grams))], pa.binary())], names=["item", "gram"])

    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text")
    each = written(items.mapInArrow(own_task("decontaminate", run), "item string, gram binary").distinct(), "windows")
    grams = written(each.select("gram").distinct().withColumn("number", F.monotonically_increasing_id()), "windows")
    return grams, written(each.join(grams, "gram").select("number", "item"), "windows")


class Block:
    """A broadcast block of windows; a worker builds its phrases once."""

    def __init__(self, grams: DataFrame, window: int):
        table = grams.select("gram", "number").toArrow()
        raw, numbers = table.column("gram").to_pylist(), table.column("number").to_numpy()
        size, windows = np.array([len(g) // 8 for g in raw], dtype=np.int64), {}
        for n in np.unique(size).tolist():
            some = np.flatnonzero(size == n)
            windows[n] = np.frombuffer(b"".join(raw[i] for i in some.tolist()), dtype="<u8").reshape(len(some), n), numbers[some]
        self.id, self.shared = uuid.uuid4().hex, grams.sparkSession.sparkContext.broadcast((windows, window))

    def phrases(self) -> Phrases:
        cache = worker_cache()
        if cache.get("phrases", (None,))[0] != self.id:
            cache["phrases"] = (self.id, Phrases(*self.shared.value))
        return cache["phrases"][1]

    def release(self) -> None:
        self.shared.unpersist()


def window_blocks(grams: DataFrame, window: int, block_bytes: int):
    """The windows in blocks of about ``block_bytes``: numbers, which are distinct, are dealt out by their hash."""
    n_blocks = max(1, -(-grams.count() * 8 * window // block_bytes))
    dealt = grams.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n_blocks)))
    for k in range(n_blocks):
        yield k, n_blocks, Block(dealt.where(F.col("block") == k), window)


SPANS = "array<struct<start:bigint,end:bigint>>"


def _in_runs(batches, shard_words: int):
    """Slices of the batches of about a shard's words of ``text``."""
    for batch in batches:
        texts = batch.column("text")
        start, size = 0, 0
        for i in range(batch.num_rows + 1):
            n = len(texts[i].as_py() or "") if i < batch.num_rows else 0
            if start < i and (i == batch.num_rows or size + n > 5 * shard_words):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n


def _searched(rows: DataFrame, block: Block, shard_words: int) -> DataFrame:
    """``row, doc_id, n_words, spans, windows`` of rows ``row, doc_id, text``: merged spans and the numbers of the windows found."""

    def run(batches):
        phrases = block.phrases()
        for batch in _in_runs(batches, shard_words):
            n, documents = batch.num_rows, words_of(batch.column("text").to_pylist())
            doc, start, end, number = occurrences(documents, phrases, shard_words)
            pair = np.unique(np.stack([doc, number], axis=1), axis=0)
            doc, start, end = merged(doc, start, end)
            spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array([len(w) for w in documents], pa.int64()), _lists(doc, spans, n),
                                              _lists(pair[:, 0], pa.array(pair[:, 1], pa.int64()), n)], names=["row", "doc_id", "n_words", "spans", "windows"])

    return rows.select("row", "doc_id", "text").mapInArrow(own_task("decontaminate", run), f"row long, doc_id long, n_words long, spans {SPANS}, windows array<long>")


def _merged_hits(parts: DataFrame) -> DataFrame:
    """``row, spans, windows`` of the rows with hits, over all blocks."""
    hits = parts.where(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("windows")).alias("windows"))

    def run(batches):
        for batch in batches:
            spans = batch.column("spans")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
            flat = spans.flatten()
            doc, start, end = merged(doc, flat.field("start").to_numpy(), flat.field("end").to_numpy())
            pairs = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(doc, pairs, batch.num_rows), batch.column("windows")], names=["row", "spans", "windows"])

    return hits.mapInArrow(own_task("decontaminate", run), f"row long, spans {SPANS}, windows array<long>")


def _items_found(hits: DataFrame, holders: DataFrame) -> DataFrame:
    """``row, items`` of the rows with hits.  Windows that many documents hit are dealt over salts, with as many copies of their items."""
    hit = hits.select("row", F.explode("windows").alias("number")).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    holder = holders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = hit.join(holder, ["number", "salt"]).select("row", F.struct(F.col("item").isNull().alias("none"), "item").alias("i"))
    return own.groupBy("row").agg(F.transform(F.array_sort(F.collect_set("i")), lambda i: i["item"]).alias("items"))


def with_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items``: merged word spans ``[start, end)`` of benchmark windows, and the items found, in order.

    A window is ``window`` consecutive words of an item, or a whole shorter item; items without words match nothing.  Items with a NULL
    ``item_id`` are searched like the others; in ``items`` all of them are one NULL, the last entry.  NULL text has no words; repeated rows are searched one by one; an empty benchmark hits nothing; an empty table gives no row.
    """
    grams, holders = windows_of(benchmark, window)
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    parts = []
    for k, n_blocks, block in window_blocks(grams, window, block_bytes):
        if not k and n_blocks > 1:
            rows = written(rows, "decontaminate")  # so that a row keeps its number in every pass
        parts.append(written(_searched(rows, block, shard_words), "decontaminate"))
        block.release()
    if len(parts) == 1:
        held = parts[0].where(F.size("spans") > 0)
        bare = parts[0].where(F.size("spans") == 0).select("doc_id", "n_words", "spans")
    else:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        hits = written(_merged_hits(every), "decontaminate")
        held = parts[0].select("row", "doc_id", "n_words").join(hits, "row")
        bare = parts[0].join(hits, "row", "left_anti").select("doc_id", "n_words", F.array().cast(SPANS).alias("spans"))
    named = held.join(_items_found(held, holders), "row").select("doc_id", "n_words", "spans", "items")
    return named.unionByName(bare.withColumn("items", F.array().cast("array<string>")))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any benchmark window, with all their columns; same rules as :func:`with_hits`."""
    for k, n_blocks, block in window_blocks(windows_of(benchmark, window)[0], window, block_bytes):
        docs = _kept(docs, block, shard_words)
        if k < n_blocks - 1:
            docs = written(docs, "decontaminate")
            block.release()
    return docs


def _kept(docs: DataFrame, block: Block, shard_words: int) -> DataFrame:
    def run(batches):
        phrases = block.phrases()
        for batch in _in_runs(batches, shard_words):
            doc = occurrences(words_of([t or "" for t in batch.column("text").to_pylist()]), phrases, shard_words)[0]
            free = np.ones(batch.num_rows, dtype=bool)
            free[doc] = False
            yield batch.filter(pa.array(free))

    return docs.mapInArrow(own_task("decontaminate", run), docs.schema)
