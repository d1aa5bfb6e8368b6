"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

Documents are cut every ``max_len`` tokens, which leaves one rest per document.  The histogram of piece
lengths has at most ``max_len`` rows however many documents there are; packing works on it alone, and
its patterns are joined back to the pieces by their rank within a length.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, written
from .tokens import TOKENIZER, token_ids, token_pieces

MAX_LEN = 4096


def pack_histogram(histogram: dict[int, int], max_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(count, [(length, copies), ...])`` that hold every piece of the histogram exactly once.

    Lengths are placed longest first, each into the packs that are shortest so far; packs with the same
    content are one pattern with a count.  A new pack is opened only when the shortest one has no room.
    """
    groups: dict[int, list[list]] = {}  # room left -> [count, pattern]
    rooms: list[int] = []  # heap of -room

    def put(room: int, count: int, pattern: tuple) -> None:
        if count:
            if room not in groups:
                groups[room] = []
                heapq.heappush(rooms, -room)
            groups[room].append([count, pattern])

    def extended(pattern: tuple, length: int, copies: int) -> tuple:
        if pattern and pattern[-1][0] == length:
            return pattern[:-1] + ((length, pattern[-1][1] + copies),)
        return pattern + ((length, copies),)

    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        left = histogram[length]
        while left:
            room = -rooms[0] if rooms else -1
            if room < length:
                each = max_len // length
                put(max_len - each * length, left // each, ((length, each),))
                if left % each:
                    put(max_len - (left % each) * length, 1, ((length, left % each),))
                break
            count, pattern = groups[room].pop()
            if not groups[room]:
                del groups[room]
                heapq.heappop(rooms)
            below = -rooms[0] if rooms else 0
            # as many copies at once as keep these packs the shortest, while all of them get as many
            copies = max(1, min((room - below) // length, left // count, room // length))
            used = min(count, left)
            if used < count:
                copies = 1
                put(room, count - used, pattern)
            put(room - copies * length, used, extended(pattern, length, copies))
            left -= used * copies
    return [(count, list(pattern)) for room in sorted(groups) for count, pattern in groups[room]]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, rank_lo, rank_hi, copies, first_sequence, offset)``: who of a length goes where."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            lo = taken.get(length, 0)
            taken[length] = lo + count * copies
            rows.append((length, lo, lo + count * copies, copies, sequence, offset))
            offset += length * copies
        sequence += count
    return rows


def ranked(pieces: DataFrame, length: str, order: list[str], salts: int) -> DataFrame:
    """``rank`` from 0 within each length, gapless.

    A length that holds a third of all pieces is numbered in ``salts`` parts, each after the others' counts.
    """
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = Window.partitionBy(length).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy(length, "salt").agg(F.count("*").alias("n"))
            .select(length, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    own = F.row_number().over(Window.partitionBy(length, "salt").orderBy(*order)) - 1
    return (salted.withColumn("own", own).join(base, [length, "salt"])
            .withColumn("rank", F.col("base") + F.col("own")).drop("salt", "own", "base"))


def pack(docs: DataFrame, max_len: int = MAX_LEN, tokenizer: str = TOKENIZER, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document's ids, then ``end_id``, are cut every ``max_len``; each sequence holds at most ``max_len`` ids and its pieces
    lie gapless from offset 0.  NULL texts count as empty (a piece of one end id); repeated rows are packed
    one by one; an empty table gives no piece.  Only the length histogram (``max_len`` rows at most) and the
    patterns made from it reach the driver.
    """
    spark = docs.sparkSession
    table = written(token_pieces(docs, max_len, tokenizer, end_id), "pack")
    start = F.col("i") * F.lit(max_len).cast("bigint")
    pieces = (table.select("doc_id", "doc_tokens", F.posexplode("crcs").alias("i", "ids_crc32"))
              .select("doc_id", start.alias("start"), F.least(F.lit(max_len).cast("bigint"), F.col("doc_tokens") - start).alias("length"),
                      "ids_crc32", "doc_tokens"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = slots(pack_histogram(histogram, max_len))
    places = spark.createDataFrame(rows, "length long, lo long, hi long, copies long, first long, at long").withColumnRenamed("length", "of")
    p = ranked(pieces, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"], max(16, shuffle_partitions(spark)))
    own = F.col("rank") - F.col("lo")
    return (p.join(F.broadcast(places), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("first") + F.floor(own / F.col("copies"))).cast("bigint").alias("sequence_id"),
                    (F.col("at") + F.pmod(own, F.col("copies")) * F.col("length")).cast("bigint").alias("offset")))


def sequences(docs: DataFrame, pieces: DataFrame, tokenizer: str = TOKENIZER, end_id: int = 2) -> DataFrame:
    """``sequence_id`` and its ``ids`` (array of int): the packed sequences themselves.  ``doc_id`` must be unique."""
    cut = (pieces.join(token_ids(docs, tokenizer, end_id), "doc_id")
           .select("sequence_id", "offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("part")))
    return (cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "part"))).alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.part")).alias("ids")))
