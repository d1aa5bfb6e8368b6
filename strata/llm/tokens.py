"""Exact token ids of a public vocabulary file, with a cache of word pieces.

``word_bpe_49k`` drops white space, folds letter case and never merges across a blank, nor from a letter or digit to the punctuation that ends a
word.  A block of texts is cut there in numpy, its pieces are dictionary-encoded in Arrow, and only distinct pieces that the cache
lacks are encoded, together in one call: plain letters or plain punctuation by blanks, as each is one word and ends in one
word-end token, and others by a special token that cuts the result apart.  Documents that may hold a special token's text are encoded as they are.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, give_back, id_text, own_task, worker_cache

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SEPARATOR, SEPARATOR_ID = "<|endoftext|>", 49407
CACHE_PIECES = 600_000
BLOCK_BYTES = 4 << 20
TAIL = 16  # marks of punctuation that are told from the word before them; a longer run stays with its word
_BLANK = np.isin(np.arange(256), [9, 10, 32])
_PUNCTUATION = np.array([chr(c) in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" for c in range(256)])  # no apostrophe: it may open an ending
_LETTER = np.array([chr(c).isascii() and chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8) + 32 * np.array([65 <= c <= 90 for c in range(256)], dtype=np.uint8)


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts end to end, lower-cased in ASCII, and the number of pieces of each text (NULL: none).

    A piece ends at a blank, and where at most ``TAIL`` marks of punctuation up to the next blank follow an ASCII letter or digit.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    data = _LOWER[np.frombuffer(b"".join(t.as_buffer() for t in texts if t.is_valid), dtype=np.uint8)]
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(sizes), dtype=np.int64)
    blank = _BLANK[data]
    at = np.flatnonzero(blank)
    stop = np.concatenate([ends, at])
    order = np.argsort(stop, kind="stable")  # a text's end comes before a blank at the same place
    stop, begin = stop[order], np.concatenate([ends, at + 1])[order]
    begin = np.concatenate([[0], begin[:-1]])
    some = begin < stop
    begin, stop = begin[some], stop[some]
    # back from each word's end over its punctuation
    tail = np.flatnonzero(_PUNCTUATION[data[stop - 1]])
    cut = stop[tail] - 1
    for _ in range(TAIL):
        more = (cut > begin[tail]) & _PUNCTUATION[data[cut - 1]]
        if not more.any():
            break
        cut -= more
    cut = cut[(cut > begin[tail]) & _LETTER[data[cut - 1]]]
    begin, stop = np.sort(np.concatenate([begin, cut]), kind="stable"), np.sort(np.concatenate([stop, cut]), kind="stable")
    offsets = np.concatenate([[0], np.cumsum(stop - begin)])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank])])
    return pieces, np.diff(np.searchsorted(begin, ends), prepend=0)


class WordTokenizer:
    """Token ids of texts; ``cache_pieces`` bounds the memory of the cache."""

    def __init__(self, name: str = TOKENIZER, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.cache_pieces = cache_pieces
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.word_end[ends] = True

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _encode(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([SEPARATOR.join(chunks)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(ids == SEPARATOR_ID)
        if len(cuts) != len(chunks) - 1:
            return [self._whole(c).tobytes() for c in chunks]
        starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]

    def _encode_plain(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are one word each: a run of letters, or of ASCII punctuation."""
        if not chunks:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(chunks) or (len(ends) and ends[-1] != len(ids)):
            return self._encode(chunks)
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        """Id bytes of distinct pieces, from the cache and for those that it lacks from the tokenizer."""
        if 2 * len(self.cache) > self.cache_pieces:
            self.older, self.cache = self.cache, {}  # what is still in use comes back from the older half
        cache, older = self.cache, self.older
        plain, others = [], []
        for p in pieces:
            if p not in cache:
                if p in older:
                    cache[p] = older[p]
                elif (word := p.decode()).isalpha() and (word.isascii() or max(word) < "ɐ" and "İ" not in word):
                    plain.append(word)
                else:
                    others.append(word)
        for words, ids in ((plain, self._encode_plain(plain)), (others, self._encode(others))):
            cache.update(zip((w.encode() for w in words), ids))
        return [cache[p] for p in pieces]

    def _encode_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, counts = pieces_of(texts)
        coded = pieces.dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy(zero_copy_only=False)
        size = np.array([len(b) >> 2 for b in known], dtype=np.int64)
        pool, first = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(size) - size
        n = size[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.arange(total) + np.repeat(first[code] - (ends - n), n)]
        return ids, np.concatenate([[0], ends])[np.cumsum(counts)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts end to end, and where each text's end; a NULL text has none."""
        special = np.flatnonzero(pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False))
        ids, ends, total, a = [], [], 0, 0
        for b in [*special.tolist(), len(texts)]:
            if b > a:
                some, stops = self._encode_pieces(texts.slice(a, b - a))
                ids.append(some)
                ends.append(stops + total)
                total += len(some)
            if b < len(texts):
                ids.append(self._whole(texts[b].as_py()))
                total += len(ids[-1])
                ends.append(np.array([total]))
            a = b + 1
        return (np.concatenate(ids), np.concatenate(ends)) if ends else (np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64))


def tokenizer(name: str = TOKENIZER) -> WordTokenizer:
    cache = worker_cache()
    key = f"tokenizer:{name}"
    if key not in cache:
        cache[key] = WordTokenizer(name)
    return cache[key]


def _per_text(tok: WordTokenizer, texts: pa.Array) -> Iterator[np.ndarray]:
    ids, ends = tok.encode(texts)
    begin = 0
    for end in ends.tolist():
        yield ids[begin:end]
        begin = end


def token_pieces(docs: DataFrame, max_tokens: int, name: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Per document: ``doc_id``, ``doc_tokens`` (end id included) and ``crcs``, the CRC-32 of the ids in each run of ``max_tokens``.

    A NULL or empty text is the end id alone.  Rows are independent: repeated rows give repeated results.
    """
    step, end = 4 * max_tokens, np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(name)
        for batch in blocks(batches, BLOCK_BYTES):
            ids = [own.tobytes() + end for own in _per_text(tok, batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(raw) // 4 for raw in ids], pa.int64()),
                 pa.array([[zlib.crc32(raw[i:i + step]) for i in range(0, len(raw), step)] for raw in ids], pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "crcs"])
            del ids
            give_back()

    return id_text(docs).mapInArrow(own_task("tokens", run), "doc_id long, doc_tokens long, crcs array<long>")


def token_counts(docs: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """``length``: the number of token ids of every document's text (NULL or empty: 0)."""

    def run(batches):
        tok = tokenizer(name)
        for batch in blocks(batches, BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(tok.encode(batch.column("text"))[1], prepend=0), pa.int64())], names=["length"])

    return id_text(docs).select(F.col("text")).mapInArrow(own_task("tokens", run), "length long")


def token_ids(docs: DataFrame, name: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int, end id included) of every document."""

    def run(batches):
        tok = tokenizer(name)
        for batch in blocks(batches, BLOCK_BYTES):
            ids = [np.append(own, end_id).astype(np.int32) for own in _per_text(tok, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(own_task("tokens", run), "doc_id long, ids array<int>")
