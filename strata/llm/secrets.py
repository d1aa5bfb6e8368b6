"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_text, own_task

KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# Letters are spelled in both cases: ignoring case would also accept letters beyond ASCII that fold to k or s.
ASSIGN = re.compile(f"({'|'.join(map(_either_case, ('password', 'passwd', 'secret', 'token')))}|{_either_case('api')}_?{_either_case('key')})"
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run is taken whole from its first character on, so runs that are too short can be passed over at once.
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGITS = re.compile(r"[0-9]")
LETTERS = re.compile(r"[A-Za-z]")

# Symbols of the Markov models: a-z, A-Z and 0-9 by name, everything else one symbol; the last is the edge.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
OTHER, EDGE, N_SYMBOLS = 62, 63, 64
_SYMBOL = np.full(256, OTHER, dtype=np.uint8)
_SYMBOL[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(62)
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
RATIO = 0.5  # mean log-likelihood ratio per character from which a string counts as random


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, by start, then kind; per kind leftmost and not overlapping."""
    out = []
    folded = text.lower()
    if any(k in folded for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def symbols(token: str) -> np.ndarray:
    return _SYMBOL[np.frombuffer(token.encode(), dtype=np.uint8)]


def transition_counts(tokens: list[str]) -> np.ndarray:
    """First-order transition counts, from and to the edge included, over ``tokens`` laid end to end."""
    joined = _SYMBOL[np.frombuffer(("\x00" + "\x00".join(tokens) + "\x00").encode(), dtype=np.uint8)].astype(np.int64)
    joined[np.concatenate([[0], np.cumsum([len(t) + 1 for t in tokens])])] = EDGE
    return np.bincount(joined[:-1] * N_SYMBOLS + joined[1:], minlength=N_SYMBOLS * N_SYMBOLS)


def samples(text: str) -> tuple[list[str], list[str]]:
    """Labelled strings of a text: values that the fixed patterns find (random), words elsewhere (ordinary)."""
    spans = base_spans(text)
    random = []
    for a, b, kind in spans:
        if kind == "assign":
            m = ASSIGN.match(text, a)
            if m and len(m[2]) >= 16 and DIGITS.search(m[2]):
                random.append(m[2])
        else:
            random.append(text[a:b])
    if spans:
        rest, at = [], 0
        for a, b, _ in spans:
            rest.append(text[at:a])
            at = max(at, b)
        rest.append(text[at:])
        text = " ".join(rest)
    ordinary = [t for t in IDENTIFIER.findall(text) if not (len(t) >= 20 and DIGITS.search(t) and LETTERS.search(t))]
    return random, ordinary


def log_ratio(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log of how much likelier each transition is under ``random``; both are smoothed, the random model towards even odds."""
    r = random.reshape(N_SYMBOLS, N_SYMBOLS) + 5.0
    # a random string may use any alphabet: what is rare in the sample of one alphabet keeps a fair share
    r = 0.5 * r / r.sum(axis=1, keepdims=True) + 0.5 / N_SYMBOLS
    o = ordinary.reshape(N_SYMBOLS, N_SYMBOLS) + 0.5
    return np.log(r) - np.log(o / o.sum(axis=1, keepdims=True))


def train(docs: DataFrame) -> np.ndarray | None:
    """The transition log-ratios from all documents: two 64 x 64 count tables are summed by Spark, whatever the input.

    Labels are the fixed patterns' own finds; without any find the model of random strings is even odds, as smoothing leaves it.
    Without any labelled string, ordinary ones included, there is nothing to compare (None).
    """

    def run(batches):
        total = np.zeros((2, N_SYMBOLS * N_SYMBOLS), dtype=np.int64)
        for batch in blocks(batches, 4 << 20):
            tokens = ([], [])
            for text in batch.column("text").to_pylist():
                for side, found in zip(tokens, samples(text)):
                    side.extend(found)
            for k in (0, 1):
                if tokens[k]:
                    total[k] += transition_counts(tokens[k])
        cells = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total.reshape(-1)[cells], pa.int64())], names=["cell", "n"])

    cells = id_text(docs).select("text").mapInArrow(own_task("secrets", run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * N_SYMBOLS * N_SYMBOLS)
    for r in cells:
        counts[r["cell"]] = r["n"]
    counts = counts.reshape(2, -1)
    return log_ratio(counts[0], counts[1]) if counts.sum() else None


def random_spans(text: str, ratio: np.ndarray, least: float = RATIO) -> list[tuple[int, int, str]]:
    """Strings of 20 characters or more, with letters and digits, that the random model explains better."""
    out = []
    for m in TOKEN.finditer(text):
        token = m[0]
        if DIGITS.search(token) and LETTERS.search(token):
            s = symbols(token)
            if ratio[s[:-1], s[1:]].mean() >= least:
                out.append((m.start(), m.end(), "random"))
    return out


def uncovered(start: int, end: int, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of ``[start, end)`` outside all of ``spans``, which are in order of their start."""
    out = []
    for a, b, _ in spans:
        if a >= end:
            break
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return out + [(start, end)] if start < end else out


def all_spans(text: str, ratio: np.ndarray | None, least: float = RATIO) -> list[tuple[int, int, str]]:
    """Base spans, and whatever of random strings no base span covers."""
    base = base_spans(text)
    if ratio is None:
        return base
    more = [(a, b, kind) for start, end, kind in random_spans(text, ratio, least) for a, b in uncovered(start, end, base)]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, ratio: np.ndarray | None, least: float = RATIO) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``(kind, start, end)`` in code points, for every document.

    NULL text is empty and has no span; repeated rows are scanned one by one; an empty table gives no row.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in blocks(batches, 4 << 20):
            found = [[{"kind": k, "start": a, "end": b} for a, b, k in all_spans(t, ratio, least)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    return id_text(docs).mapInArrow(own_task("secrets", run), "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redacted_text(text: str, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    out, at = [], 0
    for a, b, _ in spans:
        if b > at:
            if a >= at:
                out += [text[at:a], mark]
            at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, ratio: np.ndarray | None, least: float = RATIO) -> DataFrame:
    """``docs`` with every span replaced by a mark; other columns stay, ``n_chars`` (if there) follows the new text."""
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in blocks(batches, 4 << 20):
            texts = [t if t is None else redacted_text(t, all_spans(t, ratio, least)) for t in batch.column("text").to_pylist()]
            yield batch.set_column(text_at, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(own_task("secrets", run), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out
