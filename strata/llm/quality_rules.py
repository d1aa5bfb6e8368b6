"""Quality rules: counted base rules and a calibrated n-gram logistic regression against fixed thresholds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_text, mix64, own_task
from .features import char_ngram_counts, collected_features, labelled_ids, logistic, sigmoid, unit_rows
from .word_hash import split_hashes

CHAR_DIMS = 2048
WORD_DIMS = 2048
CHAR_ORDERS = (1, 2, 3)
SAMPLE_PER_CLASS = 1500  # labelled rows a class that the model is fitted on, at most
THRESHOLD = 0.3  # calibrated probability of quality 1 below which a document goes
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
# Characters that separate words: the blank and 0x09 to 0x0D, just where bytes.split() splits.
SEPARATORS = " \t\n\x0b\x0c\r"


class Words:
    """The bytes of a run of texts, and the hashes of each text's words."""

    def __init__(self, texts: list[str]):
        self.bytes = [t.encode() for t in texts]
        self.hashes = split_hashes(self.bytes)


def _symbols(points: np.ndarray) -> np.ndarray:
    """Digits become one symbol and letters beyond ASCII another; the rest keeps its case and shape."""
    out = points.copy()
    out[(points >= 48) & (points <= 57)] = 48
    out[points > 127] = 128
    return out


def word_features(ids: np.ndarray) -> np.ndarray:
    """Hashed counts of words and of word pairs, of equal neighbours and of words seen before; ``WORD_DIMS`` wide."""
    x = np.zeros(WORD_DIMS, dtype=np.float32)
    if len(ids):
        half = WORD_DIMS // 2
        x[:half] = np.bincount((ids & np.uint64(half - 1)).astype(np.int64), minlength=half)
        pairs = (ids[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ ids[1:]) % np.uint64(half - 16)
        x[half:WORD_DIMS - 16] = np.bincount(pairs.astype(np.int64), minlength=half - 16)
        x[WORD_DIMS - 1] = float((ids[1:] == ids[:-1]).sum())
        x[WORD_DIMS - 2] = float((np.diff(np.sort(ids)) == 0).sum())
    return x


def vectors(texts: list[str], words: Words | None = None) -> np.ndarray:
    """Feature rows: log-scaled unit vectors of character n-grams beside those of word n-grams."""
    if not texts:
        return np.zeros((0, CHAR_DIMS + WORD_DIMS), dtype=np.float32)
    words = words or Words(texts)
    chars = char_ngram_counts(texts, CHAR_DIMS, CHAR_ORDERS, _symbols)
    grams = np.stack([word_features(h) for h in words.hashes])
    return np.concatenate([unit_rows(np.log1p(chars)), unit_rows(np.log1p(grams))], axis=1).astype(np.float32)


class Model:
    """Logistic regression with Platt scaling; ``probability`` is of label 1."""

    def __init__(self, w: np.ndarray, b: float, scale: float, shift: float):
        self.w, self.b, self.scale, self.shift = w, b, scale, shift

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * (x @ self.w + self.b) + self.shift)


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Scale and shift that make margins probabilities (Newton steps on smoothed targets)."""
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + c)
        r, s = p - target, p * (1 - p) + 1e-9
        g = np.array([(r * margin).sum() + 1e-6 * a, r.sum()])
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(c)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on at most ``per_class`` labelled documents a class, calibrate on every fourth of them that the fit does not see.

    Both classes weigh the same, so probabilities refer to even odds.  Without documents of both classes there is no model (None): then the base rules alone decide.
    """
    ids = labelled_ids(labels, "quality", per_class)
    rows = id_text(docs).join(F.broadcast(ids), "doc_id").withColumn("label", F.col("label").cast("string"))
    x, y = collected_features(rows, CHAR_DIMS + WORD_DIMS, vectors)
    y = (y == "1").astype(np.float32)
    if not len(y) or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 4 == 3
    if y[held].size < 8 or y[held].min() == y[held].max() or y[~held].min() == y[~held].max():
        held = np.zeros(len(y), dtype=bool)
    w, b = logistic(x[~held], y[~held])
    margin = x @ w + b
    if held.any():
        scale, shift = platt(margin[held], y[held])
    else:
        scale, shift = platt(margin, y)
    return Model(w, b, scale, shift)


def base_counts(texts: list[str], words: Words) -> dict[str, list[int]]:
    """The counts of the base rules for whole texts."""
    return {"n_words": [len(h) for h in words.hashes],
            "word_chars": [len(t) - len(b) + len(b.translate(None, SEPARATORS.encode())) for t, b in zip(texts, words.bytes)],
            "n_symbols": [len(b) - len(b.translate(None, SYMBOLS.encode())) for b in words.bytes],
            "n_dup_lines": [_dup_lines(b) for b in words.bytes],
            "n_repeat_words": [_repeat_words(h) for h in words.hashes]}


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    seen, dup = set(), 0
    for line in lines:
        if line in seen:
            dup += bool(line.strip())
        else:
            seen.add(line)
    return dup


def _repeat_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that the text holds twice or more, by the hashes of its words."""
    if len(ids) < 4:
        return 0
    key = mix64(mix64(ids[:-2]) + ids[1:-1]) + ids[2:]
    order = np.argsort(key)
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        hit[order[1:][same] + k] = True
        hit[order[:-1][same] + k] = True
    return int(hit.sum())


def judged(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and verdict of every document: ``doc_id``, the base counts, ``base_failed``, ``probability``, ``kept``.

    NULL and empty texts have no words and fail; repeated rows are judged alike; an empty table gives no row.
    """
    return _scored(id_text(docs).select("doc_id", "text"), model, threshold, [])


def _scored(rows: DataFrame, model: Model | None, threshold: float, carried: list[str]) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    packed = None if model is None else (model.w.tobytes(), model.b, model.scale, model.shift)

    def run(batches):
        m = None if packed is None else Model(np.frombuffer(packed[0], dtype=np.float32), *packed[1:])
        for batch in blocks(batches, 1 << 20, 256):
            texts = batch.column("text").to_pylist()
            words = Words(texts)
            base = base_counts(texts, words)
            n, rep = np.array(base["n_words"]), np.array(base["n_repeat_words"])
            failed = (n < MIN_WORDS) | (100 * rep > MAX_REPEAT_PERCENT * n)
            p = np.ones(len(texts)) if m is None else m.probability(vectors(texts, words)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(base[k], pa.int64()) for k in names], pa.array(failed), pa.array(p, pa.float64()), pa.array(~failed & (p >= threshold))],
                names=["doc_id", *names, "base_failed", "probability", "kept"])

    return rows.mapInArrow(own_task("quality_rules", run), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass the rules, with all their columns, in one pass and without a shuffle."""
    packed = None if model is None else (model.w.tobytes(), model.b, model.scale, model.shift)

    def run(batches):
        m = None if packed is None else Model(np.frombuffer(packed[0], dtype=np.float32), *packed[1:])
        for batch in blocks(batches, 1 << 20, 256):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            words = Words(texts)
            base = base_counts(texts, words)
            n, rep = np.array(base["n_words"]), np.array(base["n_repeat_words"])
            ok = (n >= MIN_WORDS) & (100 * rep <= MAX_REPEAT_PERCENT * n)
            if m is not None:
                ok &= m.probability(vectors(texts, words)) >= threshold
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(own_task("quality_rules", run), docs.schema)
