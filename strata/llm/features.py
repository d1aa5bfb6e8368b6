"""Hashed n-gram features, labelled samples and linear models shared by the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

SEGMENT = 1 << 18  # code points handled at once


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def char_ngram_counts(texts: list[str], dims: int, orders: tuple[int, ...], fold) -> np.ndarray:
    """Counts of hashed character n-grams of whole texts, one row a text; ``fold`` maps code points to symbols.

    ``dims`` is a power of two.  A long text is counted in parts (an n-gram belongs to the part that it starts in), so memory does not
    follow its length.
    """
    out = np.zeros((len(texts), dims), dtype=np.float32)
    reach, mask = max(orders) - 1, np.uint32(dims - 1)
    for i, text in enumerate(texts):
        symbols = fold(code_points(text))
        for a in range(0, len(symbols), SEGMENT):
            part = symbols[a:a + SEGMENT + reach].astype(np.uint32, copy=False)
            slots, h = [], np.zeros(len(part), dtype=np.uint32)
            for n in range(1, min(reach + 1, len(part)) + 1):
                h = (h[:len(part) - n + 1] + part[n - 1:]) * np.uint32(2654435761)
                h ^= h >> np.uint32(15)
                if n in orders:
                    slots.append((h[:SEGMENT] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) & mask)
            if slots:
                out[i] += np.bincount(np.concatenate(slots), minlength=dims)
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def labelled_ids(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` ``doc_id, label`` rows of each class 0 and 1, the first by a hash of the id.

    Rows with a NULL id or label are left out; an id labelled both ways counts as 0.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.col(label)).cast("int").alias("label")))
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def collected_features(rows: DataFrame, dims: int, vectors) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows (``vectors(texts)``) and labels of a sample ``doc_id, label, text``, in an order of its own content.

    A sample bounded in ids is bounded in rows: the rows of one id and label are one, of the smallest text that is not empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                x = vectors(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary())], names=["doc_id", "label", "x"])

    one = rows.groupBy("doc_id", "label").agg(F.coalesce(F.min(F.nullif(F.col("text"), F.lit(""))), F.lit("")).alias("text"))
    one = one.repartition(shuffle_partitions(rows.sparkSession), "doc_id")  # few bytes, yet costly vectors: not all in one task
    got = one.mapInArrow(run, "doc_id long, label string, x binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))
    x = np.frombuffer(b"".join(r["x"] for r in got), dtype=np.float32).reshape(len(got), dims)
    return x, np.array([r["label"] for r in got])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with balanced classes, by full-batch Adam steps (deterministic)."""
    n_pos = max(1, int(y.sum()))
    n_neg = max(1, len(y) - n_pos)
    weight = np.where(y == 1, 0.5 / n_pos, 0.5 / n_neg).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        e = (sigmoid(x @ w + np.float32(b)) - y) * weight  # single precision, so that x is not copied as doubles at each step
        g, gb = x.T @ e + l2 * w, float(e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w, b = w - (lr * m / (np.sqrt(v) + 1e-8)).astype(np.float32), b - lr * mb / (np.sqrt(vb) + 1e-8)
    return w, float(b)


def linear_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge, balanced classes); ``y`` is 0 or 1."""
    sign = np.where(y == 1, 1.0, -1.0).astype(np.float32)
    n_pos = max(1, int((sign > 0).sum()))
    n_neg = max(1, int((sign < 0).sum()))
    weight = np.where(sign > 0, 0.5 / n_pos, 0.5 / n_neg).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - sign * (x @ w + np.float32(b)))
        e = -2 * slack * sign * weight
        g, gb = x.T @ e + l2 * w, float(e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w, b = w - (lr * m / (np.sqrt(v) + 1e-8)).astype(np.float32), b - lr * mb / (np.sqrt(vb) + 1e-8)
    return w, float(b)
