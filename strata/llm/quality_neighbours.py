"""Quality by nearest neighbours: cosine-weighted votes of labelled documents in a latent-semantic space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_text
from .features import char_ngram_counts, collected_features, labelled_ids, unit_rows
from .word_hash import split_hashes

DIMS = 4096
ORDERS = (1, 2, 3)
LATENT = 48
NEIGHBOURS = 31
SAMPLE_PER_CLASS = 1500  # labelled documents a class that vote, at most: the bound of what is broadcast
POWER = 8


def _shapes(points: np.ndarray) -> np.ndarray:
    """Letters become their case class, digits one symbol, line ends and other characters stay: the shape of the text."""
    out = points.copy()
    lower, upper = (points >= 97) & (points <= 122), (points >= 65) & (points <= 90)
    out[lower | (points >= 0xDF) & (points <= 0xFF)] = 97
    out[upper | (points >= 0xC0) & (points < 0xDF)] = 65
    out[(points >= 48) & (points <= 57)] = 48
    out[points > 0xFF] = 0x100
    keep = np.ones(len(out), dtype=bool)
    if len(out) > 2:
        keep[2:] = (out[2:] != out[1:-1]) | (out[2:] != out[:-2])  # runs of one class shrink to two
    return out[keep]


def _words(ids: np.ndarray) -> np.ndarray:
    """Hashed counts of words, and of words that repeat the one before."""
    x = np.zeros(DIMS // 2, dtype=np.float32)
    if len(ids):
        x[:] = np.bincount((ids % np.uint64(len(x) - 1)).astype(np.int64), minlength=len(x))
        x[-1] = 4 * float((ids[1:] == ids[:-1]).sum())
    return x


def vectors(texts: list[str]) -> np.ndarray:
    if not texts:
        return np.zeros((0, DIMS), dtype=np.float32)
    shapes = char_ngram_counts(texts, DIMS // 2, ORDERS, _shapes)
    words = np.stack([_words(h) for h in split_hashes([t.encode() for t in texts])])
    return np.concatenate([2 * unit_rows(np.log1p(shapes)), unit_rows(np.log1p(words))], axis=1).astype(np.float32)


class Space:
    """A latent-semantic projection with labelled unit vectors in it."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray, points: np.ndarray, labels: np.ndarray):
        self.idf, self.axes, self.points, self.labels = idf, axes, points, labels

    def project(self, x: np.ndarray) -> np.ndarray:
        return unit_rows((x * self.idf) @ self.axes)

    def vote(self, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of similarity held by neighbours of label 1, over the exact nearest by cosine.

        Of points that are equally near at the edge those that come first are taken (points are in order of their ids).  A vector without
        features is equally far from all points, and all of them vote alike.
        """
        own = self.project(x)
        cosine = own @ self.points.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        edge = np.take_along_axis(cosine, near, axis=1).min(axis=1)
        for i in np.flatnonzero((cosine >= edge[:, None]).sum(axis=1) > k).tolist():
            near[i] = np.lexsort((np.arange(cosine.shape[1]), -cosine[i]))[:k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3).astype(np.float64) ** POWER
        return np.where(own.any(axis=1), (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), self.labels.mean(dtype=np.float64))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, latent: int = LATENT) -> Space | None:
    """The space of at most ``per_class`` labelled documents of each class; None without any.

    Both classes bring the same number of points where the labels allow, so a vote refers to even odds.
    """
    ids = labelled_ids(labels, "quality", per_class)
    rows = id_text(docs).join(F.broadcast(ids), "doc_id").withColumn("label", F.col("label").cast("string"))
    x, y = collected_features(rows, DIMS, vectors)
    if not len(y):
        return None
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x = x * idf
    gram = x @ x.T
    values, left = np.linalg.eigh(gram.astype(np.float64))
    top = np.argsort(values)[::-1][:min(latent, len(values))]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-30)]
    axes = (x.T @ left[:, top] / np.sqrt(values[top])).astype(np.float32) if len(top) else np.zeros((DIMS, 1), dtype=np.float32)
    return Space(idf, axes, unit_rows(x @ axes), (y == "1").astype(np.float32))


def score(docs: DataFrame, space: Space | None) -> DataFrame:
    """``doc_id, score``: the vote for label 1 on every document's whole text, from 0 to 1.

    Empty and NULL texts, and others without features, have the zero vector: all labelled documents vote alike.  Without labelled documents every
    score is 0.5.  Repeated rows score alike; an empty table gives no row.
    """
    spark = docs.sparkSession
    shared = None if space is None else spark.sparkContext.broadcast((space.idf, space.axes, space.points, space.labels))

    def run(batches):
        s = None if shared is None else Space(*shared.value)
        for batch in blocks(batches, 1 << 20, 256):
            texts = batch.column("text").to_pylist()
            out = np.full(len(texts), 0.5)
            if s is not None:
                out = s.vote(vectors(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(out, 0, 1), pa.float64())], names=["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double")
