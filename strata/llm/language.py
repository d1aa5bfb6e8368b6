"""Language identification: family first, then one-versus-one linear support vector machines within the family."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, id_text, worker_cache
from .features import char_ngram_counts, collected_features, linear_svm, logistic, sigmoid, unit_rows

DIMS = 4096
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 600  # labelled documents a language that the models are fitted on, at most
SAMPLE_PARTS = 16
UNDETERMINED = "und"

# Language codes by family.
FAMILIES = {
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "hi", "mr", "ne", "ur"),
    "semitic": ("ar", "he"),
    "sinitic": ("yue", "zh"),
}


def family_of(lang: str) -> str:
    """The family of a code; a code that no family lists is a family of its own."""
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 32 if it is none."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    # beyond: scripts without case mostly; letters keep themselves
    table[0x3000:0x20000] = [c if not 0xD800 <= c < 0xE000 and chr(c).isalpha() else 32 for c in range(0x3000, 0x20000)]
    table[0x20000:0x32000] = np.arange(0x20000, 0x32000)
    return table


def letter_folder():
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = _letters()
    table = cache["letters"]

    def fold(points: np.ndarray) -> np.ndarray:
        out = table[points]
        blank = out == 32
        keep = np.ones(len(out), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])  # a run of other characters is one blank
        return out[keep]

    return fold


def vectors(texts: list[str]) -> np.ndarray:
    return unit_rows(np.sqrt(char_ngram_counts(texts, DIMS, ORDERS, letter_folder())))


class LanguageModel:
    """``families``: names; one logistic model each (one against the rest), and a margin machine for each pair of languages of a family."""

    def __init__(self, languages: list[str], families: list[str], family_w: np.ndarray, pairs: list[tuple[int, int]], pair_w: np.ndarray):
        self.languages, self.families, self.family_w, self.pairs, self.pair_w = languages, families, family_w, pairs, pair_w
        self.members = [[i for i, x in enumerate(languages) if family_of(x) == f] for f in families]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language, and a score from 0 to 1: the family's share times the share of votes won within it."""
        x = np.concatenate([x, np.ones((len(x), 1), dtype=x.dtype)], axis=1)
        f = sigmoid(x @ self.family_w.T)
        f /= np.maximum(f.sum(axis=1, keepdims=True), 1e-12)
        family = f.argmax(axis=1)
        margins = x @ self.pair_w.T if len(self.pairs) else np.zeros((len(x), 0))
        wins = np.zeros((len(x), len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            p = sigmoid(3 * margins[:, k])
            wins[:, b] += p
            wins[:, a] += 1 - p
        best, score = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        for k, members in enumerate(self.members):
            rows = np.flatnonzero(family == k)
            won = wins[np.ix_(rows, members)]
            top = won.argmax(axis=1)
            best[rows] = np.array(members)[top]
            duels = len(members) - 1
            score[rows] = f[rows, k] * (won[np.arange(len(rows)), top] / duels if duels else 1.0)
        return best, score


def train(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Fit on at most ``per_language`` rows (``doc_id, text, label``) of each label, the first by a hash of the id.

    Rows without text or label are left out; with no row left there is no model (None).
    """
    known = rows.where(F.col("text").isNotNull() & F.col("label").isNotNull())
    ids = known.select("doc_id", "label").dropDuplicates().withColumn("h", F.xxhash64("doc_id"))
    for part in (F.pmod("h", F.lit(SAMPLE_PARTS)), F.lit(0)):  # a frequent label is first ranked in parts, so the last rank sees a bounded number of rows
        by = Window.partitionBy("label", part).orderBy("h", "doc_id")
        ids = ids.withColumn("n", F.row_number().over(by)).where(F.col("n") <= per_language).drop("n")
    ids = ids.drop("h")
    picked = known.join(F.broadcast(ids), ["doc_id", "label"])
    x, y = collected_features(picked, DIMS, vectors)
    languages = sorted(set(y.tolist()))
    if not languages:
        return None
    index = {c: i for i, c in enumerate(languages)}
    y = np.array([index[c] for c in y.tolist()])
    families = sorted({family_of(c) for c in languages})
    of = np.array([families.index(family_of(c)) for c in languages])[y]
    family_w = np.stack([_with_bias(*logistic(x, (of == k).astype(np.float32))) if len(families) > 1 else np.zeros(DIMS + 1, dtype=np.float32) for k in range(len(families))])
    pairs, pair_w = [], []
    for f in families:
        for a, b in combinations([i for i, c in enumerate(languages) if family_of(c) == f], 2):
            some = (y == a) | (y == b)
            pairs.append((a, b))
            pair_w.append(_with_bias(*linear_svm(x[some], (y[some] == b).astype(np.float32))))
    return LanguageModel(languages, families, family_w, pairs, np.stack(pair_w) if pairs else np.zeros((0, DIMS + 1), dtype=np.float32))


def _with_bias(w: np.ndarray, b: float) -> np.ndarray:
    return np.append(w, np.float32(b)).astype(np.float32)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document's whole text.

    Text that is NULL or has no letter, and every text when there is no model, is ``und`` with score 0.  Repeated rows are scored
    alike; an empty table gives no row.
    """
    parts = None if model is None else (model.languages, model.families, model.family_w, model.pairs, model.pair_w)

    def run(batches):
        m = None if parts is None else LanguageModel(*parts)
        for batch in blocks(batches, 1 << 20, 256):
            texts = batch.column("text").to_pylist()
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if m is not None:
                best, score = m.predict(vectors(texts))
                for i, t in enumerate(texts):
                    if any(map(str.isalpha, t)):
                        langs[i], scores[i] = m.languages[best[i]], min(1.0, max(0.0, float(score[i])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
