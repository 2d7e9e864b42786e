"""Quality classifier: supervised subword embeddings.

Every word, word pair and character n-gram of a word is hashed to one of
``buckets`` vectors; a document is the average of its features' vectors and a
softmax over a linear layer gives the class probabilities.  Vectors and layer
are learned by stochastic gradient descent in numpy.

Training uses a bounded sample of the labelled rows (``max_rows`` whole texts,
those with the smallest hash of their id), the only part that passes the driver.  Scoring covers every document in full where
it lies: the layer is linear, so each bucket contributes one number per class
and the broadcast model is ``buckets`` numbers (1 MB), whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, U64, Powers, id_text, mix

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def words_of(text: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, start, end)`` of every word ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text,
    in bytes, computed for all words at once: buckets of features, where words
    may share one."""
    a = np.frombuffer(text, np.uint8)
    blank = np.ones(len(a) + 2, bool)
    blank[1:-1] = _BLANK[a]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[0::2], edge[1::2]
    prefix = powers.prefix(a.astype(U64))
    return mix((prefix[end] - prefix[start]) * powers.inverse[start] + (end - start).astype(U64) * U64(BASE)), start, end


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dim: int = 8
    char_min: int = 3
    char_max: int = 4
    epochs: int = 6
    rate: float = 0.6
    batch: int = 32
    max_rows: int = 4000
    seed: int = 42


class Features:
    """Feature buckets of a text: words, word pairs and the character n-grams of
    each word (bytes of the lower-cased UTF-8 text, the word's edges marked)."""

    def __init__(self, s: Settings):
        self.s, self.powers = s, Powers()

    def of(self, text: bytes) -> np.ndarray:
        text = text.lower()
        words, start, end = words_of(text, self.powers)
        if not len(words):
            return np.zeros(0, np.int64)
        found = [words]
        if len(words) > 1:
            pairs = mix(words[:-1] * U64(3) + words[1:])
            found.append(np.where(words[1:] == words[:-1], U64(1), pairs))  # a repeated word is one feature, whatever the word
        # one blank on either side marks a word's edges
        a = np.frombuffer(b" " + text + b" ", np.uint8).astype(U64)
        prefix = self.powers.prefix(a)
        first, size = start, end - start + 2
        for n in range(self.s.char_min, self.s.char_max + 1):
            room = np.maximum(size - n + 1, 0)
            at = np.repeat(first, room) + np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
            found.append(mix((prefix[at + n] - prefix[at]) * self.powers.inverse[at] + U64(n)))
        return (np.concatenate(found) % U64(self.s.buckets)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``weights[f]``: what feature bucket f adds to the log-odds of class 1;
    ``bias``: the log-odds of a text without features."""
    settings: Settings
    weights: np.ndarray
    bias: float

    def log_odds(self, features: np.ndarray) -> float:
        return self.bias + (float(self.weights[features].mean(dtype=np.float64)) if len(features) else 0.0)


def train(texts: list[bytes], labels: list[int], s: Settings = Settings()) -> Model:
    """Softmax regression on averaged feature vectors; both are learned.  Classes
    are weighted so that their sums are equal, then the bias is moved back to
    the sample's share, so that scores are probabilities of the sample."""
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():  # nothing to tell apart: the share of class 1 is all that is known
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(s, np.zeros(s.buckets, np.float32), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    layer, bias = np.zeros((s.dim, 2), np.float32), np.zeros(2, np.float32)
    reader = Features(s)
    # distinct buckets of each text with their shares
    docs = []
    for t in texts:
        f, c = np.unique(reader.of(t), return_counts=True)
        docs.append((f, (c / max(1, c.sum())).astype(np.float32)))
    weight = (len(y) / (2 * np.bincount(y, minlength=2)))[y].astype(np.float32)
    steps, step = s.epochs * -(-len(y) // s.batch), 0
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), s.batch):
            rate = s.rate * (1 - step / steps)
            step += 1
            rows = order[i:i + s.batch]
            hidden = np.stack([docs[r][1] @ vectors[docs[r][0]] if len(docs[r][0]) else np.zeros(s.dim, np.float32)
                               for r in rows])
            logit = hidden @ layer + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            error = p * weight[rows, None]
            back = error @ layer.T
            layer -= rate * hidden.T @ error / len(rows) ** 0.5
            bias -= rate * error.mean(0)
            for r, g in zip(rows, back):
                f, share = docs[r]
                vectors[f] -= (rate * s.dim) * share[:, None] * g
    odds = layer[:, 1] - layer[:, 0]
    share = np.bincount(y, minlength=2)
    return Model(s, (vectors @ odds).astype(np.float32), float(bias[1] - bias[0] + np.log(share[1] / share[0])))


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Whether a row's crc32(id as text) mod ``folds`` is 0; such rows are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from the labelled rows that are not held out (see ``Settings`` for
    the bound of the sample).  Rows without id, label or text, and documents with
    contradicting labels, are not used."""
    known = (labels.where(~held_out(id_col)).groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
             .agg(F.min(F.col(label_col).cast("int")).alias("y"), F.max(F.col(label_col).cast("int")).alias("other"))
             .where((F.col("y") == F.col("other")) & F.col("y").isin(0, 1)).select("doc_id", "y"))
    texts = id_text(docs, id_col, text_col)
    # the ids are chosen first, so only the sample's texts move
    ids = texts.select("doc_id").distinct().join(known, "doc_id")
    order = F.xxhash64(F.col("doc_id"), F.lit(settings.seed))
    sample = ids.orderBy(order, "doc_id").limit(settings.max_rows)  # at most max_rows rows: a proven bound
    rows = (texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
            .orderBy("doc_id").collect())
    return train([r["text"].encode() for r in rows], [r["y"] for r in rows], settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 in ``out`` (0 to 1), from the
    whole text alone.  NULL and empty texts get the model's share of class 1;
    every other column is passed on; a column named ``out`` is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        m = sent.value
        reader = Features(m.settings)
        odds = [m.log_odds(reader.of(t.encode())) for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700)))) if odds else pd.Series([], dtype="float64")

    return docs.withColumn(out, scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
             text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``(doc_id, held_out, score, predicted)``;
    ``predicted`` is 1 from ``threshold`` on.  NULL ids are scored (and held_out
    is false), repeated rows each get their score, an empty input gives no rows."""
    model = fit(docs, labels, id_col, text_col, settings=settings)
    rows = id_text(docs, id_col, text_col).withColumn("held_out", held_out("doc_id"))
    return (score(rows, model).drop("text")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
