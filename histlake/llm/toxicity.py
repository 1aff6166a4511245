"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features are single words, neighbouring pairs and pairs with one or two words between
them, hashed to a fixed number of slots and counted once per text. FTRL-proximal keeps
a learning rate per slot; its L1 term leaves most weights at zero, so the model is a
short list of slots whose length is bounded by the number of slots.

The model is fitted on a bounded sample of labelled rows (`max_rows`, those with the
lowest hash of their id); every text is scored whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, WordHashes, map_batches, map_slices, mix, texts

SLOT_BITS = 20
MAX_ROWS = 10_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.1
# Word characters are letters, digits and everything beyond ASCII.
APART = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def features(words: np.ndarray) -> list[np.ndarray]:
    """Slot of each single word, pair and skip-pair, by position of its first word."""
    shift = np.uint64(64 - SLOT_BITS)
    out = [mix(words) >> shift]
    for gap, factor in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F), (3, 0xE7037ED1A0B428DB)):
        out.append(mix(words[:-gap] * np.uint64(factor) + words[gap:]) >> shift)
    return out


def words_of(text: str, memo: WordHashes) -> np.ndarray:
    return memo.of(text.lower().encode("utf-8", "surrogatepass").translate(APART).split())


@dataclass(frozen=True)
class Model:
    """Slots with a weight, in rising order, their weights, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        dense = np.zeros(1 << SLOT_BITS, np.float32)
        dense[self.slots] = self.weights
        memo = WordHashes()

        def score(text: str) -> float:
            hits = []
            for slots in features(words_of(text, memo)):
                w = dense[slots]
                hits.append(slots[w != 0])
            slots = np.unique(np.concatenate(hits))
            return sigmoid(self.bias + float(dense[slots].sum(dtype=np.float64)))

        return score


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def train(rows: list[np.ndarray], labels: list[int], share: float) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over rows of distinct slots, in the given order.

    The bias starts from the share of label 1 among all labels.
    """
    z, n = np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)
    bias, bias_n = math.log(share / (1 - share)), 0.0

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for slots, y in zip(rows, labels):
            zi, ni = z[slots], n[slots]
            w = weights(zi, ni)
            g = sigmoid(bias + float(w.sum())) - y
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[slots] = zi + g - step * w
            n[slots] = ni + g * g
            bias_n += g * g
            bias -= 0.05 * g / (1 + math.sqrt(bias_n))
    kept = np.flatnonzero(np.abs(z) > L1)
    return kept, weights(z[kept], n[kept]), bias


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """Model from the texts of at most `max_rows` ids with a label of 0 or 1.

    Of each label the ids with the lowest hashes are taken, half of `max_rows` each, before
    any text is read; of several labels of an id the largest counts. Only the texts taken move: they are learnt, in the
    order of the hash, by one task, whose input `max_rows` bounds. Without labels all
    scores are 0.5; ids without a text are passed over.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
    by_id = known.agg(F.max(label_col).cast("int").alias("y"))
    order = F.xxhash64(F.col("label_id").cast("string")), F.col("label_id")
    sides = [by_id.where(F.col("y") == y).orderBy(*order).limit(max_rows // 2) for y in (0, 1)]
    chosen = spark.createDataFrame([r for side in sides for r in side.collect()], by_id.schema)
    counts = by_id.agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).first()
    share = ((counts.toxic or 0) + 0.5) / (counts.n + 1)
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    picked = joined.select(F.xxhash64(F.col("id").cast("string"), "text").alias("at"), "text", "y")

    def run(batches: Batches) -> Batches:
        memo, order, slots, labels = WordHashes(), [], [], []
        for batch in batches:
            for at, text, y in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist()):
                order.append((at, y, len(slots)))
                slots.append(np.unique(np.concatenate(features(words_of(text, memo)))).astype(np.int32))
                labels.append(y)
        if not labels:
            return
        turn = [k for _, _, k in sorted(order)]
        kept, weights, bias = train([slots[k] for k in turn], [labels[k] for k in turn], share)
        yield pa.record_batch(
            [pa.array([kept.tolist()], pa.list_(pa.int32())), pa.array([weights.tolist()], pa.list_(pa.float64())), pa.array([bias])],
            ["slots", "weights", "bias"],
        )

    found = map_batches(picked.orderBy("at", "y").limit(max_rows), run, "slots array<int>, weights array<double>, bias double").first()
    if found is None:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    return Model(np.array(found.slots, np.int64), np.array(found.weights), found.bias)


def score(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; empty and null texts get the score of the bias alone."""

    def step():
        of = model.scorer()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch.column(0), pa.array([of(t) for t in texts(batch.column(1))], pa.float64())], ["id", "score"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, score double").withColumnRenamed("id", id_col)
