"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import mix, slices, word_hashes

#: Features share 2**BITS weights.
BITS = 20
#: ASCII bytes other than letters and digits part words, so that punctuation does not split a word's evidence.
_PARTED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_KINDS = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D1, 0x082EFA98EC4E6C89, 0x452821E638D01377)]


def features(text: str | None) -> np.ndarray:
    """Hashed presence features of a whole text: words, word beginnings of 4 and 6 bytes, bigrams, skip-grams over one word."""
    tokens = text.encode("utf-8", "surrogatepass").lower().translate(_PARTED).split() if text else []
    if not tokens:
        return np.zeros(0, np.int64)
    h = word_hashes(tokens)
    grams = [
        h ^ _KINDS[0],
        word_hashes([t[:4] for t in tokens]) ^ _KINDS[1],
        word_hashes([t[:6] for t in tokens]) ^ _KINDS[2],
        (h[:-1] * np.uint64(3) + h[1:]) ^ _KINDS[3],
        (h[:-2] * np.uint64(5) + h[2:]) ^ _KINDS[4],
    ]
    return (mix(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal learner; weights that L1 holds at zero cost nothing."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)  # the last coordinate is the bias

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = _sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, epochs: int = 4, max_bytes: int = 160_000_000) -> dict[int, float]:
    """Nonzero weights by coordinate, learned from at most `max_rows` labelled rows and `max_bytes` of their features.

    Rows with crc32(doc_id) mod 3 = 1 are held out. The bounds take the rows with the smallest hash of
    doc_id, the first of them even if it is larger; a text takes four bytes a distinct feature, 4 MB at most. The sample's ids (`max_rows` rows at most) are broadcast to find its texts; one task
    then learns from their hashed features. Rows without a label or doc_id are left out; without any
    labelled row there are no weights.
    """
    train = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(cast(doc_id AS string)) % 3 != 1")
        .withColumn("place", F.xxhash64("doc_id", F.lit(10)))
        .orderBy("place", "doc_id", "toxic")
        .limit(max_rows)
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            at = [np.unique(features(t)).astype(np.int32) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([a.tobytes() for a in at], pa.binary())], names=["place", "toxic", "at"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, left = [], max_bytes
        for row in (row for b in slices(batches) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            left -= len(row[2])
            if left < 0 and rows:
                break
            rows.append(row)
        model = Ftrl()
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(rows)):
                at = np.frombuffer(rows[k][2], np.int32).astype(np.int64)
                model.learn(np.append(at, 2**BITS), rows[k][1])
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], names=["at", "w"])

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(train), "doc_id")
        .select("place", "toxic", "text")
        .mapInArrow(hashed, "place long, toxic int, at binary")
        .repartition(1)
        .sortWithinPartitions("place", "toxic", "at")
        .mapInArrow(learn, "at long, w double")
        .collect()
    )
    return {r["at"]: r["w"] for r in rows}


def score(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """doc_id and score (0 to 1) of each whole text, by the sum of the weights of its distinct features.

    Null and empty texts have the bias alone; without weights every score is 0.5. Repeated rows are scored
    each; a null doc_id stays null; extra columns are ignored. The weights are at most 2**BITS + 1 numbers.
    """
    at = np.array(sorted(weights), np.int64)
    held = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), np.array([weights[a] for a in at.tolist()], np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(2**BITS + 1, np.float32)
        w[held.value[0]] = held.value[1]
        for part in slices(batches):
            scores = []
            for text in part.column(1).to_pylist():
                f = features(text)
                f = np.unique(f[w[f] != 0])
                scores.append(_sigmoid(float(w[f].sum(dtype=np.float64)) + float(w[-1])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) of every document. See `fit` and `score`."""
    scored = score(docs, fit(docs, labels, max_rows))
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
