"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

Words and single symbols are hashed from the bytes of the text; each n-gram of up to NGRAM of them falls into one of 2^BITS buckets.  A
text is the sparse vector of its bucket counts, divided by the root of their total; its score is the sparse dot product with the
weights.  The learner keeps, for each bucket, the sum of adjusted gradients and of squared gradients, from which the weight follows in
closed form with L1 and L2 penalties, so buckets that say nothing stay at zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import sized
from tidewater.llm.hashing import WORD_BYTE, U, mix, word_hashes

NGRAM = 2
BITS = 18
#: Labelled rows that are read for training at most, passes over them, and the learner's step, smoothing and penalties.
TRAIN_ROWS = 6_000
PASSES = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: The score from which a text is kept.
KEPT = 0.5
#: Bytes that are a word each.
SYMBOL = np.zeros(256, np.bool_)
SYMBOL[[i for i in range(33, 127) if not WORD_BYTE[i]]] = True

RESULT = "doc_id long, quality double, keep boolean"


def features(column: pa.Array, ngram: int = NGRAM, bits: int = BITS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets, where each row's buckets begin and the last end)."""
    for start, end, words, at in word_hashes(column, single=SYMBOL):
        sizes = np.diff(at)
        parts, owners = [], []
        row = np.repeat(np.arange(len(sizes)), sizes)
        with np.errstate(over="ignore"):
            h = words
            for n in range(1, ngram + 1):
                if n > 1:
                    h = h[:-1] * U(0xD1342543DE82EF95) + words[n - 1 :] if len(h) else h
                whole = row[: len(h)] == row[n - 1 : n - 1 + len(h)]
                parts.append((mix(h[whole] + U(n)) >> U(64 - bits)).astype(np.int64))
                owners.append(row[: len(h)][whole])
        flat, own = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(own, kind="stable")
        yield start, end, flat[order], np.searchsorted(own[order], np.arange(len(sizes) + 1))


class Learner:
    """Follow the regularised leader, one example at a time."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(texts: list[str], labels: list[int], passes: int = PASSES) -> np.ndarray:
    examples = []
    for _, _, flat, at in features(pa.array(texts, pa.string())):
        for a, b in zip(at, at[1:], strict=False):
            where, counts = np.unique(flat[a:b], return_counts=True)
            examples.append((where, counts / np.sqrt(max(1, b - a))))
    learner, rng = Learner(), np.random.default_rng(11)
    for _ in range(passes):
        for i in rng.permutation(len(examples)):
            learner.learn(*examples[i], labels[i])
    return learner.weights().astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray | None:
    """Weights from at most `rows` labelled documents, those of the least hashes; None where there is none."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality")).where("_id is not null and quality in (0, 1)")
    share = min(1.0, 1.2 * rows / max(1, known.count()))
    known = known.where(F.xxhash64("_id") <= F.lit(int(min(2.0**63 - 1025, -(2.0**63) + share * 2.0**64)))).orderBy(F.xxhash64("_id"), "_id", "quality").limit(rows)
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(sized(known, 32), F.col("doc_id") == F.col("_id")).select("doc_id", "quality", "text").collect()
    some.sort(key=lambda r: (r["doc_id"], r["quality"], r["text"]))
    return train([r["text"] for r in some], [r["quality"] for r in some]) if some else None


def _scorer(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            total, sizes = np.zeros(len(batch)), np.zeros(len(batch))
            for start, end, flat, at in features(column):
                total[start:end] = np.bincount(np.repeat(np.arange(end - start), np.diff(at)), weights=weights[flat], minlength=end - start)
                sizes[start:end] = np.diff(at)
            score = np.round(1 / (1 + np.exp(-total / np.sqrt(np.maximum(sizes, 1)))), 6)
            some = sizes > 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, mask=~some), pa.array(some & (score >= KEPT))], ["doc_id", "quality", "keep"])

    return run


def scored(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """doc_id, quality (the probability of being good) and keep for every row of `docs`.

    A null text, or one without any word or symbol, has a null quality and is not kept.  Without weights (no labelled row) every
    quality is null and every row kept.  Rows are judged one by one, so repeated rows and null ids give a row each; other columns are
    ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if weights is None:
        return rows.select("doc_id", F.lit(None).cast("double").alias("quality"), F.lit(True).alias("keep"))
    return rows.mapInArrow(_scorer(weights), RESULT)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
