"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's tokens are its runs of letters and digits and its runs of other visible characters, lower-cased;
its features are the hashed 1- and 2-grams of tokens, each counted once per occurrence and scaled so that
the feature vector has length 1. Training runs on the driver over a bounded sample of labelled rows
(per class, drawn by hash over the whole table); scoring reads every whole text and is a sparse dot
product with one broadcast weight array of 2**BITS floats.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._shared import free_name, labelled_sample, remainder, small_batches, table

BITS = 18
#: Most labelled rows per class that are fitted.
SAMPLE_PER_CLASS = 1500
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.3, 1.0, 4
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x200-9A-Za-z\x7f-\xff]+")


def token_hashes(text: str | None) -> np.ndarray:
    """crc32 of every token of a text."""
    found = TOKEN.findall((text or "").encode().lower())
    return np.fromiter(map(zlib.crc32, found), np.uint32, len(found))


def feature_ids(hashes: np.ndarray) -> np.ndarray:
    """Hashed 1- and 2-grams, repeats kept."""
    h = hashes.astype(np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS)
    ones = (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)
    return np.concatenate([ones, pairs]).astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids and their values: counts over the vector's length."""
    ids, counts = np.unique(feature_ids(token_hashes(text)), return_counts=True)
    return ids, counts / np.sqrt((counts.astype(np.float64) ** 2).sum() or 1.0)


def fit(texts: list[str | None], labels: list[int]) -> np.ndarray:
    """FTRL-Proximal over the rows in the order given, EPOCHS times; the last weight is the bias.

    Classes weigh the same whatever their counts. Without rows all weights are 0.
    """
    n = (1 << BITS) + 1
    z, sq, w = np.zeros(n), np.zeros(n), np.zeros(n)
    rows = []
    for text in texts:
        ids, values = features(text)
        rows.append((np.append(ids, n - 1), np.append(values, 1.0)))
    share = [max(1, labels.count(0)), max(1, labels.count(1))]
    for _ in range(EPOCHS):
        for (ids, x), y in zip(rows, labels):
            zi, ni = z[ids], sq[ids]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ x, -30, 30)))
            g = (p - y) * x * (len(labels) / (2 * share[y]))
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[ids] += g - sigma * wi
            sq[ids] = ni + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(sq)) / ALPHA + L2))
    return w.astype(np.float32)


def score(text: str | None, weights: np.ndarray) -> float:
    """Probability of label 1: the sparse dot product of weights and feature vector, through the logistic."""
    ids = feature_ids(token_hashes(text))
    dot, bias = 0.0, float(weights[-1])
    if len(ids):
        if len(ids) < 4096:
            ids = np.sort(ids)
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            counts = np.diff(np.append(first, len(ids))).astype(np.float64)
            dot = float(weights[ids[first]] @ counts) / float(np.sqrt(counts @ counts))
        else:
            counts = np.bincount(ids, minlength=1 << BITS).astype(np.float64)
            dot = float(weights[:-1] @ counts) / float(np.sqrt(counts @ counts))
    return float(1.0 / (1.0 + np.exp(-(dot + bias))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, fold: int = 1) -> np.ndarray:
    """Fit on at most per_class rows of each quality, of ids whose crc32 as text mod 3 is not fold.

    Null ids and qualities other than 0 and 1 take no part; of an id that repeats, the smallest quality and text count;
    null texts count as empty. Without rows all weights are 0, which scores every text 0.5.
    """
    known = labels.where("quality in (0, 1)").where(remainder(F.col("doc_id"), 3) != fold).select("doc_id", F.col("quality").alias("label"))
    rows = labelled_sample(docs, known, per_class)
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def scores(docs: DataFrame, weights: np.ndarray, into: str = "score", text_column: str = "text") -> DataFrame:
    """docs with the column into, the probability of label 1, for every row; null and empty texts get the bias alone.

    All columns and rows of docs are kept, repeated ones included; a column of the name into is an error. Only the
    text goes to Python. An empty table gives an empty one.
    """
    if free_name(docs, into) != into:
        raise ValueError(f"the table has a column {into}")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        w = shared.value
        return pa.array([score(t.as_py(), w) for t in texts], pa.float64())

    return docs.withColumn(into, scored(F.col(text_column)))


def keep_quality(docs: DataFrame, weights: np.ndarray, at_least: float = 0.5) -> DataFrame:
    """The rows of docs that score at_least, with their columns; repeated rows stay, null and empty texts score by the bias."""
    name = free_name(docs, "quality_score")
    return scores(docs, weights, name).where(F.col(name) >= at_least).drop(name)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per document. Nulls in doc_id give a null held_out; empty and null texts get the bias alone, texts of any length all their words; a score of just 0.5 is a 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train(docs, table(spark, sf_dir, "labels"))
    out = scores(docs, weights)
    return out.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
