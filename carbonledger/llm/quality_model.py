"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

Features: the text's words (as written) and pairs of neighbouring words (a word
followed by itself is one and the same pair for all words), hashed into
``2**bits`` cells; a cell's value is its count over the square root of all
n-grams of the text, plus a bias.  Labels, language, source and ids are never
features.

Training: the rows of the training fold that have a label; at most
``max_rows`` of them (documented bound; those whose id has the smallest hash).
Their sparse feature vectors are made on the executors from whole texts; the
updates run over this bounded sample in one task, in a fixed order, and its
weights (a table of fixed size, 2**bits floats) are broadcast.

Scoring: every text, as the sparse dot product of its n-grams with the weights.

Defined cases: null and empty texts have the bias alone; rows without a label
or with a null label are not trained on; a doc_id with several labels takes the
largest; without any labelled row all scores are 0.5; repeated rows score
alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import cut

BITS = 18
MAX_ROWS = 8192
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
THRESHOLD = 0.7
REPEAT = np.uint64(0x5EED5EED5EED5EED)  # the pair "a word and itself again", whatever the word


def features(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(cells of all n-grams, text by text: words first, then pairs; n-grams of each text)."""
    h, count = hashing.words(hashing.as_bytes(texts))
    doc = np.repeat(np.arange(len(texts)), count)
    pair = doc[1:] == doc[:-1]
    two = hashing.mix(h[:-1] * np.uint64(3) + hashing.mix(h[1:]))
    two = np.where(h[:-1] == h[1:], REPEAT, two)[pair]
    cell = np.concatenate([h, two]) >> np.uint64(64 - bits)
    who = np.concatenate([doc, doc[1:][pair]])
    order = np.argsort(who, kind="stable")
    return cell[order].astype(np.int64), np.bincount(who, minlength=len(texts))


def sparse_vectors(texts: list[str | None], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(cells, values) of each text; the last cell, 2**bits, is the bias."""
    cells, n = features(texts, bits)
    out = []
    for part, size in zip(np.split(cells, np.cumsum(n)[:-1]), n):
        at, c = np.unique(part, return_counts=True)
        out.append((np.append(at, 1 << bits), np.append(c / np.sqrt(max(size, 1)), 1.0)))
    return out


class FTRL:
    """Follow-the-regularised-leader with per-coordinate rates and L1/L2 penalties."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def update(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        root = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (root - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, fold, bits: int = BITS, max_rows: int = MAX_ROWS,
          epochs: int = EPOCHS) -> np.ndarray:
    """Weights (2**bits cells and the bias) from at most ``max_rows`` labelled rows where ``fold`` is true."""
    spark = docs.sparkSession
    order = F.xxhash64("l_id")
    known = (labels.select(F.col("doc_id").alias("l_id"), F.col("quality").cast("double").alias("label"))
             .filter(F.col("label").isNotNull()).groupBy("l_id").agg(F.max("label").alias("label")))
    texts = docs.select("doc_id", "text")
    picked = (known.join(texts.filter(fold).select(F.col("doc_id").alias("l_id")).distinct(), "l_id", "left_semi")
              .orderBy(order, "l_id").limit(max_rows))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [x for r in hashing.runs(list(pdf["text"])) for x in sparse_vectors(r, bits)]
            yield pd.DataFrame({"k": pdf["k"], "label": pdf["label"], "cells": [a.astype(np.int32) for a, _ in both],
                                "vals": [b.astype(np.float32) for _, b in both]})

    # One text per sampled id (the smallest, should an id repeat), so the bound holds for rows too.
    sample = (texts.join(F.broadcast(cut(picked)), F.col("doc_id") == F.col("l_id"))
              .groupBy("l_id", "label").agg(F.min("text").alias("text"))
              .select(F.xxhash64("l_id").alias("k"), "label", "text"))
    vecs = cut(sample.mapInPandas(vectors, "k long, label double, cells array<int>, vals array<float>"))
    # Every epoch sees the rows in the same order; Spark sorts them, the task holds one batch at a time.
    passes = (vecs.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)]))).coalesce(1)
              .sortWithinPartitions("epoch", "k"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen = FTRL(bits), 0
        for pdf in batches:
            for y, at, v in zip(pdf["label"], pdf["cells"], pdf["vals"]):
                model.update(at, v.astype(np.float64), y)
                seen += 1
        if seen:
            yield pd.DataFrame({"w": [model.weights().astype(np.float32)]})

    got = passes.select("label", "cells", "vals").mapInPandas(fit, "w array<float>").collect()
    return np.array(got[0][0], np.float32) if got else np.zeros((1 << bits) + 1, np.float32)


def scores(texts: list[str | None], w: np.ndarray, bits: int = BITS) -> np.ndarray:
    cells, n = features(texts, bits)
    ends = np.cumsum(n)
    total = np.concatenate([[0.0], np.cumsum(w[cells], dtype=np.float64)])
    dot = (total[ends] - total[ends - n]) / np.sqrt(np.maximum(n, 1)) + float(w[-1])
    return 1 / (1 + np.exp(-np.clip(dot, -700, 700)))


def score_udf(weights: Broadcast, bits: int = BITS):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([scores(r, weights.value, bits) for r in hashing.runs(list(texts))]
                                        or [np.zeros(0)]))
    return score


def score(docs: DataFrame, labels: DataFrame, fold, threshold: float = THRESHOLD, bits: int = BITS,
          max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with columns score (0 to 1) and predicted (1 from ``threshold``); an existing column of either
    name is replaced."""
    w = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fold, bits, max_rows))
    scored = docs.withColumn("score", score_udf(w, bits)("text"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accept(docs: DataFrame, labels: DataFrame, fold, threshold: float = THRESHOLD, bits: int = BITS,
           max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that score ``threshold`` or more, with their columns as they are."""
    w = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fold, bits, max_rows))
    return (docs.withColumn("__q_score", score_udf(w, bits)("text")).filter(F.col("__q_score") >= threshold)
            .select(*docs.columns))
