"""Toxicity by a factorization machine over hashed terms.

A text's features are its distinct lower-case words, hashed and present or not. The machine adds to the linear weights a
product of factor vectors for every pair of present terms, so that two terms may weigh together what neither does alone.
It is fitted by proximal gradient steps: a penalty on the size of each term's weight and factors sets those of uninformative
terms to exactly zero, so long texts gather no noise. Scoring looks at the other terms only and takes time linear in them.

Defined results: a null or empty text scores the bias alone; repeated rows score alike; where nothing was learned the score
is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.sampling import held_out, row_sample

DIMENSIONS = 1 << 18
#: Words a task remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
_CORE = re.compile(r"\w+")


def word_terms(word: str) -> tuple[int, ...]:
    """Hashes of the runs of letters, digits and _ in a word."""
    return tuple(crc32(run.encode("utf-8", "surrogatepass")) % DIMENSIONS for run in _CORE.findall(word.lower()))


def terms(text: str) -> np.ndarray:
    return np.array(sorted({t for w in set(text.split()) for t in word_terms(w)}), dtype=np.int64)


def pair_score(model: dict, rows: list[np.ndarray]) -> np.ndarray:
    """Scores before the logistic function: bias + weights + sum over pairs of the products of their factors."""
    out = np.full(len(rows), model["bias"])
    for i, r in enumerate(rows):
        if len(r):
            v = model["factors"][r]
            s = v.sum(axis=0)
            out[i] += model["weights"][r].sum() + 0.5 * (s @ s - (v * v).sum())
    return out


def train(samples: list[tuple[str, int]], factors: int = 4, rounds: int = 80, rate: float = 0.08, penalty: float = 3.0, seed: int = 1) -> dict:
    """bias, weights and factors (zero for most terms), as compact arrays over the terms that count."""
    labels = np.array([float(y) for _, y in samples])
    rows = [terms(t) for t, _ in samples]
    n = len(rows)
    if n == 0 or labels.min() == labels.max():
        share = labels.mean() if n else 0.0
        return {"bias": -40.0 if share == 0 else 40.0, "terms": np.zeros(0, dtype=np.int64), "weights": np.zeros(0), "factors": np.zeros((0, factors))}
    used, index = np.unique(np.concatenate([*rows, np.zeros(0, dtype=np.int64)]), return_inverse=True)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    count = np.bincount(index, minlength=len(used))
    frequent = count >= max(3, penalty)
    # a term in fewer rows than the penalty could never leave zero
    keep = frequent[index]
    renumber = np.cumsum(frequent) - 1
    used, index, row = used[frequent], renumber[index[keep]], row[keep]
    rng = np.random.default_rng(seed)
    m = len(used)
    weights, vectors = np.zeros(m), rng.normal(0, 0.05, (m, factors))
    bias = np.array([np.log(labels.mean() / (1 - labels.mean()))])
    params = [bias, weights, vectors]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    by_term = np.argsort(index, kind="stable")
    term_starts = np.searchsorted(index[by_term], np.arange(m))
    row_starts = np.searchsorted(row, np.arange(n))
    has = np.bincount(row, minlength=n) > 0
    best = max(1, len(index))
    for step in range(1, rounds + 1):
        v = vectors[index]
        sums = np.zeros((n, factors))
        squares = np.zeros(n)
        if len(index):
            starts = np.minimum(row_starts, best - 1)
            sums = np.add.reduceat(v, starts, axis=0) * has[:, None]
            squares = np.bincount(row, weights=(v * v).sum(axis=1), minlength=n)
        score = bias[0] + np.bincount(row, weights=weights[index], minlength=n) + 0.5 * ((sums * sums).sum(axis=1) - squares)
        error = (0.5 * np.tanh(0.5 * np.clip(score, -60, 60)) + 0.5 - labels) / n
        each = error[row]
        d_weights = np.bincount(index, weights=each, minlength=m)
        pulls = each[:, None] * (sums[row] - v)
        d_vectors = np.add.reduceat(pulls[by_term], np.minimum(term_starts, best - 1), axis=0) if len(index) else np.zeros_like(vectors)
        for p, g, a, b in zip(params, (np.array([error.sum()]), d_weights, d_vectors), first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            speed = rate / (np.sqrt(b / (1 - 0.99**step)) + 1e-4)
            p -= speed * (a / (1 - 0.9**step))
            if p is not bias:
                shrink = speed * penalty / n
                if p.ndim == 1:
                    p[:] = np.sign(p) * np.maximum(np.abs(p) - shrink, 0)
                else:
                    norm = np.sqrt((p * p).sum(axis=1, keepdims=True))
                    p *= np.maximum(norm - shrink.mean(axis=1, keepdims=True), 0) / np.maximum(norm, 1e-12)
    counts = (weights != 0) | (vectors != 0).any(axis=1)
    return {"bias": float(bias[0]), "terms": used[counts], "weights": weights[counts], "factors": vectors[counts]}


class Scorer:
    def __init__(self, model: dict):
        self.place = {int(t): i for i, t in enumerate(model["terms"])}
        self.model = model
        self.known: dict[str, tuple[int, ...]] = {}

    def rows(self, text: str | None) -> np.ndarray:
        """Places of the terms of a text that count."""
        known, place, found = self.known, self.place, set()
        if len(known) > REMEMBERED:
            known.clear()
        for word in set((text or "").split()):
            at = known.get(word)
            if at is None:
                at = known[word] = tuple(place[t] for t in word_terms(word) if t in place)
            if at:
                found.update(at)
        return np.array(sorted(found), dtype=np.int64)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 0.5 * np.tanh(0.5 * np.clip(pair_score(self.model, [self.rows(t) for t in texts]), -60, 60)) + 0.5


def toxicity(documents: DataFrame, model: dict) -> DataFrame:
    """documents with a struct column `__toxicity` that holds the score of its text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series(scorer.scores(list(texts)), dtype="float64")

    return documents.withColumn("__toxicity", F.struct(scored(F.col("text")).alias("score")))


def learn(documents: DataFrame, labels: DataFrame, rows: int = 6000, longest: int = 20_000, seed: int = 1) -> dict:
    """Fits on a bounded sample of labelled rows that are not held out."""
    marks = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    fit = documents.select("doc_id", "text").filter(~held_out(F.col("doc_id")))
    rated = fit.join(marks, fit["doc_id"] == marks["__id"]).select("doc_id", "text", "toxic")
    return train(row_sample(rated, "toxic", rows, longest, seed), seed=seed)


def toxicity_report(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = toxicity(documents.select("doc_id", "text"), learn(documents, labels))
    score = F.col("__toxicity.score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted")
    )
