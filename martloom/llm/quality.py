"""Quality classifier: ordinal regression with a cumulative logistic link on graded ratings.

A text is hashed into terms: its lower-case words, their shapes (runs of small and capital letters, digits and signs) and
whether a word repeats the one before it. The score of a text is the mean weight of its terms; all grades share the weights
and differ by ordered thresholds: P(grade >= k) = sigmoid(score - threshold_k). From these come the expected grade and the
tail probability of at least a chosen grade, by which documents are kept.

Defined results: a text that is null or has no words scores the bias alone; repeated rows score alike; where no ratings
were learned every document is kept with expected grade 0 and tail probability 1; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.langid import text_runs
from martloom.llm.sampling import held_out, row_sample

DIMENSIONS = 1 << 16
#: Weights of words a task remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
_SHAPE = [(re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "9")]
REPEAT = crc32(b"repeat") % DIMENSIONS


def shape(word: str) -> str:
    for pattern, sign in _SHAPE:
        word = pattern.sub(sign, word)
    return word[:16]


def word_terms(word: str) -> tuple[int, int]:
    return (
        crc32(b"w" + word.lower().encode("utf-8", "surrogatepass")) % DIMENSIONS,
        crc32(b"s" + shape(word).encode("utf-8", "surrogatepass")) % DIMENSIONS,
    )


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms and their values: shares of the words."""
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    values: dict[int, float] = {}
    for word, count in Counter(words).items():
        for term in word_terms(word):
            values[term] = values.get(term, 0.0) + count / len(words)
    values[REPEAT] = values.get(REPEAT, 0.0) + sum(map(eq, words, words[1:])) / len(words)
    return np.fromiter(values, dtype=np.int64, count=len(values)), np.fromiter(values.values(), dtype=np.float64, count=len(values))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def train(samples: list[tuple[str, int]], rounds: int = 120, rate: float = 0.3, decay: float = 3e-6) -> dict:
    """weights, bias-free: the thresholds hold the level. Grades are small integers; the thresholds stay in order."""
    grades = sorted({g for _, g in samples})
    if len(grades) < 2:
        return {"grades": grades, "weights": np.zeros(DIMENSIONS), "thresholds": np.zeros(0)}
    rows = [features(t) for t, _ in samples]
    index = np.concatenate([i for i, _ in rows])
    value = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    level = np.array([grades.index(g) for _, g in samples])
    n, k = len(rows), len(grades) - 1
    # thresholds: the first, then logarithms of the steps between them
    share = [(level >= j + 1).mean() for j in range(k)]
    at = -np.log(np.clip(share, 0.01, 0.99) / (1 - np.clip(share, 0.01, 0.99)))
    steps = np.concatenate([at[:1], np.log(np.maximum(np.diff(at), 0.1))])
    weights = np.zeros(DIMENSIONS)
    params, first, second = [weights, steps], [np.zeros(DIMENSIONS), np.zeros(k)], [np.zeros(DIMENSIONS), np.zeros(k)]
    for step in range(1, rounds + 1):
        thresholds = _thresholds(steps)
        score = np.bincount(row, weights=weights[index] * value, minlength=n)
        reach = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - thresholds[None, :]), np.zeros((n, 1))], axis=1)
        here = np.arange(n)
        chance = np.maximum(reach[here, level] - reach[here, level + 1], 1e-9)
        slope = reach * (1 - reach)
        d_score = -(slope[here, level] - slope[here, level + 1]) / chance / n
        d_at = np.zeros(k + 2)
        np.add.at(d_at, level, slope[here, level] / chance / n)
        np.add.at(d_at, level + 1, -slope[here, level + 1] / chance / n)
        d_at = d_at[1:-1]
        behind = np.cumsum(d_at[::-1])[::-1]  # a step moves its own threshold and all behind it
        d_steps = np.concatenate([behind[:1], behind[1:] * np.exp(steps[1:])])
        d_weights = np.bincount(index, weights=d_score[row] * value, minlength=DIMENSIONS) + decay * weights
        for p, g, a, b in zip(params, (d_weights, d_steps), first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return {"grades": grades, "weights": weights, "thresholds": _thresholds(steps)}


def _thresholds(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


class Scorer:
    """Scores texts; remembers the weights of words already hashed."""

    def __init__(self, model: dict):
        self.weights = model["weights"]
        self.known: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        if len(self.known) > REMEMBERED:
            self.known = {}
        counts, known, total = Counter(words), self.known, 0.0
        for word, count in counts.items():
            weight = known.get(word)
            if weight is None:
                a, b = word_terms(word)
                weight = known[word] = float(self.weights[a] + self.weights[b])
            total += weight * count
        return (total + float(self.weights[REPEAT]) * sum(map(eq, words, words[1:]))) / len(words)


def grade(documents: DataFrame, model: dict, at_least: int) -> DataFrame:
    """doc_id, text-free: expected_grade and tail (probability of a grade >= at_least), with the other columns kept.

    The columns of documents may have any names that do not begin with two underscores; the two new ones come in one struct column `__grade`.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    grades, thresholds = model["grades"], model["thresholds"]
    score = scored(F.col("text"))
    scored_rows = documents.withColumn("__grade", F.struct(score.alias("score")))

    def reach(k: int) -> Column:
        return 1 / (1 + F.exp(F.lit(float(thresholds[k])) - F.col("__grade.score")))

    expected = F.lit(float(grades[0]) if grades else 0.0)
    for k in range(len(thresholds)):
        expected = expected + reach(k) * F.lit(float(grades[k + 1] - grades[k]))
    tails = [k for k in range(len(thresholds)) if grades[k + 1] >= at_least]
    tail = reach(tails[0]) if tails and grades[0] < at_least else F.lit(1.0)
    return scored_rows.withColumn("__grade", F.struct(expected.alias("expected_grade"), tail.alias("tail")))


def ratings(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, grade) of the rated rows that are not held out: 0 low quality, 1 fair but toxic, 2 fair."""
    graded = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    marks = labels.filter(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__id"), graded.alias("grade"))
    fit = documents.select("doc_id", "text").filter(~held_out(F.col("doc_id")))
    return fit.join(marks, fit["doc_id"] == marks["__id"]).select("doc_id", "text", "grade")


def learn(documents: DataFrame, labels: DataFrame, rows: int = 3000, longest: int = 20_000, seed: int = 1) -> dict:
    return train(row_sample(ratings(documents, labels), "grade", rows, longest, seed))


def quality_report(documents: DataFrame, labels: DataFrame, at_least: int = 1, least_tail: float = 0.5) -> DataFrame:
    """doc_id, held_out, expected_grade, tail and keep of every document."""
    graded = grade(documents.select("doc_id", "text"), learn(documents, labels), at_least)
    return graded.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "__grade.expected_grade",
        "__grade.tail",
        (F.col("__grade.tail") >= least_tail).alias("keep"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, at_least: int = 1, least_tail: float = 0.5) -> DataFrame:
    """The documents whose tail probability reaches least_tail, with their own columns."""
    return grade(documents, learn(documents, labels), at_least).filter(F.col("__grade.tail") >= least_tail).drop("__grade")
