"""Toxicity grades by cumulative-link ordinal regression.

P(grade <= j) = logistic(threshold_j - w.x): one weight vector w for all thresholds, which ascend.  The features x
say which marks a text has.  Marks are words, and pieces of words of 4 or 5 characters with the borders of the
word, that toxic documents have far more often than others: pieces find inflected and compound forms that no
labelled document has.  The result is the expected grade, the severity.

Labels say toxic or not; the grade of a toxic document is the number of its different words with a mark, in bands.
Marks, grades and weights are learnt from at most about ``SAMPLE`` labelled documents, those with the smallest
hashes of their ids.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import small_batches, staged, texts_of

SAMPLE = 6_000
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.01
MARKED = 8.0
PIECES = (4, 5)
MAX_WORDS = 200_000
BANDS = (1, 3, 6)
TOXIC_FROM = 0.5
WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    """Weights by mark, and the ascending thresholds between grades."""

    weights: dict[str, float]
    thresholds: list[float]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def pieces_of(word: str) -> set[str]:
    """The word between its borders, and all its pieces."""
    whole = f"^{word}$"
    return {whole, *(whole[i : i + n] for n in PIECES for i in range(len(whole) - n + 1))}


def marks_of(words: list[set[str]], toxic: list[int]) -> set[str]:
    """Pieces that toxic documents have ``MARKED`` times as often as others.

    A hundredth of the toxic documents has them, and ``LEAST_DOCUMENTS`` at least.
    """
    import collections

    bad, good = collections.Counter(), collections.Counter()
    for row, flag in zip(words, toxic):
        if flag:
            bad.update(set().union(*map(pieces_of, row)))
    n_bad = max(1, sum(map(bool, toxic)))
    often = {p for p, n in bad.items() if n >= max(LEAST_DOCUMENTS, LEAST_SHARE * n_bad)}
    for row, flag in zip(words, toxic):
        if not flag:
            good.update(set().union(*map(pieces_of, row)) & often)
    n_good = max(1, len(toxic) - n_bad)
    return {p for p in often if (bad[p] + 0.5) / n_bad > MARKED * (good[p] + 0.5) / n_good}


def marked(words: set[str], marks, known: dict[str, tuple]) -> list[tuple]:
    """The marks of each word that has any; ``known`` keeps those of words seen before."""
    if len(known) > MAX_WORDS:
        known.clear()
    found = []
    for word in words:
        own = known.get(word)
        if own is None:
            own = known[word] = tuple(p for p in pieces_of(word) if p in marks)
        if own:
            found.append(own)
    return found


def grades_of(found: list[list[tuple]], toxic: list[int]):
    """Grades from 0 (not toxic) to ``len(BANDS)``: the band of the number of words with a mark."""
    import numpy as np

    flags = np.array(toxic, bool)
    counts = np.array([len(row) for row in found], np.int64)
    return np.where(flags, np.maximum(1, np.searchsorted(BANDS, counts, side="right")), 0)


def fit(features: list[set[str]], grades, steps: int = 400, penalty: float = 2e-5) -> Model:
    """Weights and thresholds by Adam on the mean negative log-likelihood; a fixed number of steps from zero."""
    import collections

    import numpy as np

    grades = np.asarray(grades, np.int64)
    top = int(grades.max(initial=0))
    counts = collections.Counter(w for row in features for w in row)
    vocabulary = sorted(w for w, n in counts.items() if n >= LEAST_DOCUMENTS)
    if not top or not vocabulary:
        return Model({}, [])
    # Grades that nobody has get no threshold of their own.
    present = np.unique(grades)
    grades = np.searchsorted(present, grades)
    number = {w: k for k, w in enumerate(vocabulary)}
    found = [[number[w] for w in sorted(row) if w in number] for row in features]
    column = np.array([c for row in found for c in row], np.int64)
    row = np.repeat(np.arange(len(features)), [len(r) for r in found])
    n, size, cuts = len(features), len(vocabulary), len(present) - 1

    def logistic(v):
        return 1 / (1 + np.exp(-np.clip(v, -40, 40)))

    # Thresholds as a first one and logarithms of their distances, so that they ascend.
    theta = np.concatenate([np.zeros(size), [1.0], np.zeros(cuts - 1)])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:size], np.exp(theta[size + 1 :])
        bounds = np.concatenate([[-np.inf], theta[size] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(row, w[column], n)
        upper, lower = logistic(bounds[grades + 1] - score), logistic(bounds[grades] - score)
        p = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_score = slope_up - slope_low
        by_bound = np.bincount(grades + 1, -slope_up, cuts + 2) + np.bincount(grades, slope_low, cuts + 2)
        by_bound = by_bound[1 : cuts + 1]
        gradient = np.empty_like(theta)
        gradient[:size] = np.bincount(column, by_score[row], size) / n + penalty * w
        gradient[size] = by_bound.sum() / n
        gradient[size + 1 :] = np.array([by_bound[j + 1 :].sum() for j in range(cuts - 1)]) * gaps / n
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    bounds = theta[size] + np.concatenate([[0], np.cumsum(np.exp(theta[size + 1 :]))])
    # A missing grade shares the threshold of the next one that occurs.
    at = np.searchsorted(present, np.arange(1, present[-1] + 1)) - 1
    weights = {w: float(v) for w, v in zip(vocabulary, theta[:size]) if abs(v) > 1e-6}
    return Model(weights, [float(bounds[k]) for k in at])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents of a bounded sample; documents or labels without an id are no part of it."""
    small_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    whole = 1 << 30
    share = min(whole, whole * sample // max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("id"), F.lit(whole)) < share)

    def rows(batches) -> Iterator:
        for batch in batches:
            found = [" ".join(sorted(words_of(t))) for t in texts_of(batch["text"])]
            yield pd.DataFrame({"id": batch["id"], "toxic": batch["toxic"], "words": found})

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # About `sample` ids and their labels, whatever the size of the tables; at most `sample` different rows of theirs.
    texts = texts.join(F.broadcast(chosen), "id").withColumn("h", F.xxhash64("id", "text"))
    least = staged(texts.select("h").distinct().orderBy("h").limit(sample), "sample")
    texts = texts.join(F.broadcast(least), "h").groupBy("h", "id", "toxic").agg(F.first("text").alias("text"))
    known = texts.select("id", "toxic", "text").mapInPandas(rows, "id long, toxic int, words string").collect()
    known.sort(key=lambda r: (r["id"], r["words"]))
    words, toxic = [set(map(sys.intern, r["words"].split())) for r in known], [r["toxic"] for r in known]
    marks, seen = marks_of(words, toxic), {}
    found = [marked(row, marks, seen) for row in words]
    return fit([set().union(*row) for row in found], grades_of(found, toxic))


def graded(text: Column, model: Model) -> Column:
    """struct(severity, grade, toxic) of each whole text; without a mark, a text has the grade of an empty one."""
    known: dict[str, tuple] = {}
    @F.pandas_udf("severity double, grade int, toxic boolean")
    def grade(texts: pd.Series) -> pd.DataFrame:
        import numpy as np

        weights = model.weights
        found = (set().union(*marked(words_of(t), weights, known)) for t in texts_of(texts))
        score = np.array([sum(weights[m] for m in sorted(marks)) for marks in found], np.float64)
        bounds = np.array(model.thresholds, np.float64)
        above = 1 / (1 + np.exp(np.clip(bounds[None, :] - score[:, None], -40, 40)))  # P(grade > j)
        severity = above.sum(axis=1)
        # The first grade that at least half of the probability lies at or below.
        return pd.DataFrame(
            {
                "severity": severity,
                "grade": (above > 0.5).sum(axis=1).astype(np.int32),
                "toxic": above[:, 0] >= TOXIC_FROM if len(bounds) else np.zeros(len(score), bool),
            }
        )

    return grade(text.cast("string"))


def assess(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, severity (expected grade), grade (the median), toxic of every row.

    A null text counts as empty.  Without a toxic label to learn from, severity is 0 and nothing is toxic.
    Repeated rows get equal grades.  Other columns are not read.
    """
    small_batches(docs.sparkSession)
    model = model or learn(docs, labels)
    rows = docs.select(F.col("doc_id"), graded(F.col("text"), model).alias("g"))
    return rows.select("doc_id", "g.severity", "g.grade", "g.toxic")
