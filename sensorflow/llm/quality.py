"""Quality: ordinal regression with cumulative logits on graded ratings.

``P(grade > k) = sigmoid(w . x - theta_k)`` with one weight vector for all grades and
ordered thresholds.  Features are hashed text: words, word shapes, and marks for words and
lines that repeat, each as the square root of its share of the text.  The expected grade and
the probability of the tail (a grade of ``least`` or more) select documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import as_texts, give_back_memory, id_and_text, slices
from sensorflow.llm.hashed_text import Sparse, bucket, collect_features, held_out, sigmoid, training_sample

#: bound of the training sample, in labelled rows
TRAINING_ROWS = 8_000
LG_FEATURES = 16
GRADES = 3
#: select documents whose probability of this grade or a better one is at least SELECT
LEAST_GRADE, SELECT = 1, 0.5
L2, STEPS, RATE = 1e-4, 200, 0.3

SHAPE_RUNS = [(re.compile(r"[^\W\d_]*[a-zà-öø-ÿ][^\W\d_]*"), "x"), (re.compile(r"[^\W\d_]+"), "X"), (re.compile(r"\d+"), "9")]
REPEATED = re.compile(r"([^\w\s])\1+")


def grade(quality: Column, toxic: Column) -> Column:
    """0: low quality; 1: readable but toxic; 2: readable and harmless.  Null where quality is unknown."""
    return F.when(quality == 1, F.when(toxic == 1, 1).otherwise(2)).when(quality.isNotNull(), 0)


def shape(word: str) -> str:
    """Letters as x (any lower case) or X, digits as 9, a repeated sign twice."""
    for run, mark in SHAPE_RUNS:
        word = run.sub(mark, word) if mark != "X" else run.sub(lambda m: m[0] if m[0] == "x" else "X", word)
    return REPEATED.sub(r"\1\1", word)[:12]


_shapes: dict[str, tuple[int, int]] = {}


def _word_buckets(word: str) -> tuple[int, int]:
    """Buckets of a word and of its shape, remembered for a bounded number of words."""
    found = _shapes.get(word)
    if found is None:
        if len(_shapes) > 60_000:
            _shapes.clear()
        found = _shapes[word] = (bucket("w:" + word.lower(), LG_FEATURES), bucket("s:" + shape(word), LG_FEATURES))
    return found


SAME, AGAIN, LINE = (bucket(x, LG_FEATURES) for x in ("same word as before", "word seen before", "line seen before"))


def features(text: str) -> dict[int, float]:
    """Square roots of the shares of words, shapes and repeats; a bias per order of length."""
    words = text.split()
    if not words:
        return {bucket("empty", LG_FEATURES): 1.0}
    n = len(words)
    counts: Counter = Counter()
    distinct = Counter(words)
    for w, k in distinct.items():
        a, b = _word_buckets(w)
        counts[a] += k
        counts[b] += k
    lines = [x for x in text.split("\n") if x.strip()]
    out = {c: (k / n) ** 0.5 for c, k in counts.items()}
    out[SAME] = (sum(a == b for a, b in zip(words, words[1:])) / n) ** 0.5
    out[AGAIN] = (1 - len(distinct) / n) ** 0.5
    out[LINE] = (1 - len(set(lines)) / max(1, len(lines))) ** 0.5
    out[bucket(f"length {len(bin(n))}", LG_FEATURES)] = 0.3
    return out


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """``P(grade >= 1), P(grade >= 2), ...`` per row."""
        return sigmoid(z[:, None] - self.thresholds[None, :])


def fit(rows, columns, values, grades, n_rows, n_grades: int = GRADES, l2: float = L2, steps: int = STEPS,
        rate: float = RATE) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over all rows at once; thresholds stay ordered as a
    first value and positive gaps."""
    size, cuts = 1 << LG_FEATURES, n_grades - 1
    if not n_rows:
        return Model(np.zeros(size), np.arange(cuts) - 10.0)
    x = Sparse(rows, columns, values, n_rows, size)
    params = np.zeros(size + cuts)
    share = np.clip([(grades > k).mean() for k in range(cuts)], 1e-3, 1 - 1e-3)
    base = np.maximum.accumulate(-np.log(share / (1 - share)) + np.arange(cuts) * 1e-3)
    params[size] = base[0]
    params[size + 1:] = np.log(np.maximum(np.diff(base), 1e-2))
    m, v = np.zeros_like(params), np.zeros_like(params)
    at = np.arange(n_rows)
    for t in range(1, steps + 1):
        gaps = np.exp(params[size + 1:])
        theta = params[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = x.dot(params[:size])
        s = np.concatenate([np.ones((n_rows, 1)), sigmoid(z[:, None] - theta[None, :]), np.zeros((n_rows, 1))], axis=1)
        slope = s * (1 - s)
        p = np.maximum(s[at, grades] - s[at, grades + 1], 1e-9)
        # d log p / dz, and per threshold
        up, down = slope[at, grades] / p, slope[at, grades + 1] / p
        g_theta = np.zeros(cuts + 2)
        np.add.at(g_theta, grades, up)
        np.add.at(g_theta, grades + 1, -down)
        g_theta = g_theta[1:-1] / n_rows
        grad = np.concatenate([x.t_dot((down - up) / n_rows) + 2 * l2 * params[:size],
                               [g_theta.sum()], np.cumsum(g_theta[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params -= rate * min(1.0, 3 * (1 - t / (steps + 1))) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(params[:size], params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1:]))]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, **settings) -> Model:
    """Fit on a bounded sample of the graded rows that aren't held out."""
    sample = training_sample(docs, labels, grade(F.col("quality"), F.col("toxic")), max_rows)
    model = fit(*collect_features(sample, features, max_rows), **settings)
    give_back_memory()
    return model


def expected_grades(batches, weights: np.ndarray, thresholds: np.ndarray):
    """Per Arrow slice: the slice, expected grades, and tail probabilities."""
    model, weight = Model(weights, thresholds), weights.tolist()
    for piece in slices(batches):
        z = np.array([sum(weight[c] * x for c, x in features(t).items()) for t in as_texts(piece.column("text"))])
        tails = model.tails(z)
        yield piece, tails.sum(axis=1), tails[:, LEAST_GRADE - 1]


def score(docs: DataFrame, model: Model, select: float = SELECT) -> DataFrame:
    """``doc_id, held_out, expected_grade, tail_probability, kept`` of every whole text.

    A null or empty text is graded by its one feature, emptiness.  Null and repeated ids give
    one row per input row; ``held_out`` is false for a null id.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def apply(batches):
        for piece, grades, tail in expected_grades(batches, *shared.value):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(grades), pa.array(tail)],
                                             ["doc_id", "expected_grade", "tail_probability"])

    return (id_and_text(docs).mapInArrow(apply, "doc_id long, expected_grade double, tail_probability double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability",
                    (F.col("tail_probability") >= select).alias("kept")))


def keep_good(docs: DataFrame, model: Model, select: float = SELECT) -> DataFrame:
    """``docs`` without the rows whose tail probability is below ``select``; all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def keep(batches):
        for piece, _, tail in expected_grades(batches, *shared.value):
            yield piece.filter(pa.array(tail >= select))

    return docs.mapInArrow(keep, docs.schema)
