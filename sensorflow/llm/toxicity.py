"""Toxicity: logistic regression on hashed words with a counterfactual penalty.

Each labelled text that names a group gets copies in which that identity term is swapped
for others (a neutral one among them), with all the features that the swap changes, the
words' beginnings too; the squared change of the logit between a text
and its copies is added to the loss, so the model can't score a text by whom it names.
An L1 penalty, solved by accelerated proximal steps, selects few words; their weights are
then fitted again without it (Newton steps, a slight L2 penalty instead), as it shrinks them.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import as_texts, id_and_text, slices
from sensorflow.llm.hashed_text import (Sparse, bucket, collect_features, frequent_columns, held_out, sigmoid,
                                        training_sample)

#: terms that name a group, and the neutral ones they may be swapped for
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "black",
    "white", "asian", "african", "european", "latino", "immigrants", "refugees", "gay", "lesbian", "transgender",
    "straight", "disabled", "blind", "deaf", "elderly", "people", "persons",
)

#: bound of the training sample, in labelled rows
TRAINING_ROWS = 6_000
LG_FEATURES = 18
LEAST_ROWS = 3
#: lengths of word beginnings that are features
STEMS = (3, 4, 5, 6)
#: copies per term that a text holds, the last with the neutral term
COPIES = 4
THRESHOLD = 0.7
L1, L2, COUNTERFACTUAL, STEPS = 3e-3, 2e-5, 1.0, 60

WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> set[str]:
    return set(WORDS(text.lower()))


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its first letters, so that compounds of one stem share weights."""
    return [bucket(word, LG_FEATURES), *(bucket(word[:k] + "-", LG_FEATURES) for k in STEMS if k < len(word))]


def features(text: str) -> dict[int, float]:
    """Presence of each word and stem, by hash."""
    return {b: 1.0 for w in words_of(text) for b in word_features(w)}


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def word(self, w: str) -> float:
        return float(self.weights[bucket(w, LG_FEATURES)])


def swapped(term: str, rest: set[int]) -> list[dict[int, float]]:
    """Per copy with another term in the place of ``term``: the features it loses (+1) and gains (-1).

    ``rest`` holds the features of the text's other words, which the copy keeps.
    """
    lost, place, out = set(word_features(term)) - rest, IDENTITY_TERMS.index(term), []
    for step in range(1, COPIES + 1):
        other = IDENTITY_TERMS[(place + step * 7) % len(IDENTITY_TERMS)] if step < COPIES else IDENTITY_TERMS[-1]
        if other != term:
            gained = set(word_features(other)) - rest
            out.append(dict.fromkeys(lost - gained, 1.0) | dict.fromkeys(gained - lost, -1.0))
    return out


def with_copies(text: str) -> dict[int, float]:
    """Features of a text, and after them, ``2**LG_FEATURES`` columns per copy, those that a swap changes."""
    held = {w: word_features(w) for w in words_of(text)}
    out = {b: 1.0 for bs in held.values() for b in bs}
    changes = [c for term in IDENTITY_TERMS if term in held
               for c in swapped(term, {b for w, bs in held.items() if w != term for b in bs})]
    return out | {(k << LG_FEATURES) + b: v for k, c in enumerate(changes, 1) for b, v in c.items()}


def swaps(rows: np.ndarray, columns: np.ndarray, values: np.ndarray | None) -> Sparse:
    """One row per (text, copy) of the entries that :func:`with_copies` puts after the features."""
    at = np.flatnonzero(columns >> LG_FEATURES)
    copy = rows[at].astype(np.int64) << 32 | columns[at] >> LG_FEATURES
    kinds, k = np.unique(copy, return_inverse=True)
    return Sparse(k, columns[at] & (1 << LG_FEATURES) - 1, np.zeros(0) if values is None else values[at].astype(float),
                  max(len(kinds), 1), 1 << LG_FEATURES)


def swaps_of_features(rows: np.ndarray, columns: np.ndarray) -> Sparse:
    """As :func:`swaps` where only features are known: a term's stems count as no other word's but a term's."""
    terms = {bucket(t, LG_FEATURES): t for t in IDENTITY_TERMS}
    r, c, v, k = [], [], [], 0
    for row in np.unique(rows[np.isin(columns, list(terms))]).tolist():
        here = set(columns[rows == row].tolist())
        held = [terms[b] for b in here & terms.keys()]
        for term in held:
            rest = here.difference(word_features(term)).union(*(word_features(t) for t in held if t != term))
            for change in swapped(term, rest):
                r += [k] * len(change)
                c += change.keys()
                v += change.values()
                k += 1
    return Sparse(np.array(r, np.int64), np.array(c, np.int64), np.array(v, float), max(k, 1), 1 << LG_FEATURES)


def fit(rows, columns, values, labels, n_rows, l1: float = L1, counterfactual: float = COUNTERFACTUAL,
        steps: int = STEPS, pairs: Sparse | None = None) -> Model:
    """Minimise the mean log loss + ``counterfactual`` * mean squared swap change + ``l1`` * |w|.

    ``pairs`` are the swaps, by :func:`swaps`; without them they are taken from the features.
    """
    size = 1 << LG_FEATURES
    if not n_rows or labels.min() == labels.max():
        share = float(labels.mean()) if n_rows else 0.0
        return Model(np.zeros(size), 20.0 * (2 * share - 1))
    if pairs is None:
        pairs = swaps_of_features(rows, columns)
    ok = frequent_columns(columns, LEAST_ROWS, size)[columns]
    x = Sparse(rows[ok], columns[ok], None if values is None else values[ok], n_rows, size)
    del rows, columns, values, ok
    y = labels.astype(float)
    # step sizes per feature by how common it is (diagonal scaling), total bounded by the row lengths
    common = np.bincount(x.columns, minlength=size)
    scale = 1 / np.sqrt(common + 1.0)
    spread = np.bincount(x.rows, scale[x.columns], minlength=n_rows)
    curve = 0.25 * x.t_dot(spread) / n_rows
    swap_spread = np.bincount(pairs.rows, scale[pairs.columns], minlength=pairs.shape[0])
    curve += 2 * counterfactual * np.bincount(pairs.columns, np.abs(pairs.values) * swap_spread[pairs.rows], minlength=size) / n_rows
    step = np.where(curve > 0, scale / np.maximum(curve, 1e-12), 0.0)
    w = v = np.zeros(size)
    b = vb = float(np.log(y.mean() / (1 - y.mean())))
    t = 1.0
    for _ in range(steps):
        g = (sigmoid(x.dot(v) + vb) - y) / n_rows
        grad = x.t_dot(g) + 2 * counterfactual / n_rows * pairs.t_dot(pairs.dot(v))
        moved = v - step * grad
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        new_b = vb - 2.0 * g.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return refit(x, pairs, y, w, b, counterfactual)


def refit(x: Sparse, pairs: Sparse, y: np.ndarray, w: np.ndarray, b: float, counterfactual: float, l2: float = L2,
          steps: int = 30) -> Model:
    """Newton's method on the words with a weight and the intercept, with the same counterfactual penalty."""
    chosen = np.flatnonzero(w)
    place = np.full(len(w), -1)
    place[chosen] = np.arange(len(chosen))

    def dense(m: Sparse) -> np.ndarray:
        out = np.zeros((m.shape[0], len(chosen)))
        ok = place[m.columns] >= 0
        np.add.at(out, (m.rows[ok], place[m.columns[ok]]), 1.0 if m.values is None else m.values[ok])
        return out

    n = len(y)
    a = np.hstack([dense(x), np.ones((n, 1))])
    swapped = dense(pairs)
    ridge = np.diag([l2] * len(chosen) + [1e-9])
    ridge[:-1, :-1] += 2 * counterfactual / n * swapped.T @ swapped
    u = np.append(w[chosen], b)
    for _ in range(steps):
        p = sigmoid(a @ u)
        grad = a.T @ (p - y) / n + ridge @ u
        move = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a / n + ridge + 1e-9 * np.eye(len(u)), grad)
        u -= move * min(1.0, 4 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    out = np.zeros_like(w)
    out[chosen] = u[:-1]
    return Model(out, float(u[-1]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, **settings) -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out."""
    sample = training_sample(docs, labels, F.col("toxic"), max_rows)
    rows, columns, values, labels, n_rows = collect_features(sample, with_copies, max_rows)
    pairs, own = swaps(rows, columns, values), columns < 1 << LG_FEATURES
    return fit(rows[own], columns[own], None, labels, n_rows, pairs=pairs, **settings)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Only the text gives the score.  A null or empty text has no words and gets the score of
    the intercept.  Null and repeated ids give one row per input row; ``held_out`` is false
    for a null id.  An empty table gives no rows.
    """
    known = np.flatnonzero(model.weights)
    weights = docs.sparkSession.sparkContext.broadcast(dict(zip(known.tolist(), model.weights[known].tolist())))
    intercept = model.intercept

    def apply(batches):
        table, weighted = weights.value, {}
        for piece in slices(batches):
            held = [words_of(t) for t in as_texts(piece.column("text"))]
            if len(weighted) > 150_000:
                weighted = {}
            for w in set().union(*held) - weighted.keys():
                weighted[w] = [b for b in word_features(w) if b in table]
            known = [{b for w in ws for b in weighted[w]} for ws in held]
            z = np.array([math.fsum([intercept, *map(table.__getitem__, bs)]) for bs in known])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sigmoid(z))], ["doc_id", "score"])

    return (id_and_text(docs).mapInArrow(apply, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
