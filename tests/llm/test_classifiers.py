"""Fit and score of the two classifiers against plain forms: dense losses, and features counted anew."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_rows import prose

from sensorflow.llm import hashed_text, quality, toxicity


def logistic(z):
    return 1 / (1 + np.exp(-z))


def ordinal_loss(params, x, grades, l2):
    """Mean negative log likelihood of cumulative logits, one row at a time; the last two parameters are the thresholds."""
    w, theta = params[:-2], params[-2:]
    total = 0.0
    for row, g in zip(x, grades):
        above = [1.0, *(1 / (1 + math.exp(t - row @ w)) for t in theta), 0.0]
        total -= math.log(max(above[g] - above[g + 1], 1e-12))
    return total / len(x) + l2 * float(w @ w)


def test_ordinal_fit_reaches_the_least_loss():
    rnd = np.random.default_rng(8)
    n, k, l2 = 240, 4, 1e-2
    x = rnd.random((n, k)) * (rnd.random((n, k)) < 0.7)
    grades = np.digitize(x @ np.array([3.0, -2.0, 1.0, 0.0]) + rnd.logistic(size=n) * 0.5, [0.2, 1.5])
    rows, columns = np.nonzero(x)
    model = quality.fit(rows, columns, x[rows, columns], grades, n, l2=l2)
    assert not model.weights[k:].any() and model.thresholds[0] < model.thresholds[1]
    fitted = np.append(model.weights[:k], model.thresholds)
    best, least = fitted.copy(), ordinal_loss(fitted, x, grades, l2)
    # pattern search from the fitted point and from zero: neither finds a clearly smaller loss
    for start in (fitted, np.array([0.0] * k + [-1.0, 1.0])):
        at, value, step = start.copy(), ordinal_loss(start, x, grades, l2), 1.0
        while step > 1e-3:
            moved = False
            for i in range(k + 2):
                for sign in (step, -step):
                    trial = at.copy()
                    trial[i] += sign
                    if trial[-2] < trial[-1] and (v := ordinal_loss(trial, x, grades, l2)) < value - 1e-9:
                        at, value, moved = trial, v, True
                        break
            step = step if moved else step / 2
        best, least = (at, value) if value < least else (best, least)
    assert ordinal_loss(fitted, x, grades, l2) < least + 2e-3
    assert np.abs(logistic(x @ fitted[:k] - fitted[-2]) - logistic(x @ best[:k] - best[-2])).max() < 0.05


def plain_quality_features(text):
    """Shares counted word by word."""
    words = [w for w in re.split(r"\s+", text) if w]
    if not words:
        return {"empty": 1.0}
    out = Counter()
    for w in words:
        out["w:" + w.lower()] += 1
        out["s:" + quality.shape(w)] += 1
    merged = Counter()
    for name, c in out.items():
        merged[hashed_text.bucket(name, quality.LG_FEATURES)] += c
    found = {b: math.sqrt(c / len(words)) for b, c in merged.items()}
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(words[i] == words[i - 1] for i in range(1, len(words)))
    again = sum(w in words[:i] for i, w in enumerate(words))
    line = sum(x in lines[:i] for i, x in enumerate(lines))
    for name, share in (("same word as before", same / len(words)), ("word seen before", again / len(words)),
                        ("line seen before", line / max(1, len(lines)))):
        found[hashed_text.bucket(name, quality.LG_FEATURES)] = math.sqrt(share)
    found[hashed_text.bucket(f"length {len(bin(len(words)))}", quality.LG_FEATURES)] = 0.3
    return found


def test_quality_scores_equal_plain_ones(odd, odd_rows):
    rnd = np.random.default_rng(3)
    model = quality.Model(rnd.normal(size=1 << quality.LG_FEATURES), np.array([-0.7, 0.4]))
    want = Counter()
    for i, t, _ in odd_rows:
        f = plain_quality_features(t or "")
        if "empty" in f:
            f = {hashed_text.bucket("empty", quality.LG_FEATURES): 1.0}
        z = math.fsum(model.weights[b] * x for b, x in f.items())
        tails = [1 / (1 + math.exp(-max(-60, min(60, z - th)))) for th in model.thresholds]
        want[i, round(sum(tails), 9), round(tails[0], 9), tails[0] >= quality.SELECT] += 1
    got = quality.score(odd, model).collect()
    assert Counter((r.doc_id, round(r.expected_grade, 9), round(r.tail_probability, 9), r.kept) for r in got) == want
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for (i, _, _, ok), n in want.items() for _ in range(n) if ok)


@pytest.mark.parametrize("penalty", [0.0, 1.0, 25.0])
def test_toxicity_fit_is_stationary(penalty):
    """The final weights have a zero gradient in the dense loss with the penalty on swapped sentences, taken numerically."""
    rnd = random.Random(11)
    texts, labels = [], []
    for k in range(300):
        toxic = k % 3 == 0
        names = rnd.sample(["jews", "gay", "men"], 1) if rnd.random() < (0.6 if toxic else 0.2) else []
        texts.append(" ".join([prose(k, 12, 60), *names, "scum" if toxic and rnd.random() < 0.8 else ""]))
        labels.append(int(toxic))
    found = [toxicity.with_copies(t) for t in texts]
    rows, columns = np.repeat(np.arange(300), [len(f) for f in found]), np.array([c for f in found for c in f])
    values, own = np.array([v for f in found for v in f.values()]), columns < 1 << toxicity.LG_FEATURES
    model = toxicity.fit(rows[own], columns[own], None, np.array(labels), 300, counterfactual=penalty,
                         pairs=toxicity.swaps(rows, columns, values))
    # sentences and copies written out, features of each counted anew
    chosen = np.flatnonzero(model.weights)
    place = {c: i for i, c in enumerate(chosen.tolist())}

    def dense(text):
        out = np.zeros(len(chosen))
        for w in set(re.findall(r"[^\W\d_]+", text.lower())):
            for token in [w, *(w[:k] + "-" for k in (3, 4, 5, 6) if k < len(w))]:
                if (i := place.get(hashed_text.bucket(token, toxicity.LG_FEATURES))) is not None:
                    out[i] = 1.0
        return out

    x, y = np.array([dense(t) for t in texts]), np.array(labels)
    gaps = []
    for t in texts:
        for term in toxicity.IDENTITY_TERMS:
            if term in (ws := t.split()):
                at = toxicity.IDENTITY_TERMS.index(term)
                others = [toxicity.IDENTITY_TERMS[(at + 7 * s) % len(toxicity.IDENTITY_TERMS)] for s in range(1, toxicity.COPIES)]
                gaps += [dense(t) - dense(" ".join(o if w == term else w for w in ws))
                         for o in [*others, toxicity.IDENTITY_TERMS[-1]] if o != term]
    gaps = np.array(gaps)

    def loss(w, b):
        z = x @ w + b
        return (np.mean(np.logaddexp(0, z) - y * z) + penalty / len(y) * np.sum((gaps @ w) ** 2)
                + toxicity.L2 / 2 * np.sum(w ** 2))

    w, b, h = model.weights[chosen], model.intercept, 1e-4
    slopes = [(loss(w + h * e, b) - loss(w - h * e, b)) / (2 * h) for e in np.eye(len(w))]
    slopes.append((loss(w, b + h) - loss(w, b - h)) / (2 * h))
    assert len(chosen) > 3 and np.abs(slopes).max() < 1e-5


def test_toxicity_scores_equal_plain_ones(odd, odd_rows):
    rnd = np.random.default_rng(5)
    size = 1 << toxicity.LG_FEATURES
    model = toxicity.Model(np.where(rnd.random(size) < 0.5, rnd.normal(size=size), 0.0), -0.3)
    want = Counter()
    for i, t, _ in odd_rows:
        held = set()
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            held |= {hashed_text.bucket(x, toxicity.LG_FEATURES) for x in [w, *(w[:k] + "-" for k in (3, 4, 5, 6) if k < len(w))]}
        z = max(-60, min(60, model.intercept + math.fsum(model.weights[b] for b in held)))
        p = 1 / (1 + math.exp(-z))
        want[i, round(p, 9), int(p >= toxicity.THRESHOLD)] += 1
    assert Counter((r.doc_id, round(r.score, 9), r.predicted) for r in toxicity.score(odd, model).collect()) == want
