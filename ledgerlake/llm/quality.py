"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

r = log of the ratio of smoothed n-gram frequencies in good and bad texts. Each
indicator is scaled by its r, each text to length 1, and a linear hinge-loss model is
fitted by dual coordinate descent (one box-constrained dual variable per text,
weights kept as their sum). Scores are a logistic map of the margin, calibrated on a
fifth of the sample that the fit doesn't see.

Edges: null and empty texts have no n-grams and score by the intercept; repeated rows
and ids are scored row by row; held-out rows (null ids by the crc32 of '') are never
learnt from; with no labels, or one class, every score is that class's share (0.5
without labels); an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.features import BITS, SAMPLE, held_out, labelled_sample, present, score_texts

MIN_TEXTS = 3


def log_ratios(y: np.ndarray, rows: np.ndarray, feature: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    dims = 1 << BITS
    good = np.bincount(feature[y[rows] == 1], minlength=dims)
    bad = np.bincount(feature[y[rows] == 0], minlength=dims)
    r = np.log((good + smooth) / (np.sum(y == 1) + 2 * smooth)) - np.log((bad + smooth) / (np.sum(y == 0) + 2 * smooth))
    r[good + bad < MIN_TEXTS] = 0
    return r


def dual_descent(y: np.ndarray, indptr: np.ndarray, feature: np.ndarray, value: np.ndarray, cost: np.ndarray,
                 part: np.ndarray | None = None, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """Weights (the last is the intercept) of min |w|^2/2 + sum cost * hinge over the
    texts in ``part`` (all)."""
    part = np.arange(len(y)) if part is None else part
    w = np.zeros((1 << BITS) + 1)
    sign = np.where(y == 1, 1.0, -1.0)
    alpha = np.zeros(len(y))
    square = np.array([value[a:b] @ value[a:b] for a, b in zip(indptr[:-1], indptr[1:])]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(part):
            a, b = indptr[i], indptr[i + 1]
            f, v = feature[a:b], value[a:b]
            gradient = sign[i] * (w[f] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[f] += step * v
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def logistic_map(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a m + b))) with a > 0, by Newton steps (Platt's targets)."""
    pos, neg = max(1, int(np.sum(y == 1))), max(1, int(np.sum(y == 0)))
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([np.sum((p - t) * margin) + 1e-3 * a, np.sum(p - t)])
        s = p * (1 - p) + 1e-9
        h = np.array([[np.sum(s * margin * margin) + 1e-3, np.sum(s * margin)], [np.sum(s * margin), np.sum(s)]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def scaled(indptr: np.ndarray, feature: np.ndarray, r: np.ndarray):
    """Features with a ratio, their values scaled to length 1 per text."""
    keep = r[feature] != 0
    rows = np.repeat(np.arange(len(indptr) - 1, dtype=np.int32), np.diff(indptr))[keep]
    feature = feature[keep]
    value = r[feature].astype(np.float32)
    norm = np.sqrt(np.bincount(rows, weights=value * value, minlength=len(indptr) - 1))
    norm[norm == 0] = 1
    cuts = np.searchsorted(rows, np.arange(len(indptr)))
    return cuts, rows, feature, value / norm.astype(np.float32)[rows]


def fit(y: np.ndarray, indptr: np.ndarray, feature: np.ndarray, cost: float = 4.0) -> dict:
    """The model: ratios, weights and the logistic map."""
    if len(np.unique(y)) < 2 or min(np.sum(y == 1), np.sum(y == 0)) < 5:
        share = float(np.mean(y)) if len(y) else 0.5
        return {"share": share}
    rng = np.random.default_rng(1)
    aside = np.zeros(len(y), bool)
    for c in (0, 1):  # a fifth of either class is kept for the logistic map
        at = rng.permutation(np.flatnonzero(y == c))
        aside[at[:max(1, len(at) // 5)]] = True
    rows = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(indptr))
    seen = ~aside[rows]
    r = log_ratios(np.where(aside, -1, y), rows[seen], feature[seen])
    del rows, seen
    cuts, row, feat, value = scaled(indptr, feature, r)
    del feature
    part = np.flatnonzero(~aside)
    weight = np.where(y == 1, 0.5 / np.mean(y == 1), 0.5 / np.mean(y == 0)) ** 0.5
    w = dual_descent(y, cuts, feat, value, cost * weight, part)
    margin = np.bincount(row, weights=w[feat] * value, minlength=len(y)) + w[-1]
    a, b = logistic_map(margin[aside], y[aside])
    used = np.flatnonzero(r)
    return {"used": used.astype(np.int32), "r": r[used].astype(np.float32), "wr": (w[used] * r[used]).astype(np.float32),
            "bias": float(w[-1]), "a": a, "b": b}


class Scorer:
    def __init__(self, model: dict):
        self.model = model
        if "used" in model:
            self.r2 = np.zeros(1 << BITS, np.float32)
            self.r2[model["used"]] = model["r"] ** 2
            self.wr = np.zeros(1 << BITS, np.float32)
            self.wr[model["used"]] = model["wr"]
            self.keep = self.r2 > 0

    def __call__(self, raw, offsets):
        n, m = len(offsets) - 1, self.model
        if "share" in m:
            return (np.full(n, m["share"]),)
        text, feature = present(raw, offsets, False, self.keep)
        top = np.bincount(text, weights=self.wr[feature], minlength=n)
        norm = np.sqrt(np.bincount(text, weights=self.r2[feature], minlength=n))
        norm[norm == 0] = 1
        return (1 / (1 + np.exp(-np.clip(m["a"] * (top / norm + m["bias"]) + m["b"], -40, 40))),)


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` plus score (0 to 1) of every text, by a model fitted on at most
    ``sample`` labelled rows that aren't held out."""
    y, indptr, feature = labelled_sample(docs, labels, "quality", False, sample)
    shared = docs.sparkSession.sparkContext.broadcast(fit(y, indptr, feature))

    def run(raw, offsets, _made=[]):  # noqa: B006  one scorer per task
        from ledgerlake.llm import quality
        if not _made:
            _made.append(quality.Scorer(shared.value))
        return _made[0](raw, offsets)
    return score_texts(docs, list(columns), run, "score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    return score_quality(docs, labels, sample).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
