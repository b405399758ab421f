"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k | x) = logistic(cut_k - w.x): one weight vector for all thresholds, with
cuts kept in order. The output is the expected severity, the sum of k P(grade = k).

Labels only say toxic or not. Grade 0 is not toxic; toxic texts are graded 1 (mild) or
2 (severe) by how many strongly toxic features they hold, split at the sample's median.
Features are those n-gram indicators whose log odds differ most surely between toxic
and clean texts (z of the log odds ratio), weighted by the fit with an L2 penalty.

Edges: null and empty texts have no features: their severity is the intercepts';
repeated rows and ids are scored row by row; held-out rows are never learnt from;
without labels, or with one class, every probability is that class's share (none: not
toxic); an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import buffers, chunks, ship_package
from ledgerlake.llm.features import BITS, SAMPLE, held_out, labelled_sample, present, score_texts

FEATURES = 4096
SURE = 3.5


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def sure_features(y: np.ndarray, rows: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features (at most ``FEATURES``) by |z| of the log odds ratio, and their z."""
    dims = 1 << BITS
    n1, n0 = np.sum(y == 1), np.sum(y == 0)
    a = np.bincount(feature[y[rows] == 1], minlength=dims) + 0.5
    b = np.bincount(feature[y[rows] == 0], minlength=dims) + 0.5
    z = (np.log(a / (n1 + 1 - a)) - np.log(b / (n0 + 1 - b))) / np.sqrt(1 / a + 1 / (n1 + 1 - a) + 1 / b + 1 / (n0 + 1 - b))
    z[a + b < 4] = 0
    top = np.argsort(-np.abs(z), kind="stable")[:FEATURES]
    top = np.sort(top[np.abs(z[top]) >= SURE])
    return top, z[top]


def fit_ordinal(grade: np.ndarray, rows: np.ndarray, col: np.ndarray, dims: int, grades: int, penalty: float = 1.0,
                rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) by Adam on the mean penalised negative log likelihood; cuts are
    kept in order as a first cut plus exponentials."""
    n = len(grade)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n, 0.002, 0.998)
    cut = np.log(share / (1 - share))
    free = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    w = np.zeros(dims)
    m, v = np.zeros(dims + len(free)), np.zeros(dims + len(free))
    for t in range(1, rounds + 1):
        steps = np.exp(free[1:])
        cuts = free[0] + np.concatenate([[0], np.cumsum(steps)])
        eta = np.bincount(rows, weights=w[col], minlength=n)
        upper = _logistic(np.append(cuts, np.inf)[grade] - eta)
        lower = np.where(grade > 0, _logistic(np.concatenate([[-np.inf], cuts])[grade] - eta), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_eta = (du - dl) / n  # of the negative log likelihood
        g_w = np.bincount(col, weights=g_eta[rows], minlength=dims) + penalty * w / n
        g_cut = np.zeros(grades - 1)
        np.add.at(g_cut, grade[grade < grades - 1], -du[grade < grades - 1] / n)
        np.add.at(g_cut, grade[grade > 0] - 1, dl[grade > 0] / n)
        later = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate([g_w, [later[0]], later[1:] * steps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
        w -= move[:dims]
        free -= move[dims:]
    return w, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def fit(y: np.ndarray, indptr: np.ndarray, feature: np.ndarray) -> dict:
    if len(np.unique(y)) < 2 or min(np.sum(y == 1), np.sum(y == 0)) < 5:
        return {"share": float(np.mean(y)) if len(y) else 0.0}
    rows = np.repeat(np.arange(len(y)), np.diff(indptr))
    used, z = sure_features(y, rows, feature)
    at = np.searchsorted(used, feature)
    hit = np.flatnonzero((at < len(used)) & (used[np.minimum(at, max(len(used) - 1, 0))] == feature)) if len(used) else np.zeros(0, int)
    row, col = rows[hit], at[hit]
    strong = np.bincount(row, weights=np.maximum(z, 0)[col], minlength=len(y))
    toxic = y == 1
    grade = np.where(toxic, 1 + (strong > np.median(strong[toxic])), 0)
    grades = int(grade.max()) + 1
    w, cuts = fit_ordinal(grade, row, col, len(used), grades)
    return {"used": used.astype(np.int32), "w": w, "cuts": cuts}


class Scorer:
    def __init__(self, model: dict):
        self.model = model
        if "used" in model:
            self.keep = np.zeros(1 << BITS, bool)
            self.keep[model["used"]] = True
            self.w = np.zeros(1 << BITS)
            self.w[model["used"]] = model["w"]

    def __call__(self, raw, offsets):
        n, m = len(offsets) - 1, self.model
        if "share" in m:
            p = np.full(n, m["share"])
            return p, (p >= 0.5).astype(np.int32), p
        text, feature = present(raw, offsets, True, self.keep, True)
        eta = np.bincount(text, weights=self.w[feature], minlength=n)
        above = 1 - _logistic(m["cuts"][None, :] - eta[:, None])  # P(grade > k), sums to the expectation
        return above.sum(1), (above >= 0.5).sum(1).astype(np.int32), above[:, 0]


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
                   columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` plus severity (expected grade), grade (the largest whose
    probability of being reached is at least a half) and p_toxic (of grade 1 or
    more), by a model fitted on at most ``sample`` labelled rows that aren't held out."""
    run = _scorer(docs, labels, sample)
    return score_texts(docs, list(columns), run, "severity double, grade int, p_toxic double")


def _scorer(docs: DataFrame, labels: DataFrame, sample: int):
    y, indptr, feature = labelled_sample(docs, labels, "toxic", True, sample, True)
    shared = docs.sparkSession.sparkContext.broadcast(fit(y, indptr, feature))

    def run(raw, offsets, _made=[]):  # noqa: B006  one scorer per task
        from ledgerlake.llm import toxicity
        if not _made:
            _made.append(toxicity.Scorer(shared.value))
        return _made[0](raw, offsets)
    return run


def toxic_column(docs: DataFrame, labels: DataFrame, text: Column | str = "text", sample: int = SAMPLE) -> Column:
    """The probability of grade 1 or more as a column over ``docs``."""
    ship_package(docs.sparkSession)
    run = _scorer(docs, labels, sample)

    @F.arrow_udf("double")
    def p_toxic(col: pa.Array) -> pa.Array:
        raw, offsets = buffers(col)
        parts = [run(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[2] for i, j in chunks(offsets)]
        return pa.array(np.concatenate(parts)) if parts else pa.array([], pa.float64())
    return p_toxic(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose probability of being toxic is a half or more."""
    return docs.where(toxic_column(docs, labels, sample=sample) < 0.5)


def grade_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, severity, grade, p_toxic, toxic) for every row."""
    return score_toxicity(docs, labels, sample).select(
        "doc_id", held_out().alias("held_out"), "severity", "grade", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))
