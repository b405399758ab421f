"""Ranked search: every rank and score against a plain scan, bounds and edges."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import lexical

TERM = re.compile(lexical.TERM)
SMALL = str.maketrans(lexical.UPPER, lexical.SMALL)


def terms_of(text):
    return TERM.findall((text or "").translate(SMALL))


def plain(docs, items, k):
    """Every document scored for every item, by the formula alone."""
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = {}
    for item, terms in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in counted) + 1))) for t in terms}
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda e: (e[0], e[1], e[2] or 0))
        out[item] = [(r + 1, e[2], -e[0]) for r, e in enumerate(scored[:k])]
    return {i: v for i, v in out.items() if v}


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 3, 1) for i, t in docs], "doc_id long, text string, item_id string, terms int, score int")
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id int")
    return d, q


def found(spark, docs, items, k, **more):
    rows = lexical.ranked(*frames(spark, docs, items), k, **more).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return out


def corpus(seed, n, vocabulary=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "ÀB", "Mixed", "x1"]
    heavy = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(r.choices(words, heavy, k=r.choice([0, 1, 3, 30, 200]))) for _ in range(n)]
    texts += [texts[5]] * 40 + [None, "", " .,;", "W1-w2.W3\x1cw4"]
    return list(enumerate(texts))


def test_edges_and_ties(spark):
    docs = corpus(1, 80) + [(None, "w1 w2 w3 rare"), (3, "w1 w1 rare"), (3, "w1 w1 rare")]
    items = [(1, "W1 w2, rare!"), (2, None), (3, "absent only"), (4, "w5"), (4, "w6 é"), (None, "x1 mixed àB ÀB")]
    assert found(spark, docs, items, 7) == plain(docs, items, 7)


@pytest.mark.parametrize("first,blocks", [(1, 3), (20, 200_000)])
def test_rounds_and_blocks_change_nothing(spark, monkeypatch, first, blocks):
    monkeypatch.setattr(lexical, "FIRST_ROUND", first)
    docs = corpus(2, 300)
    r = random.Random(5)
    items = [(i, " ".join(f"w{r.randrange(60)}" for _ in range(8))) for i in range(6)]
    assert found(spark, docs, items, 10, block_terms=blocks) == plain(docs, items, 10)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 5) == {}
    assert found(spark, [(1, "a")], [], 5) == {}
    assert found(spark, [(1, None)], [(1, "a")], 5) == {}


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.booleans())
def test_bounds_never_lose_a_best_document(seed, k, floors):
    """One task's search against all scores, with and without thresholds given."""
    r = np.random.default_rng(seed)
    v, n = 12, 60
    weights = r.integers(0, 9000, v)
    rows = [np.flatnonzero(r.random(v) < 0.4) for _ in range(n)]
    rows = [t for t in rows if len(t)]
    x = [r.integers(1, 10**6, len(t)) for t in rows]
    off = np.concatenate([[0], np.cumsum([len(t) for t in rows])])
    terms, values = np.concatenate(rows), np.concatenate(x)
    norm = np.sqrt(np.add.reduceat(weights[terms] * values.astype(float) ** 2, off[:-1]))
    items = [np.flatnonzero(r.random(v) < 0.5).tolist() for _ in range(4)]
    full = [[sum(int(weights[t]) * int(b) for t, b in zip(ts, xs) if t in it) for ts, xs in zip(rows, x)] for it in items]
    floor = np.array([sorted(f)[-k] if floors else 0 for f in full], np.int64)
    search = lexical.Search(items, weights, k, floor)
    half = len(rows) // 2
    for a, b in ((0, half), (half, len(rows))):
        if a < b:
            search.add(pa.array(np.arange(a, b)), terms[off[a]:off[b]], values[off[a]:off[b]], off[a:b + 1] - off[a], norm[a:b])
    for it, f, best in zip(items, full, search.best):
        expected = sorted((-s, i) for i, s in enumerate(f) if s > 0)[:k]
        assert [(e[0], e[2]) for e in best] == expected


def test_terms_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "word_hashes", lambda raw, starts, ends: np.zeros(len(starts), np.uint64))
    n, terms, tf = lexical.term_counts(pa.array(["ab cd ab", None, "ef zz"]), lexical.Vocabulary(["ab", "cd", "ef"]))
    assert n.tolist() == [3, 0, 2] and terms.to_pylist() == [[0, 1], [], [2]] and tf.to_pylist() == [[2, 1], [], [1]]


def test_short_vectors_are_pruned(spark):
    """Long vectors set thresholds, after which short ones are not scored at all."""
    r = np.random.default_rng(3)
    weights = np.full(20, 1000)
    search = lexical.Search([list(range(20))], weights, 3, np.zeros(1, np.int64))
    long, short = np.full(20 * 50, 900_000), r.integers(1, 9000, 20 * 500)
    for values in (long, short):
        n = len(values) // 20
        off = np.arange(n + 1) * 20
        norm = np.sqrt(np.add.reduceat(1000.0 * values.astype(float) ** 2, off[:-1]))
        search.add(pa.array(np.arange(n)), np.tile(np.arange(20), n), values, off, norm)
    assert search.scored == 50
