"""Language model: counts against brute force, probabilities that sum to 1."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF, docs, edge_rows

from txlake.llm import lm
from txlake.llm.common import table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return [*WORD.findall((text or "").encode().translate(FOLD)), None]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def check_counts(rows, result):
    train = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = []
    for d, t in rows:
        ws = tokens(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want.append((d, held(d), len(ws), sum(train[w] > 0 for w in ws), n, round(base, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in result]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_counts_and_base_equal_brute_force(spark):
    frame = table(spark, SF, "documents")
    result = lm.language_model_scores(frame).collect()
    check_counts([(r.doc_id, r.text) for r in frame.collect()], result)
    held_rows = [r for r in result if r.held_out]
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows)


def test_edge_rows(spark):
    rows = edge_rows()
    result = lm.language_model_scores(docs(spark, rows)).collect()
    check_counts([r[:2] for r in rows], result)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in result)
    assert lm.language_model_scores(docs(spark, [])).collect() == []


def test_predictive_probabilities_sum_to_one():
    """Every word after a context, the unknown word included."""
    rng = np.random.default_rng(1)
    c = rng.integers(0, 6, 40)
    p = np.append(rng.dirichlet(np.ones(40)) * 0.9, 0.1)
    t = lm.sample_tables(c, 3 * p[:-1], np.arange(40, dtype=np.uint64), lm.DISCOUNT)[0]
    assert ((t <= c) & ((t > 0) == (c > 0))).all()
    own = np.append(c - lm.DISCOUNT * t, 0)
    total = (own + (lm.STRENGTH + lm.DISCOUNT * t.sum()) * p) / (lm.STRENGTH + c.sum())
    assert abs(total.sum() - 1) < 1e-12


def test_gibbs_matches_the_posterior_of_tables():
    """Long chains against the exact posterior p(t) ~ a^t * S_d(c, t)."""
    c, a, d = 6, 1.3, 0.5
    stirling = {(1, 1): 1.0}
    for n in range(1, c):
        for k in range(1, n + 2):
            stirling[n + 1, k] = stirling.get((n, k - 1), 0) + (n - d * k) * stirling.get((n, k), 0)
    exact = np.array([a * np.prod([a + d * 0 for _ in range(k - 1)]) * stirling[c, k] for k in range(1, c + 1)])
    exact /= exact.sum()
    n = 20_000
    t = lm.sample_tables(np.full(n, c), np.full(n, a), np.arange(n, dtype=np.uint64) * 7919, d, burn=30, samples=1)[0]
    seen = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(seen - exact).max() < 0.015


@pytest.mark.parametrize("c, a", [(50, 2), (50, 300), (1000, 2), (1000, 20), (2500, 20), (5000, 400), (5000, 2000), (5000, 20000)])
def test_tables_of_frequent_pairs_match_the_posterior(c, a):
    """The sampler as it runs, against a^t * S_d(c, t) by the plain recursion."""
    d = lm.DISCOUNT
    row = np.array([1.0])  # S_d(n, t) scaled, a^t included
    for n in range(1, c):
        t = np.arange(1, n + 1)
        row = np.append(row * np.maximum(n - d * t, 0), 0) + np.append(0, a * row)
        row /= row.max()
    t = np.arange(1, c + 1)
    mean = (row * t).sum() / row.sum()
    sd = math.sqrt((row * t * t).sum() / row.sum() - mean * mean)
    n = 2000
    seen = lm.sample_tables(np.full(n, c), np.full(n, a), np.arange(n, dtype=np.uint64) * 7919, d)
    assert seen.shape == (lm.SAMPLES, n)
    assert abs(seen.mean() - mean) < 5 * sd / math.sqrt(seen.size) + 0.001 * mean
    assert abs(seen.std() - sd) < 0.06 * sd + 0.01


def test_split_contexts_give_the_same_scores(spark, monkeypatch):
    """A context in a third of the tokens is split over buckets."""
    rows = [(i, "the " + " the ".join(f"w{(i * j) % 17}" for j in range(30))) for i in range(40)]
    monkeypatch.setattr(lm, "hot_contexts", lambda *_: np.empty(0, dtype=np.uint64))
    whole = {r.doc_id: r.base_score for r in lm.language_model_scores(docs(spark, rows)).collect()}
    monkeypatch.undo()
    split = lm.language_model_scores(docs(spark, rows)).collect()
    assert all(abs(whole[r.doc_id] - r.base_score) < 1e-9 for r in split)
    assert all(r.score > r.base_score for r in split)


def test_scores_do_not_depend_on_splitting(spark, monkeypatch):
    """Seating and probabilities, not the base score alone."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"the w{x}" if x % 3 else f"w{x}" for x in rng.zipf(1.4, 60) % 90)) for i in range(60)]
    split = {r.doc_id: r.score for r in lm.language_model_scores(docs(spark, rows)).collect()}
    monkeypatch.setattr(lm, "hot_contexts", lambda *_: np.empty(0, dtype=np.uint64))
    whole = {r.doc_id: r.score for r in lm.language_model_scores(docs(spark, rows)).collect()}
    assert all(abs(whole[i] - split[i]) < 1e-6 for i in whole)
