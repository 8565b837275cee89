from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import toxicity

from .conftest import frame


def _corpus(n=600):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgstn", k=rng.randint(3, 8))) for _ in range(2000)]
    out, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        low = k % 3 == 0
        text = rng.choices(words, k=rng.randint(20, 200)) + (rng.choices(["zorblat", "grumpfly", "grumpfen"], k=3) if toxic else []) + (["junky"] * 2 if low else [])
        rng.shuffle(text)
        out.append((k, " ".join(text)))
        labels.append((k, int(low), int(toxic)))
    return out, labels


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = _corpus()
    return frame(spark, rows), labels


def test_held_out_accuracy(spark, corpus):
    df, labels = corpus
    shown = spark.createDataFrame([x for x in labels if x[0] % 2 == 0], "doc_id long, low_quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.judged(df, shown, ["low_quality", "toxic"]).collect()}
    held = [x for x in labels if x[0] % 2]
    assert sum(got[i]["rejected"] for i, _, t in held if t) >= 0.95 * sum(t for _, _, t in held)
    assert sum(got[i]["rejected"] for i, _, t in held if not t) <= 0.01 * len(held)
    assert sum((got[i]["p_low_quality"] > 0.5) == bool(q) for i, q, _ in held) >= 0.95 * len(held)


def test_later_models_see_earlier_probabilities(spark, corpus):
    rows, labels = _corpus()
    same = [(i, q, q) for i, q, _ in labels]  # the second category is the first
    from tidelog.llm.shared import Workspace

    chain = toxicity.train(frame(spark, rows), spark.createDataFrame(same, "doc_id long, a int, b int"), ["a", "b"], Workspace(spark))
    assert chain.models[1][1].shape == (1,) and chain.models[1][1][0] > 0.5


def test_kept_rows(spark, corpus):
    df, labels = corpus
    shown = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    kept = toxicity.acceptable(df, shown, ["low_quality", "toxic"])
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {i for i, _, t in labels if not t} <= ids and len(ids & {i for i, _, t in labels if t}) <= 3


def test_edges(spark, none, no_id, docs, rows):
    labels = spark.createDataFrame([(i, 0, 0) for i, _ in rows[:30]], "doc_id long, low_quality int, toxic int")
    assert toxicity.judged(docs, labels, ["low_quality", "toxic"]).where("rejected").count() == 0
    nothing = labels.limit(0)
    assert toxicity.judged(docs, nothing, ["low_quality", "toxic"]).where("rejected").count() == 0
    assert toxicity.acceptable(docs, nothing, ["low_quality", "toxic"]).count() == len(rows)
    assert toxicity.judged(none, labels, ["low_quality", "toxic"]).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (3, None, 1), (3, 1, 1), (3, 0, 1)], "doc_id long, low_quality int, toxic int")
    assert toxicity.judged(no_id, odd, ["low_quality", "toxic"]).count() == 3


def _plain_linear(x, y):
    """Logistic regression of all columns as one dense table, by the same steps."""
    w, b = np.zeros(x.shape[1]), math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    first, second = np.zeros(x.shape[1] + 1), np.full(x.shape[1] + 1, 1e-12)
    for t in range(1, toxicity.ROUNDS + 1):
        gap = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        grad = np.append(x.T @ gap + toxicity.RIDGE * w, gap.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        step = 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
        w, b = w - step[:-1], b - step[-1]
    return lambda z: 1 / (1 + np.exp(-(z @ w + b)))


def test_against_a_plain_chain():
    """The same features, folds and labels in dense tables: equal probabilities of new texts, equal threshold."""
    rng = np.random.default_rng(7)
    x = (rng.random((300, 40)) < 0.2).astype(float)
    labels = np.column_stack([x[:, 0] + x[:, 1] > 0, x[:, 2] + x[:, 0] * x[:, 3] > 0]).astype(int)
    labels ^= rng.random(labels.shape) < 0.05
    folds = rng.integers(0, toxicity.FOLDS, len(x))
    new = (rng.random((50, 40)) < 0.2).astype(float)
    rows = lambda m: [np.flatnonzero(r).tolist() for r in m]
    chain = toxicity.fit_chain(["a", "b"], np.arange(40), rows(x), labels, folds)
    got = chain.probabilities(rows(new))
    unseen, known = np.zeros((len(x), 0)), np.zeros((len(new), 0))
    for c in range(2):
        y, p = labels[:, c].astype(float), np.zeros(len(x))
        for f in range(toxicity.FOLDS):
            out = folds == f
            p[out] = _plain_linear(np.column_stack([x, unseen])[~out], y[~out])(np.column_stack([x, unseen])[out])
        known = np.column_stack([known, _plain_linear(np.column_stack([x, unseen]), y)(np.column_stack([new, known]))])
        unseen = np.column_stack([unseen, p])
    assert np.abs(got - known).max() < 1e-6
    best = [t for t in sorted(set(unseen[:, 1])) if labels[unseen[:, 1] >= t, 1].mean() >= toxicity.PRECISION]
    assert not best or (unseen[:, 1] >= chain.threshold).sum() == (unseen[:, 1] >= best[0]).sum()


def test_training_rows_stay_arrays():
    """In the order of plain lists, empty and repeated ones too, and in a small part of their memory."""
    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(2048, rng.integers(0, 300), replace=False).tolist()) for _ in range(3000)]
    rows += [*rows[:50], [], [1], [1, 256], [1, 2], [256]]
    fold, y = (rng.integers(0, n, len(rows)).tolist() for n in (5, 2))
    whole = pa.table({"at": pa.array(rows, pa.list_(pa.int32())), "fold": fold, "y0": y})
    got = pa.concat_tables([whole.slice(0, 700), whole.slice(700, 0), whole.slice(700)])
    want = sorted(zip(rows, fold, y, strict=True))
    tracemalloc.start()
    at, labels, folds = toxicity._in_order(got)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(a.tolist(), f, v) for a, f, (v,) in zip(at, folds.tolist(), labels.tolist(), strict=True)] == want
    assert peak < 5_000_000  # as lists 20 MB
