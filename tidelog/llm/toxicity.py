"""Toxicity by a classifier chain of linear models.

The categories of the label table are predicted in order; each later model sees the earlier categories'
probabilities beside the text's features. In training those are out-of-fold predictions, so a later model
meets an earlier one as unsure as it is on new text; in use they come from models of all training rows.

Features are a text's words and the beginnings of its words (4 to 6 letters, which catch inflected forms),
hashed to ``BUCKETS``; at most ``FEATURES`` are kept, those whose presence tells most about a category, by
``TELLS`` standard deviations at least. Training reads a bounded sample: the ``SAMPLE`` labelled rows with the
least hashes of their ids, and of those that share the least hash of three words (copies, mostly) one, lest the words of
a much copied text tell. Everything else, the documents that are scored and their whole texts, has no bound. The rejection threshold, of the last
category, is the least one whose out-of-fold precision reaches ``PRECISION``.

Defined results: a null or empty text has no features and gets the models' base rate; a document without a
label is scored like any other; a category with one class in the sample gets that class's rate for all;
without any labels nothing is rejected (probability 0); repeated rows and null ids each get their row;
labels with null ids or categories, and repeated labels of an id beyond the first by value, take no part; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Workspace

SAMPLE = 20_000
BUCKETS = 1 << 21
FEATURES = 2048
FOLDS = 5
PRECISION = 0.99
TELLS = 4.0
ROUNDS = 100
RIDGE = 1e-4
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
REMEMBERED = 400_000


def word_features(word: str) -> list[int]:
    parts = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh64_intdigest(p.encode(), 0) % BUCKETS for p in parts]


def words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


class _Known(dict):
    """The kept features of a word, as positions among the kept."""

    def __init__(self, kept: np.ndarray):
        super().__init__()
        self.place = {int(f): k for k, f in enumerate(kept)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = tuple(k for f in word_features(word) if (k := self.place.get(f)) is not None)
        return found


def places(known: _Known, text: str | None) -> list[int]:
    return sorted({k for w in words(text) for k in known[w]})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train_linear(row: np.ndarray, col: np.ndarray, y: np.ndarray, n_features: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by accelerated gradient steps over presence pairs (row, col) and dense columns."""
    w, v, b = np.zeros(n_features), np.zeros(dense.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    n = len(y)
    mom = [np.zeros_like(w), np.zeros_like(v), 0.0]
    sq = [np.full_like(w, 1e-12), np.full_like(v, 1e-12), 1e-12]
    for t in range(1, ROUNDS + 1):
        p = _sigmoid(np.bincount(row, w[col], minlength=n) + dense @ v + b)
        gap = (p - y) / n
        grads = [np.bincount(col, gap[row], minlength=n_features) + RIDGE * w, dense.T @ gap + RIDGE * v, float(gap.sum())]
        for k, g in enumerate(grads):
            mom[k] = 0.9 * mom[k] + 0.1 * g
            sq[k] = 0.99 * sq[k] + 0.01 * g * g
        step = [0.2 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-6) for m, s in zip(mom, sq, strict=True)]
        w, v, b = w - step[0], v - step[1], b - step[2]
    return w, v, b


@dataclass
class Chain:
    """Linear models in order: weights of kept features, weights of earlier probabilities, intercept; the last one's threshold."""

    names: list[str]
    kept: np.ndarray
    models: list[tuple[np.ndarray, np.ndarray, float]]
    threshold: float

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(rows), len(self.models)))
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        col = np.array([k for r in rows for k in r], np.int64)
        for c, (w, v, b) in enumerate(self.models):
            out[:, c] = _sigmoid(np.bincount(row, w[col], minlength=len(rows)) + out[:, :c] @ v + b)
        return out


def fit_chain(names: list[str], kept: np.ndarray, rows: list[list[int]] | list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> Chain:
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    unseen = np.zeros((n, 0))
    models = []
    for c in range(len(names)):
        y, p = labels[:, c].astype(float), np.zeros(n)
        for f in range(FOLDS):
            out = folds == f
            own = ~out[row]
            renumber = np.cumsum(~out) - 1
            if out.any() and (~out).any():
                w, v, b = train_linear(renumber[row[own]], col[own], y[~out], len(kept), unseen[~out])
                p[out] = _sigmoid(np.bincount(row, w[col], minlength=n) + unseen @ v + b)[out]
        models.append(train_linear(row, col, y, len(kept), unseen))
        unseen = np.column_stack([unseen, p])
    return Chain(names, kept, models, _threshold(unseen[:, -1], labels[:, -1].astype(float)))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(-p, kind="stable")
    precise = np.flatnonzero(np.cumsum(y[order]) / np.arange(1, len(y) + 1) >= PRECISION)
    last = precise[-1] if len(precise) else -1
    if last < 0:
        return 0.99
    below = p[order[last + 1]] if last + 1 < len(p) else 0.0
    return float(max(0.05, (p[order[last]] + below) / 2))


def _key(text: str | None) -> int:
    """The least hash of three words in a row; copies share it, most near copies too, other texts hardly."""
    found = WORD.findall(text.lower()) if text else []
    runs = (" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2)))
    return min(xxhash.xxh64_intdigest(r.encode(), 1) >> 1 for r in runs)


def _with_key(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        keys = [_key(x.as_py()) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*batch.schema.names, "key"])


def train(docs: DataFrame, labels: DataFrame, names: list[str], ws: Workspace) -> Chain | None:
    """Fit the chain on the labelled rows of ``docs(doc_id, text)``; ``labels(doc_id, *names)`` hold 0 and 1."""
    usable = labels.select("doc_id", *[F.col(c).cast("int") for c in names]).dropna().groupBy("doc_id").agg(F.min(F.struct(*names)).alias("y"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    text = docs.select("doc_id", "text").join(F.broadcast(ws.save(sample, "labels")), "doc_id")  # SAMPLE rows of numbers
    text = text.mapInArrow(_with_key, T.StructType([*text.schema.fields, T.StructField("key", T.LongType())]))
    text = text.groupBy("key").agg(F.min(F.struct("doc_id", "text", "y")).alias("x")).select("x.*")
    text = ws.save(text.select("text", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int").alias("fold"), *[F.col(f"y.{c}").alias(f"y{k}") for k, c in enumerate(names)]), "sample")
    totals = text.agg(F.count("*"), *[F.sum(f"y{k}") for k in range(len(names))]).first()
    if not totals[0]:
        return None

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(names) + 1, BUCKETS), np.int32)
        for batch in found:
            ys = np.array([batch.column(2 + k).to_pylist() for k in range(len(names))]).T
            for x, y in zip(batch.column(0), ys, strict=True):
                at = np.unique([f for w in words(x.as_py()) for f in word_features(w)]).astype(np.int64)
                seen[0, at] += 1
                for k in np.flatnonzero(y):
                    seen[k + 1, at] += 1
        some = np.flatnonzero(seen[0])
        for cut in range(0, len(some), 50_000):
            part = some[cut : cut + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(s[part].astype(np.int64)) for s in seen)], names=["f", "n", *(f"n{k}" for k in range(len(names)))])

    sums = text.mapInArrow(count, ", ".join(["f long", "n long", *(f"n{k} long" for k in range(len(names)))]))
    sums = sums.groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n", *(f"n{k}" for k in range(len(names))))]).where(F.col("n") >= 3)
    rows = F.lit(float(totals[0]))
    tell = F.lit(0.0)
    for k in range(len(names)):
        rate = (totals[k + 1] or 0) / totals[0]
        spread = F.sqrt(F.col("n") * rate * (1 - rate) * (1 - F.col("n") / (rows + 1))) + 0.5
        tell = F.greatest(tell, F.abs(F.col(f"n{k}") - F.col("n") * rate) / spread)
    kept = np.array(sorted(r["f"] for r in sums.where(tell >= TELLS).orderBy(tell.desc(), "f").limit(FEATURES).select("f").collect()), np.int64)

    def reduce(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(kept)
        for batch in found:
            at = pa.array([places(known, x.as_py()) for x in batch.column(0)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([at, *batch.columns[1:]], names=["at", *batch.schema.names[1:]])

    shape = T.StructType([T.StructField("at", T.ArrayType(T.IntegerType())), *text.schema.fields[1:]])
    got = text.mapInArrow(reduce, shape).toArrow()  # SAMPLE rows, FEATURES small numbers each at most
    return fit_chain(names, kept, *_in_order(got))


def _in_order(got: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of places, labels and folds of ``got(at, ..., fold, y...)``, ascending, so that sums have one order.

    Places stay arrays of numbers: as lists of objects those of SAMPLE rows take some 200 MB of the driver.
    """
    at = [x for part in got.column("at").chunks for x in np.split(part.flatten().to_numpy(), np.cumsum(pc.list_value_length(part).to_numpy())[:-1]) if len(part)]
    rest = np.column_stack([got.column(c).to_numpy() for c in got.column_names if c != "at"])
    order = sorted(range(len(at)), key=lambda k: (at[k].astype(">u4").tobytes(), *rest[k].tolist()))  # of bytes: as the numbers ascend
    return [at[k] for k in order], rest[order, 1:], rest[order, 0]


def score(docs: DataFrame, chain: Chain | None, names: list[str]) -> DataFrame:
    """``docs``'s ``doc_id`` and ``text`` with ``p_<category>`` and, of the last category, ``rejected``."""
    kinds = T.StructType([docs.schema["doc_id"], docs.schema["text"], *(T.StructField(f"p_{c}", T.DoubleType()) for c in names), T.StructField("rejected", T.BooleanType())])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(chain.kept) if chain else None
        for batch in found:
            p = chain.probabilities([places(known, x.as_py()) for x in batch.column(1)]) if chain else np.zeros((batch.num_rows, len(names)))
            gone = p[:, -1] >= chain.threshold if chain else np.zeros(batch.num_rows, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(p[:, k]) for k in range(len(names))), pa.array(gone)], names=kinds.names)

    return docs.select("doc_id", "text").mapInArrow(batches, kinds)


def judged(docs: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """``(doc_id, p_<category>..., rejected)`` of each row of ``docs``."""
    chain = train(docs, labels, names, Workspace(docs.sparkSession))
    return score(docs, chain, names).drop("text")


def acceptable(docs: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """The rows of ``docs`` that the chain does not reject; all columns stay."""
    chain = train(docs, labels, names, Workspace(docs.sparkSession))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(chain.kept)
        for batch in found:
            p = chain.probabilities([places(known, x.as_py()) for x in batch.column("text")])
            yield batch.filter(pa.array(p[:, -1] < chain.threshold))

    return docs.mapInArrow(batches, docs.schema) if chain else docs
