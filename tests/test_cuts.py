"""Resetting cuts against a plain loop."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.operators import cuts


def plain(rows, limits, span):
    """``(first, cut)`` of rows ``(order, weights, time)`` in order."""
    out, first, began, held = [], None, None, None
    for order, weights, time in rows:
        if first is None:
            first, began, held = order, time, [0] * len(limits)
        held = [h + (w or 0) for h, w in zip(held, weights, strict=True)]
        cut = any(h >= limit for h, limit in zip(held, limits, strict=True)) or (span is not None and time - began >= span)
        out.append((order, first, cut))
        if cut:
            first = None
    return out


@pytest.mark.parametrize("clock", [False, True])
def test_runs_of_all_lengths(spark, monkeypatch, clock):
    rng = random.Random(3)
    rows = []
    for run in range(25):
        time = 0
        for k in range(rng.choice([1, 2, 7, 40, 300])):
            time += rng.choice([0, 1, 1, 5, 60])
            rows.append((None if run == 3 else run, k * 3 + run, rng.choice([0, 1, 1, 2, 9]), rng.choice([None, 0, 5, 30, 120]), time))
    df = spark.createDataFrame(rows, "run long, o long, n long, bytes long, t long").repartition(5)
    for limits in ((5, 100), (1, 10**9), (10**9, 10**9), (40, 2000)):
        got = cuts.resetting_cuts(df, ["run"], "o", {"n": limits[0], "bytes": limits[1]}, *(("t", 70) if clock else ()))
        want = []
        for run in {r[0] for r in rows}:
            own = sorted((o, (n, b), t) for x, o, n, b, t in rows if x == run)
            want += [(run, *x) for x in plain(own, limits, 70 if clock else None)]
        assert sorted(((r["run"], r["o"], r["first"], r["cut"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert cuts.resetting_cuts(df.where("n > 100"), ["run"], "o", {"n": 5}).count() == 0


def test_a_million_rows_of_one_transaction(spark):
    df = spark.range(1_000_000).select(F.lit(7).alias("tx"), "id", F.lit(1).alias("n"), (F.col("id") * F.col("id") % 997).alias("bytes"))
    got = cuts.resetting_cuts(df, ["tx"], "id", {"n": 2048, "bytes": 1_000_000}).where("cut").select("id", "first").orderBy("id").collect()
    ids = np.arange(1_000_000)
    want, begin, n, held = [], 0, 0, 0
    for k, b in zip(ids.tolist(), (ids * ids % 997).tolist(), strict=True):
        n, held = n + 1, held + b
        if n >= 2048 or held >= 1_000_000:
            want.append((k, begin))
            begin, n, held = k + 1, 0, 0
    assert [tuple(r) for r in got] == want


def test_short_runs_are_walked_and_long_ones_cut_by_stretches(spark, monkeypatch):
    monkeypatch.setattr(cuts, "SHORT", 30)
    taken = []
    for name in ("_walked", "_by_stretches"):
        monkeypatch.setattr(cuts, name, lambda rows, *a, name=name, real=getattr(cuts, name): taken.append((name, rows.select("run").distinct().count())) or real(rows, *a))
    rng = random.Random(4)
    rows = [(None if run == 3 else run, k, rng.choice([0, 1, 2]), rng.choice([None, 0, 30])) for run, n in enumerate([1, 2, 30, 31, 200]) for k in range(n)]
    df = spark.createDataFrame(rows, "run long, o long, n long, bytes long").repartition(3)
    want = [(run, *x) for run in {r[0] for r in rows} for x in plain([(o, (n, b), 0) for r, o, n, b in rows if r == run], (4, 90), None)]
    got = cuts.resetting_cuts(df, ["run"], "o", {"n": 4, "bytes": 90})
    assert sorted(((r["run"], r["o"], r["first"], r["cut"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(taken) == [("_by_stretches", 2), ("_walked", 3)]
