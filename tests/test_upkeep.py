"""State by base and changes against a plain fold of the whole log, after each of 50 batches and as of positions."""

from __future__ import annotations

import random

from pyspark.sql import types as T

from tidelog.functions.codes import DELETE, INSERT, UPDATE
from tidelog.streaming.upkeep import Upkeep

SCHEMA = T.StructType().add("id", "long").add("pos", "long").add("op_code", T.IntegerType()).add("unavailable", T.ArrayType(T.StringType())).add("a", "string").add("b", "long")


def plain(changes, upto=10**9):
    state = {}
    for key, pos, op, unavailable, a, b in changes:
        if pos > upto:
            break
        if op == DELETE:
            state.pop(key, None)
            continue
        old = state.get(key, (None, ["a", "b"], None, None))
        lost = unavailable or []
        unknown = [c for c in ("a", "b") if c in lost and c in old[1]]
        state[key] = (pos, unknown, old[2] if "a" in lost else a, old[3] if "b" in lost else b)
    return {(k, *v[:1], tuple(v[1]), *v[2:]) for k, v in state.items()}


def told(df):
    return {(r["id"], r["pos"], tuple(r["unavailable"]), r["a"], r["b"]) for r in df.collect()}


def test_state_after_each_batch_and_as_of_positions(spark, tmp_path):
    rng = random.Random(2)
    table = Upkeep(spark, str(tmp_path / "t"), SCHEMA, ["id"], "pos", buckets=2, keep=6)
    log, pos = [], 0
    for number in range(50):
        batch = []
        for _ in range(rng.choice([0, 1, 5, 9])):
            pos += rng.randint(1, 3)
            batch.append((rng.randrange(12), pos, rng.choice([INSERT, UPDATE, UPDATE, DELETE]), rng.choice([None, [], ["a"], ["b"], ["a", "b"]]), f"a{pos}", rng.choice([None, pos])))
        log += batch
        df = spark.createDataFrame(batch, SCHEMA)
        table.apply(df, number)
        if number % 9 == 4:
            table.apply(df, number)  # run again
        assert told(table.read()) == plain(log), number
    for upto in (0, 10, pos // 3, pos // 2, pos - 4, pos):
        assert told(table.read(upto)) == plain(log, upto), upto
    assert len(table._bases()) >= 7 and len(table._deltas(table._bases()[-1][0])) <= 6
