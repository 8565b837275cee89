from __future__ import annotations

import numpy as np
import pytest

from tidelog.llm import vectors
from tidelog.llm.queries import ORACLE_SQL, QUERIES  # noqa: F401

from .test_simhash import plain_components


def _given():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [b + rng.normal(size=16) * s for b in base for s in (0.0, 0.03, 0.06, 0.09)]
    rows += [base[0], base[0], 2 * base[1], base[2].astype(np.float32)]
    rows = [r.astype(np.float32).tolist() for r in rows]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf"), *[1.0] * 15], [None, *[1.0] * 15], [], [1.0, 2.0], [1.0, 2.0]]
    return [(k, x, "clash") for k, x in enumerate([*rows, *odd])]


@pytest.mark.parametrize(("limit", "aim"), [(2048, 4096), (5, 4096), (5, 1)])
def test_links_against_brute_force(spark, monkeypatch, limit, aim):
    monkeypatch.setattr(vectors, "LIST_ROWS", limit)
    monkeypatch.setattr(vectors, "LIST_AIM", aim)  # 1: lists are divided into cells
    given = _given()
    usable = {k: np.array(x, float) for k, x, _ in given if x and None not in x and np.isfinite(x).all() and any(x)}

    def linked(a, b):
        if a == b or a not in usable or b not in usable or len(usable[a]) != len(usable[b]):
            return False
        return usable[a] @ usable[b] / np.linalg.norm(usable[a]) / np.linalg.norm(usable[b]) >= 0.95

    ids = [k for k, _, _ in given]
    label = plain_components(ids, linked)
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>, node string")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    assert len(got) == len(ids)
    want = {k: sum(linked(k, m) for m in ids) for k in ids}
    found = sum(got[k]["n_links"] for k in ids)
    assert found >= 0.9 * sum(want.values()) and all(got[k]["n_links"] <= want[k] for k in ids)
    assert found == sum(want.values())  # on this fixture nothing is lost
    assert all(got[k]["component_id"] == label[k] and got[k]["kept"] == (label[k] == k) for k in ids)


def test_cells_divide_lists_and_keep_recall(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4000, 32))
    x = np.concatenate([base, base + 0.12 * rng.normal(size=base.shape)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = np.argwhere(np.triu(unit @ unit.T >= 0.95, 1))
    monkeypatch.setattr(vectors, "LIST_AIM", 2)
    index = vectors.fit(x, len(x), 0.95)
    assert len(index.cells) >= 8
    near = index.nearest(unit, vectors.PROBES + 1)
    assert all(len(set(r)) == vectors.PROBES + 1 for r in near[:100].tolist())
    met = [(near[b] == near[a, 0]).any() or (near[a] == near[b, 0]).any() for a, b in pairs]
    assert len(pairs) > 3000 and np.mean(met) >= 0.9


def test_a_list_of_near_copies_is_dealt_in_slices():
    """500,000 members of one list: a batch of them is dealt to all its blocks without being held whole."""
    node = np.arange(10_000)
    members = np.array([-(-500_000 // vectors.LIST_ROWS)])
    row, _, task, role = vectors._places(node, np.zeros((10_000, 1), np.int64), members, np.array([0]))
    assert len(row) == 31 * 10_000 and (np.bincount(row) == 31).all()
    met = {}
    for r, t, x in zip(row.tolist(), task.tolist(), role.tolist(), strict=True):
        met.setdefault(t, set()).add((r % 31, x))
    assert len(met) == 31 * 32 // 2 and all(len(v) == (1 if (0 in {x for _, x in v}) else 2) for v in met.values())


def test_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    one = vectors.near_duplicates(spark.createDataFrame([(None, [1.0]), (4, None)], "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in one) == [("4", 0, True), ("None", 0, True)]
