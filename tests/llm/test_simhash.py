from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import shared, simhash
from tidelog.llm.shared import Workspace, components

from .conftest import frame


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    label = {n: n for n in nodes}
    while True:
        new = {n: min([label[n], *(label[m] for m in nodes if linked(n, m))]) for n in nodes}
        if new == label:
            return label
        label = new


def test_fingerprints_and_components(docs, rows):
    fps = {}
    for i, t in rows:
        fps.setdefault(plain_fingerprint(t), []).append(i)
    label = plain_components(list(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for fp, ids in fps.items():
        least[label[fp]] = min([least.get(label[fp], 10**9), *ids])
    want = sorted((i, format(plain_fingerprint(t), "016x"), least[label[plain_fingerprint(t)]]) for i, t in rows)
    got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex("fp").alias("fp"), "component_id")
    assert sorted(map(tuple, got.collect())) == want


def test_one_of_each(docs, rows):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) == simhash.near_duplicates(docs).select("component_id").distinct().count()


def plain_wide(text, words=5, lanes=4):
    """The wide fingerprint of a text and its number of shingles."""
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[k : k + words]) for k in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    whole = (1 << 64) - 1
    out = 0
    for q in range(lanes):
        counts = [0] * 64
        for shingle in shingles:
            z = xxhash.xxh64_intdigest(shingle.encode(), 42)
            if q:
                z = z * simhash._ODD[q - 1] & whole
                z ^= z >> 31
                z = z * simhash._ODD[0] & whole
                z ^= z >> 29
            for b in range(64):
                counts[b] += z >> b & 1
        out |= sum(1 << (64 * q + b) for b in range(64) if 2 * counts[b] > len(shingles))
    return (out, len(shingles)), frozenset(shingles)


def plain_groups(texts):
    """For each text the number of its group, by all pairs of wide fingerprints and by the Jaccard of their shingles."""
    prints = [plain_wide(t) for t in texts]
    shingles = dict(prints)

    def link(a, b):
        both = len(shingles[a] | shingles[b])
        return (a[0] ^ b[0]).bit_count() <= 56 and (len(shingles[a] & shingles[b]) >= 0.8 * both if both else True)

    label = plain_components(list(shingles), link)
    return [label[p] for p, _ in prints]


def test_wide_setting_against_all_pairs(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    texts = [None, "", "one", "one two three four five six", "six five four three two one"]
    for _ in range(30):
        words = [name() for _ in range(rng.randint(150, 400))]
        texts.append(" ".join(words))
        for changes in (1, 2, 4):
            edited = list(words)
            for at in rng.sample(range(len(words)), changes):
                edited[at] = name()
            texts.append(" ".join(edited))
    rng.shuffle(texts)
    want = plain_groups(texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, enumerate(texts)), simhash.COPIES).collect()}
    least = {}
    for k, group in enumerate(want):
        least.setdefault(group, k)
    assert got == {k: least[group] for k, group in enumerate(want)} and 30 <= len(least) <= 40


def test_close_texts_of_less_likeness_stay_apart(spark, monkeypatch):
    """A large component of close fingerprints: only pairs whose shingles are alike join, also over blocks."""
    monkeypatch.setattr(simhash, "TEXTS", 7)
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [word() for _ in range(300)]
    texts = []
    for k in range(40):
        edited = list(base)
        for at in rng.sample(range(300), 1 + k % 9):
            edited[at] = word()
        texts.append(" ".join(edited))
    want = plain_groups(texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, [*enumerate(texts), (0, texts[0])]), simhash.COPIES).collect()}
    least = {}
    for k, group in enumerate(want):
        least.setdefault(group, k)
    assert got == {k: least[group] for k, group in enumerate(want)} and 5 <= len(least) <= 39


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(9)
    text = " ".join("".join(rng.choices("aBcé", k=rng.randint(1, 9))) for _ in range(3000)) + "\t \n"
    whole, n = simhash.text_fingerprints([text, "x " * 50, " " * 500, "y" * 500], 4)
    for piece, chunk in ((64, 1 << 17), (100, 70), (1, 1)):
        monkeypatch.setattr(simhash, "PIECE", piece)
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        fps, sizes = simhash.text_fingerprints([text, "x " * 50, " " * 500, "y" * 500], 4)
        assert (fps == whole).all() and (sizes == n).all()
    assert int(whole[0, 0]) == plain_fingerprint(text) and n.tolist() == [2997, 47, 0, 1]


def test_ties_of_other_columns(spark):
    same = [(1, "a text of some words", "b"), (1, "a text of some words", "a"), (None, None, "c"), (None, None, "b")]
    df = spark.createDataFrame(same, "doc_id long, text string, other string")
    got = simhash.one_of_each(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a text of some words", "a"), (None, None, "b")], key=str)


def test_hub_of_links(spark):
    edges = [(0, k) for k in range(1, 2000)] + [(k, k + 5000) for k in range(1, 50)] + [(9000, 9001)]
    got = components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark)).collect()
    assert len(got) == 2051 and all(r["component"] == (0 if r["node"] < 9000 else 9000) for r in got)


def test_components_take_few_plans(spark):
    edges = [(k, k + 1) for k in range(3000)] + [(9000, k) for k in range(9001, 9500)]
    context = spark.sparkContext
    context.setJobGroup("few plans", "components")
    got = components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark)).collect()
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 3501 and {r["component"] for r in got} == {0, 9000}
    assert len(context.statusTracker().getJobIdsForGroup("few plans")) <= 8  # of rounds over the whole graph it were dozens


@pytest.mark.parametrize("most", [1, 7, 400])
def test_components_by_blocks(spark, monkeypatch, most):
    rng = random.Random(most)
    names = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(160)]
    edges = [(names[k], names[k + 1]) for k in range(39)] + [(names[40], n) for n in names[41:110]] + [(rng.choice(names[110:]), rng.choice(names[110:])) for _ in range(30)]
    edges += [(v, u) for u, v in edges[:20]] + [(names[150], names[150])] + [(names[0], None)]
    rng.shuffle(edges)
    linked = {frozenset(e) for e in edges}
    nodes = sorted({n for u, v in edges if v is not None and u != v for n in (u, v)})
    label = plain_components(nodes, lambda a, b: frozenset((a, b)) in linked)
    want = {n: min(m for m in nodes if label[m] == label[n]) for n in nodes}
    monkeypatch.setattr(shared, "BLOCK_LINKS", most)
    got = components(spark.createDataFrame(edges, "u long, v long").repartition(3), Workspace(spark)).collect()
    assert len(got) == len(want) and {r["node"]: r["component"] for r in got} == want


def test_empty_and_no_ids(none, no_id):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
    got = simhash.near_duplicates(no_id).collect()
    assert sorted(str(r["component_id"]) for r in got) == ["3", "3", "None"]
    assert simhash.one_of_each(no_id).count() == 2


def test_long_lists_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(120)}
    fps |= {rng.getrandbits(64) for _ in range(60)}
    label = plain_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    want = len(set(label.values()))
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    for limit, settle in ((4096, 64), (4096, 3), (7, 2)):
        monkeypatch.setattr(simhash, "LIST_ROWS", limit)
        monkeypatch.setattr(simhash, "SETTLE", settle)
        ws = Workspace(spark)
        found = components(simhash.links(df, ws), ws)
        got = found.groupBy("component").count().agg(F.count("*"), F.sum("count")).first()
        assert len(fps) - (got[1] or 0) + got[0] == want


def test_triples_meet_all_fours():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_no_machine_local_folder_on_a_cluster():
    from tidelog.llm.shared import shared_root

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        shared_root(Session())
