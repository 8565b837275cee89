"""Repeats held against all windows of all texts, and suffix arrays against plain ones."""

from __future__ import annotations

import hashlib
import os
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import repeats, shared


def plain(rows, length):
    """Windows in the order of ids and starts; rows of one id are one place."""
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        place = (i is not None, i or 0)
        data = (t or "").encode()
        for at in range(len(data) - length + 1):
            w = data[at : at + length]
            first[w] = min(first.get(w, (place, at)), (place, at))
    out = []
    for i, t in rows:
        place, data = (i is not None, i or 0), (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < (place, at):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((i, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n):
    """Copies, edited copies, shared passages in other surroundings, and periodic texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randint(2, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, base = prose(45), prose(150)
    texts = []
    for k in range(n):
        kind = k % 6
        if kind == 0:
            texts.append(base)
        elif kind == 1:
            at = rng.randrange(len(base))
            texts.append(base[:at] + word() + base[at + rng.randrange(4) :])
        elif kind == 2:
            texts.append(prose(rng.randint(1, 30)) + passage + prose(rng.randint(1, 30)))
        elif kind == 3:
            texts.append(prose(rng.randint(5, 60)))
        elif kind == 4:
            at = rng.randrange(200)
            texts.append(prose(3) + base[at : at + rng.randint(90, 300)] + passage[: rng.randint(50, 150)])
        else:
            texts.append(rng.choice(["a" * rng.randint(90, 400), "ab" * rng.randint(40, 200), "xyz" * 90 + passage, (base[:120] + " ") * 3]))
    ids = list(range(n))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def got(df):
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_all_windows(spark, docs, rows, none, no_id):
    assert got(repeats.digests(docs)) == plain(rows, 100)
    assert repeats.digests(none).count() == 0
    rows = [(None, "a text without an id of some words"), (None, None), (3, None)]
    assert got(repeats.digests(no_id, 24)) == plain(rows, 24)


@pytest.mark.parametrize("small", [False, True])
def test_copies_edits_and_passages(spark, monkeypatch, small):
    if small:  # blocks, salted runs, stretches and batches of a few rows
        for name, value in (("BLOCK", 3), ("FLUSH", 4), ("HEAVY", 40), ("SALTS", 3), ("STRETCH", 150), ("COMBINED", 60), ("SORTED_BYTES", 2000)):
            monkeypatch.setattr(repeats, name, value)
    rows = corpus(5, 240)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50 if small else 10_000)
    found = repeats.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got(found) == plain(rows, 100)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_ids(spark):
    rng = random.Random(3)
    long = "".join(rng.choices("abc", k=300))
    rows = [(1, long), (1, long), (1, "xx" + long), (None, long[50:200]), (2, long + long), (2, "")]
    assert got(repeats.digests(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows, 100)


def test_disk_goes_back_with_each_stage(spark, tmp_path, monkeypatch):
    """Of a run only the spans stay, and no shuffle of a stage that is written."""
    monkeypatch.setattr(shared, "shared_root", lambda spark: f"file://{tmp_path}")
    kept = lambda: {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    rows = corpus(7, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = kept()
    found = repeats.digests(df)
    until = time.monotonic() + 10
    while kept() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not kept() - before
    assert [p.name for p in tmp_path.glob("tidelog/*/*")] == ["spans"]
    assert got(found) == plain(rows, 100) and got(found) == plain(rows, 100)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_runs_in_many_surroundings_take_rounds(spark, monkeypatch):
    """Where most pieces are compared, no shuffle holds all of them."""
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(400)]
    rows = [(k, " ".join(f"v{k}x{j}" if (j + k) % 13 == 0 else w for j, w in enumerate(base))) for k in range(12)] + [(20, " ".join(base[:90]) + " end " + " ".join(base[:60]))]
    sizes = []
    own = repeats.texts_of
    monkeypatch.setattr(repeats, "texts_of", lambda asked, docs, length: sizes.append(asked.agg(F.sum(F.col("n") + length)).first()[0] or 0) or own(asked, docs, length))
    assert got(repeats.digests(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows, 100)
    assert sum(sizes) > sum(len(t) for _, t in rows) and max(sizes) < 0.75 * sum(len(t) for _, t in rows)


def test_spans_are_joined_across_batches(spark):
    rng = random.Random(2)
    spans = [(d, d % 3, a, a + rng.randint(1, 40)) for d in range(30) for a in rng.choices(range(900), k=40)]
    spans += [(-5, 0, 0, 7), (-5, 0, 7, 9), (-5, 0, 2, 3), (-5, 1, 0, 2), (-5, 1, 3, 4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    have = sorted(map(tuple, repeats.joined(spark.createDataFrame(spans, repeats.SPANS)).collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for d, h in sorted({x[:2] for x in spans}):
        covered = sorted({at for x in spans if x[:2] == (d, h) for at in range(*x[2:])})
        starts = [a for a in covered if a - 1 not in covered]
        want += [(d, h, a, next(b for b in range(a, 1000) if b not in covered)) for a in starts]
    assert have == want


def test_groups_hold_all_occurrences(spark):
    rows = corpus(6, 120)
    found = repeats.Repeats(spark.createDataFrame(rows, "doc_id long, text string"), 60, members=True)
    texts = {i: t.encode() for i, t in rows}
    groups = defaultdict(set)
    for r in found.groups().collect():
        groups[r["group"], r["length"]].add((r["doc_id"], r["start"]))
    assert len(groups) > 50
    for (_, length), places in groups.items():
        strings = {texts[i][s : s + length] for i, s in places}
        assert len(strings) == 1 and len(next(iter(strings))) == length >= 60
    inner = [(length, places) for (name, length), places in groups.items() if ":block:" in name]
    assert any(len({texts[i][s - 1 : s] for i, s in places}) > 1 for _, places in inner)


def test_suffix_array_and_intervals():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(8, 60))) for _ in range(12)]
    group = np.array([0] * 6 + [1] * 6)
    found = repeats.Suffixes(texts, group, 6)
    every = sorted((int(group[k]), t[at:], k, at) for k, t in enumerate(texts) for at in range(len(t) - 5))
    assert [(g, t) for g, t, _, _ in every] == [(int(group[found.text[p]]), texts[found.text[p]][p - found.starts[found.text[p]] :]) for p in found.array.tolist()]
    for j in range(1, len(every)):
        same = os.path.commonprefix([every[j - 1][1], every[j][1]]) if every[j - 1][0] == every[j][0] else b""
        assert found.common[j] == len(same)
    want = set()
    for g in (0, 1):
        places = defaultdict(list)
        for k, t in enumerate(texts):
            if group[k] == g:
                for at in range(len(t)):
                    for stop in range(at + 6, len(t) + 1):
                        places[t[at:stop]].append((k, at))
        for s, own in places.items():
            right = {texts[k][at + len(s) : at + len(s) + 1] or (k, at) for k, at in own}
            left = {texts[k][at - 1 : at] if at else (k, at) for k, at in own}
            if len(own) > 1 and len(right) > 1 and (len(left) > 1 or not isinstance(next(iter(left)), bytes)):
                want.add((g, s, len(own)))
    have = set()
    for first, last, depth in found.intervals(6):
        p = int(found.array[first])
        own = texts[found.text[p]][p - found.starts[found.text[p]] :][:depth]
        have.add((int(group[found.text[p]]), own, last - first + 1))
    assert have == want
