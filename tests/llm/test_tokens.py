from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidelog.llm import bpe, packing, token_counts, token_files, tokens
from tidelog.llm.shared import Workspace

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids(rows):
    library = Tokenizer.from_file(BYTES)
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t in rows]


def test_counts(docs, none, no_id, rows, ids):
    got = sorted(map(tuple, token_counts.token_counts(docs, BYTES, 100).collect()))
    assert got == sorted((i, len((t or "").encode()), len(x) - 1, len(x) - 1 > 100) for (i, t), x in zip(rows, ids, strict=True))
    assert token_counts.token_counts(none, BYTES, 1).count() == 0
    assert token_counts.token_counts(no_id, BYTES, 1).count() == 3


def test_files_round_trip(spark, docs, none, rows, ids):
    ws = Workspace(spark)
    manifest = ws.save(token_files.write(docs, ws.path("ids"), BYTES, shards=5), "manifest")
    got = token_files.read_digests(manifest, ws.path("ids")).orderBy("start").collect()
    order = [r["doc_id"] for r in got]
    assert order == sorted(i for i, _ in rows)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, ids, strict=True))
    shard = manifest.first()
    stored = token_files.Shard(ws.path("ids"), shard["shard"], shard["dtype"])
    assert stored.offsets.dtype == np.dtype("<i8") and stored.dtype == np.dtype("<u2")
    empty = ws.save(token_files.write(none, ws.path("none"), BYTES), "none_manifest")
    assert token_files.read_digests(empty, ws.path("none")).count() == 0


def test_files_keep_documents_without_an_id(spark, no_id):
    ws = Workspace(spark)
    manifest = ws.save(token_files.write(no_id, ws.path("x"), BYTES, shards=2), "manifest")
    got = token_files.read_digests(manifest, ws.path("x")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 3] and [r["n_tokens"] for r in got].count(1) == 2


def test_packing(docs, none, rows, ids):
    got = packing.pack(docs, BYTES, capacity=128).toPandas()
    by_id = {}
    for (i, _), x in zip(rows, ids, strict=True):
        by_id.setdefault(i, []).append(x)
    for i, pieces in got.groupby("doc_id"):
        copies = len(by_id[i])
        want = np.concatenate(by_id[i][:1])
        assert (pieces.doc_tokens == len(want)).all() and pieces.length.sum() == copies * len(want)
        for p in pieces.itertuples():
            assert zlib.crc32(want[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        starts = pieces.drop_duplicates("start").sort_values("start")
        assert (starts.start.values == np.r_[0, np.cumsum(starts.length.values)[:-1]]).all()
    for _, window in got.sort_values("offset").groupby("sequence_id"):
        assert (window.offset.values == np.r_[0, np.cumsum(window.length.values)[:-1]]).all()
        assert window.length.sum() <= 128
    assert packing.pack(none, BYTES).count() == 0


@pytest.mark.parametrize("size", [1, 200, 4 << 20])
def test_columns_of_texts(rows, ids, monkeypatch, size):
    """Ids by column are those of the library, wherever a column is divided and whatever meets at its texts' ends."""
    monkeypatch.setattr(tokens, "COLUMN_BYTES", size)
    rng, library = random.Random(5), Tokenizer.from_file(BYTES)
    parts = ["'", "'s", "'re", "'l", "ve", "s", " ", "  ", "\n", "\u00a0", "\u3000", "a", "1", "\u00e9", "\u00bd", "!", "\x1c", "\U0001f642", "\u0301", "<|endo", "ftext|>", "<|endoftext|>"]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(3000)]
    want = [*ids, *(np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in odd)]
    column = pa.array(["left out", *(t for _, t in rows), *odd], pa.string()).slice(1)
    coder = tokens.byte_coder(BYTES)
    assert coder.cutter.columns_proven
    assert [coder.wide(x) for x in coder.rows(column, 0)] == [x.tobytes() for x in want]
    assert list(coder.rows(column.slice(0, 0), 0)) == [] and list(coder.rows(pa.array([None, ""], pa.string()))) == [b"", b""]


def test_pieces_of_one_length_are_dealt_at_once(monkeypatch):
    met, pop = [], packing.heapq.heappop
    monkeypatch.setattr(packing.heapq, "heappop", lambda heap: met.append(1) or pop(heap))
    lengths = [128] * 700 + list(range(1, 101))
    where = packing.windows(lengths, 1024)
    sums = np.bincount(where, weights=lengths)
    assert sums.max() <= 1024 and sums.max() - sums.min() <= 40 and len(sums) == -(-sum(lengths) // 1024)
    assert len(met) == 200  # a meeting for each of the other pieces


def test_many_empty_documents(spark):
    many = spark.range(40_000).selectExpr("id as doc_id", "cast(null as string) as text").coalesce(1)
    got = packing.pack(many, BYTES)
    assert got.count() == 40_000 and got.select("sequence_id").distinct().count() <= 42


def test_windows_are_near_equal_and_the_count_rises():
    rng = random.Random(2)
    lengths = [rng.randint(1, 128) for _ in range(900)]
    where = packing.windows(lengths, 1024)
    sums = np.bincount(where, weights=lengths)
    assert sums.max() <= 1024 and len(sums) <= -(-sum(lengths) // 1024) + 2
    assert sums.max() - sums.min() <= 40
    assert packing.windows([600, 600, 600], 1024).tolist() != [0, 0, 0] and packing.windows([600, 600, 600], 1024).max() == 2
    assert packing.windows([], 8).tolist() == [] and packing.windows([5], 8).tolist() == [0]


def test_word_round_trip(docs, none, no_id, rows):
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, t in rows:
        found = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(found, skip_special_tokens=False)
        want.append((i, len(found), hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(docs, WORDS).collect())) == sorted(want)
    assert bpe.round_trip(none, WORDS).count() == 0 and bpe.round_trip(no_id, WORDS).count() == 3


def test_tree_equals_one_pass():
    coder, rng = bpe.word_coder(WORDS), random.Random(4)
    for n in [*(rng.randint(65, 700) for _ in range(150)), bpe.THREADED, 40_000]:
        symbols = "".join(rng.choices("theinsraoé"[: rng.randint(2, 9)], k=n))
        assert coder.tree(symbols) == coder._merge(symbols, True)
