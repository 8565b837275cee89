"""Ranked search held against scores of every document for every item."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from tidelog.llm import bitfunnel

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, items, top):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in TERM.findall((text or "").translate(LOWER)) if c[t])
            if score:
                found.append((-score, i is not None, i or 0))
        out += [(item, k, i if some else None, -score) for k, (score, some, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def items_of(rows):
    texts = [t for _, t in rows if t and len(t) < 3000]
    return [(k, t) for k, t in enumerate(texts[::6])] + [(900, None), (901, "  "), (902, "zzznowhere"), (903, texts[7].upper()), (903, texts[7].upper()), (None, texts[9])]


@pytest.fixture(params=[1024, 5])
def block_docs(request, monkeypatch):
    monkeypatch.setattr(bitfunnel, "BLOCK_DOCS", request.param)
    return request.param


def test_against_all_scores(spark, docs, rows, block_docs):
    items = items_of(rows)
    got = bitfunnel.ranked(docs, spark.createDataFrame(items, "item_id long, text string"), 7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, items, 7)


def test_groups_of_items_and_odd_tables(spark, docs, rows, none, no_id, monkeypatch):
    monkeypatch.setattr(bitfunnel, "ITEMS", 3)
    items = items_of(rows)[:8]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, bitfunnel.ranked(docs, asked, 3).collect()), key=repr) == plain(rows, items, 3)
    assert bitfunnel.ranked(none, asked).count() == 0 and bitfunnel.ranked(docs, asked.where("item_id < 0")).count() == 0
    odd = [(None, "a text without an id of some words"), (None, None), (3, None), (5, "a text without an id of some words"), (5, "a text without an id of some words")]
    got = bitfunnel.ranked(spark.createDataFrame(odd, "doc_id long, text string"), spark.createDataFrame([(1, "text of words")], "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(odd, [(1, "text of words")], 20)
    assert bitfunnel.ranked(no_id, asked).count() >= 0


def test_bounds_are_not_below_scores(rows):
    """Bounds of whole blocks; where no count is above one and no bit is shared by chance they are the scores."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = [bitfunnel.counted(t) for _, t in texts]
    counts = [c for c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    items = [(k, c) for k, c in enumerate(counts[:40])]
    queries = bitfunnel.Queries(items, df, n_docs, n_terms, 20)
    blocks = bitfunnel._Blocks()
    made = [b for i, t in texts for b in blocks.add(i, t)] + [blocks.out(bits) for bits in list(blocks.held)]
    near = pairs = 0
    for b in made:
        bits, docs, lengths, slices, found = (b.column(k)[0].as_py() for k in range(5))
        lengths = np.array(lengths)
        bounds = queries.bounds(bits, np.frombuffer(slices, np.uint8).reshape(bits, -1), lengths)
        spread = queries.spread(lengths)
        for k, text in enumerate(found):
            own = bitfunnel.counted(text)
            for item in range(len(items)):
                score = queries.exact(item, own, int(spread[k]))
                assert bounds[item, k] >= score
                near += bounds[item, k] <= 1.5 * score
                pairs += 1
    assert near > 0.5 * pairs


def test_index_is_written_and_read_by_size(spark, monkeypatch):
    """A file's row groups and a task's Arrow batches hold few blocks, however many the file holds."""
    monkeypatch.setattr(bitfunnel, "BLOCK_BYTES", 1 << 16)
    kept = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(kept)
    seen, search = [], bitfunnel.search
    monkeypatch.setattr(bitfunnel, "search", lambda blocks, queries: seen.append(blocks) or search(blocks, queries))
    monkeypatch.setattr(bitfunnel, "BY_SIZE", bitfunnel.BY_SIZE | {"parquet.block.size": str(1 << 20)})
    long = spark.range(0, 4000, 1, 1).selectExpr("id doc_id", "concat_ws(' ', transform(sequence(1, 400), x -> hex(xxhash64(x, id)))) text")
    asked = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    bitfunnel.ranked(long, asked)
    groups = [g.total_byte_size for f in ds.dataset(seen[0].inputFiles()[0].removeprefix("file://")).get_fragments() for g in f.row_groups]
    sizes = lambda found: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"]) for b in found)
    batches = seen[0].mapInArrow(sizes, "rows long, size long").collect()
    spark.conf.unset(kept)
    assert sum(groups) > 16 << 20 and max(groups) < 6 << 20
    assert sum(b["size"] for b in batches) > 16 << 20 and max(b["size"] for b in batches) < 12 << 20


def test_counts_of_asked_terms():
    counts = Counter(b"of the of words".split())
    queries = bitfunnel.Queries([(1, Counter([b"of", b"nowhere"]))], {b"of": 1}, 1, 4, 20)
    assert queries.counted(b"OF the of words") == {b"of": 2} and queries.exact(0, queries.counted(b"OF the of words"), 1200) == queries.exact(0, counts, 1200)
