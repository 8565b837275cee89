from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidelog.llm import toxicity
from tidelog.llm.queries import QUERIES, TOXICITY_CATEGORIES, toxicity_labels
from tidelog.llm.shared import BATCH_BYTES

from .test_simhash import plain_groups
from .test_spans import plain_secrets


def plain_kept(rows):
    """Of ``(doc_id, text)`` the one with the least id of each group of near copies."""
    groups = plain_groups([t for _, t in rows])
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        least[g] = min(i, least.get(g, i))
    return [(i, t) for (i, t), g in zip(rows, groups, strict=True) if least[g] == i]


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    rejected = {r["doc_id"] for r in toxicity.judged(docs, toxicity_labels(spark, sf_dir), TOXICITY_CATEGORIES).where("rejected").collect()}
    kept = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in rejected)
    assert sorted((r["doc_id"], r["text"]) for r in stage["toxicity"](spark, docs, sf_dir).collect()) == kept
    want = plain_kept(kept)
    kept_df = docs.where(~docs.doc_id.isin(list(rejected)))
    once = stage["simhash_near_dedup"](spark, kept_df, sf_dir)
    assert sorted((r["doc_id"], r["text"]) for r in once.collect()) == want and len(want) < len(kept)
    clean = {r["doc_id"]: r["text"] for r in stage["secret_scan"](spark, once, sf_dir).collect()}
    assert set(clean) == {i for i, _ in want}
    for i, text in want:
        assert ("[SECRET]" in clean[i]) >= bool(plain_secrets(text)) and not plain_secrets(clean[i].replace("[SECRET]", " "))
        gaps = clean[i].split("[SECRET]")
        assert re.fullmatch(".*".join(map(re.escape, gaps)), text, re.DOTALL)  # nothing but spans is replaced
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in clean.items()}
    covered = dict.fromkeys(ids, 0)
    for r in corpus_pipeline.run(spark, sf_dir).orderBy("doc_id", "start").collect():
        own = ids[r["doc_id"]]
        assert r["start"] == covered[r["doc_id"]] and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        covered[r["doc_id"]] += r["length"]
    assert covered == {i: len(own) for i, own in ids.items()}


def test_odd_rows_through_all_stages(spark, sf_dir, tmp_path, monkeypatch):
    long = "word " * 5000
    given = [(1, None), (2, ""), (3, "a text of some words"), (3, "a text of some words"), (None, "a text without an id, of other words"), (4, long), (5, "user: bob password: hunter22hunter22")]
    columns = "doc_id long, text string, lang string, source string, n_chars int"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, rows in (("odd", given), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], columns).write.parquet(str(folder / "documents.parquet"))
        labels.write.parquet(str(folder / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        ids = {r["doc_id"] for r in out}
        assert ids == ({1, 3, None, 4, 5} if rows else set())  # null and empty texts are copies of each other
        whole = {}
        for r in out:
            whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
        assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in out)


@pytest.mark.parametrize("name", ["toxicity", "simhash_near_dedup", "packing"])
def test_long_texts_come_in_small_batches(spark, sf_dir, name):
    kept = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(kept)
    dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    long = spark.range(0, 2000, 1, 1).selectExpr("id doc_id", "repeat('some words ', 1000) text")
    sizes = lambda found: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"]) for b in found)
    got = long.mapInArrow(sizes, "rows long, size long").collect()
    spark.conf.unset(kept)
    assert sum(r["rows"] for r in got) == 2000 and max(r["size"] for r in got) < 1.5 * BATCH_BYTES  # of 22 MB


def test_all_operators_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}

