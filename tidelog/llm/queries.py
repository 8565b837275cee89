"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bitfunnel, bpe, packing, pii, repeats, secrets, simhash, spotsigs, token_counts, token_files, toxicity, vectors
from .shared import Workspace, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=1024, end=0)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=1024)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    folder = ws.path("tokens")
    manifest = ws.save(token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"), end=0), "manifest")
    return token_files.read_digests(manifest, folder)


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


#: The chain's order: text of low quality is told first and helps to tell the toxic.
TOXICITY_CATEGORIES = ["low_quality", "toxic"]


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), toxicity_labels(spark, sf_dir), TOXICITY_CATEGORIES)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"), length=100)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitfunnel.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_token_files": op5_token_files,
    "op6_spotsigs": op6_spotsigs,
    "op7_secret_scan": op7_secret_scan,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_alignment": op13_alignment,
}
#: SQL knows neither the tokenizers nor the hashes of the others, which tests hold against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op12_ranked_search": r"""
WITH lower AS (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT r, doc_id, term, COUNT(*) AS tf FROM (SELECT r, doc_id, UNNEST(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lower) GROUP BY ALL),
n AS (SELECT r, SUM(tf) AS n FROM d GROUP BY r),
s AS (SELECT COUNT(*) AS docs, SUM(n) AS terms FROM n),
m AS (SELECT n.r, CAST(75 + (25 * n.n * s.docs) // s.terms AS BIGINT) AS m FROM n, s),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM d, s GROUP BY term, s.docs),
i AS (SELECT row_number() OVER () AS q, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark),
q AS (SELECT q, item_id, UNNEST(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
c AS (SELECT q.q, q.item_id, d.r, d.doc_id, SUM(w.w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * m.m))) AS score FROM q JOIN d USING (term) JOIN w USING (term) JOIN m ON m.r = d.r GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM c WHERE score > 0) WHERE rank <= 20""",
    "op4_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS MATERIALIZED (SELECT * FROM v WHERE len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in e if x <> 0]) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity([COALESCE(x, 0) for x in a.e], [COALESCE(x, 0) for x in b.e]) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
c AS (SELECT a AS vec_id, MIN(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, COUNT(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, COALESCE(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept FROM v JOIN c ON c.vec_id = v.vec_id LEFT JOIN n ON n.vec_id = v.vec_id""",
}
