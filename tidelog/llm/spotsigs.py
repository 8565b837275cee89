"""SpotSigs fingerprints, in DataFrame functions alone.

A signature is an anchor and the chain of the up to ``CHAIN`` content words that follow it, anchors between them
skipped. Anchors are common words of four languages and, so that lists and texts in other tongues have some, the
words whose hash falls in a fixed share; the start of a text is an anchor too, with chains of 1 to ``CHAIN`` content
words, so that a text of few words has some. One rule holds for texts of all lengths. Words before a position are
anchors or content, so the content that follows the k-th anchor, at position p, begins at content word p - k: one
pass marks anchors, one collects content, and time is in proportion to a text's length. A fingerprint is the sorted
set of 32-bit signature hashes, eight hex digits each.

Two sets are compared by their Jaccard likeness, by a hash set of the two. Where a floor is given, they are compared by
partition of their lengths: sets whose partitions lie more than one apart cannot reach it and are given 0 unseen.

Defined results: a null text counts as empty, its set is empty and its fingerprint the empty string; a text of anchors
alone has one signature for each different one; a text without words takes the hash of the text; two empty sets are
alike (1), an empty and another are not (0); equal texts have equal fingerprints; among equal
ids the order is that of the texts' hashes; a null id comes after all others; an only document is its own
next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 3
SHARE = 16
BUCKET_BYTES = 1 << 28  # of text in a range of ids, where there are more ranges than tasks
#: Common words of English, German, French and Spanish.
COMMON = """
the of and to in is that it for was
der die und das den von zu mit sich auf
le la les de des et un du que en
el los las del y se por con una su
""".split()


def _hashed(text: str) -> Column:
    return F.transform(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Column ``out``: the sorted set of signatures (longs below 2**32) of the text column."""
    common = df.sparkSession.range(1).select(F.array(*[F.xxhash64(F.lit(w)) for w in COMMON]).alias("h")).first()["h"]
    anchor = lambda h: h.isin(common) | (F.pmod(h, F.lit(SHARE)) == 0)
    short = lambda c: F.pmod(c, F.lit(1 << 32))
    df = df.withColumn("_words", _hashed(text))
    df = df.withColumn("_content", F.filter("_words", lambda h: ~anchor(h)))
    df = df.withColumn("_at", F.filter(F.transform("_words", lambda h, i: F.when(anchor(h), i).otherwise(F.lit(-1))), lambda i: i >= 0))
    follow = lambda at, n: [F.get("_content", at + i) for i in range(n)]  # noqa: E731  # no word beyond the last; a hash passes over those
    chains = F.transform("_at", lambda p, k: short(F.xxhash64(F.get("_words", p), *follow(p - k, CHAIN))))
    starts = F.array(*[short(F.xxhash64(F.lit("start"), *follow(F.lit(0), n))) for n in range(1, CHAIN + 1)])
    found = F.when(F.size("_content") > 0, F.concat(starts, chains)).when(F.size("_words") > 0, chains)
    found = found.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(short(F.xxhash64(F.lit("text"), text))))
    return df.withColumn(out, F.array_sort(F.array_distinct(found))).drop("_words", "_content", "_at")


def as_text(signatures: str) -> Column:
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: str, b: str, floor: float = 0.0) -> Column:
    """Jaccard likeness of two sets, 0 where their lengths' partitions rule out a floor."""
    x, y = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    found = F.when((x == 0) & (y == 0), 1.0).when((x == 0) | (y == 0), 0.0)
    if floor > 0:
        part = lambda n: F.floor(F.log(n.cast("double")) / math.log(1 / floor))
        found = found.when(F.abs(part(x) - part(y)) > 1, 0.0).when(F.least(x, y) < floor * F.greatest(x, y), 0.0)
    return found.otherwise(both / (x + y - both))


def _below(bounds: list[int], of: Column) -> Column:
    """How many of the sorted bounds lie below a number, by halving; 0 for null."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")  # a literal, once folded

    def halve(span: Column, _: Column) -> Column:
        mid = F.shiftright(span["lo"] + span["hi"], 1)
        right = F.coalesce(F.get(table, mid) < of, F.lit(False))
        half = F.when(right, F.struct((mid + 1).alias("lo"), span["hi"].alias("hi"))).otherwise(F.struct(span["lo"].alias("lo"), mid.alias("hi")))
        return F.when(span["lo"] < span["hi"], half).otherwise(span)

    whole = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.array(*[F.lit(0)] * len(bounds).bit_length()), whole, halve, lambda span: span["lo"])


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``docs(doc_id, text)`` dealt into ranges of ids, and the window in which ``lead`` is the next document.

    The first row of each range is there a second time (``ghost``) as the last of the range before it, that
    of the first range as the last of the last; callers drop ghosts. Range bounds are approximate quantiles,
    as many as the bytes of text ask for, so ranges follow the ids' density and no row has to see another range.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    bounds = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], F.lit(10 * n)).alias("q")).first()["q"] or []
    docs = docs.withColumn("bucket", _below(sorted(set(bounds)), F.col("doc_id").cast("long")))
    first = sorted(docs.groupBy("bucket").agg(F.max("doc_id").alias("first")).collect(), reverse=True)  # a row a range
    rows = [(r["bucket"], r["first"], first[k - 1]["bucket"]) for k, r in enumerate(first)]
    ends = F.broadcast(spark.createDataFrame(rows, f"bucket int, first {docs.schema['doc_id'].dataType.simpleString()}, before int"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(F.struct(F.col("bucket"), F.lit(0).alias("ghost")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("ghost"))))
    places = F.explode(places.otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("ghost")))))
    dealt = docs.join(ends, "bucket").select("doc_id", "text", places.alias("at")).select("doc_id", "text", "at.bucket", "at.ghost")
    return dealt, Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))


def compare_edited(docs: DataFrame, floor: float = 0.0) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to that and to the next document's.

    The edited text is the text with its last third replaced by the beginning of the next document.
    """
    dealt, order = with_next(docs)
    third = F.floor(F.length("text") / 3).cast("int")
    df = dealt.withColumn("edited", F.concat(F.left("text", F.length("text") - third), F.left(F.lead("text").over(order), third)))
    df = with_signatures(with_signatures(df, "text", "own"), "edited", "changed")
    df = df.withColumn("following", F.lead("own").over(order)).where("ghost = 0")
    return df.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed", floor).alias("near_edited"),
        likeness("own", "following", floor).alias("near_next"),
    )
