"""Secret scans with multipart credential linking, in DataFrame functions alone.

Base kinds are single patterns. Weak kinds (``id`` an access identifier, ``key`` a short or bare secret,
``host`` an endpoint) say little alone and are reported only when complementary parts co-occur: an
interval join pairs the secrets of a text with the identifiers and with the endpoints that lie within ``SCOPE``
code points of them, between the end of one and the start of the other, base spans taking part as secrets or
identifiers, and an endpoint joins where a paired identifier lies within its scope. Both sides are dealt to the
buckets of ``SCOPE`` that they touch, one side with its scope, so a bucket holds what fits into that much text and no
text's parts are ever paired all with all.

Positions come from the pieces between matches: ``split`` gives their lengths, ``regexp_extract_all`` the
matches', and running sums of the two (blocks of sums, then within a block) give each start. Documents without
a match take one pass a pattern.

Defined results: a null text counts as empty and has no spans; overlapping spans of different kinds all
stand; weak spans that overlap a base span are not repeated; repeated rows and null ids each get their
row; an empty table gives no rows; other columns are ignored. Cost grows with a text's length, and with the power
1.5 of the matches in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace

SCOPE = 200
SUMS = 256
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
#: The base patterns, and the least length of what must be long.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # what `[0-9a-f]+` of 16 or more finds: runs are disjoint and taken whole
BASE = [("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16)]
WEAK = [
    ("id", r"""(?i:access_?key(?:_?id)?|client_?id|account|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}|(?:AKIA|ASIA)[A-Z0-9]{8,}"""),
    ("key", r"""(?i:password|passwd|pwd|secret|token|api_?key|auth)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"""),
    ("host", r"""(?i:https?|ftp|s3|redis|mysql|mongodb|amqps?|postgres(?:ql)?|jdbc:[a-z0-9]+)://[^\s"'<>]+|(?<![A-Za-z0-9.-])[a-z0-9][a-z0-9.-]*\.[a-z]{2,}:[0-9]{2,5}"""),
]
RANKS = {kind: k for k, kind in enumerate([*(b[0] for b in BASE), *(w[0] for w in WEAK)])}


def _running(lengths: str) -> Column:
    """For each element, the sum of those before it."""
    add = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    block = lambda i: F.floor(i / SUMS).cast("int")
    return F.transform(
        lengths,
        lambda _, i: add(F.slice("_sums", 1, block(i))) + add(F.slice(lengths, block(i) * SUMS + 1, i - block(i) * SUMS)),
    )


def _with_spans(df: DataFrame, out: str, kind: str, pattern: str, group: int, least: int, given: Column | None = None) -> DataFrame:
    """Column ``out``: the spans of a pattern whose group has the least length; given: where to look at all."""
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    df = df.withColumn("_found", found if given is None else F.when(given, found).otherwise(empty))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.transform(F.split("text", pattern, -1), lambda x: F.length(x))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_steps", F.transform("_found", lambda x, i: F.get("_gaps", i) + F.length(x)))
    blocks = F.when(F.size("_steps") > 0, F.sequence(F.lit(0), F.floor((F.size("_steps") - 1) / SUMS).cast("int"))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_sums", F.transform(blocks, lambda b: F.aggregate(F.slice("_steps", b * SUMS + 1, SUMS), F.lit(0), lambda a, x: a + x)))
    df = df.withColumn("_before", _running("_steps"))
    long = lambda x: F.length(F.regexp_extract(x, pattern, group) if group else x) >= least
    spans = F.transform(
        "_found",
        lambda x, i: F.when(
            long(x),
            F.struct(
                (F.get("_before", i) + F.get("_gaps", i)).alias("start"), F.lit(RANKS[kind]).alias("rank"), (F.get("_before", i) + F.get("_steps", i)).alias("end"), F.lit(kind).alias("kind")
            ),
        ),
    )
    return df.withColumn(out, F.array_compact(spans).cast(SPAN)).drop("_found", "_gaps", "_steps", "_sums", "_before")


def as_text(spans: str) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both with a gap of SCOPE at most between their spans, by the buckets that left touches and right reaches; some twice."""
    start, end = F.col("span.start"), F.col("span.end")
    bucket = lambda at: F.floor(at / SCOPE).cast("int")
    a = left.withColumn("bucket", F.explode(F.sequence(bucket(start), bucket(end)))).alias("a")
    b = right.withColumn("bucket", F.explode(F.sequence(bucket(start - SCOPE), bucket(end + SCOPE)))).alias("b")
    on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.h") == F.col("b.h")) & (F.col("a.bucket") == F.col("b.bucket"))
    gap = F.greatest(F.col("b.span.start") - F.col("a.span.end"), F.col("a.span.start") - F.col("b.span.end"))
    return a.join(b, on & gap.between(0, SCOPE))


def _linked(found: DataFrame) -> DataFrame:
    """``(doc_id, h, links)``: the weak spans of each text whose parts co-occur."""
    parts = lambda *columns: found.select("doc_id", "h", F.explode(F.concat(*columns)).alias("span"))
    pairs = _near(parts("key", "assign", "hex"), parts("id", "access", "host"))
    pairs = pairs.select("a.doc_id", "a.h", F.explode(F.array("a.span", "b.span")).alias("span")).distinct()
    hosts = _near(pairs.where(F.col("span.kind").isin("id", "access")), parts("host")).select("b.doc_id", "b.h", "b.span").distinct()
    weak = pairs.union(hosts).where(F.col("span.kind").isin([w[0] for w in WEAK]))
    return weak.groupBy("doc_id", "h").agg(F.collect_set("span").alias("links"))


PARTS = [*(b[0] for b in BASE), *(w[0] for w in WEAK)]
PARTNERS = "size(id) + size(access) + size(host) > 0"
COMPLETE = f"{PARTNERS} and size(key) + size(assign) + size(hex) > 0"


def _with_parts(df: DataFrame) -> DataFrame:
    """Columns of base spans and of weak spans, and ``h``, for each row of ``df(doc_id, text)``; texts are not null."""
    for kind, pattern, group, least in BASE:
        df = _with_spans(df, kind, kind, pattern, group, least)
    df = _with_spans(df, "id", *WEAK[0], 0, 0)
    df = _with_spans(df, "host", *WEAK[2], 0, 0)
    df = _with_spans(df, "key", *WEAK[1], 0, 0, given=F.expr(PARTNERS))
    clear = lambda c: F.filter(c, lambda w: ~F.exists(F.concat("assign", "access", "hex"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    some = F.expr(COMPLETE)
    weak = {w[0]: F.when(some, clear(w[0])).otherwise(F.array().cast(SPAN)) for w in WEAK}
    return df.withColumns(weak | {"h": F.xxhash64("text")})


def _with_links(found: DataFrame) -> DataFrame:
    """Column ``links`` in place of the weak spans; only rows that may have some are joined."""
    may = F.expr(COMPLETE)
    links = _linked(found.where(may).select("doc_id", "h", *PARTS).dropDuplicates(["doc_id", "h"])).withColumnsRenamed({"doc_id": "_doc", "h": "_h"})
    joined = found.where(may).join(links, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h")), "left").drop("_doc", "_h")
    joined = joined.withColumn("links", F.coalesce("links", F.array().cast(SPAN)))
    return joined.unionByName(found.where(~may).withColumn("links", F.array().cast(SPAN))).drop(*[w[0] for w in WEAK])


def scan(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs(doc_id, text)``: ``doc_id``, ``h`` (the text's hash), spans ``assign``, ``access``, ``hex`` and ``links``."""
    df = _with_parts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    found = Workspace(docs.sparkSession).save(df.select("doc_id", "h", *PARTS), "spans")
    return _with_links(found).select("doc_id", "h", *[b[0] for b in BASE], "links")


def report(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans of each row."""
    base = F.concat(*[b[0] for b in BASE])
    df = scan(docs).withColumn("_base", base).withColumn("_all", F.concat("_base", "links"))
    return df.select("doc_id", *[F.size(b[0]).cast("long").alias(f"n_{b[0]}") for b in BASE], F.sha2(as_text("_base"), 256).alias("base_sha256"), as_text("_all").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by the mark and ``n_chars``, where there is one, counted anew; columns and rows stay.

    Texts are written once beside their spans; only those that may hold linked parts are shuffled.
    """
    rest = [c for c in docs.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row")
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("_null"), row)
    df = _with_links(Workspace(docs.sparkSession).save(_with_parts(df), "parts"))
    df = df.withColumn("_spans", F.array_sort(F.concat(*[b[0] for b in BASE], "links")))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        kept = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        after = F.struct(span["end"].alias("at"), F.concat(done["out"], kept, F.lit(mark)).alias("out"))
        inside = F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["out"].alias("out"))
        return F.when(span["start"] >= done["at"], after).otherwise(inside)

    clean = F.aggregate("_spans", start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    changed = F.size("_spans") > 0
    df = df.withColumn("_new", F.when(F.col("_null"), F.lit(None)).when(changed, clean).otherwise(text))
    out = {c: F.col("_row")[c] for c in rest} | {"text": F.col("_new")}
    if "n_chars" in rest:
        out["n_chars"] = F.when(changed, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return df.select(*[out[c].alias(c) for c in docs.columns])
