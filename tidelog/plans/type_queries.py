"""Type mapping, options translation and pattern queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import types
from tidelog.operators import schema
from tidelog.plans.registry import query
from tidelog.sources.portable import Portable, choice
from tidelog.sources.static import Static

COLUMNS = Static("cols", "name string, p int, s int, kind string, envelope string, flat string, flat_fit string", (
    ("VARCHAR2", -1, -1, "VARCHAR2", "string", "string", "string"), ("number", -1, -1, "NUMBER", "struct<scale:int32,value:bytes>", "decimal:127", "float64"), ("NUMBER", 2, 0, "NUMBER", "int8", "decimal:0", "int8"), ("NUMBER", 9, 0, "NUMBER", "int32", "decimal:0", "int32"),
    ("NUMBER", 18, -2, "NUMBER", "int64", "decimal:-2", "int64"), ("NUMBER", 19, 0, "NUMBER", "decimal:0", "decimal:0", "string"), ("NUMBER", 10, 2, "NUMBER", "decimal:2", "decimal:2", "float64"), ("FLOAT", 126, -1, "FLOAT", "struct<scale:int32,value:bytes>", "float64", "float64"),
    ("BINARY_DOUBLE", -1, -1, "BINARY_DOUBLE", "float64", None, None), ("DATE", -1, -1, "DATE", "int64:ms", "timestamp:ms", "timestamp:ms"), ("TIMESTAMP(3)", -1, 3, "TIMESTAMP", "int64:ms", "timestamp:ms", "timestamp:ms"), ("TIMESTAMP(9)", -1, 9, "TIMESTAMP", "int64:ns", "timestamp:ms", "timestamp:ms"),
    ("TIMESTAMP(6) WITH TIME ZONE", -1, 6, "TIMESTAMP_TZ", "string:zoned", "timestamp:ms", "timestamp:ms"), ("TIMESTAMP(6) WITH LOCAL TIME ZONE", -1, 6, "TIMESTAMP_LTZ", "string:zoned", "timestamp:ms", "timestamp:ms"), ("INTERVAL YEAR(2) TO MONTH", -1, -1, "INTERVAL_YM", "float64:us", None, None),
    ("RAW", -1, -1, "RAW", "bytes", "bytes", "bytes"), ("CLOB", -1, -1, "CLOB", "string", None, None), ("JSON", -1, -1, "JSON", None, None, None), ("SDO_GEOMETRY", -1, -1, "UNKNOWN", None, None, None),
))


@query("types_of_columns", f"WITH {COLUMNS.sql} SELECT name, p, s, kind, envelope, flat, flat_fit FROM cols")
def types_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p, s = types.kind(F.col("name")), F.col("p"), F.col("s")
    return COLUMNS.df(spark).select("name", "p", "s", k.alias("kind"), types.envelope_type(k, p, s).alias("envelope"), types.flat_type(k, p, s).alias("flat"), types.flat_type(k, p, s, numeric="BEST_FIT_OR_STRING").alias("flat_fit"))


@query("types_exact_integers", "SELECT event_id, CASE WHEN value = FLOOR(value) AND value BETWEEN -128 AND 127 THEN CAST(value AS BIGINT) END AS small FROM events")
def exact_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.sources import derived as d

    return d.events(spark, sf_dir).select("event_id", types.exact_integer(F.col("value").cast("string"), 8).alias("small"))


SETTINGS = Static("old", "name string, value string", (("table.include.list", "A.B"), ("tombstones.on.delete", "true"), ("log.mining.strategy", "x"), ("made.up", "1")))
RULES = Static("rules", "name string, action string, target string", (("table.include.list", "rename", "include"), ("tombstones.on.delete", "rename", "tombstones"), ("log.mining.strategy", "drop", None)))


@query("r8_settings_translation", f"WITH {SETTINGS.sql}, {RULES.sql} SELECT o.name, COALESCE(r.action, 'manual') AS action, r.target, CASE WHEN r.action = 'rename' THEN o.value END AS value FROM old o LEFT JOIN rules r ON r.name = o.name")
def settings_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = SETTINGS.df(spark).join(RULES.df(spark), "name", "left")
    return joined.select("name", F.coalesce("action", F.lit("manual")).alias("action"), "target", F.when(F.col("action") == "rename", F.col("value")).alias("value"))


_NAME = "c_mktsegment || CAST(c_custkey AS STRING)"
PATTERNS = Portable("pats", "customer", {"id": "c_custkey", "pattern": choice("c_custkey", f"'^A.' || {_NAME} || CHR(36)", f"'A.(B|' || {_NAME} || ')'", f"'A|' || {_NAME}", f"'^' || {_NAME}", f"{_NAME} || CHR(92) || CHR(36)")})


@query(
    "f24_pattern_helpers",
    f"""SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'A.' || n WHEN 1 THEN 'A.(B|' || n || ')' WHEN 2 THEN '(?:A|' || n || ')' WHEN 3 THEN n ELSE n || CHR(92) || CHR(36) END AS plain FROM (SELECT c_custkey, {_NAME} AS n FROM customer)""",
)
def pattern_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("pattern", r"^\^", ""), r"(?<!\\)\$$", "")
    outside = F.regexp_replace(bare, r"\([^)]*\)|\[[^\]]*\]", "")
    return PATTERNS.df(spark, sf_dir).select("id", F.when(outside.contains("|"), F.concat(F.lit("(?:"), bare, F.lit(")"))).otherwise(bare).alias("plain"))


#: Stored and current layouts of a table an order, its last DDL and the time of the resume position, in seconds.
LAYOUTS = Portable("layouts", "orders", {"id": "o_orderkey", "stored": "'ID,' || o_orderstatus", "current": choice("o_orderkey", "'ID,' || o_orderstatus", "'ID,V'", "NULL"), "ddl_s": "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 40 END", "resume_s": "20"})


@query("startup_schema_validation", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 2 THEN 'dropped since' WHEN o_orderkey % 3 = 0 OR o_orderstatus = 'V' THEN 'same' WHEN o_orderkey % 11 <> 0 AND o_orderkey % 40 > 10 THEN 'explained' ELSE 'stop' END AS verdict FROM orders")
def startup_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LAYOUTS.df(spark, sf_dir).select("id", schema.startup_verdict(F.col("stored"), F.col("current"), F.timestamp_seconds("ddl_s"), F.timestamp_seconds("resume_s")).alias("verdict"))


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each event: wrapped in its schema, bare, a null and a broken one."""
    event = F.col("event_id")
    inner = F.concat(F.lit('{"op":"'), F.substring("event_type", 1, 1), F.lit('","before":'), F.when(event % 2 == 1, F.concat(F.lit('{"ID":'), event, F.lit("}"))).otherwise("null"), F.lit(',"after":'), F.when(event % 2 == 0, F.concat(F.lit('{"ID":'), event, F.lit("}"))).otherwise("null"), F.lit(',"source":{"scn":"'), event * 10, F.lit('"}}'))
    body = F.when(event % 5 < 2, F.concat(F.lit('{"schema":{"x":1},"payload":'), inner, F.lit("}"))).when(event % 5 < 3, inner).when(event % 5 == 3, "null").otherwise("broken")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", body.alias("body"))


@query("p22_wrapped_records", "SELECT event_id, CASE WHEN event_id % 5 < 3 THEN LEFT(event_type, 1) END AS op, CASE WHEN event_id % 5 < 3 THEN event_id END AS id, CASE WHEN event_id % 5 < 3 THEN event_id * 10 END AS scn FROM events")
def wrapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = "op string, before struct<ID:long>, after struct<ID:long>, source struct<scn:string>"
    whole, inner = F.from_json("body", rec), F.from_json("body", f"payload struct<{', '.join(f.replace(' ', ':', 1) for f in rec.split(', '))}>")["payload"]
    r = F.coalesce(inner, whole)
    return _document(spark, sf_dir).select("event_id", r["op"].alias("op"), F.coalesce(r["after"]["ID"], r["before"]["ID"]).alias("id"), r["source"]["scn"].cast("long").alias("scn"))


LARGE_TOPICS = Portable("ltop", "part", {"id": "p_partkey", "kind": choice("p_partkey", "'CLOB'", "'BLOB'", "'XMLTYPE'"), "stable_key": "p_size > 10"})


@query("large_topic_requirements", "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 2 THEN 'XMLTYPE has no topic of its own' WHEN p_size <= 10 THEN 'needs a stable column key' END AS error FROM part")
def large_topic_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LARGE_TOPICS.df(spark, sf_dir).select("id", F.when(F.col("kind") == "XMLTYPE", "XMLTYPE has no topic of its own").when(~F.col("stable_key"), "needs a stable column key").alias("error"))
