"""Whole captures over the raw log derived from ``events``: nested, flat, typed by the dictionary and the log's statements, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import ops
from tidelog.options import Options
from tidelog.plans.capture import capture, log_layouts
from tidelog.plans.registry import query
from tidelog.sources import derived as d
from tidelog.sources.raw_log import CENTS_SQL, CHANGED_SQL, EVERY, dictionary, raw_log

KEYS = {"APP.ITEMS": ["ID"], "APP.CARTS": ["ID"]}
_OP = "CASE op_code WHEN 1 THEN 'c' WHEN 2 THEN 'd' ELSE 'u' END"
_PLACE = "CAST(commit_scn AS VARCHAR) AS commit_scn, event_index"
_READ = "event_id % 37 <> 0"
_KEY = "'{\"ID\":\"' || event_id || '\"}'"


def _at(path: str) -> Column:
    return F.get_json_object("value", f"$.{path}")


@query(
    "capture_nested",
    f"""WITH {d.SURVIVORS_SQL}, r AS (SELECT *, {CENTS_SQL} AS cents, {_OP} AS op FROM sv WHERE {_READ})
    SELECT 'srv.APP.' || tab AS topic, {_KEY} AS key, op, CAST(event_id AS VARCHAR) AS id, CAST(cents AS VARCHAR) AS value, CAST(event_index + 1 AS VARCHAR) AS total_order, CAST(collection_order AS VARCHAR) AS table_order, CAST(commit_scn AS VARCHAR) AS commit_scn FROM r
    UNION ALL SELECT 'srv.APP.' || tab, {_KEY}, NULL, NULL, NULL, NULL, NULL, CAST(commit_scn AS VARCHAR) FROM r WHERE op = 'd'""",
)
def capture_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = capture(raw_log(spark, sf_dir, statements=False), KEYS, Options.of({"decode_error": "dlq"}), server="srv").records
    side = lambda c: F.coalesce(_at(f"after.{c}"), _at(f"before.{c}"))
    return records.select("topic", "key", _at("op").alias("op"), side("ID").alias("id"), side("VALUE").alias("value"), _at("transaction.total_order").alias("total_order"), _at("transaction.data_collection_order").alias("table_order"), F.col("commit_scn").cast("string").alias("commit_scn"))


@query(
    "capture_flat",
    f"""WITH {d.SURVIVORS_SQL} SELECT {_KEY} AS key, CASE op_code WHEN 1 THEN 'I' WHEN 2 THEN 'D' ELSE 'U' END AS op_type, 'P1.APP.' || tab AS table_name, CAST({CENTS_SQL} AS VARCHAR) AS value, CAST(scn AS VARCHAR) AS scn FROM sv WHERE {_READ} AND user_id % 10 <> 3""",
)
def capture_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = Options.of({"decode_error": "dlq", "format": "flat", "tombstones": "false", "include": r"P1\.APP\.(ITEMS|CARTS)", "exclude_users": "U3"})
    records = capture(raw_log(spark, sf_dir, statements=False), KEYS, options).records
    return records.select("key", _at("op_type").alias("op_type"), _at("table").alias("table_name"), _at("VALUE").alias("value"), _at("scn").alias("scn"))


@query(
    "capture_dead_letters",
    f"""WITH {d.SURVIVORS_SQL} SELECT con_id, user_id AS usn, sqn, scn, tab, 'Unsupported' AS sql_redo FROM sv WHERE NOT {_READ}""",
)
def capture_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = capture(raw_log(spark, sf_dir, statements=False), KEYS, Options.of({"decode_error": "dlq"})).dead
    return dead.select(F.col("con_id").cast("long").alias("con_id"), "usn", "sqn", "scn", "tab", "sql_redo")


@query(
    "capture_ddl",
    f"""WITH {d.SURVIVORS_SQL}, r AS (SELECT *, {CHANGED_SQL} AS turns, {CENTS_SQL} AS cents FROM sv WHERE {_READ})
    SELECT event_id AS id, {_OP} AS op, '{{"ID":' || event_id || '}}' AS key, cents AS value, CAST(1 + turns AS VARCHAR) AS version, CASE WHEN op_code = 1 AND turns % 2 = 1 THEN 'n' || event_id END AS note FROM r""",
)
def capture_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No layouts are given: they are made from the dictionary's readings and the statements in the log."""
    options = Options.of({"decode_error": "dlq", "tombstones": "false"})
    records = capture(raw_log(spark, sf_dir), options=options, dictionary=dictionary(spark, sf_dir)).records
    side = lambda c: F.coalesce(_at(f"after.{c}"), _at(f"before.{c}"))
    return records.select(side("ID").cast("long").alias("id"), _at("op").alias("op"), "key", side("VALUE").cast("long").alias("value"), F.col("headers")["cdc.schema_version"].alias("version"), _at("after.NOTE").alias("note"))


@query(
    "layouts_from_log",
    f"""WITH s AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'ITEMS' ELSE 'CARTS' END AS tab, {CHANGED_SQL} AS turns FROM events WHERE event_id % {EVERY} = 0 AND event_id > 0)
    SELECT tab, 1 + turns AS version, event_id * 10 + 997 AS valid_from, 'ddl' AS cause, CASE WHEN turns % 2 = 1 THEN 'ID,RID,VALUE,NOTE' ELSE 'ID,RID,VALUE' END AS columns FROM s
    UNION ALL SELECT tab, 1, 0, 'start', 'ID,RID,VALUE' FROM (VALUES ('ITEMS'), ('CARTS')) t(tab)""",
)
def layouts_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = log_layouts(raw_log(spark, sf_dir), dictionary(spark, sf_dir))
    return found.select("tab", "version", "valid_from", "cause", F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("columns"))


@query(
    "s16_capture_events",
    f"""WITH {d.SURVIVORS_SQL}, s AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'ITEMS' ELSE 'CARTS' END AS tab, {CHANGED_SQL} AS turns FROM events WHERE event_id % {EVERY} = 0 AND event_id > 0)
    SELECT 'ddl-seen' AS type, event_id * 10 + 997 AS at, 'object=' || tab || ';owner=APP;pdb=P1;scn=' || (event_id * 10 + 997) || ';sql=alter table app.' || LOWER(tab) || CASE WHEN turns % 2 = 1 THEN ' add (note varchar2(30))' ELSE ' drop column note' END AS details FROM s
    UNION ALL SELECT 'ddl-applied', event_id * 10 + 997, 'columns=' || CASE WHEN turns % 2 = 1 THEN 4 ELSE 3 END || ';object=' || tab || ';owner=APP;pdb=P1;scn=' || (event_id * 10 + 997) || ';version=' || (1 + turns) FROM s
    UNION ALL SELECT 'decode-error-dlq', scn, 'error=unknown statement unsupported;operation=255;scn=' || scn || ';table=APP.' || tab || ';xid=' || user_id || '.0.' || sqn FROM sv WHERE NOT {_READ}""",
)
def capture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a capture: statements seen, layouts that they left, rows that could not be decoded."""
    raw, c = raw_log(spark, sf_dir), F.col
    layouts = log_layouts(raw, dictionary(spark, sf_dir)).where("cause = 'ddl'")
    where = {"pdb": c("pdb"), "owner": c("owner"), "object": c("tab"), "scn": c("valid_from")}
    seen = ops.records(layouts, "ddl-seen", "db", F.lit(0), c("valid_from"), **where, sql=c("sql"))  # each of the log's statements leaves a layout
    applied = ops.records(layouts, "ddl-applied", "db", F.lit(0), c("valid_from"), **where, version=c("version"), columns=F.size("columns"))
    dead = capture(raw_log(spark, sf_dir, statements=False), KEYS, Options.of({"decode_error": "dlq"})).dead
    failed = ops.records(dead, "decode-error-dlq", "db", F.lit(0), c("scn"), table=F.concat_ws(".", "owner", "tab"), xid=F.concat_ws(".", "usn", "slot", "sqn"), scn=c("scn"), operation=c("op_code"), error=c("exception"))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("details"), lambda p: F.concat_ws("=", p["key"], p["value"]))), ";")
    return seen.unionByName(applied).unionByName(failed).select("type", c("resume_scn").alias("at"), text.alias("details"))
