"""Rendering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import render, scans
from tidelog.plans.registry import query
from tidelog.plans.transaction_queries import survivors
from tidelog.sources import derived as d
from tidelog.sources.portable import Portable, choice

TX = d.TX


@query("p9_p10_images", f"""WITH {d.ROWS_SQL} SELECT event_id, CASE WHEN op_code <> 1 THEN CONCAT('RID=', rid) END AS before_rid, CASE WHEN op_code = 1 THEN CONCAT('RID=', rid) WHEN op_code = 3 THEN CONCAT('RID=', rid) END AS after_rid,
  CASE WHEN op_code = 3 THEN CAST(value AS VARCHAR) WHEN op_code = 1 THEN CAST(value AS VARCHAR) END IS NOT NULL AS after_has_value, op_code IN (2, 3) AS partial FROM e WHERE NOT undo""")
def image_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).where("not undo")
    where = F.create_map(F.lit("RID"), F.col("rid"))
    set_ = F.when(F.col("op_code") == 1, F.create_map(F.lit("RID"), F.col("rid"), F.lit("VALUE"), F.col("value").cast("string"))).otherwise(F.create_map(F.lit("VALUE"), F.col("value").cast("string")))
    before, after = render.images(F.col("op_code"), set_, where)
    text = lambda m: F.concat(F.lit("RID="), F.try_element_at(m, F.lit("RID")))
    return rows.select("event_id", text(before).alias("before_rid"), text(after).alias("after_rid"), F.try_element_at(after, F.lit("VALUE")).isNotNull().alias("after_has_value"), render.partial(F.col("op_code"), where, 2).alias("partial"))


@query(
    "p11_envelope",
    f"""WITH {d.SURVIVORS_SQL} SELECT event_id, CASE op_code WHEN 1 THEN 'c' WHEN 3 THEN 'u' ELSE 'd' END AS op, EPOCH_US(ts) // 1000 AS ts_ms, EPOCH_US(ts) AS ts_us, EPOCH_US(ts) * 1000 AS ts_ns,
    CAST(con_id AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) || '.' || CAST(sqn AS VARCHAR) AS tx_id, event_index + 1 AS total_order, collection_order AS data_collection_order, 'APP' AS source_schema, tab AS source_table, scn AS source_scn, commit_scn AS source_commit_scn FROM sv""",
)
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = F.unix_micros(F.to_timestamp("ts"))
    source = F.struct(F.lit("APP").alias("schema"), F.col("tab").alias("table"), "scn", "commit_scn")
    block = F.struct(F.concat_ws(".", *[F.col(c).cast("string") for c in TX]).alias("id"), (F.col("event_index") + 1).alias("total_order"), F.col("collection_order").alias("data_collection_order"))
    rec = survivors(spark, sf_dir).select("event_id", render.envelope_op(F.col("op_code")).alias("op"), F.floor(us / 1000).cast("long").alias("ts_ms"), us.alias("ts_us"), (us * 1000).alias("ts_ns"), source.alias("source"), block.alias("transaction"))
    return rec.select("event_id", "op", "ts_ms", "ts_us", "ts_ns", F.col("transaction.id").alias("tx_id"), "transaction.total_order", "transaction.data_collection_order", F.col("source.schema").alias("source_schema"), F.col("source.table").alias("source_table"), F.col("source.scn").alias("source_scn"), F.col("source.commit_scn").alias("source_commit_scn"))


KEYED_SQL = f"{d.SURVIVORS_SQL}, kd AS (SELECT sv.*, CASE WHEN op_code = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS old_key, CASE WHEN op_code = 2 THEN NULL WHEN op_code = 3 AND event_id % 10 = 7 THEN CAST(user_id + 100000 AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS new_key FROM sv)"


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    op, user = F.col("op_code"), F.col("user_id").cast("string")
    moved = (op == 3) & (F.col("event_id") % 10 == 7)
    return survivors(spark, sf_dir).withColumn("old_key", F.when(op != 1, user)).withColumn("new_key", F.when(moved, (F.col("user_id") + 100000).cast("string")).when(op != 2, user))


@query(
    "p12_p13_key_change_and_tombstones",
    f"""WITH {KEYED_SQL}
    SELECT event_id, event_index, 0 AS sub, CASE WHEN op_code = 3 AND old_key <> new_key THEN 'd' WHEN op_code = 1 THEN 'c' WHEN op_code = 3 THEN 'u' ELSE 'd' END AS op, CASE WHEN op_code = 3 AND old_key <> new_key THEN old_key ELSE COALESCE(new_key, old_key) END AS key, TRUE AS has_value FROM kd
    UNION ALL SELECT event_id, event_index, 1, 'tombstone', old_key, FALSE FROM kd WHERE op_code = 2 OR (op_code = 3 AND old_key <> new_key)
    UNION ALL SELECT event_id, event_index, 2, 'c', new_key, TRUE FROM kd WHERE op_code = 3 AND old_key <> new_key""",
)
def key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.envelope_records(keyed(spark, sf_dir), F.col("old_key"), F.col("new_key")).select("event_id", "event_index", "sub", "op", "key", "has_value")


FLAT_SQL = """WITH {base}
    SELECT event_id, 0 AS sub, CASE WHEN op_code = 3 AND old_key <> new_key THEN NULL WHEN op_code = 1 THEN 'I' WHEN op_code = 3 THEN 'U' ELSE {deleted} END AS op_type, CASE WHEN op_code = 3 AND old_key = new_key OR op_code = 1 THEN new_key ELSE old_key END AS key, scn, tab AS "table" FROM kd
    UNION ALL SELECT event_id, 1, 'I', new_key, scn, tab FROM kd WHERE op_code = 3 AND old_key <> new_key"""


@query("p15_p16_flat_with_tombstones", FLAT_SQL.format(base=KEYED_SQL, deleted="NULL"))
def flat_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.flat_records(keyed(spark, sf_dir), F.col("old_key"), F.col("new_key"), True).select("event_id", "sub", "op_type", "key", "scn", F.col("tab").alias("table"))


@query("p15_p16_flat_without_tombstones", FLAT_SQL.format(base=KEYED_SQL, deleted="'D'"))
def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.flat_records(keyed(spark, sf_dir), F.col("old_key"), F.col("new_key"), False).select("event_id", "sub", "op_type", "key", "scn", F.col("tab").alias("table"))


@query("p14_truncate_records", f"WITH {d.ROWS_SQL} SELECT tab, 't' AS op, CAST(NULL AS VARCHAR) AS key, scn FROM e WHERE event_id % 500 = 0 UNION ALL SELECT tab, 'c', rid, scn FROM e WHERE op_code = 1 AND event_id % 500 <> 0")
def truncates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    cleared = rows.where("event_id % 500 = 0").select("tab", F.lit("t").alias("op"), F.lit(None).cast("string").alias("key"), "scn")
    return cleared.unionByName(rows.where("op_code = 1 and event_id % 500 <> 0").select("tab", F.lit("c").alias("op"), F.col("rid").alias("key"), "scn"))


#: Updates by line: the name may change, be lacking on a side or stay; the note, a large value, changes or stays.
LARGE = Portable("upd", "lineitem", {"id": "l_orderkey * 10 + l_linenumber", "name_before": choice("l_orderkey", "l_returnflag", "l_returnflag", "NULL", "NULL"), "name_after": choice("l_orderkey", "l_returnflag", "l_linestatus", "NULL", "l_returnflag"), "note_before": "'x'", "note_after": choice("l_linenumber", "'x'", "l_returnflag")})


@query("p17_large_only_updates", "SELECT l_orderkey * 10 + l_linenumber AS id, CASE l_orderkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN l_returnflag = l_linestatus WHEN 2 THEN TRUE ELSE FALSE END AS suppressed FROM lineitem")
def large_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = lambda side: F.create_map(F.lit("NAME"), F.col(f"name_{side}"), F.lit("NOTE"), F.col(f"note_{side}"))
    return LARGE.df(spark, sf_dir).select("id", render.only_large_changed(image("before"), image("after"), ["NOTE"]).alias("suppressed"))


@query("p18_joined_keys", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) || '_' || o_orderstatus END AS key FROM orders")
def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("status", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")))
    return rows.select("o_orderkey", render.joined_key("o_orderkey", "status").alias("key"))


#: A table a brand, a column a part: names with spaces, dashes, leading digits, and some that meet once adjusted.
FIELD_NAMES = Portable("fields", "part", {"tab": "p_brand", "name": choice("p_partkey", "p_type || ' A'", "p_type || '-A'", "CAST(p_size AS STRING) || 'ST_' || p_type", "CHR(36) || p_name")})
_CLEAN = "c AS (SELECT tab, name, REGEXP_REPLACE(name, '[^A-Za-z0-9_]', '_', 'g') AS s FROM fields), a AS (SELECT tab, name, CASE WHEN REGEXP_MATCHES(s, '^[0-9]') THEN '_' || s ELSE s END AS adjusted FROM c)"


@query("p19_avro_names", f"WITH {FIELD_NAMES.sql}, {_CLEAN} SELECT tab, name, adjusted FROM a")
def avro_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FIELD_NAMES.df(spark, sf_dir).withColumn("adjusted", render.adjust_name(F.col("name"), "AVRO"))


@query(
    "p19_avro_unicode_names",
    f"""WITH {FIELD_NAMES.sql}, r AS (SELECT tab, name, REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(name, '_', '_u005f'), ' ', '_u0020'), '-', '_u002d'), CHR(36), '_u0024'), '#', '_u0023') AS s FROM fields)
    SELECT tab, name, CASE WHEN REGEXP_MATCHES(s, '^[0-9]') THEN '_u003' || LEFT(s, 1) || SUBSTR(s, 2) ELSE s END AS adjusted FROM r""",
)
def avro_unicode_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FIELD_NAMES.df(spark, sf_dir).select("tab", "name", render.adjust_name(F.col("name"), "AVRO_UNICODE").alias("adjusted"))


@query("p20_name_collisions", f"WITH {FIELD_NAMES.sql}, {_CLEAN}, d AS (SELECT DISTINCT tab, name, adjusted FROM a) SELECT tab, adjusted, CAST(COUNT(*) AS BIGINT) AS n FROM d GROUP BY ALL HAVING COUNT(*) > 1")
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avro_names(spark, sf_dir).distinct().groupBy("tab", "adjusted").agg(F.count("*").alias("n")).where("n > 1")


@query("p21_headers", f"WITH {d.SURVIVORS_SQL} SELECT event_id, CAST(scn AS VARCHAR) AS h_scn, CAST(commit_scn AS VARCHAR) AS h_commit_scn, CONCAT(con_id, '.', user_id, '.', sqn) AS h_xid, CAST(event_index AS VARCHAR) AS h_index, CAST(event_count AS VARCHAR) AS h_count FROM sv")
def header_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survivors(spark, sf_dir).withColumn("h", render.headers(TX))
    names = {"h_scn": "cdc.scn", "h_commit_scn": "cdc.commit_scn", "h_xid": "cdc.xid", "h_index": "cdc.event_index", "h_count": "cdc.event_count"}
    return rows.select("event_id", *[F.col("h")[F.lit(v)].alias(k) for k, v in names.items()])


@query("p22_record_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def record_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.events(spark, sf_dir).select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("s13_topic_routing", "SELECT c_custkey, 'srv.' || c_mktsegment || '.' || c_name AS expanded, SUBSTR(REGEXP_REPLACE(REGEXP_REPLACE(REGEXP_REPLACE('srv.' || c_mktsegment || '.' || c_name, '[^A-Za-z0-9._-]', '_', 'g'), '\\.\\.+', '.', 'g'), '^\\.+', ''), 1, 249) AS topic FROM customer")
def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    expanded, clean = render.topic("srv.${schema}.${table}", schema="c_mktsegment", table="c_name")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", expanded.alias("expanded"), clean.alias("topic"))


@query("s13_topic_collisions", "WITH t AS (SELECT 'srv.' || (CASE WHEN c_custkey % 2 = 0 THEN 'a#' ELSE 'a$' END) || CAST(c_custkey % 50 - c_custkey % 2 AS VARCHAR) AS expanded FROM customer) SELECT REGEXP_REPLACE(expanded, '[^A-Za-z0-9._-]', '_', 'g') AS topic, CAST(COUNT(DISTINCT expanded) AS BIGINT) AS tables FROM t GROUP BY 1 HAVING COUNT(DISTINCT expanded) > 1")
def topic_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.when(key % 2 == 0, "a#").otherwise("a$").alias("schema"), (key % 50 - key % 2).alias("table"))
    expanded, clean = render.topic("srv.${schema}${table}", schema="schema", table="table")
    return render.topic_collisions(rows.select(expanded.alias("expanded"), clean.alias("topic")))


@query("s14_large_value_topics", f"WITH {d.SURVIVORS_SQL} SELECT tab AS \"table\", 'NOTE' AS \"column\", user_id AS primary_key, scn, CASE WHEN op_code <> 2 THEN HEX(ENCODE('note ' || CAST(event_id AS VARCHAR))) END AS hex FROM sv WHERE event_id % 3 = 0 OR op_code = 2")
def large_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survivors(spark, sf_dir).withColumn("note", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("note "), F.col("event_id").cast("string"))))
    return render.large_value_records(rows, {"NOTE": "note"}, "user_id").withColumn("hex", F.hex("data")).drop("data")


@query("s15_dead_letters", f"WITH {d.ROWS_SQL} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'unsupported' ELSE 'decode-error' END AS kind, 'bad literal' AS exception, CASE WHEN tab <> 'CARTS' THEN 'sql ' || CAST(event_id AS VARCHAR) END AS sql_redo FROM e WHERE event_id % 101 = 5")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    rows = d.data_rows(spark, sf_dir).withColumn("sql_redo", F.concat(F.lit("sql "), eid.cast("string"))).withColumn("op_code", F.when(eid % 2 == 0, 255).otherwise(F.col("op_code")))
    return render.dead_letters(rows, F.when(eid % 101 == 5, "bad literal"), "sql_redo", F.col("tab") == "CARTS").select("event_id", "kind", "exception", "sql_redo")


#: A table a brand, a column a part; some names are secret, in either case.
COLUMNS = Portable("cols", "part", {"id": "p_partkey", "fqn": "'P.APP.' || p_brand", "col": choice("p_partkey", "p_type", "'SECRET_' || p_type", "'secret_' || p_name", "p_name")})


@query("p6_p7_column_exclusion", f"WITH {COLUMNS.sql} SELECT id, p_partkey % 4 IN (1, 2) AS excluded, EXISTS (SELECT 1 FROM part q WHERE q.p_brand = part.p_brand AND q.p_partkey % 4 IN (1, 2)) AS statement_withheld FROM cols JOIN part ON p_partkey = id")
def column_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's statements are withheld where one of its columns is excluded: told once a table, and joined."""
    rows = COLUMNS.df(spark, sf_dir).withColumn("excluded", scans.whole(F.concat_ws(".", "fqn", "col"), [r".*\.SECRET_.*"]))
    tables = rows.groupBy("fqn").agg(F.max("excluded").alias("statement_withheld"))
    return rows.join(tables, "fqn").select("id", "excluded", "statement_withheld")
