"""A change log derived from the ``events`` table: data rows, transactions and log files.

An event is a data row of the transaction (container, user, week); ``error`` events are undo rows. Each
transaction has a start one position before its first row and an end one after its last: a commit (7), a
rollback (36) or none while it is open. The same derivation is kept as SQL for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.codes import COMMIT, DELETE, INSERT, ROLLBACK, START, UPDATE

TX = ["con_id", "user_id", "sqn"]

ROWS_SQL = """
e AS (
  SELECT event_id, ts, user_id, value, CAST(FLOOR((EXTRACT(DAY FROM ts) - 1) / 7.0) AS BIGINT) AS sqn,
         event_id * 10 + 1000 AS scn, CAST(1 + user_id % 2 AS BIGINT) AS con_id,
         CASE WHEN event_id % 2 = 0 THEN 'ITEMS' ELSE 'CARTS' END AS tab,
         CONCAT('R', CAST(event_id % 5 AS VARCHAR(20))) AS rid,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS op_code,
         event_type = 'error' AS undo
  FROM events),
tx AS (
  SELECT con_id, user_id, sqn, MIN(scn) - 1 AS start_scn, MAX(scn) + 1 AS end_scn,
         CASE WHEN (user_id + sqn) % 11 = 0 THEN NULL WHEN (user_id + sqn) % 7 = 0 THEN 36 ELSE 7 END AS end_code
  FROM e GROUP BY con_id, user_id, sqn)"""

SURVIVORS_SQL = f"""{ROWS_SQL},
s1 AS (SELECT e.*, SUM(CASE WHEN undo THEN -1 ELSE 1 END) OVER (PARTITION BY con_id, user_id, sqn, rid ORDER BY scn ROWS UNBOUNDED PRECEDING) AS s FROM e),
s2 AS (SELECT s1.*, s - LEAST(0, MIN(s) OVER (PARTITION BY con_id, user_id, sqn, rid ORDER BY scn ROWS UNBOUNDED PRECEDING)) AS depth FROM s1),
s3 AS (SELECT s2.*, MIN(depth) OVER (PARTITION BY con_id, user_id, sqn, rid ORDER BY scn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS fut FROM s2),
sv AS (
  SELECT s3.con_id, s3.user_id, s3.sqn, s3.scn, tx.start_scn, tx.end_scn AS commit_scn, s3.tab, s3.rid, s3.op_code, s3.value, s3.ts, s3.event_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY s3.con_id, s3.user_id, s3.sqn ORDER BY s3.scn) - 1 AS BIGINT) AS event_index,
         CAST(COUNT(*) OVER (PARTITION BY s3.con_id, s3.user_id, s3.sqn) AS BIGINT) AS event_count,
         CAST(ROW_NUMBER() OVER (PARTITION BY s3.con_id, s3.user_id, s3.sqn, s3.tab ORDER BY s3.scn) AS BIGINT) AS collection_order
  FROM s3 JOIN tx ON s3.con_id = tx.con_id AND s3.user_id = tx.user_id AND s3.sqn = tx.sqn
  WHERE NOT undo AND (fut IS NULL OR fut >= depth) AND end_code = 7)"""

LOGS_SQL = """
g AS (
  SELECT CAST(1 + user_id % 2 AS BIGINT) AS thread, CAST(FLOOR(event_id / 64.0) AS BIGINT) + 1 AS seq,
         MIN(event_id * 10 + 1000) AS first_scn, CAST(COUNT(*) * 1048576 AS BIGINT) AS bytes, MIN(ts) AS first_time, MAX(ts) AS next_time
  FROM events GROUP BY CAST(1 + user_id % 2 AS BIGINT), CAST(FLOOR(event_id / 64.0) AS BIGINT) + 1),
logs AS (
  SELECT thread, seq, first_scn, COALESCE(LEAD(first_scn) OVER (PARTITION BY thread ORDER BY seq), 9223372036854775807) AS next_scn,
         bytes, first_time, next_time, (seq * 7 + thread) % 13 = 5 AS deleted FROM g)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def data_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``e``: one data or undo row for each event."""
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.floor((F.dayofmonth("ts") - 1) / 7).cast("long").alias("sqn"),
        (F.col("event_id") * 10 + 1000).alias("scn"),
        (F.col("user_id") % 2 + 1).cast("long").alias("con_id"),
        F.when(F.col("event_id") % 2 == 0, "ITEMS").otherwise("CARTS").alias("tab"),
        F.concat(F.lit("R"), (F.col("event_id") % 5).cast("string")).alias("rid"),
        F.when(kind == "signup", INSERT).when(kind == "purchase", DELETE).otherwise(UPDATE).alias("op_code"),
        (kind == "error").alias("undo"),
    )


def transactions(rows: DataFrame) -> DataFrame:
    """``tx``: bounds and end code of each transaction."""
    key = F.col("user_id") + F.col("sqn")
    return rows.groupBy(*TX).agg((F.min("scn") - 1).alias("start_scn"), (F.max("scn") + 1).alias("end_scn")).withColumn(
        "end_code", F.when(key % 11 == 0, F.lit(None).cast("int")).when(key % 7 == 0, ROLLBACK).otherwise(COMMIT)
    )


def mined(rows: DataFrame) -> DataFrame:
    """Data and control rows as one log: kind of each row by its operation code."""
    tx = transactions(rows)
    none = lambda kind: F.lit(None).cast(kind)
    control = lambda scn, code: tx.select(*TX, F.col(scn).alias("scn"), code.cast("int").alias("op_code"), none("string").alias("tab"), none("string").alias("rid"), F.lit(False).alias("undo"), none("double").alias("value"), none("timestamp_ntz").alias("ts"))
    data = rows.select(*TX, "scn", F.col("op_code").cast("int").alias("op_code"), "tab", "rid", "undo", "value", "ts")
    return data.unionByName(control("start_scn", F.lit(START))).unionByName(control("end_scn", F.col("end_code")).where("op_code is not null"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files as position intervals by thread."""
    made = events(spark, sf_dir).groupBy(
        (F.col("user_id") % 2 + 1).cast("long").alias("thread"), (F.floor(F.col("event_id") / 64).cast("long") + 1).alias("seq")
    ).agg(F.min(F.col("event_id") * 10 + 1000).alias("first_scn"), (F.count("*") * 1048576).alias("bytes"), F.min("ts").alias("first_time"), F.max("ts").alias("next_time"))
    by_seq = Window.partitionBy("thread").orderBy("seq")
    return made.withColumn("next_scn", F.coalesce(F.lead("first_scn").over(by_seq), F.lit(9223372036854775807))).withColumn(
        "deleted", (F.col("seq") * 7 + F.col("thread")) % 13 == 5
    ).select("thread", "seq", "first_scn", "next_scn", "bytes", "first_time", "next_time", "deleted")
