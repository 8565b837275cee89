"""Scans, filters, classification, transaction assembly and ordering over the derived log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.codes import ROW_CODES, SYSTEM_OWNERS, TX_CODES
from tidelog.operators import scans
from tidelog.operators import transactions as t
from tidelog.plans.registry import query
from tidelog.sources import derived as d
from tidelog.sources.portable import Portable, choice
from tidelog.sources.static import Static

TX = d.TX


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    return t.committed(rows, d.transactions(rows))


@query(
    "flagship_changes_by_table",
    f"WITH {d.SURVIVORS_SQL} SELECT tab, op_code, CAST(COUNT(*) AS BIGINT) AS changes, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM sv GROUP BY tab, op_code",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(spark, sf_dir).groupBy("tab", "op_code").agg(F.count("*").alias("changes"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@query("k1_w1_w2_committed_changes", f"WITH {d.SURVIVORS_SQL} SELECT con_id, user_id, sqn, scn, commit_scn, tab, rid, op_code, event_index, event_count, event_index + 1 AS total_order, collection_order FROM sv")
def committed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(spark, sf_dir).select(*TX, "scn", "commit_scn", "tab", "rid", "op_code", "event_index", "event_count", (F.col("event_index") + 1).alias("total_order"), "collection_order")


@query("w3_k2_undo_matching", f"WITH {d.SURVIVORS_SQL} SELECT con_id, user_id, sqn, CAST(SUM(CASE WHEN NOT undo AND (fut IS NULL OR fut >= depth) THEN 1 ELSE 0 END) AS BIGINT) AS standing, CAST(SUM(CASE WHEN undo THEN 1 ELSE 0 END) AS BIGINT) AS undo_rows FROM s3 GROUP BY con_id, user_id, sqn")
def undo_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = t.mark_survivors(d.data_rows(spark, sf_dir))
    return marked.groupBy(*TX).agg(F.sum(F.col("survives").cast("long")).alias("standing"), F.sum(F.col("undo").cast("long")).alias("undo_rows"))


@query(
    "a11_buffer_statistics",
    f"""WITH {d.SURVIVORS_SQL},
    m AS (SELECT s3.*, LEAST(0, MIN(s) OVER (PARTITION BY con_id, user_id, sqn, rid ORDER BY scn ROWS UNBOUNDED PRECEDING)) AS low FROM s3),
    u AS (SELECT m.*, undo AND low < COALESCE(LAG(low) OVER (PARTITION BY con_id, user_id, sqn, rid ORDER BY scn), 0) AS unmatched, NOT undo AND (fut IS NULL OR fut >= depth) AS standing FROM m),
    p AS (SELECT u.con_id, u.user_id, u.sqn, MAX(end_code) AS end_code, MIN(start_scn) AS start_scn, SUM(CAST(standing AS INT)) AS kept, SUM(CAST(NOT undo AND NOT standing AS INT)) AS undone, SUM(CAST(unmatched AS INT)) AS unmatched
          FROM u JOIN tx ON u.con_id = tx.con_id AND u.user_id = tx.user_id AND u.sqn = tx.sqn GROUP BY u.con_id, u.user_id, u.sqn)
    SELECT CAST(SUM(CASE WHEN end_code IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS open_transactions, CAST(SUM(CASE WHEN end_code = 7 THEN 1 ELSE 0 END) AS BIGINT) AS committed,
      CAST(SUM(CASE WHEN end_code = 36 THEN 1 ELSE 0 END) AS BIGINT) AS rolled_back, CAST(SUM(CASE WHEN end_code IS NULL THEN kept ELSE 0 END) AS BIGINT) AS buffered_changes,
      CAST(SUM(undone) AS BIGINT) AS undone, CAST(SUM(unmatched) AS BIGINT) AS unmatched_undos, MIN(CASE WHEN end_code IS NULL THEN start_scn END) AS oldest_open_scn FROM p""",
)
def buffer_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    return t.buffer_statistics(rows, d.transactions(rows))


MINED_SQL = f"""{d.ROWS_SQL},
mined AS (
  SELECT con_id, user_id, sqn, scn, op_code, tab, rid, undo FROM e
  UNION ALL SELECT con_id, user_id, sqn, start_scn, 6, NULL, NULL, FALSE FROM tx
  UNION ALL SELECT con_id, user_id, sqn, end_scn, end_code, NULL, NULL, FALSE FROM tx WHERE end_code IS NOT NULL)"""


@query("s1_p1_range_scan", f"WITH {MINED_SQL} SELECT con_id, user_id, sqn, scn, op_code, tab, rid FROM mined WHERE scn >= 5000 AND scn < 20000 AND op_code IN (1, 2, 3, 9, 10, 11, 29, 255)")
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.range_scan(d.mined(d.data_rows(spark, sf_dir)), 5000, 20000, ROW_CODES).select(*TX, "scn", "op_code", "tab", "rid")


@query("p8_event_kinds", f"""WITH {MINED_SQL} SELECT CASE WHEN op_code = 6 THEN 'tx_start' WHEN op_code = 7 THEN 'commit' WHEN op_code = 36 THEN 'rollback' WHEN op_code = 5 THEN 'ddl' WHEN op_code = 34 THEN 'missing_scn'
    WHEN op_code = 255 THEN 'unsupported' WHEN undo THEN 'undo' WHEN op_code IN (1, 2, 3, 9, 10, 11, 29) THEN 'dml' ELSE 'other' END AS kind, CAST(COUNT(*) AS BIGINT) AS n FROM mined GROUP BY 1""")
def event_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.mined(d.data_rows(spark, sf_dir)).groupBy(scans.event_kind().alias("kind")).agg(F.count("*").alias("n"))


ADDRESSED_SQL = """addressed AS (
  SELECT event_id, CAST(1 + user_id % 2 AS BIGINT) AS thread, event_id * 10 + 1000 AS scn,
         CASE WHEN event_id % 97 = 0 THEN '000000.00000000.0000' ELSE CONCAT(LPAD(CAST(FLOOR(event_id / 8.0) AS BIGINT)::VARCHAR, 12, '0'), ' ') END AS rs_id, event_id % 8 AS ssn FROM events)"""


def addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, eid = d.events(spark, sf_dir), F.col("event_id")
    rs = F.when(eid % 97 == 0, scans.ZERO_ADDRESS).otherwise(F.concat(F.lpad(F.floor(eid / 8).cast("string"), 12, "0"), F.lit(" ")))
    return ev.select("event_id", (F.col("user_id") % 2 + 1).cast("long").alias("thread"), (eid * 10 + 1000).alias("scn"), rs.alias("rs_id"), (eid % 8).alias("ssn"))


CURSOR = Static("cur", "thread long, rs_id string, ssn long, scn long", ((1, "000000000050", 3, 5030),))


@query(
    "s2_cursor_scan",
    f"""WITH {ADDRESSED_SQL}, {CURSOR.sql}
    SELECT a.event_id, a.thread FROM addressed a LEFT JOIN cur c ON a.thread = c.thread
    WHERE CASE WHEN a.rs_id = '000000.00000000.0000' THEN a.scn >= 5030
               WHEN c.thread IS NOT NULL THEN RTRIM(a.rs_id) > c.rs_id OR (RTRIM(a.rs_id) = c.rs_id AND a.ssn > c.ssn)
               ELSE a.scn >= 5030 END""",
)
def cursor_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.cursor_scan(addressed(spark, sf_dir), CURSOR.df(spark), 5030).select("event_id", "thread")


@query("t1_redo_order", f"WITH {ADDRESSED_SQL} SELECT event_id, thread, CAST(ROW_NUMBER() OVER (PARTITION BY thread ORDER BY RTRIM(rs_id), ssn, scn, event_id) AS BIGINT) AS place FROM addressed WHERE rs_id <> '000000.00000000.0000'")
def redo_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = addressed(spark, sf_dir).where(F.col("rs_id") != scans.ZERO_ADDRESS)
    order = Window.partitionBy("thread").orderBy(*t.redo_key()[1:], "event_id")
    return rows.select("event_id", "thread", F.row_number().over(order).cast("long").alias("place"))


@query("p25_zero_address_rule", f"WITH {ADDRESSED_SQL} SELECT thread, CAST(COUNT(*) AS BIGINT) AS zero_rows, MIN(scn) AS first_stop FROM addressed WHERE rs_id = '000000.00000000.0000' GROUP BY thread")
def zero_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addressed(spark, sf_dir).where(F.col("rs_id") == scans.ZERO_ADDRESS).groupBy("thread").agg(F.count("*").alias("zero_rows"), F.min("scn").alias("first_stop"))


@query("p24_already_applied", f"WITH {ADDRESSED_SQL}, marks AS (SELECT thread, MAX(scn) AS mark FROM addressed WHERE event_id % 3 = 0 AND event_id < 500 GROUP BY thread) SELECT a.event_id FROM addressed a LEFT JOIN marks m ON a.thread = m.thread WHERE m.mark IS NULL OR a.scn > m.mark")
def already_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = addressed(spark, sf_dir)
    marks = rows.where("event_id % 3 = 0 and event_id < 500").groupBy("thread").agg(F.max("scn").alias("mark"))
    return scans.not_applied(rows, marks, "thread", "scn").select("event_id")


PARTS_SQL = """parts AS (
  SELECT o_orderkey AS xid, n.k AS k, o_orderkey * 10 + n.k AS pos, CONCAT('part', CAST(n.k AS VARCHAR), ' of ', CAST(o_orderkey AS VARCHAR), '; ') AS txt,
         CASE WHEN n.k < o_orderkey % 3 OR o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS csf
  FROM orders CROSS JOIN (VALUES (0), (1), (2)) AS n(k) WHERE n.k <= o_orderkey % 3)"""


@query(
    "s3_continuation_join",
    f"""WITH {PARTS_SQL}, i AS (SELECT parts.*, COALESCE(SUM(CASE WHEN csf = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY xid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM parts)
    SELECT xid, STRING_AGG(txt, '' ORDER BY pos) AS statement, CAST(COUNT(*) AS BIGINT) AS n FROM i GROUP BY xid, island HAVING MIN(csf) = 0""",
)
def continuation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    parts = spark.read.parquet(f"{sf_dir}/orders.parquet").select(key.alias("xid"), F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))).alias("k"))
    parts = parts.select("xid", (F.col("xid") * 10 + F.col("k")).alias("pos"), F.concat(F.lit("part"), F.col("k").cast("string"), F.lit(" of "), F.col("xid").cast("string"), F.lit("; ")).alias("txt"), F.when((F.col("k") < F.col("xid") % 3) | (F.col("xid") % 50 == 0), 1).otherwise(0).alias("csf"))
    return scans.join_continuations(parts, ["xid"], "pos", "txt", "csf").select("xid", "statement", "n")


OBJECTS = Static("objects", "con_id long, tab string, obj_id long", ((1, "ITEMS", 70), (2, "ITEMS", 70), (1, "CARTS", 71)))


@query("p2_captured_objects", f"WITH {d.ROWS_SQL}, {OBJECTS.sql} SELECT e.event_id FROM e WHERE EXISTS (SELECT 1 FROM objects o WHERE o.con_id = e.con_id AND o.tab = e.tab)")
def captured_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.data_rows(spark, sf_dir).join(F.broadcast(OBJECTS.df(spark)), ["con_id", "tab"], "left_semi").select("event_id")  # the literal table above


@query("j1_object_names", f"WITH {d.ROWS_SQL}, {OBJECTS.sql} SELECT COALESCE('APP.' || o.tab, CONCAT('OBJ# ', CAST(70 + CAST(e.tab = 'CARTS' AS INT) AS VARCHAR))) AS name, CAST(COUNT(*) AS BIGINT) AS n FROM e LEFT JOIN objects o ON o.con_id = e.con_id AND o.tab = e.tab GROUP BY 1")
def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("obj_id", F.when(F.col("tab") == "CARTS", 71).otherwise(70))
    return scans.resolve_objects(rows, OBJECTS.df(spark).withColumnRenamed("tab", "object")).groupBy("name").agg(F.count("*").alias("n"))


USERS_SQL = f"{MINED_SQL}, named AS (SELECT mined.*, CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'BATCH' ELSE 'APP' END AS username FROM mined)"


@query("p3_user_exclusion", f"WITH {USERS_SQL} SELECT op_code, CAST(COUNT(*) AS BIGINT) AS n FROM named WHERE op_code = 5 OR username IS NULL OR username NOT IN ('BATCH') GROUP BY op_code")
def user_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.mined(d.data_rows(spark, sf_dir))
    named = rows.withColumn("username", F.when(F.col("user_id") % 4 == 0, F.lit(None)).when(F.col("user_id") % 4 == 1, "BATCH").otherwise("APP"))
    return named.where(scans.user_allowed(["BATCH"])).groupBy("op_code").agg(F.count("*").alias("n"))


DDL_OWNERS = Portable("ddl", "customer", {"id": "c_custkey", "owner": choice("c_custkey", "'SYS'", "c_mktsegment", "'XDB'", "NULL", "'app' || CAST(c_nationkey AS STRING)", "'OJVMSYS'", "'GGSYS_' || CAST(c_nationkey AS STRING)")})


@query("p4_system_owners", "SELECT c_custkey AS id FROM customer WHERE c_custkey % 7 NOT IN (0, 2, 5)")
def system_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DDL_OWNERS.df(spark, sf_dir).where(F.col("owner").isNull() | ~F.col("owner").isin(SYSTEM_OWNERS)).select("id")


NAMES = Portable("names", "supplier", {"id": "s_suppkey", "pdb": "'P' || CAST(s_suppkey % 4 AS STRING)", "fqn": "'P' || CAST(s_suppkey % 4 AS STRING) || " + choice("s_suppkey", "'.APP.ITEMS'", "'.app.t'", "'.HR.PEOPLE'", "'.App.T'", "'.XAPP.T'") + " || CAST(s_nationkey AS STRING) || " + choice("s_nationkey", "''", "'_OLD'", "'_old'")})


@query("p5_table_patterns", "SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 4 IN (1, 2) AND s_suppkey % 5 IN (0, 1, 3) AND s_nationkey % 3 = 0")
def table_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NAMES.df(spark, sf_dir).where(scans.table_selected("fqn", [r".*\.app\..*"], [r".*_OLD"], pdb="pdb", pdbs=["P1", "P2"])).select("id")


@query(
    "p23_first_start_scope",
    f"""WITH {MINED_SQL}, r AS (SELECT m.*, MAX(CASE WHEN op_code = 6 AND scn >= 3000 THEN 1 ELSE 0 END) OVER (PARTITION BY con_id, user_id, sqn ORDER BY scn ROWS UNBOUNDED PRECEDING) AS started FROM mined m)
    SELECT con_id, user_id, sqn, scn, op_code FROM r WHERE scn >= 6000 OR started = 1 OR (user_id % 5 = 0 AND sqn = 0)""",
)
def first_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.mined(d.data_rows(spark, sf_dir))
    open_at_start = rows.where("user_id % 5 = 0 and sqn = 0").select(*TX).distinct()
    return scans.first_start_scope(rows, open_at_start, floor=6000, open_scn=3000, tx=TX).select(*TX, "scn", "op_code")


@query("t2_commit_order", f"WITH {d.ROWS_SQL} SELECT con_id, user_id, sqn, CAST(ROW_NUMBER() OVER (ORDER BY end_scn, con_id, user_id, sqn) AS BIGINT) AS place FROM tx WHERE end_code = 7")
def commit_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = d.transactions(d.data_rows(spark, sf_dir)).where("end_code = 7")
    return scans.global_place(tx, "end_scn", [F.col(c) for c in ("end_scn", *TX)]).select(*TX, "place")


@query(
    "t3_top_open_transactions",
    f"WITH {d.ROWS_SQL} SELECT tx.con_id, tx.user_id, tx.sqn, tx.start_scn, CAST(SUM(160 + 2 * LENGTH(rid)) AS BIGINT) AS bytes FROM e JOIN tx ON e.con_id = tx.con_id AND e.user_id = tx.user_id AND e.sqn = tx.sqn WHERE end_code IS NULL GROUP BY ALL ORDER BY bytes DESC, start_scn LIMIT 10",
)
def top_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    sized = rows.join(d.transactions(rows).where("end_code is null"), TX).groupBy(*TX, "start_scn").agg(F.sum(160 + 2 * F.length("rid")).cast("long").alias("bytes"))
    return sized.orderBy(F.desc("bytes"), "start_scn").limit(10)  # a top-k report


@query(
    "t6_spill_victims",
    f"""WITH {d.ROWS_SQL}, z AS (SELECT tx.con_id, tx.user_id, tx.sqn, CAST(SUM(160 + 2 * LENGTH(rid)) AS BIGINT) AS bytes FROM e JOIN tx ON e.con_id = tx.con_id AND e.user_id = tx.user_id AND e.sqn = tx.sqn WHERE end_code IS NULL GROUP BY ALL),
    r AS (SELECT z.*, SUM(bytes) OVER (PARTITION BY con_id) - COALESCE(SUM(bytes) OVER (PARTITION BY con_id ORDER BY bytes DESC, user_id, sqn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held FROM z)
    SELECT con_id, user_id, sqn, bytes FROM r WHERE held > 20000""",
)
def spill_victims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    sized = rows.join(d.transactions(rows).where("end_code is null"), TX).groupBy(*TX).agg(F.sum(160 + 2 * F.length("rid")).cast("long").alias("bytes"))
    return scans.spill_victims(sized, ["con_id"], "bytes", ["user_id", "sqn"], budget=20000).select(*TX, "bytes")


@query("a13_oldest_open_by_thread", f"WITH {d.ROWS_SQL} SELECT con_id AS thread, MIN(start_scn) AS oldest FROM tx WHERE end_code IS NULL GROUP BY con_id")
def oldest_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.transactions(d.data_rows(spark, sf_dir)).where("end_code is null").groupBy(F.col("con_id").alias("thread")).agg(F.min("start_scn").alias("oldest"))


@query("a12_size_estimate", f"WITH {d.ROWS_SQL} SELECT event_id, CAST(160 + 2 * LENGTH(rid) + 32 + (48 + 2 * LENGTH('TAB') + 2 * LENGTH(tab)) + (48 + 2 * LENGTH('VALUE') + 8) AS BIGINT) AS bytes FROM e")
def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("image", F.create_map(F.lit("TAB"), 2 * F.length("tab"), F.lit("VALUE"), F.lit(8)))
    return rows.select("event_id", scans.estimated_size("rid", "image").cast("long").alias("bytes"))


@query(
    "k3_partial_rollback",
    f"""WITH {d.SURVIVORS_SQL}, k AS (SELECT con_id, user_id, sqn, SUM(CASE WHEN NOT undo AND (fut IS NULL OR fut >= depth) THEN 1 ELSE 0 END) AS kept FROM s3 GROUP BY con_id, user_id, sqn)
    SELECT k.con_id, k.user_id, k.sqn, kept = 0 AS ends FROM k JOIN tx ON k.con_id = tx.con_id AND k.user_id = tx.user_id AND k.sqn = tx.sqn WHERE end_code = 36""",
)
def partial_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    kept = t.mark_survivors(rows).groupBy(*TX).agg(F.max("survives").alias("kept"))
    return kept.join(d.transactions(rows).where("end_code = 36"), TX).select(*TX, (~F.col("kept")).alias("ends"))


SLOTS_SQL = """slots AS (SELECT event_id, CAST(1 + user_id % 2 AS BIGINT) AS con_id, user_id % 7 AS slot, event_id % 5 = 4 AS partial, event_id % 11 = 10 AS ends, CASE WHEN event_id % 5 = 4 THEN NULL ELSE user_id END AS sq FROM events)"""


@query(
    "j12_partial_xid",
    f"""WITH {SLOTS_SQL}, l AS (SELECT s.*, COALESCE(SUM(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY con_id, slot ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM slots s),
    m AS (SELECT l.*, MAX(sq) OVER (PARTITION BY con_id, slot, life ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_sq FROM l)
    SELECT event_id, COALESCE(sq, open_sq) AS resolved FROM m WHERE sq IS NOT NULL OR open_sq IS NOT NULL""",
)
def partial_xid(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    slots = d.events(spark, sf_dir).select("event_id", (F.col("user_id") % 2 + 1).cast("long").alias("con_id"), (F.col("user_id") % 7).alias("slot"), (eid % 11 == 10).alias("ends"), F.when(eid % 5 != 4, F.col("user_id")).alias("sq"))
    return scans.resolve_partial(slots, ["con_id", "slot"], "event_id", "sq", "ends").select("event_id", "resolved")


@query("u1_union_all", f"WITH {d.ROWS_SQL} SELECT tab AS name, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT tab FROM e WHERE con_id = 1 UNION ALL SELECT tab FROM e WHERE con_id = 2) GROUP BY tab")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    return rows.where("con_id = 1").select("tab").unionByName(rows.where("con_id = 2").select("tab")).groupBy(F.col("tab").alias("name")).agg(F.count("*").alias("n"))


assert set(TX_CODES) == {6, 7, 36}
