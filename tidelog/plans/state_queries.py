"""State, comparison and delivery queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.operators import state
from tidelog.plans.registry import query
from tidelog.plans.transaction_queries import survivors
from tidelog.sources import derived as d

TX = d.TX
CENTS = "cast(round(value * 100) as bigint) as cents"
CH_SQL = f"{d.SURVIVORS_SQL}, ch AS (SELECT tab, user_id, scn, commit_scn, op_code, CAST(ROUND(value * 100) AS BIGINT) AS cents, commit_scn * 1000000 + event_index AS pos, event_id FROM sv)"
LAST_SQL = "(SELECT *, ROW_NUMBER() OVER (PARTITION BY tab, user_id ORDER BY pos DESC) AS rn FROM ch{where})"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(spark, sf_dir).select("tab", "user_id", "scn", "commit_scn", "op_code", F.expr(CENTS), (F.col("commit_scn") * 1000000 + F.col("event_index")).alias("pos"), "event_id")


@query("j6_materialise", f"WITH {CH_SQL} SELECT tab, user_id, cents, scn FROM {LAST_SQL.format(where='')} WHERE rn = 1 AND op_code <> 2")
def materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(changes(spark, sf_dir), ["tab", "user_id"], "pos").select("tab", "user_id", "cents", "scn")


CUT = 40_000


@query("s8_p26_state_as_of", f"WITH {CH_SQL} SELECT tab, user_id, cents FROM {LAST_SQL.format(where=f' WHERE commit_scn <= {CUT}')} WHERE rn = 1 AND op_code <> 2")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(changes(spark, sf_dir).where(F.col("commit_scn") <= CUT), ["tab", "user_id"], "pos").select("tab", "user_id", "cents")


@query("p26_check_position_classes", f"WITH {CH_SQL} SELECT CAST(SUM(CASE WHEN commit_scn <= {CUT} THEN 1 ELSE 0 END) AS BIGINT) AS applied, CAST(SUM(CASE WHEN commit_scn > {CUT} THEN 1 ELSE 0 END) AS BIGINT) AS later FROM ch")
def check_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).agg(F.count_if(F.col("commit_scn") <= CUT).alias("applied"), F.count_if(F.col("commit_scn") > CUT).alias("later"))


@query(
    "j7_carry_forward",
    f"""WITH {CH_SQL}, u AS (SELECT ch.*, event_id % 4 <> 1 AS known, COALESCE(SUM(CASE WHEN op_code = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY tab, user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM ch),
    k AS (SELECT u.*, MAX(CASE WHEN known THEN pos END) OVER (PARTITION BY tab, user_id, life ORDER BY pos ROWS UNBOUNDED PRECEDING) AS src FROM u)
    SELECT k.tab, k.user_id, k.pos, v.cents, k.src IS NOT NULL AS resolved FROM k LEFT JOIN ch v ON v.tab = k.tab AND v.user_id = k.user_id AND v.pos = k.src""",
)
def carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.carry_forward(changes(spark, sf_dir), ["tab", "user_id"], "pos", "cents", F.col("event_id") % 4 != 1).select("tab", "user_id", "pos", "cents", "resolved")


SIDES_SQL = f"""{CH_SQL}, db AS (SELECT tab, user_id, cents FROM {LAST_SQL.format(where='')} WHERE rn = 1 AND op_code <> 2),
  tp AS (SELECT tab, user_id, CASE WHEN user_id % 13 = 3 THEN cents + 1 ELSE cents END AS cents FROM db WHERE user_id % 11 <> 4 UNION ALL SELECT tab, user_id + 1000000, cents FROM db WHERE user_id % 17 = 5)"""


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    db = materialise(spark, sf_dir).select("tab", "user_id", "cents")
    kept = db.where("user_id % 11 <> 4").withColumn("cents", F.when(F.col("user_id") % 13 == 3, F.col("cents") + 1).otherwise(F.col("cents")))
    return db, kept.unionByName(db.where("user_id % 17 = 5").withColumn("user_id", F.col("user_id") + 1000000))


@query(
    "j4_state_diff",
    f"""WITH {SIDES_SQL} SELECT COALESCE(db.tab, tp.tab) AS tab, COALESCE(db.user_id, tp.user_id) AS user_id, CASE WHEN tp.tab IS NULL THEN 'missing' WHEN db.tab IS NULL THEN 'extra' ELSE 'mismatch' END AS status
    FROM db FULL OUTER JOIN tp ON db.tab = tp.tab AND db.user_id = tp.user_id WHERE tp.tab IS NULL OR db.tab IS NULL OR db.cents IS DISTINCT FROM tp.cents""",
)
def state_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.diff(*sides(spark, sf_dir), ["tab", "user_id"], ["cents"])


@query("j5_u2_missing_and_extra", f"WITH {SIDES_SQL} SELECT 'missing' AS side, tab, user_id FROM (SELECT tab, user_id FROM db EXCEPT SELECT tab, user_id FROM tp) UNION ALL SELECT 'extra', tab, user_id FROM (SELECT tab, user_id FROM tp EXCEPT SELECT tab, user_id FROM db)")
def missing_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, tp = sides(spark, sf_dir)
    key = ["tab", "user_id"]
    return db.join(tp, key, "left_anti").select(F.lit("missing").alias("side"), *key).unionByName(tp.join(db, key, "left_anti").select(F.lit("extra").alias("side"), *key))


@query("u4_keys_on_both_sides", f"WITH {SIDES_SQL} SELECT tab, user_id FROM db INTERSECT SELECT tab, user_id FROM tp")
def both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, tp = sides(spark, sf_dir)
    return db.select("tab", "user_id").intersect(tp.select("tab", "user_id"))


@query("j15_key_only_resolve", f"WITH {SIDES_SQL} SELECT db.tab, db.user_id, COALESCE(tp.cents, db.cents) AS cents, tp.tab IS NOT NULL AS resolved FROM db LEFT JOIN tp ON db.tab = tp.tab AND db.user_id = tp.user_id")
def key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, tp = sides(spark, sf_dir)
    other = tp.withColumnRenamed("cents", "_c").withColumn("_on", F.lit(True))
    return db.join(other, ["tab", "user_id"], "left").select("tab", "user_id", F.coalesce("_c", "cents").alias("cents"), F.col("_on").isNotNull().alias("resolved"))


MULTI_SQL = f"{d.ROWS_SQL}, m AS (SELECT tab, rid, user_id % 20 AS u, CAST(SUM(CASE op_code WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END) AS BIGINT) AS copies FROM e GROUP BY ALL)"


@query("a10_multiset_copies", f"WITH {MULTI_SQL} SELECT * FROM m WHERE copies <> 0")
def multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("u", F.col("user_id") % 20)
    return state.multiset(rows, ["tab", "rid", "u"], F.when(F.col("op_code") == 1, 1).when(F.col("op_code") == 2, -1).otherwise(0))


@query("u3_multiset_difference", "SELECT user_id % 50 AS u, event_type FROM events WHERE event_id % 2 = 0 EXCEPT ALL SELECT user_id % 50, event_type FROM events WHERE event_id % 2 = 1")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.events(spark, sf_dir).select((F.col("user_id") % 50).alias("u"), "event_type", "event_id")
    return rows.where("event_id % 2 = 0").drop("event_id").exceptAll(rows.where("event_id % 2 = 1").drop("event_id"))


@query(
    "a9_table_hash",
    "WITH RECURSIVE h AS (SELECT sha256(CAST(o_orderkey AS VARCHAR) || chr(30) || '[\"' || o_orderstatus || '\"]') AS x FROM orders), "
    "l AS (SELECT COUNT(*) AS n, " + ", ".join(f"CAST(SUM(CAST('0x' || SUBSTR(x, {8 * k + 1}, 8) AS UBIGINT)) AS HUGEINT) AS l{k}" for k in range(8)) + " FROM h), "
    "c7 AS (SELECT *, l7 AS t7 FROM l), " + ", ".join(f"c{k} AS (SELECT *, l{k} + (t{k + 1} // 4294967296) AS t{k} FROM c{k + 1})" for k in reversed(range(7))) + " "
    "SELECT CAST(n AS BIGINT) AS row_count, " + " || ".join(f"LPAD(LOWER(TO_HEX(CAST(t{k} % 4294967296 AS BIGINT))), 8, '0')" for k in range(8)) + " AS hash FROM c0",
)
def table_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return state.table_hash(rows, F.col("o_orderkey").cast("string"), F.concat(F.lit('["'), "o_orderstatus", F.lit('"]')), F.lit(1))


DELIVERED_SQL = f"""{d.SURVIVORS_SQL}, dl AS (
  SELECT con_id, user_id, sqn, event_index, event_count, op_code, commit_scn, event_id, user_id % 4 AS part, commit_scn * 1000 + event_index AS off FROM sv WHERE event_id % 53 <> 7
  UNION ALL SELECT con_id, user_id, sqn, event_index, event_count, op_code, commit_scn, event_id, user_id % 4, commit_scn * 1000 + event_index + 90000000 FROM sv WHERE event_id % 29 = 3 AND event_id % 53 <> 7)"""


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survivors(spark, sf_dir).where("event_id % 53 <> 7").select(*TX, "event_index", "event_count", "op_code", "commit_scn", "event_id", (F.col("user_id") % 4).alias("part"), (F.col("commit_scn") * 1000 + F.col("event_index")).alias("off"))
    return rows.unionByName(rows.where("event_id % 29 = 3").withColumn("off", F.col("off") + 90000000))


@query("a8_transaction_invariants", f"WITH {DELIVERED_SQL} SELECT con_id, user_id, sqn, CAST(COUNT(DISTINCT event_index) AS BIGINT) AS indexes, CAST(MAX(event_count) - COUNT(DISTINCT event_index) AS BIGINT) AS gaps, CAST(COUNT(*) - COUNT(DISTINCT (event_index, op_code)) AS BIGINT) AS duplicates, MAX(event_count) <> MIN(event_count) AS count_mismatch FROM dl GROUP BY con_id, user_id, sqn")
def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.transaction_invariants(delivered(spark, sf_dir), TX, "event_index", "event_count", "op_code")


@query("k9_redeliveries", f"WITH {DELIVERED_SQL}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY con_id, user_id, sqn, event_index, op_code ORDER BY off) AS rn FROM dl) SELECT part, CAST(SUM(CASE WHEN rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS redelivered, CAST(COUNT(*) AS BIGINT) AS records FROM n GROUP BY part")
def redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = state.mark_redeliveries(delivered(spark, sf_dir), TX, "event_index", "op_code", "off")
    return marked.groupBy("part").agg(F.count_if("redelivered").alias("redelivered"), F.count("*").alias("records"))


@query(
    "w7_order_violations",
    f"""WITH {DELIVERED_SQL}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY con_id, user_id, sqn, event_index, op_code ORDER BY off) AS rn FROM dl),
    v AS (SELECT *, LAG(commit_scn) OVER (PARTITION BY part ORDER BY event_id) AS before FROM n WHERE rn = 1) SELECT part, event_id, commit_scn FROM v WHERE commit_scn < before""",
)
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = state.mark_redeliveries(delivered(spark, sf_dir), TX, "event_index", "op_code", "off")
    return state.order_violations(marked, "part", "event_id", "commit_scn").select("part", "event_id", "commit_scn")


@query(
    "r7_verdict",
    f"""WITH {SIDES_SQL}, x AS (SELECT COALESCE(db.tab, tp.tab) AS tab, CASE WHEN tp.tab IS NULL THEN 1 ELSE 0 END AS missing, CASE WHEN db.tab IS NULL THEN 1 ELSE 0 END AS extra, CASE WHEN db.tab IS NOT NULL AND tp.tab IS NOT NULL AND db.cents <> tp.cents THEN 1 ELSE 0 END AS mismatched
      FROM db FULL OUTER JOIN tp ON db.tab = tp.tab AND db.user_id = tp.user_id)
    SELECT tab, CAST(SUM(missing) AS BIGINT) AS missing, CAST(SUM(extra) AS BIGINT) AS extra, CAST(SUM(mismatched) AS BIGINT) AS mismatched, CASE WHEN tab = 'CARTS' THEN 'INCONCLUSIVE' WHEN SUM(missing + extra + mismatched) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM x GROUP BY tab""",
)
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, tp = sides(spark, sf_dir)
    found = state.diff(db, tp, ["tab", "user_id"], ["cents"]).groupBy("tab").agg(*[F.count_if(F.col("status") == s).alias(c) for s, c in (("missing", "missing"), ("extra", "extra"), ("mismatch", "mismatched"))])
    tables = db.select("tab").distinct().join(found, "tab", "left").na.fill(0)
    problems = F.when(F.col("tab") == "CARTS", 1).otherwise(0)
    return tables.withColumn("verdict", state.verdict(problems, F.col("missing"), F.col("extra"), F.col("mismatched"), F.lit(True)))


@query("s19_sealed_report", "SELECT o_orderkey, sha256('{\"status\":\"' || o_orderstatus || '\",\"day\":' || CAST(EXTRACT(DAY FROM o_orderdate) AS VARCHAR) || '}') AS seal FROM orders")
def sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.dayofmonth("o_orderdate").alias("day")))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.sha2(body, 256).alias("seal"))


@query("f23_canonical_rows", "SELECT o_orderkey, '[[\"O_ORDERKEY\",\"' || CAST(o_orderkey AS VARCHAR) || '\"],[\"O_ORDERSTATUS\",\"' || o_orderstatus || '\"]]' AS row_json FROM orders")
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = lambda n, c: F.array(F.lit(n), F.col(c).cast("string"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.to_json(F.array(pair("O_ORDERKEY", "o_orderkey"), pair("O_ORDERSTATUS", "o_orderstatus"))).alias("row_json"))


SNAP_SQL = f"{d.SURVIVORS_SQL}, un AS (SELECT user_id AS id, 'r' AS op, CAST(30000 AS BIGINT) AS scn, 0 AS kind FROM sv WHERE commit_scn < 30000 GROUP BY user_id UNION ALL SELECT user_id, 'x', commit_scn, 1 FROM sv WHERE commit_scn >= 30000 GROUP BY user_id, commit_scn)"


@query("u5_k17_snapshot_before_stream", f"WITH {SNAP_SQL} SELECT id, op, scn, CAST(ROW_NUMBER() OVER (PARTITION BY id ORDER BY scn, kind) AS BIGINT) AS place FROM un")
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    sv = survivors(spark, sf_dir)
    read = sv.where("commit_scn < 30000").select(F.col("user_id").alias("id")).distinct().select("id", F.lit("r").alias("op"), F.lit(30000).cast("long").alias("scn"), F.lit(0).alias("kind"))
    live = sv.where("commit_scn >= 30000").select(F.col("user_id").alias("id"), F.lit("x").alias("op"), F.col("commit_scn").alias("scn"), F.lit(1).alias("kind")).distinct()
    return read.unionByName(live).withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("scn", "kind")).cast("long")).drop("kind")
