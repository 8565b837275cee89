"""Schema, replay, snapshot, journal and boundary queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.operators import cuts, replay, scans, schema
from tidelog.plans.registry import query
from tidelog.plans.transaction_queries import survivors
from tidelog.sources import derived as d
from tidelog.sources.portable import Portable, choice
from tidelog.sources.static import Static

TX = d.TX
VERSIONS = Static("versions", "tab string, version long, valid_from long, exact boolean, columns string", (
    ("ITEMS", 1, 2000, True, "ID,RID"), ("ITEMS", 2, 30000, False, "ID,RID,VALUE"), ("ITEMS", 3, 70000, True, "ID,VALUE"), ("CARTS", 1, 0, True, "ID"), ("CARTS", 2, 50000, True, "ID,NOTE"),
))
WITH_TO = f"{VERSIONS.sql}, vt AS (SELECT *, LEAD(valid_from) OVER (PARTITION BY tab ORDER BY version) AS valid_to FROM versions)"


@query("j2_k15_schema_as_of", f"WITH {d.ROWS_SQL}, {WITH_TO} SELECT event_id, vt.version, CASE WHEN vt.version IS NULL THEN 'no version' WHEN NOT exact THEN 'inexact version' END AS error FROM e LEFT JOIN vt ON vt.tab = e.tab AND scn >= valid_from AND (valid_to IS NULL OR scn < valid_to)")
def schema_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.as_of(d.data_rows(spark, sf_dir), VERSIONS.df(spark)).select("event_id", "version", "error")


@query("j3_schema_by_number", f"WITH {d.ROWS_SQL}, {VERSIONS.sql} SELECT event_id, v.version, v.valid_from FROM e LEFT JOIN versions v ON v.tab = e.tab AND v.version = CASE WHEN event_id % 3 = 0 THEN (SELECT MAX(version) FROM versions w WHERE w.tab = e.tab) ELSE event_id % 3 END")
def schema_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("schema_version", F.col("event_id") % 3)
    return schema.by_number(rows, VERSIONS.df(spark)).select("event_id", "version", "valid_from")


LINE_VERSIONS = Portable("versions", "lineitem", {"tab": "l_orderkey", "version": "l_linenumber", "valid_from": "l_orderkey * 7 % 1000 + l_linenumber * 1000"})


@query("w17_schema_pruning", f"WITH {LINE_VERSIONS.sql} SELECT tab, version FROM versions v WHERE valid_from >= 3500 OR NOT EXISTS (SELECT 1 FROM versions w WHERE w.tab = v.tab AND w.valid_from <= 3500 AND w.version > v.version)")
def schema_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.prune(LINE_VERSIONS.df(spark, sf_dir), 3500).select("tab", "version")


@query("k16_lagging_columns", f"WITH {d.ROWS_SQL}, {WITH_TO} SELECT event_id, 'COL ' || CAST(1 + event_id % 3 AS VARCHAR) AS named, NULLIF(SPLIT_PART(vt.columns, ',', CAST(1 + event_id % 3 AS INTEGER)), '') AS resolved FROM e JOIN vt ON vt.tab = e.tab AND scn >= valid_from AND (valid_to IS NULL OR scn < valid_to)")
def lagging_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schema.as_of(d.data_rows(spark, sf_dir), VERSIONS.df(spark)).where("version is not null").join(VERSIONS.df(spark).select("tab", "version", "columns"), ["tab", "version"])
    named = rows.withColumn("named", F.concat(F.lit("COL "), (F.col("event_id") % 3 + 1).cast("string")))
    return named.select("event_id", "named", F.get(F.split("columns", ","), F.regexp_extract("named", r"COL (\d+)", 1).cast("int") - 1).alias("resolved"))


DDL = Static("ddl", "stmt string, kind string", (
    ("create table app.t (id number)", "CREATE_TABLE"), ("CREATE GLOBAL TEMPORARY TABLE t (id number)", "CREATE_TABLE"), ("create or replace view v as select 1 from t", "NO_SCHEMA_CHANGE"),
    ("alter table t add (note varchar2(10))", "COLUMNS"), ("alter table t add constraint c check (x > 0)", "CONSTRAINTS"), ("alter table t add (primary key (id))", "CONSTRAINTS"),
    ("alter table app . t add supplemental log data (all) columns", "SUPPLEMENTAL_LOG"), ("alter table t modify default attributes tablespace x", "PARTITION"), ("alter table t drop unused columns", "NO_SCHEMA_CHANGE"),
    ("alter table t set unused (a)", "COLUMNS"), ("alter table t rename column a to b", "COLUMNS"), ("alter table t rename to u", "RENAME_TABLE"), ("rename t to u", "RENAME_TABLE"),
    ("alter table t split partition p at (1)", "PARTITION"), ("truncate table t", "TRUNCATE"), ("drop /* gone */ table t purge", "DROP_TABLE"), ("drop index i", "NO_SCHEMA_CHANGE"),
    ("comment on table t is 'alter table'", "NO_SCHEMA_CHANGE"), ("alter table t disable constraint c", "CONSTRAINTS"), ("alter table t enable row movement", "NO_SCHEMA_CHANGE"), ("alter table t move tablespace x", "NO_SCHEMA_CHANGE"),
    ("alter table \"My T\" drop column a -- x", "COLUMNS"), ("alter session set x = 1", "NO_SCHEMA_CHANGE"), ("alter table t frobnicate", "UNKNOWN"), ("explain plan", "UNKNOWN"), (None, "UNKNOWN"),
))


_TAB = "LOWER(c_mktsegment) || CAST(c_custkey AS STRING)"


def _statement(stmt: str | None) -> str:
    """The statement as an expression, its table ``t`` named after a customer."""
    pieces = re.split(r"\bt\b", stmt) if stmt is not None else []
    return f" || {_TAB} || ".join(f"'{x}'" for x in pieces) if pieces else "NULL"


_NAMED = [(stmt, kind) for stmt, kind in DDL.rows if stmt is None or "'" not in stmt]
STATEMENTS = Portable("statements", "customer", {"id": "c_custkey", "stmt": choice("c_custkey", *[_statement(stmt) for stmt, _ in _NAMED])})
_KIND_SQL = choice("c_custkey", *[f"'{kind}'" for _, kind in _NAMED])


@query("f15_ddl_kinds", f"SELECT c_custkey AS id, {_KIND_SQL} AS kind FROM customer")
def ddl_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return STATEMENTS.df(spark, sf_dir).select("id", schema.ddl_kind(F.col("stmt")).alias("kind"))


@query("f16_step_cuts", f"SELECT c_custkey AS id, kind IN ('CREATE_TABLE', 'DROP_TABLE') OR (kind IN ('PARTITION', 'RENAME_TABLE') AND c_nationkey % 2 = 0) AS cuts FROM (SELECT *, {_KIND_SQL} AS kind FROM customer)")
def step_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of even nations stand for captured tables."""
    captured = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 2 == 0).alias("captured"))
    return ddl_kinds(spark, sf_dir).join(captured, "id").select("id", schema.cuts_step(F.col("kind"), F.col("captured")).alias("cuts"))


@query("k15_versions_from_ddl", "WITH l AS (SELECT event_type AS tab, event_id AS scn, CAST(FLOOR(user_id / 40.0) AS BIGINT) AS layout FROM events), c AS (SELECT *, LAG(layout) OVER (PARTITION BY tab ORDER BY scn) AS b FROM l) SELECT tab, CAST(ROW_NUMBER() OVER (PARTITION BY tab ORDER BY scn) AS BIGINT) AS version, scn AS valid_from, layout FROM c WHERE layout IS DISTINCT FROM b")
def versions_from_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.events(spark, sf_dir).select(F.col("event_type").alias("tab"), F.col("event_id").alias("scn"), F.floor(F.col("user_id") / 40).cast("long").alias("layout"))
    return schema.versions_of(rows)


#: A table a part: an override, a primary key and a unique index, each there or not.
KEYS = Portable("keys", "part", {"id": "p_partkey", "override": "CASE WHEN p_size < 5 THEN p_brand END", "pk": "CASE WHEN p_size % 3 = 0 THEN p_name END", "uniq": "CASE WHEN p_partkey % 2 = 0 THEN p_type END"})


@query("key_selection", "SELECT p_partkey AS id, CASE WHEN p_size < 5 THEN 'OVERRIDE' WHEN p_size % 3 = 0 THEN 'PRIMARY_KEY' WHEN p_partkey % 2 = 0 THEN 'UNIQUE_INDEX' ELSE 'ROWID' END AS source FROM part")
def key_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return KEYS.df(spark, sf_dir).select("id", schema.key_source(F.col("override"), F.col("pk"), F.col("uniq"), "ROWID").alias("source"))


@query("j14_dictionary_joins", "SELECT n.n_name, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal < -900)")
def dictionary_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    nation = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return nation.join(read("customer").where("c_acctbal < -900"), F.col("c_nationkey") == F.col("n_nationkey"), "left_anti").select("n_name", "r_name")


@query("k7_resume_points", f"WITH {d.ROWS_SQL}, c AS (SELECT con_id AS thread, MAX(scn) AS scn FROM e GROUP BY con_id), o AS (SELECT con_id AS thread, MIN(start_scn) AS s FROM tx WHERE end_code IS NULL GROUP BY con_id) SELECT c.thread, LEAST(c.scn, COALESCE(o.s, c.scn)) AS resume_scn FROM c LEFT JOIN o ON o.thread = c.thread")
def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("thread", F.col("con_id"))
    work = d.transactions(rows).where("end_code is null").withColumn("thread", F.col("con_id"))
    return replay.resume_points(rows.groupBy("thread").agg(F.max("scn").alias("scn")), work)


@query("k8_replay_suffix", f"WITH {d.SURVIVORS_SQL}, k AS (SELECT sv.*, CAST(con_id AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) || '.' || CAST(sqn AS VARCHAR) AS k FROM sv), l AS (SELECT commit_scn AS c, k AS lk FROM k WHERE event_count >= 3 ORDER BY commit_scn, k LIMIT 1) SELECT event_id, event_index FROM k, l WHERE commit_scn > c OR (commit_scn = c AND k.k > lk) OR (commit_scn = c AND k.k = lk AND event_index >= 2)")
def replay_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws(".", *[F.col(c).cast("string") for c in TX])
    sv = survivors(spark, sf_dir)
    last = sv.where("event_count >= 3").select("commit_scn", key.alias("k")).orderBy("commit_scn", "k").first()  # the stored position
    return replay.skip_applied(sv, last and last["commit_scn"], last and last["k"], 2, key).select("event_id", "event_index")


@query("k6_below_floor", f"WITH {d.ROWS_SQL}, fl AS (SELECT con_id AS thread, CAST(AVG(scn) AS BIGINT) - CAST(AVG(scn) AS BIGINT) % 10 AS floor_scn FROM e GROUP BY con_id) SELECT fl.thread, CAST(COUNT(*) AS BIGINT) AS below FROM e JOIN fl ON fl.thread = e.con_id WHERE scn < floor_scn GROUP BY fl.thread")
def below_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("thread", F.col("con_id"))
    mean = F.round(F.avg("scn")).cast("long")
    floors = rows.groupBy("thread").agg((mean - mean % 10).alias("floor_scn"))
    return replay.floor_violations(rows, floors).groupBy("thread").agg(F.count("*").alias("below"))


@query("k5_safe_end", f"WITH {d.LOGS_SQL} SELECT MIN(top) AS safe_end FROM (SELECT thread, MAX(CASE WHEN NOT deleted AND next_scn < 9223372036854775807 THEN next_scn END) AS top FROM logs GROUP BY thread)")
def safe_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    archived = d.logs(spark, sf_dir).where("not deleted and next_scn < 9223372036854775807")
    return archived.groupBy("thread").agg(F.max("next_scn").alias("top")).agg(F.min("top").alias("safe_end"))


@query("s4_w9_key_chunks", "WITH n AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn FROM orders), s AS (SELECT CAST((rn - 1) // 500 AS BIGINT) AS chunk, o_orderkey AS lower_bound FROM n WHERE (rn - 1) % 500 = 0) SELECT chunk, lower_bound, LEAD(lower_bound) OVER (ORDER BY chunk) AS upper_bound FROM s")
def key_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    return replay.plan_key_chunks(scans.global_place(orders, "o_orderkey", [F.col("o_orderkey")]), "o_orderkey", "place", 500)


@query("s4_f22_tuple_bounds", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey > 100 OR (l_orderkey = 100 AND l_linenumber >= 3)) AND (l_orderkey < 200 OR (l_orderkey = 200 AND l_linenumber < 2))")
def tuple_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = replay.tuple_bound(["l_orderkey", "l_linenumber"], [100, 3], [200, 2])
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(keep).select("l_orderkey", "l_linenumber", "l_partkey")


@query("s5_extent_chunks", f"WITH {d.LOGS_SQL} SELECT thread, seq, CAST(FLOOR(COALESCE(SUM(bytes // 1048576) OVER (PARTITION BY thread ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 200.0) AS BIGINT) AS chunk FROM logs")
def extent_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    extents = d.logs(spark, sf_dir).withColumn("blocks", (F.col("bytes") / 1048576).cast("long"))
    return replay.plan_extent_chunks(extents, "thread", "seq", "blocks", 10_000).select("thread", "seq", "chunk")


@query("s6_whole_snapshot", "SELECT n_nationkey, n_name, 'r' AS op FROM nation")
def whole_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", F.lit("r").alias("op"))


#: A table a part: its key columns and their types, whether one may be null, whether it is index-organised.
TABLES = Portable("tabs", "part", {"id": "p_partkey", "keys": choice("p_partkey", "'ID'", "'ID,D'", "''"), "types": choice("p_partkey", "'NUMBER'", "CASE WHEN p_size > 25 THEN 'NUMBER,RAW' ELSE 'NUMBER,VARCHAR2' END", "''"), "nullable": "p_size % 4 = 0", "iot": "p_size % 5 < 2"})


@query("s7_snapshot_strategy", "SELECT p_partkey AS id, CASE WHEN p_size % 4 <> 0 AND (p_partkey % 3 = 0 OR (p_partkey % 3 = 1 AND p_size <= 25)) THEN 'KEY' WHEN p_size % 5 < 2 THEN 'ALL' ELSE 'ROWID' END AS strategy FROM part")
def strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    return TABLES.df(spark, sf_dir).select("id", replay.snapshot_strategy(parts("keys"), parts("types"), F.col("nullable"), F.col("iot")).alias("strategy"))


@query("f21_bound_text", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'N:' ELSE 'n:' || CAST(o_orderkey AS VARCHAR) END AS low, 's:' || o_orderstatus AS status FROM orders")
def bound_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", replay.bound_text(low, "number").alias("low"), replay.bound_text(F.col("o_orderstatus"), "text").alias("status"))


@query("w4_snapshot_markers", "SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER w = 1 THEN 'first' WHEN LEAD(o_orderkey) OVER w IS NULL THEN 'last' ELSE 'true' END AS marker FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)")
def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", replay.snapshot_marker(["o_orderkey"], ["o_orderstatus"]).alias("marker"))


PROGRESS = Static("progress", "tab string, frontier long, done boolean", (("A", 900, False), ("B", None, True), ("C", 0, False)))


@query("k19_snapshot_progress", f"WITH {PROGRESS.sql} SELECT tab, CASE WHEN done THEN 0 ELSE (SELECT COUNT(*) FROM orders WHERE o_orderkey >= frontier) END AS remaining FROM progress")
def snapshot_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    left = PROGRESS.df(spark).join(orders, ~F.col("done") & (F.col("o_orderkey") >= F.col("frontier")), "left")
    return left.groupBy("tab").agg(F.count("o_orderkey").alias("remaining"))


#: The columns of a user's journal; queries derive one from events: a user's are the generations of a few chunks.
JOURNAL = Static("journal", "xid string, chunk long, generation long, acknowledged long, events long, bytes long", ())
ACTIVE = Static("active", "xid string", ())
EVENT_JOURNAL = Portable("journal", "events", {"xid": "CAST(user_id AS STRING)", "chunk": "event_id % 3 + CASE WHEN user_id % 6 = 0 AND event_id % 3 = 2 THEN 1 ELSE 0 END", "generation": "event_id", "acknowledged": "(user_id % 5 + 1) * 150", "events": "event_id % 7 + 1", "bytes": "event_id * 3"})


@query("w14_k12_journal_state", f"WITH {EVENT_JOURNAL.sql}, g AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY xid, chunk ORDER BY generation DESC) AS r FROM journal WHERE generation <= acknowledged), n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY xid ORDER BY chunk) - 1 AS n FROM g WHERE r = 1) SELECT xid, chunk, generation, events FROM n WHERE chunk = n")
def journal_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.journal_state(EVENT_JOURNAL.df(spark, sf_dir)).select("xid", "chunk", "generation", "events")


@query("a14_journal_summary", f"WITH {EVENT_JOURNAL.sql} SELECT xid, CAST(COUNT(DISTINCT chunk) AS BIGINT) AS chunks, CAST(COUNT(DISTINCT generation) AS BIGINT) AS generations, CAST(SUM(events) AS BIGINT) AS events, CAST(SUM(bytes) AS BIGINT) AS bytes FROM journal GROUP BY xid")
def journal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks_by_transaction(EVENT_JOURNAL.df(spark, sf_dir))


def chunks_by_transaction(journal: DataFrame) -> DataFrame:
    return journal.groupBy("xid").agg(F.count_distinct("chunk").alias("chunks"), F.count_distinct("generation").alias("generations"), F.sum("events").alias("events"), F.sum("bytes").alias("bytes"))


@query("j16_journaled_transactions", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS xid, user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS active FROM events")
def journaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("xid"))
    return with_activity(EVENT_JOURNAL.df(spark, sf_dir), active)


def with_activity(journal: DataFrame, active: DataFrame) -> DataFrame:
    """Journaled transactions, and whether the database still knows them."""
    flag = active.select("xid").distinct().withColumn("_a", F.lit(True))
    return journal.select("xid").distinct().join(flag, "xid", "left").select("xid", F.col("_a").isNotNull().alias("active"))


@query("j13_k14_orphans", f"WITH {d.ROWS_SQL} SELECT con_id, user_id, sqn FROM tx WHERE end_code IS NULL AND user_id % 3 <> 0 AND user_id % 5 <> 0 AND start_scn < 50000")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = d.transactions(d.data_rows(spark, sf_dir)).where("end_code is null")
    probe = lambda n: tx.where(F.col("user_id") % n == 0).select(*TX)  # noqa: E731  two probes of active transactions
    return tx.join(probe(3), TX, "left_anti").join(probe(5), TX, "left_anti").where("start_scn < 50000").select(*TX)


@query("k11_due_for_journal", f"WITH {d.ROWS_SQL}, z AS (SELECT tx.con_id, tx.user_id, tx.sqn, tx.start_scn, COUNT(*) AS n FROM e JOIN tx ON e.con_id = tx.con_id AND e.user_id = tx.user_id AND e.sqn = tx.sqn WHERE end_code IS NULL GROUP BY ALL) SELECT con_id, user_id, sqn, CASE WHEN n >= 15 THEN 'size' ELSE 'age' END AS reason FROM z WHERE n >= 15 OR start_scn < 9000")
def due_for_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    open_ = rows.join(d.transactions(rows).where("end_code is null"), TX).groupBy(*TX, "start_scn").agg(F.count("*").alias("n"))
    return open_.where("n >= 15 or start_scn < 9000").select(*TX, F.when(F.col("n") >= 15, "size").otherwise("age").alias("reason"))


@query("k13_age_policy", f"WITH {d.ROWS_SQL} SELECT con_id, user_id, sqn, (SELECT MAX(scn) FROM e) - start_scn AS age, CASE WHEN con_id = 1 THEN 'fail' ELSE 'discard' END AS action FROM tx WHERE end_code IS NULL AND (SELECT MAX(scn) FROM e) - start_scn > 60000")
def age_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir)
    now = rows.agg(F.max("scn")).first()[0] or 0
    old = d.transactions(rows).where("end_code is null").withColumn("age", F.lit(now) - F.col("start_scn")).where("age > 60000")
    return old.select(*TX, "age", F.when(F.col("con_id") == 1, "fail").otherwise("discard").alias("action"))


@query("w15_k10_split_marks", f"WITH {d.SURVIVORS_SQL} SELECT event_id, event_index // 4 AS piece, event_index // 4 < (event_count - 1) // 4 AS more FROM sv")
def split_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.split_marks(survivors(spark, sf_dir), TX, 4).select("event_id", "piece", "more")


@query("w16_batch_boundaries", f"""WITH RECURSIVE {d.ROWS_SQL}, c AS (SELECT con_id, user_id, sqn, COUNT(*) AS n FROM e GROUP BY ALL), o AS (SELECT con_id, user_id, sqn, n, ROW_NUMBER() OVER (PARTITION BY con_id, user_id ORDER BY sqn) AS rn FROM c),
    f(con_id, user_id, rn, sqn, held, batch, given) AS (SELECT con_id, user_id, rn, sqn, CASE WHEN n >= 12 THEN 0 ELSE n END, CASE WHEN n >= 12 THEN 1 ELSE 0 END, CAST(0 AS BIGINT) FROM o WHERE rn = 1
      UNION ALL SELECT o.con_id, o.user_id, o.rn, o.sqn, CASE WHEN f.held + o.n >= 12 THEN 0 ELSE f.held + o.n END, f.batch + CASE WHEN f.held + o.n >= 12 THEN 1 ELSE 0 END, CAST(f.batch AS BIGINT) FROM f JOIN o ON o.con_id = f.con_id AND o.user_id = f.user_id AND o.rn = f.rn + 1)
    SELECT con_id, user_id, sqn, given AS batch FROM f""")
def batch_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = d.data_rows(spark, sf_dir).groupBy(*TX).agg(F.count("*").alias("n"))
    queue = sized.groupBy("con_id", "user_id").agg(F.array_sort(F.collect_list(F.struct("sqn", "n"))).alias("q"))  # weeks of one user: a handful
    cut = queue.withColumn("b", replay.fold_boundaries(F.transform("q", lambda x: x["n"]), 12))
    return cut.select("con_id", "user_id", F.explode(F.arrays_zip("q", "b")).alias("z")).select("con_id", "user_id", F.col("z.q.sqn").alias("sqn"), F.col("z.b").alias("batch"))


_SPLIT_SQL = f"""WITH RECURSIVE {d.SURVIVORS_SQL}, x AS (SELECT con_id, user_id, sqn, event_id, event_index, 40 + event_id * event_id % 61 AS bytes FROM sv),
    f(con_id, user_id, sqn, event_id, event_index, n, b, first, cut) AS (SELECT con_id, user_id, sqn, event_id, event_index, 1, bytes, event_index, bytes >= 200 FROM x WHERE event_index = 0
      UNION ALL SELECT x.con_id, x.user_id, x.sqn, x.event_id, x.event_index, CASE WHEN cut THEN 1 ELSE n + 1 END, CASE WHEN cut THEN x.bytes ELSE b + x.bytes END, CASE WHEN cut THEN x.event_index ELSE first END, CASE WHEN cut THEN x.bytes >= 200 ELSE n + 1 >= 4 OR b + x.bytes >= 200 END
        FROM f JOIN x ON x.con_id = f.con_id AND x.user_id = f.user_id AND x.sqn = f.sqn AND x.event_index = f.event_index + 1)
    SELECT event_id, first, cut FROM f"""


@query("w15_split_by_bytes", _SPLIT_SQL)
def split_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survivors(spark, sf_dir).select(*TX, "event_id", "event_index", F.lit(1).alias("n"), (F.col("event_id") * F.col("event_id") % 61 + 40).alias("bytes"))
    return cuts.resetting_cuts(rows, TX, "event_index", {"n": 4, "bytes": 200}).select("event_id", "first", "cut")


_BATCHES_SQL = f"""WITH RECURSIVE {d.ROWS_SQL}, c AS (SELECT con_id, user_id % 16 AS shard, MAX(scn) + 1 AS end_scn, COUNT(*) AS n, SUM(40 + event_id % 61) AS bytes FROM e GROUP BY con_id, user_id, sqn),
    o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY con_id, shard ORDER BY end_scn) AS rn FROM c),
    f(con_id, shard, rn, end_scn, n, b, first, cut) AS (SELECT con_id, shard, rn, end_scn, n, CAST(bytes AS BIGINT), end_scn, n >= 12 OR bytes >= 700 FROM o WHERE rn = 1
      UNION ALL SELECT o.con_id, o.shard, o.rn, o.end_scn, CASE WHEN cut THEN 0 ELSE f.n END + o.n, CAST(CASE WHEN cut THEN 0 ELSE b END + o.bytes AS BIGINT), CASE WHEN cut THEN o.end_scn ELSE first END,
        CASE WHEN cut THEN 0 ELSE f.n END + o.n >= 12 OR CASE WHEN cut THEN 0 ELSE b END + o.bytes >= 700 OR o.end_scn - CASE WHEN cut THEN o.end_scn ELSE first END >= 3000 FROM f JOIN o ON o.con_id = f.con_id AND o.shard = f.shard AND o.rn = f.rn + 1)
    SELECT con_id, shard, end_scn, first, cut FROM f"""


@query("w16_batches_by_bytes_and_time", _BATCHES_SQL)
def batches_by_bytes_and_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches end with a transaction; the position stands for the time."""
    rows = d.data_rows(spark, sf_dir).groupBy(*TX).agg((F.max("scn") + 1).alias("end_scn"), F.count("*").alias("n"), F.sum(F.col("event_id") % 61 + 40).alias("bytes"))
    rows = rows.select("con_id", (F.col("user_id") % 16).alias("shard"), "end_scn", "n", "bytes")
    return cuts.resetting_cuts(rows, ["con_id", "shard"], "end_scn", {"n": 12, "bytes": 700}, clock="end_scn", span=3000).select("con_id", "shard", "end_scn", "first", "cut")


STEPS = Static("steps", "run string, results string, final long", (("a", "fast,fast,fast,fast,fast", 16), ("b", "fast,fast,timeout", 2), ("c", "timeout,timeout,timeout", -1), ("d", "timeout,fast,timeout,timeout,ok", 1), ("e", "ok", 1)))


@query("w10_adaptive_window", f"WITH {STEPS.sql} SELECT run, final AS size FROM steps")
def adaptive_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return STEPS.df(spark).select("run", replay.adaptive_window(F.split("results", ","), 16).alias("size"))


@query("k20_heartbeats", "WITH g AS (SELECT user_id % 2 AS part, ts, LEAD(ts) OVER (PARTITION BY user_id % 2 ORDER BY ts) AS nxt FROM events) SELECT part, CAST(COUNT(*) AS BIGINT) AS due FROM g WHERE nxt > ts + INTERVAL 15 MINUTE GROUP BY part")
def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.events(spark, sf_dir).withColumn("part", F.col("user_id") % 2)
    gap = rows.withColumn("nxt", F.lead("ts").over(Window.partitionBy("part").orderBy("ts"))).where(F.col("nxt") > F.col("ts") + F.expr("interval 15 minutes"))
    return gap.groupBy("part").agg(F.count("*").alias("due"))


@query("j11_large_value_reselect", f"WITH {d.SURVIVORS_SQL} SELECT a.event_id, MAX(b.event_id) AS found FROM sv a LEFT JOIN sv b ON b.tab = a.tab AND b.user_id = a.user_id AND b.commit_scn <= a.commit_scn AND b.event_id % 3 = 0 GROUP BY a.event_id")
def reselect(spark: SparkSession, sf_dir: str) -> DataFrame:
    sv = survivors(spark, sf_dir).select("tab", "user_id", "commit_scn", "event_id")
    upto = Window.partitionBy("tab", "user_id").orderBy("commit_scn").rangeBetween(Window.unboundedPreceding, 0)
    return sv.withColumn("found", F.max(F.when(F.col("event_id") % 3 == 0, F.col("event_id"))).over(upto)).select("event_id", "found")
