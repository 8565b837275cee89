"""Analytics over log metadata, metric samples and catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import errors
from tidelog.operators import doctor, ops, scans
from tidelog.plans.registry import query
from tidelog.sources import derived as d
from tidelog.sources.portable import Portable, choice
from tidelog.sources.static import Static

SAMPLE_SQL = """mr AS (SELECT CAST(1 + user_id % 2 AS BIGINT) AS container, 'APP' AS owner, CASE WHEN event_type = 'click' THEN NULL ELSE 'T' || CAST(user_id % 6 AS VARCHAR) END AS tab,
   CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'DIRECT INSERT' ELSE 'INSERT' END WHEN 'purchase' THEN 'DELETE' WHEN 'view' THEN 'UPDATE' WHEN 'click' THEN 'COMMIT' ELSE 'DDL' END AS operation, event_type = 'error' AND event_id % 3 = 0 AS truncate FROM events),
  sm AS (SELECT container, owner, tab, operation, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(CASE WHEN truncate THEN 1 ELSE 0 END) AS BIGINT) AS truncates FROM mr GROUP BY ALL)"""
PROFILE_SQL = f"""{SAMPLE_SQL}, pf AS (SELECT container, owner, tab, CAST(SUM(CASE WHEN operation LIKE '%INSERT%' THEN rows ELSE 0 END) AS BIGINT) AS inserts, CAST(SUM(CASE WHEN operation = 'UPDATE' THEN rows ELSE 0 END) AS BIGINT) AS updates,
   CAST(SUM(CASE WHEN operation = 'DELETE' THEN rows ELSE 0 END) AS BIGINT) AS deletes, CAST(SUM(CASE WHEN operation = 'DDL' THEN rows ELSE 0 END) AS BIGINT) AS ddl, CAST(SUM(truncates) AS BIGINT) AS truncates,
   CAST(SUM(CASE WHEN operation LIKE '%INSERT%' OR operation IN ('UPDATE', 'DELETE', 'DDL') THEN 0 ELSE rows END) AS BIGINT) AS other, CAST(SUM(rows) AS BIGINT) AS total, tab IN ('T0', 'T1', 'T2') AS captured FROM sm WHERE tab IS NOT NULL GROUP BY container, owner, tab)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, eid = F.col("event_type"), F.col("event_id")
    op = F.when(kind == "signup", F.when(eid % 2 == 0, "DIRECT INSERT").otherwise("INSERT")).when(kind == "purchase", "DELETE").when(kind == "view", "UPDATE").when(kind == "click", "COMMIT").otherwise("DDL")
    rows = d.events(spark, sf_dir).select((F.col("user_id") % 2 + 1).alias("container"), F.lit("APP").alias("owner"), F.when(kind != "click", F.concat(F.lit("T"), (F.col("user_id") % 6).cast("string"))).alias("tab"), op.alias("operation"), ((kind == "error") & (eid % 3 == 0)).alias("truncate"))
    return doctor.redo_samples(rows)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.redo_profile(samples(spark, sf_dir), scans.whole("tab", ["T[0-2]"]), reload_rows=300)


@query("a1_redo_samples", f"WITH {SAMPLE_SQL} SELECT * FROM sm")
def redo_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir)


@query("a2_a4_redo_profile", f"WITH {PROFILE_SQL} SELECT *, CASE WHEN truncates > 0 AND inserts >= 300 THEN 'truncate-and-reload' WHEN LEAST(deletes, inserts) >= 300 AND LEAST(deletes, inserts) >= 0.8 * GREATEST(deletes, inserts) THEN 'delete-and-reload' END AS pattern FROM pf")
def redo_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir)


@query("a3_discard_share", f"WITH {PROFILE_SQL} SELECT CAST(SUM(total) AS BIGINT) AS table_rows, CAST(SUM(CASE WHEN captured THEN total ELSE 0 END) AS BIGINT) AS captured_rows, SUM(CASE WHEN captured THEN 0 ELSE total END)::DOUBLE / SUM(total)::DOUBLE AS discard_share FROM pf")
def discard_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.discard_share(profile(spark, sf_dir))


@query("t5_top_tables", f"WITH {PROFILE_SQL} SELECT container, tab, total FROM pf ORDER BY total DESC, container, tab LIMIT 5")
def top_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir).select("container", "tab", "total").orderBy(F.desc("total"), "container", "tab").limit(5)  # a top-k report


START, END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
WIN_SQL = f"{d.LOGS_SQL}, wl AS (SELECT * FROM logs WHERE next_time >= TIMESTAMP '{START}' AND next_time < TIMESTAMP '{END}'), hr AS (SELECT DATE_TRUNC('hour', next_time) AS hour, thread, CAST(COUNT(*) AS BIGINT) AS logs, CAST(SUM(bytes) AS BIGINT) AS bytes FROM wl GROUP BY ALL)"


@query("a5_hourly_rate", f"WITH {WIN_SQL} SELECT * FROM hr")
def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.hourly(doctor.in_window(d.logs(spark, sf_dir), START, END))


ONLINE = Static("online", "thread long, current_bytes long", ((1, 1073741824),))


@query(
    "a6_log_sizing",
    f"""WITH {WIN_SQL}, {ONLINE.sql}, pk AS (SELECT thread, MAX(logs) AS peak_switches, MAX(bytes) AS peak_bytes FROM hr GROUP BY thread), ph AS (SELECT hr.thread, MIN(hour) AS peak_hour FROM hr JOIN pk ON pk.thread = hr.thread AND hr.logs = pk.peak_switches GROUP BY hr.thread),
    tt AS (SELECT thread, COUNT(*) AS logs, SUM(bytes) AS b FROM wl GROUP BY thread)
    SELECT tt.thread, CAST(tt.logs AS BIGINT) AS logs, tt.logs / 480.0::DOUBLE AS switches_per_hour, peak_switches, peak_hour, peak_bytes, CAST(FLOOR(b::DOUBLE / 20.0::DOUBLE + 0.5) AS BIGINT) AS bytes_per_day,
      GREATEST(COALESCE(current_bytes, 0), CAST(CEIL((peak_bytes // 4) / 67108864.0::DOUBLE) * 67108864 AS BIGINT)) AS recommended_bytes FROM tt JOIN pk ON pk.thread = tt.thread JOIN ph ON ph.thread = tt.thread LEFT JOIN online ON online.thread = tt.thread""",
)
def sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.sizing(doctor.in_window(d.logs(spark, sf_dir), START, END), ONLINE.df(spark), 480.0)


@query("a6_archive_space", f"WITH {WIN_SQL}, h AS (SELECT SUM(bytes) AS b FROM wl GROUP BY DATE_TRUNC('hour', next_time)), y AS (SELECT SUM(bytes) AS b FROM wl GROUP BY DATE_TRUNC('day', next_time)) SELECT CAST((SELECT MAX(b) FROM h) AS BIGINT) AS peak_hour_bytes, CAST((SELECT MAX(b) FROM y) AS BIGINT) AS peak_day_bytes, CAST((SELECT MAX(b) FROM y) * 3 AS BIGINT) AS space_bytes")
def archive_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.archive_space(doctor.in_window(d.logs(spark, sf_dir), START, END), 72)


@query("a7_redo_reach", f"WITH {d.LOGS_SQL}, p AS (SELECT thread, MIN(CASE WHEN NOT deleted THEN first_time END) AS t, BOOL_OR(deleted) AS dl FROM logs GROUP BY thread) SELECT MAX(t) AS available_from, BOOL_OR(dl) AS purge_seen FROM p")
def reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.reach(d.logs(spark, sf_dir))


GAPS_SQL = f"{d.LOGS_SQL}, pr AS (SELECT thread, seq, LAG(seq) OVER (PARTITION BY thread ORDER BY seq) AS b FROM logs WHERE NOT deleted)"


@query("w5_sequence_gaps", f"WITH {GAPS_SQL} SELECT thread, b AS after_seq, seq - b - 1 AS missing FROM pr WHERE seq - b > 1")
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.sequence_gaps(d.logs(spark, sf_dir).where("not deleted"))


@query("w6_missing_ranges", f"WITH {d.LOGS_SQL}, r AS (SELECT thread, seq, seq - ROW_NUMBER() OVER (PARTITION BY thread ORDER BY seq) AS g FROM logs WHERE deleted), i AS (SELECT thread, MIN(seq) AS a, MAX(seq) AS b FROM r GROUP BY thread, g) SELECT thread, STRING_AGG(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || ' to ' || CAST(b AS VARCHAR) END, ', ' ORDER BY a) AS ranges FROM i GROUP BY thread")
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.range_text(d.logs(spark, sf_dir).where("deleted"), "thread", "seq")


@query("j8_r4_log_overlap", f"WITH {d.LOGS_SQL} SELECT thread, seq, first_scn, next_scn FROM logs WHERE next_scn > 20000 AND first_scn <= 40000")
def overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.overlapping(d.logs(spark, sf_dir), 20000, 40000).select("thread", "seq", "first_scn", "next_scn")


@query("j8_position_in_log", f"WITH {d.ROWS_SQL}, {d.LOGS_SQL} SELECT e.event_id, l.seq FROM e JOIN logs l ON l.thread = e.con_id AND e.scn >= l.first_scn AND e.scn < l.next_scn")
def position_in_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).withColumn("thread", F.col("con_id"))
    return doctor.locate(rows, d.logs(spark, sf_dir), 5000).select("event_id", "seq")


COPIES_SQL = f"{d.LOGS_SQL}, cp AS (SELECT thread, seq, 1 AS dest, seq % 3 <> 0 AS readable FROM logs UNION ALL SELECT thread, seq, 2, seq % 2 = 0 FROM logs)"


@query("w13_one_copy", f"WITH {COPIES_SQL}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY thread, seq ORDER BY readable DESC, dest) AS n FROM cp) SELECT thread, seq, dest, readable FROM r WHERE n = 1")
def one_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = d.logs(spark, sf_dir)
    copy = lambda dest, ok: logs.select("thread", "seq", F.lit(dest).alias("dest"), ok.alias("readable"))
    return doctor.one_copy(copy(1, F.col("seq") % 3 != 0).unionByName(copy(2, F.col("seq") % 2 == 0)))


#: For SQL: each sequence number of a thread up to its newest, and whether its log is there. Plans are told from these, one number at a time.
_EVERY_LOG = f"""{d.LOGS_SQL}, top AS (SELECT thread, MIN(seq) AS low, MAX(seq) AS high FROM logs GROUP BY thread),
every AS (SELECT t.thread, s.seq, l.first_scn, l.next_scn, l.seq IS NOT NULL AND NOT l.deleted AS here FROM top t, LATERAL (SELECT UNNEST(GENERATE_SERIES(t.low, t.high)) AS seq) s LEFT JOIN logs l ON l.thread = t.thread AND l.seq = s.seq)"""


@query(
    "r3_redo_coverage",
    f"""WITH {_EVERY_LOG}, p(position) AS (SELECT CAST(MAX(event_id) * 8 + 1000 AS BIGINT) FROM events),
    f AS (SELECT t.thread, (SELECT MIN(seq) FROM every e, p WHERE e.thread = t.thread AND e.next_scn > position) AS start FROM top t)
    SELECT f.thread, (SELECT MIN(seq) FROM every e, p WHERE e.thread = f.thread AND e.here AND e.next_scn > position) AS from_seq,
      EXISTS (SELECT 1 FROM every e, p WHERE e.thread = f.thread AND e.here AND e.first_scn <= position AND e.next_scn > position) AND NOT EXISTS (SELECT 1 FROM every e WHERE e.thread = f.thread AND e.seq >= f.start AND NOT e.here) AS covered,
      (SELECT COUNT(*) FROM every e WHERE e.thread = f.thread AND e.seq >= f.start AND NOT e.here) AS holes FROM f""",
)
def redo_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = d.events(spark, sf_dir).agg(F.max("event_id") * 8 + 1000).first()[0]  # the position that the report is asked for
    return doctor.coverage(d.logs(spark, sf_dir), position)


@query(
    "r5_r6_position_plans",
    f"""WITH {_EVERY_LOG}, now AS (SELECT MAX(event_id) * 10 + 1000 AS current FROM events), t AS (SELECT DISTINCT first_scn + 5 AS target FROM logs UNION SELECT 500 UNION SELECT 9999999999)
    SELECT target, CASE WHEN target > current THEN 'beyond the end'
      WHEN EXISTS (SELECT 1 FROM top WHERE NOT EXISTS (SELECT 1 FROM every e WHERE e.thread = top.thread AND e.here AND e.first_scn <= target AND e.next_scn > target)) THEN 'redo is gone'
      WHEN EXISTS (SELECT 1 FROM every e JOIN every x ON x.thread = e.thread AND x.seq > e.seq AND NOT x.here WHERE e.here AND e.first_scn <= target AND e.next_scn > target) THEN 'redo is gone'
      WHEN target > 20000 THEN 'needs allow-skip' ELSE 'ok' END AS plan FROM t, now""",
)
def position_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = d.logs(spark, sf_dir)
    targets = logs.select((F.col("first_scn") + 5).alias("target")).union(spark.createDataFrame([(500,), (9999999999,)], "target long")).distinct()
    current = d.events(spark, sf_dir).agg((F.max("event_id") * 10 + 1000).alias("current"))
    return doctor.position_plans(logs, targets, 20000, current=current)


#: Positions and tables of the plans that the query asks for, and whether unlisted tables may lose a gap.
RESNAPSHOTS = [(2000, ["items", "CARTS "], False), (2000, ["ITEMS"], False), (30000, ["ITEMS"], True), (30000, ["ITEMS", "NOTES"], False), (101500, ["ITEMS"], False)]
_ASKED_SQL = ", ".join(f"({p}::BIGINT, {[n.strip().upper() for n in names]}, {skip})" for p, names, skip in RESNAPSHOTS)
RESNAPSHOT_SQL = f"""WITH {d.LOGS_SQL}, c AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN 'ITEMS' ELSE 'CARTS' END AS tab FROM events), ask AS (SELECT * FROM (VALUES {_ASKED_SQL}) AS v(position, named, skip)),
cand AS (SELECT a.position, a.position AS p FROM ask a UNION SELECT a.position, l.first_scn FROM ask a JOIN logs l ON l.first_scn >= a.position AND NOT l.deleted),
lack AS (SELECT position, MAX(next_scn) AS s FROM ask JOIN logs ON next_scn > position AND deleted GROUP BY position),
seqs AS (SELECT thread, first_scn, next_scn, seq - LAG(seq) OVER (PARTITION BY thread ORDER BY seq) AS step FROM logs),
jump AS (SELECT position, MAX(first_scn) AS s FROM ask JOIN seqs ON step > 1 AND first_scn > position GROUP BY position),
late AS (SELECT position, MAX(f) AS s FROM ask JOIN (SELECT thread, MIN(first_scn) AS f FROM logs GROUP BY thread) ON f > position GROUP BY position),
r AS (SELECT a.position, a.named, a.skip, (SELECT MIN(p) FROM cand WHERE cand.position = a.position AND p >= GREATEST(a.position, COALESCE((SELECT s FROM lack WHERE lack.position = a.position), 0), COALESCE((SELECT s FROM jump WHERE jump.position = a.position), 0), COALESCE((SELECT s FROM late WHERE late.position = a.position), 0))) AS resume,
  COALESCE((SELECT STRING_AGG(n, ',' ORDER BY n) FROM (SELECT UNNEST(a.named) AS n) WHERE n NOT IN (SELECT tab FROM c)), '') AS unknown, COALESCE((SELECT STRING_AGG(tab, ',' ORDER BY tab) FROM c WHERE NOT LIST_CONTAINS(a.named, tab)), '') AS unlisted FROM ask a)
SELECT position, resume, unknown, unlisted, CASE WHEN unknown <> '' THEN 'refused: not captured' WHEN resume = position THEN 'signal' WHEN resume IS NULL THEN 'refused: no later start' WHEN unlisted <> '' AND NOT skip THEN 'refused: unlisted tables' ELSE 'signal and move' END AS plan FROM r"""


@query("r6_resnapshot_plan", RESNAPSHOT_SQL)
def resnapshot_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = d.data_rows(spark, sf_dir).select("tab").distinct()
    return reduce(DataFrame.unionByName, [doctor.resnapshot_plan(d.logs(spark, sf_dir), captured, *asked) for asked in RESNAPSHOTS])


@query("w11_log_window", f"WITH {d.LOGS_SQL}, r AS (SELECT thread, next_scn, ROW_NUMBER() OVER (PARTITION BY thread ORDER BY seq) AS n FROM logs WHERE next_scn > 15000) SELECT MIN(next_scn) AS window_end FROM r WHERE n = 3")
def log_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor.window_end(d.logs(spark, sf_dir), 15000, 3)


@query(
    "w12_dictionary_builds",
    f"""WITH {d.LOGS_SQL}, b AS (SELECT *, seq % 10 = 3 AS dict_begin, seq % 10 = 5 AS dict_end FROM logs), m AS (SELECT *, MAX(CASE WHEN dict_begin THEN seq END) OVER w AS bs, MAX(CASE WHEN deleted THEN seq END) OVER w AS bad FROM b WINDOW w AS (PARTITION BY thread ORDER BY seq ROWS UNBOUNDED PRECEDING))
    SELECT thread, ARG_MAX(bs, seq) AS begin_seq, MAX(seq) AS end_seq FROM m WHERE dict_end AND bs IS NOT NULL AND first_scn <= 60000 AND (bad IS NULL OR bad < bs) GROUP BY thread""",
)
def dictionary_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = d.logs(spark, sf_dir).withColumn("dict_begin", F.col("seq") % 10 == 3).withColumn("dict_end", F.col("seq") % 10 == 5)
    return doctor.dictionary_build(logs, 60000)


@query("t4_newest_logs", f"WITH {d.LOGS_SQL}, n AS (SELECT * FROM logs ORDER BY next_scn DESC, thread DESC LIMIT 6) SELECT MIN(first_scn) AS low, MAX(first_scn) AS high FROM n")
def newest_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = d.logs(spark, sf_dir).orderBy(F.desc("next_scn"), F.desc("thread")).limit(6)  # a top-k report
    return newest.agg(F.min("first_scn").alias("low"), F.max("first_scn").alias("high"))


@query("thread_statistics", f"WITH {d.LOGS_SQL} SELECT thread, CAST(SUM(CASE WHEN next_time >= TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS recent_switches, COALESCE(MIN(CASE WHEN next_scn > 50000 THEN seq END), MAX(seq)) AS oldest_needed FROM logs GROUP BY thread")
def thread_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = F.col("next_time") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return d.logs(spark, sf_dir).groupBy("thread").agg(F.count_if(recent).alias("recent_switches"), F.coalesce(F.min(F.when(F.col("next_scn") > 50000, F.col("seq"))), F.max("seq")).alias("oldest_needed"))


METRIC_SQL = "ms AS (SELECT user_id % 3 AS task, event_id, ts, CASE WHEN event_id % 400 < 3 THEN 0 ELSE event_id * 7 END AS rows_mined FROM events)"


@query("w8_counter_rates", f"WITH {METRIC_SQL}, l AS (SELECT *, LAG(rows_mined) OVER (PARTITION BY task ORDER BY event_id) AS b, LAG(ts) OVER (PARTITION BY task ORDER BY event_id) AS bt FROM ms) SELECT task, event_id, GREATEST(0, rows_mined - b) AS rows_mined_delta, EPOCH_US(ts) // 1000000 - EPOCH_US(bt) // 1000000 AS seconds FROM l WHERE b IS NOT NULL")
def counter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.events(spark, sf_dir).select((F.col("user_id") % 3).alias("task"), "event_id", "ts", F.when(F.col("event_id") % 400 < 3, 0).otherwise(F.col("event_id") * 7).alias("rows_mined"))
    second = F.floor(F.unix_micros(F.to_timestamp("ts")) / 1_000_000)
    return doctor.counter_rates(rows, "task", "event_id", ["rows_mined"], (second - F.lag(second).over(Window.partitionBy("task").orderBy("event_id"))).cast("long"))


@query("a15_soak_metrics", "SELECT user_id % 3 AS task, CAST(MAX(CASE WHEN ts < TIMESTAMP '2024-01-02 00:00:00' THEN event_id END) AS BIGINT) AS first_max, CAST(MAX(CASE WHEN ts >= TIMESTAMP '2024-01-30 00:00:00' THEN event_id END) AS BIGINT) AS last_max, CAST(AVG(CASE WHEN ts < TIMESTAMP '2024-01-02 00:00:00' THEN event_id END) AS DOUBLE) AS first_mean, CAST(MAX(event_id) AS BIGINT) AS overall_max FROM events GROUP BY 1")
def soak_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    first, last = F.col("ts") < at("2024-01-02 00:00:00"), F.col("ts") >= at("2024-01-30 00:00:00")
    early = F.when(first, F.col("event_id"))
    return d.events(spark, sf_dir).groupBy((F.col("user_id") % 3).alias("task")).agg(F.max(early).alias("first_max"), F.max(F.when(last, F.col("event_id"))).alias("last_max"), F.avg(early).alias("first_mean"), F.max("event_id").alias("overall_max"))


@query("r10_alerts", f"WITH {METRIC_SQL}, b AS (SELECT task, DATE_TRUNC('hour', ts) AS h, MAX(rows_mined) - MIN(rows_mined) AS grown FROM ms GROUP BY ALL) SELECT task, CAST(COUNT(*) AS BIGINT) AS stalled_hours FROM b WHERE grown = 0 GROUP BY task")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.events(spark, sf_dir).select((F.col("user_id") % 3).alias("task"), "ts", F.when(F.col("event_id") % 400 < 3, 0).otherwise(F.col("event_id") * 7).alias("rows_mined"))
    per = rows.groupBy("task", F.date_trunc("hour", "ts").alias("h")).agg((F.max("rows_mined") - F.min("rows_mined")).alias("grown"))
    return per.where("grown = 0").groupBy("task").agg(F.count("*").alias("stalled_hours"))


@query("k22_lag_metrics", f"WITH {d.ROWS_SQL} SELECT con_id, MAX(scn) - MAX(CASE WHEN event_id % 50 = 0 THEN scn END) AS scn_lag, (EPOCH_US(MAX(ts)) - EPOCH_US(MAX(CASE WHEN event_id % 50 = 0 THEN ts END))) // 1000 AS behind_ms FROM e GROUP BY con_id")
def lag_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.col("event_id") % 50 == 0
    us = lambda c: F.unix_micros(F.to_timestamp(c))
    return d.data_rows(spark, sf_dir).groupBy("con_id").agg((F.max("scn") - F.max(F.when(done, F.col("scn")))).alias("scn_lag"), F.floor((us(F.max("ts")) - us(F.max(F.when(done, F.col("ts"))))) / 1000).cast("long").alias("behind_ms"))


LAGS = Static("lags", "id long, behind_ms long, steps long, timeouts long, replays long, step_ms long, fill_before double, fill_after double, scn_growth long, events long, open_tx long, spilled_bytes long, causes string", (
    (1, 500, 5, 0, 0, 900, 0.1, 0.1, 10, 5, 2, 0, "NONE"), (2, 60000, 5, 0, 0, 900, 0.95, 1.0, 10, 5, 2, 0, "KAFKA"), (3, 60000, 5, 2, 1, 9000, 0.1, 0.1, 10, 5, 2, 0, "MINING,LAG_REPLAY"),
    (4, 60000, 5, 0, 0, 6000, 0.1, 0.1, 10, 500000, 2, 0, "LARGE_TRANSACTION,MINING"), (5, 60000, 5, 0, 0, 900, 0.1, 0.2, 10, 5, 2, 0, "UNCLEAR"), (6, 10, 0, 0, 0, 900, 0.1, 0.2, 10, 5, 2, 7, "LARGE_TRANSACTION"), (7, 10, 0, 0, 0, 900, 0.0, 0.0, 3, 5, 2, 0, "UNCLEAR"),
))


#: A pair of samples an event.
SAMPLES = Portable("lags", "events", {
    "id": "event_id", "behind_ms": "event_id * 37 % 60000", "steps": "event_id % 4", "timeouts": "CASE WHEN event_id % 13 = 0 THEN 2 ELSE 0 END", "replays": "CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END", "step_ms": "event_id * 31 % 12000",
    "fill_before": "CAST(event_id % 21 AS DOUBLE) / 20", "fill_after": "CAST(event_id % 11 AS DOUBLE) / 10", "scn_growth": "event_id % 3", "events": "event_id * 911 % 400000", "open_tx": "event_id % 6", "spilled_bytes": "CASE WHEN event_id % 29 = 0 THEN 7 ELSE 0 END",
})


@query(
    "r2_t7_lag_causes",
    f"""WITH {SAMPLES.sql}, f AS (SELECT *, LEAST(fill_before, fill_after) >= {doctor.QUEUE_FULL} AS is_full FROM lags),
    c AS (SELECT id, 'KAFKA' AS cause, 1 + fill_after AS score FROM f WHERE is_full UNION ALL SELECT id, 'LARGE_TRANSACTION', CASE WHEN spilled_bytes > 0 THEN 1.2 ELSE 0.9 END FROM f WHERE spilled_bytes > 0 OR (events >= {doctor.LARGE_EVENTS} AND open_tx IN (1, 2, 3))
      UNION ALL SELECT id, 'MINING', CASE WHEN timeouts > 0 THEN 1.4 ELSE LEAST(1.3, GREATEST(0.6, step_ms / 8000.0)) END FROM f WHERE timeouts > 0 OR (NOT is_full AND step_ms >= 5000) UNION ALL SELECT id, 'LAG_REPLAY', 1.1 FROM f WHERE replays > 0)
    SELECT id, COALESCE((SELECT STRING_AGG(cause, ',' ORDER BY score DESC, cause) FROM c WHERE c.id = f.id), CASE WHEN behind_ms >= {doctor.LAG_MS} OR timeouts > 0 OR is_full OR (scn_growth > 0 AND steps = 0) THEN 'UNCLEAR' ELSE 'NONE' END) AS causes FROM f""",
)
def lag_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_causes(SAMPLES.df(spark, sf_dir))


def ranked_causes(lags: DataFrame) -> DataFrame:
    """``id, causes``: the causes of each pair of samples as one text, best first."""
    ranked = doctor.explain_lag(lags)
    return ranked.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "cause"))), lambda x: x["cause"]), ",").alias("causes"))


@query("a16_catalog_counts", "SELECT c_nationkey, CAST(COUNT(*) AS BIGINT) AS n, COUNT(*) > 0 AS present FROM customer GROUP BY c_nationkey")
def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy("c_nationkey").agg(F.count("*").alias("n"), (F.count("*") > 0).alias("present"))


#: A destination a supplier, some of each nation's in use and on its machine.
DESTS = Portable("dests", "supplier", {"site": "s_nationkey", "id": "s_suppkey", "valid": "s_acctbal > 0", "local": "s_suppkey % 3 <> 1"})


@query("archive_destination", "SELECT s_nationkey AS site, (SELECT s.s_suppkey FROM supplier s WHERE s.s_nationkey = n.s_nationkey AND s.s_acctbal > 0 AND s.s_suppkey % 3 <> 1 ORDER BY s.s_suppkey LIMIT 1) AS dest FROM (SELECT DISTINCT s_nationkey FROM supplier) n")
def archive_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DESTS.df(spark, sf_dir).groupBy("site").agg(F.min(F.when(F.col("valid") & F.col("local"), F.col("id"))).alias("dest"))


SIGNALS = Static("signals", "body string, kind string, tables string", (('{"id":"1","type":"snapshot","data":{"tables":["A","B"]}}', "snapshot", "A,B"), ('{"id":"2","type":"log-state"}', "log-state", None), ('{"id":"3","type":"dance"}', "unknown", None), ("nonsense", "unreadable", None)))
#: The commands that a signal may carry.
SIGNAL_TYPES = ["snapshot", "snapshot-pause", "snapshot-resume", "snapshot-stop", "refresh-tables", "log-state"]


def read_signals(bodies: DataFrame) -> DataFrame:
    """Signals with what they command: ``kind``, and the tables they name."""
    p = F.from_json("body", "id string, type string, data struct<tables:array<string>>")
    kind = F.when(p["type"].isNull(), "unreadable").when(p["type"].isin(SIGNAL_TYPES), p["type"]).otherwise("unknown")
    return bodies.select("*", kind.alias("kind"), F.when(p["data"]["tables"].isNotNull(), F.array_join(p["data"]["tables"], ",")).alias("tables"))


@query("s17_signals", "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'snapshot' WHEN 1 THEN 'snapshot-stop' WHEN 2 THEN 'refresh-tables' WHEN 3 THEN 'unknown' ELSE 'unreadable' END AS kind, CASE WHEN o_orderkey % 5 = 0 THEN 'T' || o_custkey || ',' || o_orderstatus END AS tables FROM orders")
def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signal an order."""
    key = F.col("o_orderkey")
    body = F.to_json(F.struct(key.cast("string").alias("id"), F.when(key % 5 == 0, "snapshot").when(key % 5 == 1, "snapshot-stop").when(key % 5 == 2, "refresh-tables").otherwise("dance").alias("type"), F.when(key % 5 == 0, F.struct(F.array(F.concat(F.lit("T"), F.col("o_custkey").cast("string")), F.col("o_orderstatus")).alias("tables"))).alias("data")))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(key.alias("id"), F.when(key % 5 == 4, F.concat(F.lit("nonsense "), key.cast("string"))).otherwise(body).alias("body"))
    return read_signals(rows).select("id", "kind", "tables")


@query("s16_ops_events", f"WITH {d.ROWS_SQL} SELECT 'transaction-discarded' AS type, con_id, user_id, sqn, start_scn AS at FROM tx WHERE end_code = 36 UNION ALL SELECT 'transaction-open', con_id, user_id, sqn, start_scn FROM tx WHERE end_code IS NULL")
def ops_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = d.transactions(d.data_rows(spark, sf_dir))
    event = lambda kind, cond: tx.where(cond).select(F.lit(kind).alias("type"), *d.TX, F.col("start_scn").alias("at"))
    return event("transaction-discarded", "end_code = 36").unionByName(event("transaction-open", "end_code is null"))


RECORDS_SQL = f"""WITH {d.ROWS_SQL}, {SIGNALS.sql}, z AS (SELECT con_id, user_id, sqn, MIN(scn) AS a, MAX(scn) AS b, COUNT(*) AS n, EPOCH_US(MIN(ts)) // 1000 AS t0, EPOCH_US(MAX(ts)) // 1000 AS t1, con_id || '.' || user_id || '.' || sqn AS xid FROM e GROUP BY ALL), j AS (SELECT z.*, tx.end_code, tx.end_scn FROM z JOIN tx USING (con_id, user_id, sqn))
SELECT CAST(1 AS INTEGER) AS v, 'transaction-discarded' AS type, t1 AS ts_ms, 'db' AS server, a AS resume_scn, 'xid=' || xid || ';con_id=' || con_id || ';user=' || user_id || ';first_scn=' || a || ';last_scn=' || b || ';events=' || n || CASE WHEN t1 > t0 THEN ';age_ms=' || (t1 - t0) ELSE '' END AS details FROM j WHERE end_code IS NULL AND user_id % 3 = 0
UNION ALL SELECT 1, 'transaction-orphan-released', t1, 'db', a, 'xid=' || xid || ';con_id=' || con_id || ';first_scn=' || a || ';last_scn=' || b || ';events=' || n || ';reason=absent' FROM j WHERE end_code IS NULL AND user_id % 3 <> 0
UNION ALL SELECT 1, 'transaction-split', t1, 'db', NULL, 'xid=' || xid || ';commit_scn=' || end_scn || ';events=' || n || ';kafka_transactions=' || ((n + 1) // 2) FROM j WHERE end_code = 7 AND n > 2
UNION ALL SELECT 1, 'signal-ack', 0, 'db', NULL, CASE WHEN kind = 'unreadable' THEN '' ELSE 'id=' || (body::JSON ->> 'id') || ';type=' || (body::JSON ->> 'type') || ';' END || 'outcome=' || CASE kind WHEN 'unknown' THEN 'unknown' WHEN 'unreadable' THEN 'invalid' ELSE 'ok' END FROM signals"""


@query("s16_ops_event_records", RECORDS_SQL)
def ops_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of aged, orphaned and split transactions and of signals as records; details as one text."""
    rows = d.data_rows(spark, sf_dir)
    ms = lambda c: F.unix_millis(F.to_timestamp(c))
    sizes = rows.groupBy(*d.TX).agg(F.min("scn").alias("a"), F.max("scn").alias("b"), F.count("*").alias("n"), ms(F.min("ts")).alias("t0"), ms(F.max("ts")).alias("t1"))
    tx = sizes.join(d.transactions(rows), d.TX).withColumn("xid", F.concat_ws(".", *d.TX))
    c, none = F.col, F.lit(None)
    open_, done = tx.where("end_code is null"), tx.where("end_code = 7 and n > 2")
    own = {"xid": c("xid"), "con_id": c("con_id"), "first_scn": c("a"), "last_scn": c("b"), "events": c("n")}
    aged = ops.records(open_.where("user_id % 3 = 0"), "transaction-discarded", "db", c("t1"), c("a"), **own, user=c("user_id"), age_ms=F.when(c("t1") > c("t0"), c("t1") - c("t0")))
    gone = ops.records(open_.where("user_id % 3 <> 0"), "transaction-orphan-released", "db", c("t1"), c("a"), **own, reason=F.lit("absent"), client_id=none)
    split = ops.records(done, "transaction-split", "db", c("t1"), none, xid=c("xid"), commit_scn=c("end_scn"), events=c("n"), kafka_transactions=F.expr("(n + 1) div 2"))
    said = read_signals(SIGNALS.df(spark).select("body")).select("*", F.get_json_object("body", "$.id").alias("id"), F.get_json_object("body", "$.type").alias("said"))
    outcome = F.when(c("kind") == "unknown", "unknown").when(c("kind") == "unreadable", "invalid").otherwise("ok")
    acks = ops.records(said, "signal-ack", "db", F.lit(0), none, id=c("id"), type=c("said"), outcome=outcome)
    text = F.array_join(F.transform(F.map_entries("details"), lambda p: F.concat_ws("=", p["key"], p["value"])), ";")
    return reduce(DataFrame.unionByName, [aged, gone, split, acks]).withColumn("details", text)


CLASSES_SQL = """SELECT l_orderkey, l_linenumber, CAST(range AS BIGINT) AS ora,
CASE WHEN range IN (1031, 942, 1017, 28000, 1045) THEN 'CDC-5002' WHEN range IN (310, 334, 1289, 1291, 1368, 1013) THEN 'CDC-1002' WHEN range IN (1284, 308, 1285, 16226) THEN 'CDC-2002'
WHEN range IN (28, 31, 3113, 3114, 3135, 12170, 12541, 12514, 12516, 12528, 12537, 12543, 1033, 1034, 1089, 1090, 1092, 1109, 16331, 17002, 17008, 17410, 17800, 25408, 4068) THEN 'CDC-1001'
WHEN range IN (1555, 8181) THEN 'CDC-8001' END AS code,
CASE WHEN range IN (310, 334, 1289, 1291, 1368, 1013) THEN 'mine again' WHEN range IN (1555, 8181) THEN 'split' WHEN range = 1466 THEN 'wait'
WHEN range IN (28, 31, 3113, 3114, 3135, 12170, 12541, 12514, 12516, 12528, 12537, 12543, 1033, 1034, 1089, 1090, 1092, 1109, 16331, 17002, 17008, 17410, 17800, 25408, 4068) THEN 'retry' ELSE 'stop' END AS action FROM (SELECT l_orderkey, l_linenumber, 1 + (l_orderkey * 7 + l_linenumber * 4096) % 32767 AS range FROM lineitem)"""


@query("r9_k18_error_classes", CLASSES_SQL)
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error number for each line, over all that a source may have."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("ora", (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 4096) % 32767 + 1)
    code, action = errors.classify(F.col("ora"))
    return rows.select("l_orderkey", "l_linenumber", F.col("ora").cast("long").alias("ora"), code.alias("code"), action.alias("action"))


_CODE = "'ORA-' || LPAD(CAST(700 + o_orderkey % 30000 AS STRING), 5, '0') || ': it failed'"
#: A message an order: a code within one or two recursive ones, alone, none at all.
WRAPPED = Portable("wrapped", "orders", {"id": "o_orderkey", "message": choice("o_orderkey", f"'ORA-00604: error occurred at recursive SQL level 1 ' || {_CODE} || ' ORA-00308: cannot open'", "'ORA-00604: error occurred at recursive SQL level 1'", "'IO error ' || o_orderstatus", _CODE, f"'ORA-00604: x ORA-00604: y ' || {_CODE}", "NULL")})


@query("r9_effective_code", "SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 6 IN (0, 3, 4) THEN 700 + o_orderkey % 30000 WHEN o_orderkey % 6 = 1 THEN 604 END AS BIGINT) AS ora FROM orders")
def effective_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WRAPPED.df(spark, sf_dir).select("id", errors.effective_code(F.col("message")).alias("ora"))


_CODES = "CDC-1001 transient-database,CDC-1002 mining-step-retry,CDC-2001 log-gap,CDC-2002 log-purged,CDC-3001 decode,CDC-3002 corruption,CDC-3003 lob-too-large,CDC-4001 buffer-exhausted,CDC-4002 journal-corruption,CDC-4003 mining-stalled,CDC-4004 transaction-too-old,CDC-5001 topology,CDC-5002 privilege,CDC-6001 dictionary-unavailable,CDC-6002 unsupported-ddl,CDC-6003 schema-mismatch,CDC-6004 name-collision,CDC-7001 orphan-release-violation,CDC-7002 orphan-transaction,CDC-7003 resume-floor-violation,CDC-8001 snapshot-too-old"


@query("r9_error_codes", f"WITH k AS ({CLASSES_SQL}), c AS (SELECT UNNEST(STRING_SPLIT('{_CODES}', ',')) AS x) SELECT substr(x, 1, 8) AS code, substr(x, 10) AS name, substr(x, 1, 5) = 'CDC-1' AS goes_on, (SELECT COUNT(*) FROM k WHERE k.code = substr(x, 1, 8)) AS errors FROM c")
def error_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed codes, and how many of the errors in hand have each."""
    found = error_classes(spark, sf_dir).groupBy("code").agg(F.count("*").alias("errors"))
    return errors.codes(spark).join(found, "code", "left").withColumn("errors", F.coalesce("errors", F.lit(0).cast("long")))


@query("r11_workload_ledger", f"WITH {d.SURVIVORS_SQL} SELECT con_id, user_id, sqn, CAST(COUNT(*) AS BIGINT) AS ops, CAST(SUM(CASE WHEN op_code = 1 THEN 1 ELSE 0 END) AS BIGINT) AS inserts, CAST(SUM(CASE WHEN op_code = 3 THEN 1 ELSE 0 END) AS BIGINT) AS updates, CAST(SUM(CASE WHEN op_code = 2 THEN 1 ELSE 0 END) AS BIGINT) AS deletes FROM sv GROUP BY con_id, user_id, sqn")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.plans.transaction_queries import survivors

    op = F.col("op_code")
    return survivors(spark, sf_dir).groupBy(*d.TX).agg(F.count("*").alias("ops"), F.count_if(op == 1).alias("inserts"), F.count_if(op == 3).alias("updates"), F.count_if(op == 2).alias("deletes"))


# -- preflight rules ------------------------------------------------------------------------------------

SETTINGS = Static("settings", "name string, value long", (
    ("archive_mode", 0), ("minimal_logging", 1), ("undo_retention", 60), ("archive_dests", 0), ("threads", 2), ("role_ok", 0), ("version", 18), ("fixed_stats", 0), ("tx_timeout_ms", 5000), ("commit_interval_ms", 10000),
    ("keepalive_s", 900), ("idle_s", 600), ("managed_retention_h", 4), ("needed_retention_h", 24), ("standby_dictionary", 0), ("dictionary_builds", 0), ("reach_h", 3),
))
CATALOG = Static("catalog", "tab string, col string, kind string, logged string, has_key boolean, row_movement boolean, large_mode string", (
    ("T1", "ID", "NUMBER", "ALL", True, False, "inline"), ("T2", "V", "VECTOR", "KEY", True, False, "inline"), ("T3", "NOTE", "CLOB", "NONE", False, True, "skip"), ("A_TABLE_NAME_LONGER_THAN_THIRTY_CHARS", "ID", "NUMBER", "ALL", True, False, "inline"), ("T 5", "1ST", "NUMBER", "ALL", True, False, "inline"),
))
GRANTS = Static("grants", "privilege string, held boolean, pdb string, open_saved boolean", (("LOGMINING", True, "P1", True), ("SELECT ANY TRANSACTION", False, "P2", False)))
TOPICS = Static("topics", "topic string, policy string, wanted string", (("schema", "compact", "compact"), ("journal", "delete", "compact"), ("signals", None, "delete")))

#: Scalar rules: setting, severity, and when it is bad.
SCALAR_RULES = [
    ("DOC-1", "archive_mode", "blocking", "value = 0"), ("DOC-2", "minimal_logging", "blocking", "value = 0"), ("DOC-10", "reach_h", "warning", "value < 24"), ("DOC-11", "undo_retention", "warning", "value < 120"), ("DOC-12", "archive_dests", "blocking", "value = 0"),
    ("DOC-13", "threads", "blocking", "value > 1"), ("DOC-14", "role_ok", "blocking", "value = 0"), ("DOC-15", "version", "blocking", "value < 19"), ("DOC-16", "fixed_stats", "warning", "value = 0"), ("DOC-20", "dictionary_builds", "warning", "value = 0"), ("DOC-24", "standby_dictionary", "blocking", "value = 0"),
]
#: Rules over pairs of settings: the first must exceed the second.
PAIR_RULES = [("DOC-18", "tx_timeout_ms", "commit_interval_ms", "blocking"), ("DOC-19", "idle_s", "keepalive_s", "warning"), ("DOC-23", "managed_retention_h", "needed_retention_h", "warning")]
#: Rules over catalog rows: severity and condition, in SQL that both engines read.
CATALOG_RULES = [
    ("DOC-3", "CASE WHEN logged = 'NONE' THEN 'blocking' ELSE 'warning' END", "logged <> 'ALL'"), ("DOC-5", "'blocking'", "kind IN ('VECTOR', 'JSON', 'BFILE', 'BOOLEAN')"), ("DOC-6", "'blocking'", "LENGTH(tab) > 30 OR LENGTH(col) > 30"),
    ("DOC-7", "CASE WHEN row_movement THEN 'blocking' ELSE 'warning' END", "NOT has_key"), ("DOC-8", "CASE WHEN large_mode = 'skip' THEN 'info' ELSE 'warning' END", "kind IN ('CLOB', 'BLOB', 'NCLOB')"),
]
_RULES_SQL = " UNION ALL ".join(
    [f"SELECT '{r}' AS rule, '{sev}' AS severity, name AS object FROM settings WHERE name = '{n}' AND {bad}" for r, n, sev, bad in SCALAR_RULES]
    + [f"SELECT '{r}', '{sev}', a.name FROM settings a JOIN settings b ON b.name = '{low}' WHERE a.name = '{high}' AND a.value <= b.value" for r, high, low, sev in PAIR_RULES]
    + [f"SELECT '{r}', {sev}, tab || '.' || col FROM catalog WHERE {bad}" for r, sev, bad in CATALOG_RULES]
    + [
        "SELECT 'DOC-22', 'warning', tab || '.' || col FROM catalog WHERE REGEXP_MATCHES(tab || col, '[^A-Za-z0-9_$#]') OR REGEXP_MATCHES(col, '^[0-9]')",
        "SELECT 'DOC-4', 'blocking', privilege FROM grants WHERE NOT held",
        "SELECT 'DOC-21', 'warning', pdb FROM grants WHERE NOT open_saved",
        "SELECT 'DOC-17', CASE WHEN policy IS NULL THEN 'blocking' ELSE 'warning' END, topic FROM topics WHERE policy IS NULL OR policy <> wanted",
        "SELECT 'DOC-9', 'warning', CAST(thread AS VARCHAR) FROM (SELECT thread, DATE_TRUNC('hour', next_time) AS h, COUNT(*) AS n FROM logs GROUP BY ALL) WHERE n > 1 GROUP BY thread",
    ]
)


@query("r1_preflight_rules", f"WITH {d.LOGS_SQL}, {SETTINGS.sql}, {CATALOG.sql}, {GRANTS.sql}, {TOPICS.sql} {_RULES_SQL}")
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings_of(d.logs(spark, sf_dir), *(x.df(spark) for x in (SETTINGS, CATALOG, GRANTS, TOPICS)))


def findings_of(logs: DataFrame, settings: DataFrame, catalog: DataFrame, grants: DataFrame, topics: DataFrame) -> DataFrame:
    """``rule, severity, object`` of all rules over a database's log metadata, settings, columns, grants and topics."""
    found = [doctor.findings(r, settings, F.lit(sev), F.col("name"), (F.col("name") == n) & F.expr(bad)) for r, n, sev, bad in SCALAR_RULES]
    other = settings.select(F.col("name").alias("other"), F.col("value").alias("least"))
    pairs = settings.join(other, F.col("name") != F.col("other"))
    found += [doctor.findings(r, pairs, F.lit(sev), F.col("name"), (F.col("name") == high) & (F.col("other") == low) & (F.col("value") <= F.col("least"))) for r, high, low, sev in PAIR_RULES]
    column = F.concat_ws(".", "tab", "col")
    found += [doctor.findings(r, catalog, F.expr(sev), column, F.expr(bad)) for r, sev, bad in CATALOG_RULES]
    found.append(doctor.findings("DOC-22", catalog, F.lit("warning"), column, F.concat("tab", "col").rlike("[^A-Za-z0-9_$#]") | F.col("col").rlike("^[0-9]")))
    found.append(doctor.findings("DOC-4", grants, F.lit("blocking"), F.col("privilege"), ~F.col("held")))
    found.append(doctor.findings("DOC-21", grants, F.lit("warning"), F.col("pdb"), ~F.col("open_saved")))
    found.append(doctor.findings("DOC-17", topics, F.when(F.col("policy").isNull(), "blocking").otherwise("warning"), F.col("topic"), ~F.col("policy").eqNullSafe(F.col("wanted"))))
    busy = doctor.hourly(logs).where("logs > 1").select("thread").distinct()
    found.append(doctor.findings("DOC-9", busy, F.lit("warning"), F.col("thread"), F.lit(True)))
    return reduce(DataFrame.unionByName, found)
