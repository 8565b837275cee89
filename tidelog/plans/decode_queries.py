"""Decoding queries: redo text, literals, large values, canonical texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import redo, values
from tidelog.operators import large
from tidelog.plans.registry import query
from tidelog.sources import derived as d
from tidelog.sources.portable import B, Portable, Q, choice, text


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A redo statement for each order: inserts, updates, deletes and some broken ones."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    q = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    insert = F.concat(F.lit('insert into "APP"."ORDERS"("ID","STATUS","NOTE") values ('), q(key), F.lit(","), q(status), F.lit(",'it''s ok');"))
    update = F.concat(F.lit('update "APP"."ORDERS" set "STATUS" = '), q(status), F.lit(' where "ID" = '), q(key), F.lit(" and \"NOTE\" IS NULL and ROWID = 'AAA"), key, F.lit("'"))
    delete = F.concat(F.lit('delete from "APP"."ORDERS" where "ID" = '), q(key))
    broken = F.concat(F.lit("Unsupported "), key)
    k = F.col("o_orderkey") % 4
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus", F.when(k == 0, insert).when(k == 1, update).when(k == 2, delete).otherwise(broken).alias("sql"))


@query(
    "f1_parse_redo",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' END AS op, CASE WHEN o_orderkey % 4 < 2 THEN o_orderstatus END AS set_status, CASE WHEN o_orderkey % 4 = 0 THEN 'it''s ok' END AS set_note,
    CASE WHEN o_orderkey % 4 IN (1, 2) THEN CAST(o_orderkey AS VARCHAR) END AS where_id, CASE WHEN o_orderkey % 4 = 1 THEN 'AAA' || CAST(o_orderkey AS VARCHAR) END AS rowid, o_orderkey % 4 = 3 AS failed FROM orders""",
)
def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = statements(spark, sf_dir).withColumn("p", redo.parse_redo("sql"))
    get = lambda side, c: F.try_element_at(F.col(f"p.{side}"), F.lit(c))["value"]
    return p.select("o_orderkey", "p.op", get("sets", "STATUS").alias("set_status"), get("sets", "NOTE").alias("set_note"), get("where", "ID").alias("where_id"), "p.rowid", F.col("p.error").isNotNull().alias("failed"))


@query("k21_decode_error_policy", "SELECT CASE WHEN o_orderkey % 4 = 3 THEN 'dead letter' ELSE 'continue' END AS route, CAST(COUNT(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def error_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = statements(spark, sf_dir).withColumn("p", redo.parse_redo("sql"))
    return parsed.groupBy(F.when(F.col("p.error").isNotNull(), "dead letter").otherwise("continue").alias("route")).agg(F.count("*").alias("n"))


_N = "event_id"
_INTO = lambda value: text('"insert into "', "CHR(34)", '"A"', "CHR(34)", '"."', "CHR(34)", '"T"', "CHR(34)", '"("', "CHR(34)", '"C"', "CHR(34)", '") values ("') + " || " + value + " || ')'"
LITERALS = Portable("lits", "events", {"id": _N, "sql": choice(
    _N, _INTO("'NULL'"), _INTO(text(Q, '"1."', _N, '"E+010"', Q)), _INTO(text('"TO_DATE("', Q, '"2026-01-"', f"LPAD(CAST(1 + {_N} % 28 AS STRING), 2, '0')", '" 03:04:05"', Q, '","', Q, '"YYYY-MM-DD HH24:MI:SS"', Q, '")"')),
    _INTO(text('"TO_TIMESTAMP_TZ("', Q, '"2026-01-02 03:04:05."', _N, '" +05:30"', Q, '")"')), _INTO(text('"HEXTORAW("', Q, f"HEX({_N} + 256)", Q, '")"')), _INTO("'EMPTY_CLOB()'"),
    _INTO(text('"UNISTR("', Q, '"n"', B, '"00E1"', _N, '" "', B, '"D83D"', B, '"DE42"', Q, '")"')), _INTO("'SYSDATE'"), _INTO(text(Q, _N, Q)) + " || ' extra'", _INTO(text(Q, _N, Q, '","', Q, '"b"', Q)),
)})


@query(
    "f2_f3_literals",
    """SELECT event_id AS id, CASE event_id % 10 WHEN 0 THEN 'NULL' WHEN 1 THEN 'STRING' WHEN 2 THEN 'TO_DATE' WHEN 3 THEN 'TO_TIMESTAMP_TZ' WHEN 4 THEN 'HEXTORAW' WHEN 5 THEN 'EMPTY_CLOB' WHEN 6 THEN 'STRING' END AS kind,
    CASE event_id % 10 WHEN 1 THEN '1.' || event_id || 'E+010' WHEN 2 THEN STRFTIME(DATE '2026-01-01' + CAST(event_id % 28 AS INTEGER), '%Y-%m-%d') || ' 03:04:05' WHEN 3 THEN '2026-01-02 03:04:05.' || event_id || ' +05:30' WHEN 4 THEN PRINTF('%X', event_id + 256) WHEN 5 THEN '' WHEN 6 THEN 'ná' || event_id || ' 🙂' END AS value FROM events""",
)
def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lit = F.try_element_at(F.col("p.sets"), F.lit("C"))
    return LITERALS.df(spark, sf_dir).withColumn("p", redo.parse_redo("sql")).select("id", lit["kind"].alias("kind"), lit["value"].alias("value"))


_K = "o_orderkey"
TEXTS = Portable("texts", "orders", {"id": _K, "hex_in": choice(_K, f"' ' || HEX({_K} * 256 + 4096)", f"HEX({_K} % 16)", "''", "NULL", "'xyz1'"), "ts_in": choice(_K, "SUBSTR(CAST(o_orderdate AS STRING), 1, 10) || ' 01:02:03'", "'2026-13-02 03:04:05'", "'bad'", "NULL"),
    "ym": choice(_K, text('"+"', f"{_K} % 50", '"-"', f"{_K} % 12"), text('"-"', f"{_K} % 50", '"-0"', f"{_K} % 10"), "'x'", "NULL"), "ds": choice(_K, text('"+"', f"{_K} % 90", '" 04:03:0"', f"{_K} % 10", '".5"'), text('"-"', f"{_K} % 90", '" 00:00:01"'), "'1 2'", "NULL"),
    "num": choice(_K, text('"00"', f"{_K}", '".500"'), "'-0.00'", text(f"{_K}", '".0"'), "NULL"), "rid": choice(_K, text('"AAA"', _K, '"#R1"'), "'#X'", text('"B"', _K), "NULL")})


@query(
    "f4_f5_f7_f9_f17_scalars",
    """SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN CASE WHEN LENGTH(PRINTF('%X', o_orderkey * 256 + 4096)) % 2 = 0 THEN PRINTF('%X', o_orderkey * 256 + 4096) END WHEN 2 THEN '' END AS hex_out,
    CASE WHEN o_orderkey % 4 = 0 THEN DATE_TRUNC('day', o_orderdate) + INTERVAL '1 hour 2 minutes 3 seconds' END AS ts_out, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 50 * 12 + o_orderkey % 12 WHEN 1 THEN -(o_orderkey % 50 * 12 + o_orderkey % 10) END AS INTEGER) AS months,
    CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 90 * 86400 + 14580 + o_orderkey % 10) * 1000000 + 500000 WHEN 1 THEN -(o_orderkey % 90 * 86400 + 1) * 1000000 END AS micros,
    CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || '.5' WHEN 1 THEN '0' WHEN 2 THEN CAST(o_orderkey AS VARCHAR) END AS number, CASE o_orderkey % 4 WHEN 0 THEN 'AAA' || o_orderkey WHEN 2 THEN 'B' || o_orderkey END AS rowid FROM orders""",
)
def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TEXTS.df(spark, sf_dir).select(
        "id", F.hex(values.hex_bytes(F.col("hex_in"))).alias("hex_out"), values.local_time(F.col("ts_in")).alias("ts_out"), values.months(F.col("ym")).cast("int").alias("months"),
        values.interval_micros(F.col("ds")).alias("micros"), values.canonical_number(F.col("num")).alias("number"), values.rowid_part(F.col("rid")).alias("rowid"),
    )


@query("f6_zoned_time", "SELECT o_orderkey, EPOCH_US(o_orderdate) - 19800000000 AS utc_us, EPOCH_US(o_orderdate) AS plain_us FROM orders")
def zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return rows.select("o_orderkey", F.unix_micros(values.zoned_instant(F.concat(text, F.lit(" +05:30")))).alias("utc_us"), F.unix_micros(values.zoned_instant(text)).alias("plain_us"))


@query("f8_epochs", "SELECT event_id, EPOCH_US(ts) // 1000 AS ms, EPOCH_US(ts) AS us, EPOCH_US(ts) * 1000 AS ns FROM events")
def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.to_timestamp("ts")
    return d.events(spark, sf_dir).select("event_id", *[values.epoch(ts, u).alias(u) for u in ("ms", "us", "ns")])


@query("f12_local_text", "SELECT event_id, CASE WHEN EPOCH_US(ts) % 1000000 = 0 AND EXTRACT(SECOND FROM ts) = 0 THEN STRFTIME(ts, '%Y-%m-%dT%H:%M') WHEN EPOCH_US(ts) % 1000000 = 0 THEN STRFTIME(ts, '%Y-%m-%dT%H:%M:%S') WHEN EPOCH_US(ts) % 1000 = 0 THEN STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.%g') ELSE STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS txt FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN DATE_TRUNC('minute', ts) WHEN 1 THEN DATE_TRUNC('second', ts) WHEN 2 THEN DATE_TRUNC('milliseconds', ts) ELSE ts END AS ts FROM events)")
def local_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    cut = F.when(k == 0, F.date_trunc("minute", "ts")).when(k == 1, F.date_trunc("second", "ts")).when(k == 2, F.date_trunc("millisecond", "ts")).otherwise(F.to_timestamp("ts"))
    return d.events(spark, sf_dir).withColumn("ts", cut.cast("timestamp_ntz")).select("event_id", values.local_text(F.col("ts")).alias("txt"))


@query("f13_interval_micros", "SELECT o_orderkey, CAST(FLOOR((o_orderkey % 100) * (365.25::DOUBLE / 12) * 86400000000 + 0.5) AS BIGINT) AS us FROM orders")
def interval_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", values.months_to_micros(F.col("o_orderkey") % 100).alias("us"))


@query("f14_f26_binary_text", "SELECT c_custkey, LOWER(HEX(ENCODE(c_name))) AS hex_text, TO_BASE64(ENCODE(c_name)) AS b64, LOWER(REGEXP_REPLACE(HEX(ENCODE(c_name)), '(..)', '00\\1', 'g')) AS utf16 FROM customer")
def binary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.encode("c_name", "UTF-8")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.lower(F.hex(F.unbase64(F.base64(name)))).alias("hex_text"), F.base64(name).alias("b64"), F.lower(F.hex(F.encode("c_name", "UTF-16BE"))).alias("utf16"))


#: The digits of the shortest text and the power of ten of the first of them, then the form by that power.
DOUBLE_SQL = """WITH t AS (SELECT event_id, value, CAST(ABS(value) AS VARCHAR) AS s FROM events),
p AS (SELECT event_id, value, s, REGEXP_EXTRACT(s, '^([0-9]+)', 1) AS whole, REGEXP_EXTRACT(s, '\\.([0-9]+)', 1) AS part, COALESCE(TRY_CAST(REGEXP_EXTRACT(s, 'e([-+]?[0-9]+)', 1) AS INTEGER), 0) AS e FROM t),
q AS (SELECT event_id, value, s, RTRIM(LTRIM(whole || part, '0'), '0') AS digits, CASE WHEN whole = '0' THEN e - 1 - (LENGTH(part) - LENGTH(LTRIM(part, '0'))) ELSE e + LENGTH(whole) - 1 END AS power FROM p)
SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN ISNAN(value) THEN 'NaN' ELSE (CASE WHEN value < 0 THEN '-' ELSE '' END) ||
CASE WHEN ISINF(value) THEN 'Infinity' WHEN value = 0 THEN '0.0' WHEN ABS(value) >= 0.001 AND ABS(value) < 10000000 THEN s
ELSE SUBSTR(digits, 1, 1) || '.' || CASE WHEN LENGTH(digits) > 1 THEN SUBSTR(digits, 2) ELSE '0' END || 'E' || power END END AS txt FROM q"""


@query("f11_double_text", DOUBLE_SQL)
def double_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.events(spark, sf_dir).select("event_id", F.col("value").cast("string").alias("txt"))


DECIMALS = Portable("decs", "orders", {"id": _K, "txt": choice(_K, text(f"{_K} % 12", '"."', f"{_K} % 10"), text('"-"', f"{_K} % 12", '"."', f"{_K} % 10"), text(f"{_K} % 3", '"E+2"'), "'x'")})


@query(
    "f10_variable_decimals",
    """WITH u AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 12 * 10 + o_orderkey % 10 WHEN 1 THEN -(o_orderkey % 12 * 10 + o_orderkey % 10) WHEN 2 THEN o_orderkey % 3 * 100 END AS u, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 END AS scale FROM orders)
    SELECT id, CAST(scale AS INTEGER) AS scale, CASE WHEN u < 128 AND u >= -128 THEN PRINTF('%02X', (u + 256) % 256) ELSE PRINTF('%04X', (u + 65536) % 65536) END AS hex FROM u""",
)
def variable_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DECIMALS.df(spark, sf_dir).select("id", values.variable_decimal("txt").alias("v")).select("id", "v.scale", F.hex("v.value").alias("hex"))


def _offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored position for each order, with two, one or no pending transactions."""
    key = F.col("o_orderkey")
    pending = F.when(key % 3 == 0, F.array(key + 60, key + 70 - key % 40)).when(key % 3 == 1, F.array(key + 1)).otherwise(F.array().cast("array<bigint>"))
    scn = F.when(key % 3 == 0, key + 50).otherwise(key).cast("string")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(key.alias("id"), F.to_json(F.struct(scn.alias("scn"), F.transform(pending, lambda p: F.struct(p.alias("scn"))).alias("pending"))).alias("doc"))


@query("f25_offset_documents", "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN LEAST(o_orderkey + 50, o_orderkey + 70 - o_orderkey % 40) ELSE o_orderkey END AS scn FROM orders")
def offset_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("doc", "scn string, pending array<struct<scn:long>>")
    return _offsets(spark, sf_dir).select("id", F.array_min(F.concat(F.array(p["scn"].cast("long")), F.transform(p["pending"], lambda x: x["scn"]))).alias("scn"))


@query("f20_human_texts", "SELECT o_orderkey, CASE WHEN b < 1048576 THEN (b // 1024)::VARCHAR || ' KiB' WHEN b < 1073741824 THEN (b // 1048576)::VARCHAR || ' MiB' WHEN b % 1073741824 = 0 THEN (b // 1073741824)::VARCHAR || ' GiB' ELSE FORMAT('{:.1f}', FLOOR(b / 1073741824.0::DOUBLE * 10 + 0.5) / 10) || ' GiB' END AS size, CASE WHEN m < 60 THEN m::VARCHAR || ' min' WHEN m % 60 = 0 THEN (m // 60)::VARCHAR || ' h' ELSE (m // 60)::VARCHAR || ' h ' || (m % 60)::VARCHAR || ' min' END AS age FROM (SELECT o_orderkey, o_orderkey * o_orderkey * 1048576 // 64 AS b, o_orderkey % 500 AS m FROM orders)")
def human_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", values.human_bytes(key * key * 16384).alias("size"), values.human_minutes(key % 500).alias("age"))


def _block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block for each order that writes, erases and trims, or is broken."""
    key = F.col("o_orderkey").cast("string")
    size = F.length(key)
    head = F.concat(F.lit('DECLARE loc_c CLOB; buf_c VARCHAR2(100); loc_num NUMBER; BEGIN select "NOTE" into loc_c from "APP"."T" where "ID" = \''), key, F.lit("' for update; buf_c := '"), key, F.lit("'; dbms_lob.write(loc_c, "))
    amount = F.when(F.col("o_orderkey") % 3 == 1, size + 1).otherwise(size)
    whole = F.concat(head, amount.cast("string"), F.lit(", 1, buf_c); dbms_lob.erase(loc_c, 2, 2); dbms_lob.trim(loc_c, 4); END;"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 2, F.concat(F.lit("DECLARE x NUMBER; nothing "), key)).otherwise(whole).alias("sql"))


@query("f19_large_blocks", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'write,erase,trim' END AS kinds, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS where_id, CASE WHEN o_orderkey % 3 = 0 THEN LENGTH(CAST(o_orderkey AS VARCHAR)) END AS amount FROM orders")
def large_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _block(spark, sf_dir).withColumn("p", redo.parse_large_block("sql"))
    return p.select("o_orderkey", F.array_join(F.transform("p.edits", lambda e: e["edit"]), ",").alias("kinds"), F.try_element_at(F.col("p.where"), F.lit("ID"))["value"].alias("where_id"), F.get("p.edits", F.lit(0))["amount"].alias("amount"))


@query("f18_large_edits", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE RPAD(LEFT('base', CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 2 END), 5, ' ') || 'x' || o_orderstatus END AS value, o_orderkey % 3 <> 2 AS known FROM orders")
def large_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    edit = lambda o, e, n, at, data: F.struct(F.lit(o).alias("ord"), F.lit(e).alias("edit"), F.lit(n).cast("long").alias("amount"), F.lit(at).cast("long").alias("offset"), data.alias("data"))
    k = F.col("o_orderkey") % 3
    write = edit(2, "write", 2, 6, F.concat(F.lit("x"), "o_orderstatus"))
    steps = F.when(k == 1, F.array(edit(1, "trim", 2, 0, F.lit(None).cast("string")), write)).otherwise(F.array(write))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.when(k != 2, "base").alias("base"), F.lit(False).alias("binary"), F.explode(steps).alias("s")).select("o_orderkey", "base", "binary", "s.*")
    return large.fold_edits(rows, ["o_orderkey"])


@query(
    "j10_locator_updates",
    f"""WITH {d.ROWS_SQL}, w AS (SELECT con_id, user_id, sqn, scn, op_code, event_id, tab, LAG(op_code) OVER x AS po, LAG(tab) OVER x AS pt, LEAD(op_code) OVER x AS no, LEAD(tab) OVER x AS nt, LEAD(event_id) OVER x AS ne FROM e WHERE NOT undo WINDOW x AS (PARTITION BY con_id, user_id, sqn ORDER BY scn))
    SELECT event_id, CASE WHEN op_code = 1 AND no = 3 AND nt = tab THEN ne ELSE event_id END AS large FROM w WHERE NOT COALESCE(op_code = 3 AND po = 1 AND pt = tab, FALSE)""",
)
def locator_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.data_rows(spark, sf_dir).where("not undo")
    return large.fold_locator_updates(rows, d.TX, "scn", F.col("tab"), F.col("event_id")).select("event_id", "large")


@query(
    "j9_large_fragments",
    """WITH f AS (SELECT user_id, event_id, event_type, MAX(CASE WHEN event_type NOT IN ('click', 'view') THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS opener FROM events)
    SELECT f.user_id, f.opener AS change, LEFT(ARG_MAX(f.event_type, f.event_id), 1) AS value FROM f JOIN events o ON o.event_id = f.opener WHERE f.event_type IN ('click', 'view') AND o.event_type = 'signup' GROUP BY f.user_id, f.opener""",
)
def large_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "locator").when(F.col("event_type").isin("click", "view"), "write").otherwise("other")
    rows = d.events(spark, sf_dir).select("user_id", "event_id", kind.alias("edit"), F.lit(1).cast("long").alias("amount"), F.lit(1).cast("long").alias("offset"), F.substring("event_type", 1, 1).alias("data"))
    # values start empty and each write is at the first place, so the last one stands
    return large.assemble(rows, ["user_id"], "event_id", base="")
