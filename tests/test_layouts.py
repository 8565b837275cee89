"""Layouts made from readings of the dictionary and from the log's own statements."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.test_capture import row
from tidelog.functions.types import RAW_ROW
from tidelog.operators import layouts as lay, schema
from tidelog.options import Options
from tidelog.plans.capture import capture, log_layouts

BASE = datetime.datetime(2026, 10, 6, 9)
TYPES = {"ID": "NUMBER", "NAME": "VARCHAR2", "EXTRA": "VARCHAR2"}


def at(scn):
    """The log's clock: position 1000 is at BASE and each position one second later."""
    return BASE + datetime.timedelta(seconds=scn - 1000)


def timed(scn, op, **more):
    r = list(row(scn, op, **more))
    r[RAW_ROW.fieldNames().index("TIMESTAMP")] = at(scn)
    return tuple(r)


def insert(scn, sqn, names, values, rid, tab="T"):
    given = ",".join(f'"{n}"' for n in names), ",".join(f"'{v}'" for v in values)
    return [timed(scn, 6, sqn=sqn), timed(scn + 1, 1, sqn=sqn, sql=f'insert into "APP"."{tab}"({given[0]}) values ({given[1]})', rid=rid, tab=tab), timed(scn + 2, 7, sqn=sqn)]


def ddl(scn, sqn, sql, tab="T"):
    return [timed(scn, 6, sqn=sqn), timed(scn + 1, 5, sqn=sqn, sql=sql, tab=tab), timed(scn + 2, 7, sqn=sqn)]


def reading(read, columns, last_ddl, tab="T", key=("ID",)):
    shown = [(c, TYPES[c], -1, -1) for c in columns] if columns else None
    return ("P1", "APP", tab, read, at(read), None if last_ddl is None else at(last_ddl), shown, list(key), None)


def tables(spark, log, readings, include=r"P1\.APP\.T", **more):
    raw = spark.createDataFrame(log, RAW_ROW)
    return log_layouts(raw, spark.createDataFrame(readings, lay.DICTIONARY), Options(include=[include]), **more)


def told(df):
    return sorted(((r["tab"], r["version"], r["valid_from"], r["exact"], [c["name"] for c in r["columns"]] if r["columns"] else None, r["cause"]) for r in df.collect()), key=lambda r: (r[0], r[2], r[1] is None))


def records(spark, log, readings, start=1100, include=r"P1\.APP\.T", **options):
    raw = spark.createDataFrame(log, RAW_ROW)
    got = capture(raw, options=Options.of({"include": include, "decode_error": "dlq", **options}), dictionary=spark.createDataFrame(readings, lay.DICTIONARY), start=start)
    rows = got.records.orderBy("commit_scn", "event_index", "sub").collect()
    return [(json.loads(r["value"])["op"], json.loads(r["value"])["after"], r["headers"]["cdc.schema_version"]) for r in rows if r["value"]], [r["exception"] for r in got.dead.collect()]


BEFORE, AFTER = ("ID", "NAME"), ("ID", "NAME", "EXTRA")
ADD = "alter table app.t add (extra varchar2(10))"


def test_rows_after_a_statement_decode_with_the_new_version(spark):
    log = insert(1101, 1, BEFORE, (1, "one"), "A") + ddl(1105, 2, ADD) + insert(1110, 3, AFTER, (2, "two", "x"), "B")
    readings = [reading(1100, BEFORE, 1000), reading(1112, AFTER, 1106)]
    assert told(tables(spark, log, readings, start=1100)) == [("T", 1, 1100, True, list(BEFORE), "start"), ("T", 2, 1106, True, list(AFTER), "ddl")]
    assert records(spark, log, readings) == ([("c", {"ID": "1", "NAME": "one"}, "1"), ("c", {"ID": "2", "NAME": "two", "EXTRA": "x"}, "2")], [])
    early = insert(1101, 1, AFTER, (1, "one", "x"), "A") + log[3:]
    assert records(spark, early, readings)[1] == ["column EXTRA is not in the layout"]


def test_a_truncation_is_delivered_between_its_commits_and_changes_nothing(spark):
    log = insert(1101, 1, BEFORE, (1, "one"), "A") + ddl(1105, 2, "truncate table app.t") + insert(1110, 3, BEFORE, (2, "two"), "B")
    readings = [reading(1100, BEFORE, 1000)]
    assert [r[0] for r in told(tables(spark, log, readings, start=1100))] == ["T"]
    found, dead = records(spark, log, readings, truncates="true")
    assert [(op, version) for op, _, version in found] == [("c", "1"), ("t", "1"), ("c", "1")] and not dead


def test_an_unknown_statement_stops_on_a_captured_table_only(spark):
    other = ddl(1101, 1, "alter table app.other frobnicate", tab="OTHER")
    readings = [reading(1100, BEFORE, 1000), reading(1100, BEFORE, 1000, tab="OTHER")]
    assert len(told(tables(spark, other, readings, start=1100))) == 1
    with pytest.raises(Exception, match=r"CDC-6002.*P1\.APP\.T.*frobnicate"):
        tables(spark, other + ddl(1105, 2, "alter table app.t  frobnicate"), readings, start=1100).collect()


def test_a_dropped_table_is_forgotten_and_a_made_one_begins_anew(spark):
    log = insert(1101, 1, BEFORE, (1, "one"), "A") + ddl(1105, 2, "drop table app.t purge") + insert(1109, 3, BEFORE, (2, "two"), "B") + ddl(1115, 4, "create table app.t (id number)") + insert(1120, 5, ("ID",), (3,), "C")
    readings = [reading(1100, BEFORE, 1000), reading(1110, None, None), reading(1118, ("ID",), 1116)]
    assert told(tables(spark, log, readings, start=1100)) == [("T", 1, 1100, True, list(BEFORE), "start"), ("T", None, 1106, True, None, "drop"), ("T", 1, 1116, True, ["ID"], "ddl")]
    found, dead = records(spark, log, readings)
    assert [r[1]["ID"] for r in found] == ["1", "3"] and dead == ["no layout at this position"]


def test_a_renamed_table_goes_on_under_its_new_name(spark):
    log = insert(1101, 1, BEFORE, (1, "one"), "A") + ddl(1105, 2, 'alter table app.t rename to "U"') + insert(1109, 3, BEFORE, (2, "two"), "B", tab="U") + ddl(1113, 4, "rename u to v", tab="U") + insert(1117, 5, BEFORE, (3, "x"), "C", tab="V")
    readings = [reading(1100, BEFORE, 1000)]
    assert told(tables(spark, log, readings, include=r"P1\.APP\.[TUV]", start=1100)) == [
        ("T", 1, 1100, True, list(BEFORE), "start"), ("T", None, 1106, True, None, "rename"), ("U", 1, 1106, True, list(BEFORE), "rename"), ("U", None, 1114, True, None, "rename"), ("V", 1, 1114, True, list(BEFORE), "rename")]
    found, dead = records(spark, log, readings, include=r"P1\.APP\.[TUV]")
    assert [r[1]["ID"] for r in found] == ["1", "2", "3"] and not dead


def test_new_names(spark):
    given = ["alter table t rename to u", 'ALTER TABLE "A"."t" RENAME TO "x y";', "rename a to b$1", "alter table t rename column a to b", "alter table t rename constraint a to b", "drop table t", None, "/* c */ rename -- x\n a to c"]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(given)], "k int, s string").select("k", schema.ddl_kind(F.col("s")).alias("kind"), schema.new_name(F.col("s")).alias("n"))
    assert [r["n"] for r in df.orderBy("k").collect() if r["kind"] == "RENAME_TABLE"] == ["U", "x y", "B$1", "C"]


def test_a_first_version_holds_from_the_start_only_where_no_statement_can_lie_behind(spark):
    log = insert(1101, 1, BEFORE, (1, "one"), "A") + ddl(1105, 2, ADD) + [timed(1116 + k, 6, sqn=9) for k in range(3)]
    # the statement ran three seconds after the start and before the reading: valid from ten seconds after it
    late = [reading(1107, AFTER, 1106)]
    assert told(tables(spark, log, late, start=1103)) == [("T", 1, 1116, True, list(AFTER), "start")]
    assert records(spark, log, late, start=1103)[1] == ["no layout at this position"]
    # judged at 1108, the version holds from the position where reading begins
    old = [timed(1001 + k, 6, sqn=8) for k in range(108)] + insert(1110, 3, BEFORE, (2, "x"), "B")
    assert told(tables(spark, old, [reading(1110, BEFORE, 1050)], start=1001, quiet=1108))[0][2] == 1001
    assert told(tables(spark, old, [reading(1110, BEFORE, 1050)], start=1001))[0][2] == 1060
    assert told(tables(spark, old, [reading(1110, BEFORE, None)], start=1001))[0][2] == 0


def test_a_table_that_joins_is_read_when_it_joins(spark):
    log = [timed(1099, 6, sqn=8)] + insert(1101, 1, BEFORE, (1, "one"), "A", tab="J") + ddl(1105, 2, ADD.replace("app.t", "app.j"), tab="J") + insert(1110, 3, AFTER, (2, "two", "x"), "B", tab="J")
    readings = [reading(1100, BEFORE, 1000, tab="J"), reading(1112, AFTER, 1106, tab="J")]
    joined = spark.createDataFrame([("P1", "APP", "J", 1100)], "pdb string, owner string, tab string, at long")
    assert told(tables(spark, log, readings, include=r"P1\.APP\.J", start=1000, joined=joined)) == [("J", 1, 1100, True, list(BEFORE), "start"), ("J", 2, 1106, True, list(AFTER), "ddl")]


def test_a_reading_ahead_of_its_statement_is_inexact_until_confirmed(spark):
    log = [timed(1099, 6, sqn=8)] + ddl(1105, 2, ADD) + insert(1110, 3, AFTER, (2, "two", "x"), "B") + ddl(1130, 4, "alter table app.t add constraint c check (id > 0)")
    ahead = [reading(1100, BEFORE, 1000), reading(1133, AFTER, 1131)]
    assert told(tables(spark, log, ahead, start=1100)) == [("T", 1, 1100, True, list(BEFORE), "start"), ("T", 2, 1106, False, list(AFTER), "ddl"), ("T", 3, 1131, True, list(AFTER), "ddl")]
    assert records(spark, log, ahead)[1] == ["no exact layout at this position"]


def test_keys_and_empty_tables(spark):
    keyed = [("P1", "APP", "T", 1100, at(1100), at(1000), [("ID", "NUMBER", -1, -1)], None, ["ID"]), ("P1", "APP", "U", 1100, at(1100), at(1000), [("ID", "NUMBER", -1, -1)], None, None)]
    df = tables(spark, ddl(1105, 2, "comment on table t is 'x'"), keyed, include=r"P1\..*", start=1100)
    assert sorted((r["tab"], r["key"]) for r in df.collect()) == [("T", ["ID"]), ("U", [])]
    assert tables(spark, [], [], start=1).count() == 0


def test_a_row_finds_its_version_among_many_by_a_search_tree(spark, monkeypatch):
    monkeypatch.setattr(lay, "FAN", 3)
    rng = random.Random(5)
    columns = [("ID", "NUMBER", 18, 0)]
    known = [("P1", "APP", tab, v, rng.randrange(400), v % 5 > 0, columns if v % 7 else None, ["ID"]) for tab, n in (("T", 100), ("U", 1), ("V", 28)) for v in range(1, n + 1)]
    rows = [("P1", "APP", tab, scn) for tab in "TUVW" for scn in range(-1, 402)]
    for bound in (lay.BROADCAST_VERSIONS, 10):
        monkeypatch.setattr(lay, "BROADCAST_VERSIONS", bound)
        changes = spark.createDataFrame(rows, "pdb string, owner string, tab string, scn long")
        got = lay.resolve(changes, spark.createDataFrame(known, lay.LAYOUT))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_versions" not in plan
        want = {}
        for _, _, tab, scn in rows:
            last = max(((k[4], k[3], k) for k in known if k[2] == tab and k[4] <= scn), default=None)
            want[tab, scn] = last[1] if last and last[2][6] else None
        assert {(r["tab"], r["scn"]): r["layout"] and r["layout"]["version"] for r in got.collect()} == want
