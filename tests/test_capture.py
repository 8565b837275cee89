"""A whole capture over a hand-written raw log."""

from __future__ import annotations

import datetime
import json

import pytest

from tidelog.functions.types import RAW_ROW
from tidelog.options import Options
from tidelog.plans.capture import capture

NOW = datetime.datetime(2026, 1, 2, 3, 4, 5)
KEYS = {"APP.T": ["ID"]}


def row(scn, op, sqn=1, sql=None, rid=None, undo=0, csf=0, tab="T", user="U", owner="APP"):
    given = {"SCN": scn, "TIMESTAMP": NOW, "THREAD#": 1, "XIDUSN": 1, "XIDSLT": 2, "XIDSQN": sqn, "OPERATION_CODE": op, "ROLLBACK": undo, "SEG_OWNER": owner, "TABLE_NAME": tab, "USERNAME": user, "ROW_ID": rid, "RS_ID": f"0x{scn:08d} ", "SSN": 0, "CSF": csf, "SRC_CON_ID": 3, "SRC_CON_NAME": "P1", "SQL_REDO": sql}
    return tuple(given.get(n) for n in RAW_ROW.fieldNames())


LOG = [
    row(1, 6), row(2, 1, sql='insert into "APP"."T"("ID","V") ', rid="A", csf=1), row(3, 1, sql="values ('1','x')", rid="A"),
    row(4, 3, sql='update "APP"."T" set "V" = \'y\' where "ID" = \'1\' and "V" = \'x\'', rid="A"), row(5, 3, sql='update "APP"."T" set "V" = \'x\' where "ID" = \'1\'', rid="A", undo=1),
    row(6, 3, sql='update "APP"."T" set "ID" = \'2\' where "ID" = \'1\' and "V" = \'x\'', rid="A"), row(7, 2, sql='delete from "APP"."T" where "ID" = \'9\' and "V" IS NULL', rid="B"), row(8, 7),
    row(11, 6, sqn=2), row(12, 1, sqn=2, sql='insert into "APP"."T"("ID","V") values (\'5\',NULL)', rid="C"), row(13, 36, sqn=2),
    row(21, 6, sqn=3), row(22, 1, sqn=3, sql='insert into "APP"."OTHER"("ID") values (\'5\')', rid="D", tab="OTHER"), row(23, 7, sqn=3),
    row(31, 6, sqn=4), row(32, 1, sqn=4, sql='insert into "APP"."T"("ID") values (\'5\')', rid="E", user="BATCH"), row(33, 7, sqn=4),
]


def test_records_of_a_log(spark):
    raw = spark.createDataFrame(LOG, RAW_ROW)
    got = capture(raw, KEYS, Options(include=[r"P1\.APP\.T"], exclude_users=["BATCH"], exclude_columns=[r".*\.NOTHING"]), server="srv").records.orderBy("commit_scn", "event_index", "sub").collect()
    told = [(json.loads(r["value"])["op"] if r["value"] else None, json.loads(r["key"])["ID"]) for r in got]
    assert told == [("c", "1"), ("d", "1"), (None, "1"), ("c", "2"), ("d", "9"), (None, "9")]
    first = json.loads(got[0]["value"])
    assert first["after"] == {"ID": "1", "V": "x"} and first["transaction"] == {"id": "1.2.1", "total_order": 1, "data_collection_order": 1}
    assert got[0]["topic"] == "srv.APP.T" and got[0]["headers"]["cdc.event_count"] == "3" and first["source"]["commit_scn"] == "8"


def test_undecodable_rows(spark):
    bad = [row(1, 6), row(2, 255, sql="Unsupported", rid="A"), row(3, 1, sql='insert into "APP"."T"("ID") values (\'1\')', rid="B"), row(4, 7)]
    raw = spark.createDataFrame(bad, RAW_ROW)
    got = capture(raw, KEYS, Options.of({"decode_error": "dlq"}))
    assert got.records.count() == 1 and got.dead.first()["sql_redo"] == "Unsupported"
    with pytest.raises(Exception, match="cannot decode"):
        capture(raw, KEYS).records.collect()


def test_excluded_columns_leave_records_and_dead_letters(spark):
    log = [row(1, 6), row(2, 1, sql='insert into "APP"."T"("ID","V") values (\'1\',\'s3cret\')', rid="B"), row(3, 255, sql="Unsupported s3cret", rid="C"), row(4, 7)]
    got = capture(spark.createDataFrame(log, RAW_ROW), KEYS, Options.of({"decode_error": "dlq", "exclude_columns": r".*\.T\.V"}))
    assert "s3cret" not in got.records.first()["value"] and got.dead.first()["sql_redo"] is None


def test_flat_records(spark):
    raw = spark.createDataFrame(LOG, RAW_ROW)
    told = {}
    for tombstones in ("true", "false"):
        options = Options.of({"include": r"P1\.APP\.T", "exclude_users": "BATCH", "format": "flat", "tombstones": tombstones})
        rows = capture(raw, KEYS, options).records.orderBy("commit_scn", "event_index", "sub").collect()
        told[tombstones] = [(json.loads(r["value"])["op_type"] if r["value"] else None, json.loads(r["key"])["ID"]) for r in rows]
        assert json.loads(rows[0]["value"])["V"] == "x" and json.loads(rows[0]["value"])["table"] == "P1.APP.T"
    assert told["true"] == [("I", "1"), (None, "1"), ("I", "2"), (None, "9")]
    assert told["false"] == [("I", "1"), (None, "1"), ("I", "2"), ("D", "9")]


COLUMNS = [("ID", "NUMBER", 9, 0), ("AMOUNT", "NUMBER", 12, 2), ("NAME", "VARCHAR2", -1, -1), ("BORN", "DATE", -1, -1), ("SEEN", "TIMESTAMP(6)", -1, 6), ("RATIO", "BINARY_DOUBLE", -1, -1), ("BITS", "RAW", -1, -1), ("NOTE", "CLOB", -1, -1)]
LAYOUTS = [("P1", "APP", "T", 1, 0, True, COLUMNS[:3], ["ID"]), ("P1", "APP", "T", 2, 100, True, COLUMNS, ["ID"]), ("P1", "APP", "NOKEY", 1, 0, True, COLUMNS[:3], []), ("P1", "APP", "OLD", 1, 50, True, COLUMNS[:3], ["ID"])]
TYPED = (
    "insert into \"APP\".\"T\"(\"ID\",\"AMOUNT\",\"NAME\",\"BORN\",\"SEEN\",\"RATIO\",\"BITS\",\"NOTE\") values ('7','012.50','q\"x',TO_DATE('1970-01-02 00:00:01', 'YYYY-MM-DD HH24:MI:SS'),TO_TIMESTAMP('1970-01-01 00:00:00.000005'),'1.5E+010',HEXTORAW('00ff'),EMPTY_CLOB())"
)


def _block(column, *edits):
    lines = "".join(f" buf := '{text}'; dbms_lob.write(loc, {len(text)}, {at}, buf);" for at, text in edits)
    return f'DECLARE loc CLOB; buf VARCHAR2(6000); BEGIN select "{column}" into loc from "APP"."T" where "ID" = \'7\' for update;{lines} END;'


def test_layouts_type_values_by_position(spark):
    layouts = spark.createDataFrame(LAYOUTS, "pdb string, owner string, tab string, version long, valid_from long, exact boolean, columns array<struct<name:string,type:string,precision:int,scale:int>>, key array<string>")
    log = [
        row(1, 6), row(2, 1, sql='insert into "APP"."T"("ID","AMOUNT","NAME") values (\'1\',\'1.50\',NULL)', rid="A"), row(3, 1, sql='insert into "APP"."T"("ID","BITS") values (\'1\',HEXTORAW(\'00\'))', rid="B"),
        row(4, 1, sql='insert into "APP"."T"("ID") values (\'1.5\')', rid="C"), row(5, 1, sql='insert into "APP"."OLD"("ID") values (\'1\')', rid="D", tab="OLD"), row(6, 1, sql='insert into "APP"."NOKEY"("ID") values (\'1\')', rid="E", tab="NOKEY"), row(7, 7),
        row(101, 6, sqn=2), row(102, 1, sqn=2, sql=TYPED, rid="F"), row(103, 10, sqn=2, sql=_block("NOTE", (1, "hello "), (7, "world")), rid="F"), row(104, 7, sqn=2),
        row(111, 6, sqn=3), row(112, 10, sqn=3, sql=_block("NOTE", (1, "anew")), rid="F"), row(113, 5, sqn=3, sql="TRUNCATE TABLE app.t", rid=None), row(114, 7, sqn=3),
    ]
    raw = spark.createDataFrame(log, RAW_ROW)
    got = capture(raw, options=Options.of({"decode_error": "dlq", "truncates": "true"}), layouts=layouts)
    assert sorted((r["tab"], r["exception"]) for r in got.dead.collect()) == [("NOKEY", "the table has no key"), ("OLD", "no layout at this position"), ("T", "column BITS is not in the layout"), ("T", "column ID is no NUMBER")]
    records = got.records.orderBy("commit_scn", "event_index", "sub").collect()
    told = [json.loads(r["value"]) for r in records]
    assert told[0]["after"] == {"ID": 1, "AMOUNT": "1.5", "NAME": None} and records[0]["key"] == '{"ID":1}' and records[0]["headers"]["cdc.schema_version"] == "1"
    assert told[1]["after"] == {"ID": 7, "AMOUNT": "12.5", "NAME": 'q"x', "BORN": 86_401_000, "SEEN": 5, "RATIO": 1.5e10, "BITS": "AP8=", "NOTE": "hello world"} and records[1]["headers"]["cdc.schema_version"] == "2"
    # the edit of the third transaction leaves a part of a value whose rest is not known: the record has no column for it
    assert [t["op"] for t in told] == ["c", "c", "u", "t"] and told[2]["after"] == {"ID": 7}
    keyed = capture(raw, options=Options.of({"decode_error": "dlq", "keyless": "rowid", "decimals": "DOUBLE", "temporals": "ISO_STRING", "large_values": "skip"}), layouts=layouts).records.orderBy("commit_scn", "event_index").collect()
    assert [r["key"] for r in keyed if "NOKEY" in r["topic"]] == ['{"ROWID":"E"}']
    typed = json.loads(keyed[-1]["value"])["after"]
    assert typed["AMOUNT"] == 12.5 and typed["BORN"] == "1970-01-02T00:00:01" and typed["SEEN"] == "1970-01-01T00:00:00.000005" and typed["NOTE"] == ""
    flat = capture(raw, options=Options.of({"decode_error": "dlq", "format": "flat"}), layouts=layouts).records.where("commit_scn = 7").collect()
    assert [json.loads(r["value"])["AMOUNT"] for r in flat] == ["1.5"]
    with pytest.raises(ValueError, match="large_values"):
        capture(raw, options=Options.of({"large_values": "reselect"}), layouts=layouts)


def test_only_transactions_with_edits_of_large_values_are_read_again(spark):
    parses = lambda log: capture(spark.createDataFrame(log, RAW_ROW), KEYS).records._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")
    assert parses(LOG) == 1
    edit = 'declare loc clob; buf varchar2(9); begin select "V" into loc from "APP"."T" where "ID" = \'7\' for update; buf := \'abc\'; dbms_lob.write(loc, 3, 1, buf); end;'
    log = [*LOG, row(51, 6, sqn=6), row(52, 1, sqn=6, sql='insert into "APP"."T"("ID","V") values (\'7\',EMPTY_CLOB())', rid="L"), row(53, 10, sqn=6, sql=edit, rid="L"), row(54, 7, sqn=6)]
    assert parses(log) > 1
    got = {json.loads(r["value"])["after"]["ID"]: json.loads(r["value"])["after"].get("V") for r in capture(spark.createDataFrame(log, RAW_ROW), KEYS, Options(include=[r"P1\.APP\.T"])).records.collect() if r["value"] and json.loads(r["value"])["op"] == "c"}
    assert got["7"] == "abc" and got["2"] == "x"
