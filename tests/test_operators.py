"""Properties: undo matching against a stack, parse identity, large-value edits, replay suffixes."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import redo
from tidelog.operators import replay, state
from tidelog.operators import transactions as t


def test_undo_matching_equals_a_stack(spark):
    rng = random.Random(7)
    rows, want = [], set()
    scn = 0
    for tx in range(200):
        stacks: dict[str, list[int]] = {}
        for _ in range(rng.randint(1, 25)):
            scn += 1
            rid, undo = f"R{rng.randint(0, 3)}", rng.random() < 0.4
            rows.append((1, tx, 0, scn, rid, undo))
            stack = stacks.setdefault(rid, [])
            if not undo:
                stack.append(scn)
            elif stack:
                stack.pop()
        want |= {s for stack in stacks.values() for s in stack}
    df = spark.createDataFrame(rows, "con_id long, user_id long, sqn long, scn long, rid string, undo boolean")
    marked = t.mark_survivors(df)
    assert {r["scn"] for r in marked.where("survives").collect()} == want
    undos = sum(r[5] for r in rows)
    changes = len(rows) - undos
    assert marked.where("unmatched").count() == undos - (changes - len(want))


names = st.text(st.characters(codec="utf-8", exclude_characters='"', exclude_categories=("Cs", "Cc")), min_size=1, max_size=12)
texts = st.text(st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=30)


@settings(max_examples=300, deadline=None)
@given(owner=names, table=names, values=st.dictionaries(names, st.one_of(st.none(), texts), min_size=1, max_size=6))
def test_parse_gives_back_what_was_rendered(owner, table, values):
    quote = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    name = lambda n: '"' + n + '"'
    sql = f"insert into {name(owner)}.{name(table)}({','.join(map(name, values))}) values ({','.join(map(quote, values.values()))})"
    got = redo.parse_dml(sql)
    assert (got["op"], got["owner"], got["table"]) == ("INSERT", owner, table)
    assert {k: v.value for k, v in got["sets"].items()} == values
    where = " and ".join(f"{name(k)} IS NULL" if v is None else f"{name(k)} = {quote(v)}" for k, v in values.items())
    got = redo.parse_dml(f"delete from {name(owner)}.{name(table)} where {where} and ROWID = 'AAAx';")
    assert {k: v.value for k, v in got["where"].items()} == values and got["rowid"] == "AAAx"


@pytest.mark.parametrize("sql", ["", "select 1", 'insert into "A"."B"("C") values (1+1)', 'update "A"."B" set "C" = \'x\' where', 'delete from "A"."B" where "C" = \'x\' trailing', "insert into A.B(C) values ('x')", 'insert into "A"."B"("C") values (\'open'])
def test_bad_statements_are_errors(sql):
    with pytest.raises(redo.RedoError):
        redo.parse_dml(sql)


def test_unistr():
    assert redo.unistr("n\\00E1r \\D83D\\DE42 \\\\") == "nár 🙂 \\"
    for bad in ("\\12", "\\D83D"):
        with pytest.raises(redo.RedoError):
            redo.unistr(bad)


def test_large_edits():
    write = lambda at, data: {"edit": "write", "amount": len(data), "offset": at, "data": data}
    assert redo.apply_edits("abc", [write(5, "x🙂")], False) == "abc x🙂"
    assert redo.apply_edits(None, [write(3, "x")], False) is None
    assert redo.apply_edits(None, [write(1, "xyz"), {"edit": "trim", "amount": 2, "offset": 0}], False) == "xy"
    assert redo.apply_edits("abcdef", [{"edit": "erase", "amount": 3, "offset": 5}], False) == "abcd  "
    assert redo.apply_edits(b"\x01", [write(3, "ff")], True) == b"\x01\x00\xff"


def test_replay_gives_the_unacknowledged_suffix(spark):
    rng = random.Random(3)
    rows = [(c // 2, f"k{c % 2}", i, f"{c}/{i}") for c in range(1, 30) for i in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows, "commit_scn long, k string, event_index long, id string")
    for _ in range(6):
        cut = rng.randrange(len(rows))
        c, k, i, _ = rows[cut]
        got = {r["id"] for r in replay.skip_applied(df, c, k, i, F.col("k")).collect()}
        assert got == {r[3] for r in rows[cut:]}
    assert replay.skip_applied(df, None, None, 0, F.col("k")).count() == len(rows)


def test_carried_nulls_stay_known(spark):
    rows = [(1, 1, 1, None), (1, 2, 3, "?"), (1, 3, 2, "?"), (1, 4, 3, "?"), (1, 5, 3, "b"), (1, 6, 3, "?")]
    df = spark.createDataFrame(rows, "k long, pos long, op_code int, v string")
    got = [(r["v"], r["resolved"]) for r in state.carry_forward(df, ["k"], "pos", "v", ~F.col("v").eqNullSafe("?")).orderBy("pos").collect()]
    assert got == [(None, True), (None, True), (None, True), (None, False), ("b", True), ("b", True)]


def test_table_hash_is_the_sum_of_hashes(spark):
    import hashlib

    rows = [(f"k{n}", f"r{n % 7}", 1 + n % 3) for n in range(200)]
    want = sum(int(hashlib.sha256(f"{k}\x1e{r}".encode()).hexdigest(), 16) * c for k, r, c in rows) % 2**256
    got = state.table_hash(spark.createDataFrame(rows, "k string, r string, c int"), F.col("k"), F.col("r"), F.col("c")).first()
    assert got["hash"] == format(want, "064x") and got["row_count"] == sum(c for *_, c in rows)


def test_registered_parsers(spark):
    redo.register(spark)
    got = spark.sql("""select parse_redo('delete from "A"."B" where "C" = ''x''').op as op, decode_unistr('\\\\00E1') as u""").first()
    assert got["op"] == "DELETE" and got["u"] == "á"


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert "flagship_changes_by_table" in __spark_entry__.queries() and "flagship_changes_by_table" in __spark_entry__.oracle_sql()


def test_double_text_of_all_sizes(spark):
    """Small, large, zero, missing and non-finite numbers, against the SQL of the query."""
    import duckdb

    from tidelog.plans.decode_queries import DOUBLE_SQL

    values = [None, 0.0, -0.5, 1e-3, 9.999e-4, 1e-5, 1.25e-10, -3.5e-7, 9999999.0, 1e7, 12345678.5, -1e10, 1.5e16, 1e22, 1.7976931348623157e308, float("nan"), float("inf"), float("-inf"), 100.0, 123456.789]
    con = duckdb.connect()
    con.execute("create table events (event_id bigint, value double)")
    con.executemany("insert into events values (?, ?)", list(enumerate(values)))
    want = dict(con.sql(DOUBLE_SQL).fetchall())
    df = spark.createDataFrame(list(enumerate(values)), "event_id long, value double")
    assert {r["event_id"]: r["txt"] for r in df.selectExpr("event_id", "cast(value as string) as txt").collect()} == want
    assert want[9] == "1.0E7" and want[5] == "1.0E-5" and want[10] == "1.23456785E7"


LOGS = "thread long, seq long, first_scn long, next_scn long, deleted boolean"


def test_moves_are_refused_where_a_log_of_any_thread_is_lacking(spark):
    from tidelog.operators import doctor

    def plan(target, *logs, **more):
        return doctor.position_plans(spark.createDataFrame(logs, LOGS), spark.createDataFrame([(target,)], "target long"), 1000, **more).first()["plan"]

    assert plan(20, (1, 1, 0, 200, False), (2, 1, 0, 200, True)) == "redo is gone"
    middle = [(1, 1, 0, 100, False), (1, 2, 100, 150, True), (1, 3, 150, 200, False)]
    assert plan(120, *middle) == plan(50, *middle) == "redo is gone" and plan(150, *middle) == "ok"
    newest = [(1, 1, 0, 100, False), (1, 2, 100, 200, False)]
    assert plan(150, *newest) == "ok" and plan(201, *newest) == "beyond the end"
    assert plan(50, (1, 1, 0, 100, False), (1, 3, 150, 200, False)) == "redo is gone"  # a number that is not listed
    assert plan(160, *newest, (2, 7, 170, 200, False)) == "redo is gone" and plan(170, *newest, (2, 7, 170, 200, False)) == "ok"
    far = [(1, 1, 0, 2**63 - 1, False)]
    now = spark.createDataFrame([(5000,)], "current long")
    assert plan(2000, *far, current=now) == "needs allow-skip" and plan(2000, *far, current=now, allow_skip=True) == "ok" and plan(5001, *far, current=now) == "beyond the end"


def test_coverage_tells_of_every_thread(spark):
    from tidelog.operators import doctor

    logs = [(1, 1, 0, 100, False), (1, 2, 100, 200, False), (2, 1, 0, 100, True), (2, 2, 100, 200, True), (3, 1, 0, 100, False), (3, 2, 100, 150, True), (3, 3, 150, 200, False), (4, 1, 0, 40, False), (5, 1, 0, 100, False), (5, 2, 100, 200, True), (6, 4, 60, 200, False)]
    got = {r["thread"]: tuple(r)[1:] for r in doctor.coverage(spark.createDataFrame(logs, LOGS), 50).collect()}
    assert got == {1: (1, True, 0), 2: (None, False, 2), 3: (1, False, 1), 4: (None, False, 0), 5: (1, False, 1), 6: (4, False, 0)}
