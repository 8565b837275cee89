"""The streaming assembler against its batch twin, over restarts."""

from __future__ import annotations

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelog.operators import transactions as t
from tidelog.sources import derived as d
from tidelog.streaming import assembly, sinks


class Held:
    """A list state."""

    def __init__(self):
        self.lists, self.puts = [], 0

    def exists(self):
        return bool(self.lists)

    def get(self):
        return (row for part in self.lists for row in part)

    def appendList(self, rows):
        self.lists.append(rows)
        self.puts += 1

    def clear(self):
        self.lists = []


class One:
    """A value state."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Clock:
    def __init__(self):
        self.now, self.timers = 1_000_000, []

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def registerTimer(self, at):
        self.timers.append(at)


KEY = (1, 2, 3)


class Machine:
    """One key's state machine over a clock."""

    def __init__(self, **policy):
        self.clock = Clock()
        self.machine = assembly.Assembler(assembly.KEY, assembly.CHANGE, assembly.Policy(**policy))
        self.machine.rows, self.machine.about, self.machine.given_up, self.machine.handle = Held(), One(), One(), self.clock
        self.scn = 10

    def rows(self, *ops):
        made = []
        for op in ops:
            self.scn += 1
            made.append((f"{self.scn:05d}", 0, self.scn, op, False, "T", "R", 0.5))
        return self._out(self.machine.handleInputRows(KEY, iter([pd.DataFrame(made, columns=assembly.CHANGE.fieldNames())]), self.clock))

    def probe(self, active, mined_to=None, session=False):
        verdict = {c: [None] for c in assembly.CHANGE.fieldNames()} | {"probe_active": [active], "probe_scn": [self.scn], "probe_ms": [self.clock.now], "probe_mined_to": [self.scn if mined_to is None else mined_to], "probe_session": [session]}
        return self._out(self.machine.handleInputRows(KEY, iter([pd.DataFrame(verdict)]), self.clock))

    def later(self, minutes):
        """The clock goes on, and timers that are due fire."""
        self.clock.now += minutes * 60_000
        due = [t for t in self.clock.timers if t <= self.clock.now]
        self.clock.timers = [t for t in self.clock.timers if t > self.clock.now]
        return [x for _ in due for x in self._out(self.machine.handleExpiredTimer(KEY, self.clock, None))]

    def _out(self, frames):
        return [(r["outcome"], r["event_count"]) for f in frames for r in f.to_dict("records")]


MINUTES = 60_000


def test_discard_drops_a_transaction_and_its_late_commit_stops():
    m = Machine(max_age_ms=5 * MINUTES, max_age_action=assembly.AgeAction.DISCARD)
    assert m.rows(6, 1) == [] and m.later(4) == [] and m.later(2) == [("discarded", 1)]
    assert not m.machine.rows.exists() and not m.machine.about.exists()
    assert m.rows(1) == [] and not m.machine.rows.exists()
    with pytest.raises(assembly.ReleasedTransactionCommitted, match="CDC-7001.*1.2.3"):
        m.rows(1, 7)
    again = Machine(max_age_ms=5 * MINUTES, max_age_action=assembly.AgeAction.DISCARD)
    again.rows(6, 1), again.later(6)
    assert again.rows(1, 36) == [] and again.rows(6, 1, 7) == [("committed", 1)]


def test_fail_names_the_transaction_and_drops_nothing():
    m = Machine(max_age_ms=5 * MINUTES)
    m.rows(6, 1)
    with pytest.raises(assembly.TransactionTooOld, match="CDC-4004.*1.2.3.*max_age_ms"):
        m.later(6)
    assert m.machine.rows.exists()
    quick = Machine(max_age_ms=5 * MINUTES)
    assert quick.rows(6, 1, 7) == [("committed", 1)] and quick.later(3) == []
    quick.rows(6, 1)
    assert quick.later(3) == [] and quick.rows(7) == [("committed", 1)]  # a timer of the one before does not count


def test_an_orphan_needs_two_absences_and_its_late_commit_stops():
    m = Machine(orphan_ms=5 * MINUTES)
    m.rows(6, 1)
    assert m.probe(False) == [] and m.machine.about.get()[2] is None  # too young
    m.later(6)
    assert m.probe(False, mined_to=m.scn - 1) == [] and m.machine.about.get()[2] == m.scn
    assert m.probe(False, mined_to=m.scn - 1) == []  # its end may lie ahead
    assert m.probe(False, session=True) == []  # its session lives
    assert m.probe(False) == [("orphan", 1)] and not m.machine.rows.exists()
    with pytest.raises(assembly.ReleasedTransactionCommitted, match="CDC-7001"):
        m.rows(1, 7)


def test_an_active_transaction_is_never_released():
    m = Machine(orphan_ms=5 * MINUTES)
    m.rows(6, 1)
    for active in (True, False, True, False, True):
        m.later(6)
        assert m.probe(active) == []
    assert m.rows(7) == [("committed", 1)]
    stops = Machine(orphan_ms=5 * MINUTES, orphan_action=assembly.OrphanAction.FAIL)
    stops.rows(6, 1)
    stops.later(6)
    stops.probe(False)
    with pytest.raises(assembly.OrphanTransaction, match="CDC-4003.*orphaned"):
        stops.probe(False)


def test_orphans_on_a_stream_over_restarts(spark, tmp_path):
    """Rows and verdicts as two inputs; the probe reads what is open from the query's state."""
    source, words, out, checkpoint = (str(tmp_path / x) for x in ("in", "probes", "out", "state"))
    policy = assembly.Policy(orphan_ms=1)
    verdict_schema = "con_id long, user_id long, sqn long, probe_active boolean, probe_scn long, probe_ms long, probe_mined_to long, probe_session boolean"

    def mined(name, *rows):
        made = [(1, user, 1, f"{scn:05d}", 0, scn, op, False, "T", "R", 0.5) for user, scn, op in rows]
        spark.createDataFrame(made, assembly.MINED).coalesce(1).write.json(f"{source}/part={name}")

    def run():
        stream = assembly.assemble(sinks.log_stream(spark, source, assembly.MINED, files=100).drop("part"), policy, probes=spark.readStream.schema(verdict_schema).json(words).drop("part"))
        sinks.run_available(stream, checkpoint, sinks.idempotent(out, floor=None), timed=True)

    spark.createDataFrame([], verdict_schema).write.json(words + "/part=none")
    mined("a", (1, 11, 6), (1, 12, 1), (2, 13, 6), (2, 14, 1), (3, 15, 6), (3, 16, 1), (3, 17, 7))
    run()
    opened = assembly.open_transactions(spark, checkpoint)
    assert sorted((r["user_id"], r["scn"], r["absent"]) for r in opened.collect()) == [(1, 12, None), (2, 14, None)]
    for n in range(2):
        active = spark.createDataFrame([(1, 2, 1)], "con_id long, user_id long, sqn long")
        assembly.verdicts(assembly.open_transactions(spark, checkpoint), active, scn=20 + n, at_ms=10**14, mined_to=30).coalesce(1).write.json(f"{words}/part={n}")
        run()
    assert sorted((r["user_id"], r["outcome"]) for r in spark.read.parquet(out).collect()) == [(1, "orphan"), (3, "committed")]
    mined("b", (2, 40, 7))
    run()
    assert sorted((r["user_id"], r["outcome"]) for r in spark.read.parquet(out).collect()) == [(1, "orphan"), (2, "committed"), (3, "committed")]
    mined("c", (1, 50, 7))
    with pytest.raises(Exception, match="CDC-7001"):
        run()


def test_a_query_tells_of_itself(spark, tmp_path):
    """Start, figures of each batch, and the stop with its code."""
    from tidelog.streaming import events

    source, out, checkpoint, told = (str(tmp_path / x) for x in ("in", "out", "state", "told"))
    listener = events.Listener(spark, told, "srv")
    spark.streams.addListener(listener)
    try:
        rows = [(1, user, 1, f"{scn:05d}", 0, scn, op, False, "T", "R", 0.5) for user, scn, op in ((1, 11, 6), (1, 12, 1), (1, 13, 7), (2, 14, 1))]
        spark.createDataFrame(rows, assembly.MINED).coalesce(1).write.json(f"{source}/part=0")
        stream = events.observed(assembly.assemble(sinks.log_stream(spark, source, assembly.MINED).drop("part")))
        sinks.run_available(stream, checkpoint, sinks.idempotent(out, floor=None))

        def stop(batch, number):
            raise sinks.FloorError("CDC-7003: below")

        spark.createDataFrame(rows, assembly.MINED).coalesce(1).write.json(f"{source}/part=1")
        with pytest.raises(Exception, match="CDC-7003"):
            sinks.run_available(stream, checkpoint, stop)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(60):
            kinds = sorted(r["type"] for r in spark.read.json(f"{told}/events").collect())
            if kinds.count("stop") == 2:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert kinds == ["startup", "startup", "stop", "stop"]
    assert "CDC-7003" in {r["details"]["code"] for r in spark.read.json(f"{told}/events").where("type = 'stop'").collect()}
    figures = spark.read.schema(events.FIGURES).json(f"{told}/figures").where("input_rows > 0").collect()
    assert [(r["input_rows"], r["released"], r["committed"], r["given_up"]) for r in figures] == [(4, 1, 1, 0)]


def test_floors_are_kept_by_thread(spark, tmp_path):
    floor = sinks.Floor(str(tmp_path / "f"), "rs", ["con_id", "thread"])
    batch = lambda *rows: spark.createDataFrame([(1, t, rs) for t, rs in rows], "con_id long, thread int, rs string")
    at = lambda block: f" 0x000001.{block:08x}.0000 "

    def hand(number, *rows):
        floor.check(batch(*rows), number)
        floor.keep(batch(*rows), number)

    hand(0, (1, at(10)), (2, at(5)))
    hand(0, (1, at(10)), (2, at(5)))  # run again
    hand(1, (2, at(6)), (3, at(1)))  # other threads never compare, one without a floor passes
    hand(2)
    for thread, block in ((1, 10), (1, 9), (2, 6), (3, 1)):
        with pytest.raises(sinks.FloorError, match=f"CDC-7003.*thread {thread}"):
            floor.check(batch((thread, at(block))), 3)
    hand(3, (1, at(11)), (1, "0x000000.00000000.0000"), (2, None))
    with pytest.raises(sinks.FloorError, match="missing"):
        sinks.Floor(str(tmp_path / "none"), "rs", ["con_id", "thread"]).check(batch((1, at(1))), 1)


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return d.mined(d.data_rows(spark, sf_dir)).drop("ts").cache()


def _part(log, low, high, folder, name):
    log.where((F.col("scn") >= low) & (F.col("scn") < high)).coalesce(1).write.json(f"{folder}/{name}")


def test_stream_equals_batch_over_a_restart(spark, sf_dir, log, tmp_path):
    rows = d.data_rows(spark, sf_dir)
    want = {(r["con_id"], r["user_id"], r["sqn"], r["scn"], r["event_index"], r["event_count"]) for r in t.committed(rows, d.transactions(rows)).collect()}
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    cuts = [0, 3000, 6000, 9000, 10**9]
    for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        _part(log, low, high, source, f"part={k}")
        stream = assembly.assemble(sinks.log_stream(spark, source, assembly.MINED, files=1).drop("part"))
        sinks.run_available(stream, checkpoint, sinks.idempotent(out, floor=None))  # each round is a restart from the checkpoint
    got = [(r["con_id"], r["user_id"], r["sqn"], r["scn"], r["event_index"], r["event_count"]) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame([(1, 5)], "con_id long, commit_scn long")
    write = sinks.idempotent(out)
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(sinks.FloorError):
        write(spark.createDataFrame([(1, 4)], "con_id long, commit_scn long"), 1)
    write(spark.createDataFrame([(1, 6), (2, 1)], "con_id long, commit_scn long"), 1)
    assert spark.read.parquet(out).count() == 3


def test_bounded_topics(spark, log, tmp_path):
    _part(log, 0, 3000, str(tmp_path / "t"), "p=0")
    assert sinks.topic_table(spark, str(tmp_path / "t"), assembly.MINED).count() == log.where("scn < 3000").count()


def test_data_source_prunes_files_by_position(spark, log, tmp_path):
    from tidelog.sources.redo_files import _Reader, register

    for low, high in ((0, 3000), (3000, 6000), (6000, 10**9)):
        rows = log.where((F.col("scn") >= low) & (F.col("scn") < high)).toJSON().collect()
        (tmp_path / f"{low}-{high}.json").write_text("\n".join(rows))
    register(spark)
    df = spark.read.format("redo_files").load(str(tmp_path))
    assert df.count() == log.count()
    assert df.where("scn >= 3500 and scn < 5000").count() == log.where("scn >= 3500 and scn < 5000").count()
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    reader = _Reader(str(tmp_path), ["scn"])
    list(reader.pushFilters([GreaterThanOrEqual(("scn",), 3500), LessThan(("scn",), 5000)]))
    assert [p.value.rsplit("/", 1)[1] for p in reader.partitions()] == ["3000-6000.json"]


def test_raw_rows_to_records_equal_the_batch_capture(spark, tmp_path):
    """Rows that share a position, statements that go on over a restart, undo, rollback, dead letters."""
    from tidelog.functions.types import RAW_ROW
    from tidelog.options import Options
    from tidelog.plans.capture import capture
    from tidelog.streaming import capture as stream_capture

    from .test_capture import KEYS, LOG, NOW, row

    def at(scn, ssn, op, sql=None, rid=None, undo=0, csf=0):
        made = dict(zip(RAW_ROW.fieldNames(), row(scn, op, sqn=9, sql=sql, rid=rid, undo=undo, csf=csf), strict=True))
        return tuple({**made, "RS_ID": f"0x{scn:08d} ", "SSN": ssn, "TIMESTAMP": NOW}.values())

    many = [at(50, 0, 6)] + [at(51, n, 1, f'insert into "APP"."T"("ID","V") values (\'{n}\',\'v\')', f"R{n}") for n in range(1, 200)]
    many += [at(51, 300, 2, 'delete from "APP"."T" where "ID" = \'7\'', "R7", undo=1), at(51, 301, 255, "Unsupported", "R9"), at(52, 0, 7)]
    options = Options.of({"large_values": "skip", "decode_error": "dlq"})
    whole = [*LOG, *many]
    want = capture(spark.createDataFrame(whole, RAW_ROW), KEYS, options)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k, (low, high) in enumerate(((0, 2), (2, 9), (9, 130), (130, len(whole)))):
        part = list(reversed(whole[low:high]))  # a batch is sorted by address, whatever its order
        spark.createDataFrame(part, RAW_ROW).coalesce(1).write.json(f"{source}/part={k}")
        stream = stream_capture.changes(sinks.log_stream(spark, source, RAW_ROW, files=1), options)
        sinks.run_available(stream, checkpoint, stream_capture.sink(out, KEYS, options))
    told = lambda df: sorted((r["topic"], r["key"] or "", r["value"] or "", r["event_index"], r["sub"], str(sorted(r["headers"].items()))) for r in df.collect())
    assert told(spark.read.parquet(f"{out}/records")) == told(want.records)
    said = spark.read.parquet(f"{out}/events").collect()
    assert [(r["type"], r["details"]["table"], r["details"]["operation"]) for r in said] == [("decode-error-dlq", "APP.T", "255")]
    dead = lambda df: sorted((r["scn"], r["tab"], r["op_code"], r["exception"], r["sql_redo"]) for r in df.collect())
    assert dead(spark.read.parquet(f"{out}/dead")) == dead(want.dead) and [d[:3] for d in dead(want.dead)] == [(51, "T", 255)]
    with pytest.raises(ValueError, match="large_values"):
        stream_capture.changes(spark.createDataFrame(LOG, RAW_ROW), Options.of({"large_values": "reselect"}))


def test_large_values_on_a_stream_equal_the_batch_capture(spark, tmp_path):
    """Edits that go on over restarts, trims and erases, two rows and two columns, undone edits."""
    from tidelog.functions.types import RAW_ROW
    from tidelog.options import Options
    from tidelog.plans.capture import capture
    from tidelog.streaming import capture as stream_capture

    from .test_capture import _block, row

    insert = 'insert into "APP"."T"("ID","NOTE","MORE") values (\'7\',EMPTY_CLOB(),EMPTY_CLOB())'
    edit = lambda scn, text, rid="F", op=10, undo=0: row(scn, op, sqn=2, sql=text, rid=rid, undo=undo)
    trim = _block("NOTE", (1, "x")).replace("buf := 'x'; dbms_lob.write(loc, 1, 1, buf);", "dbms_lob.trim(loc, 8);")
    log = [
        row(1, 6, sqn=2), row(2, 1, sqn=2, sql=insert, rid="F"), edit(3, _block("NOTE", (1, "hello "), (7, "world"))), edit(4, _block("MORE", (3, "gap"))), edit(5, _block("NOTE", (1, "J"))),
        row(6, 1, sqn=2, sql=insert.replace("'7'", "'8'"), rid="G"), edit(7, _block("NOTE", (1, "second")), rid="G"), edit(8, trim, op=11), row(9, 7, sqn=2),
        row(21, 6, sqn=3), row(22, 10, sqn=3, sql=_block("NOTE", (2, "unknown base")), rid="F"), row(23, 7, sqn=3),
    ]
    options = Options.of({"decode_error": "dlq"})
    keys = {"APP.T": ["ID"]}
    want = capture(spark.createDataFrame(log, RAW_ROW), keys, options)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k, (low, high) in enumerate(((0, 4), (4, 8), (8, len(log)))):
        spark.createDataFrame(log[low:high], RAW_ROW).coalesce(1).write.json(f"{source}/part={k}")
        stream = stream_capture.changes(sinks.log_stream(spark, source, RAW_ROW, files=1), options)
        sinks.run_available(stream, checkpoint, stream_capture.sink(out, keys, options))
    told = lambda df: sorted((r["topic"], r["key"] or "", r["value"] or "", r["event_index"], r["sub"]) for r in df.collect())
    assert told(spark.read.parquet(f"{out}/records")) == told(want.records)
    values = [r[2] for r in told(want.records)]
    assert any('"NOTE":"Jello wo"' in v and '"MORE":"  gap"' in v for v in values) and any('"NOTE":"second"' in v for v in values)


def test_a_large_transaction_is_released_in_slices():
    """200,000 changes of one transaction: state is only appended to, and rows go out some at a time."""

    machine = assembly.Assembler(assembly.KEY, assembly.CHANGE)
    machine.rows = Held()
    columns = assembly.CHANGE.fieldNames()
    for part in range(10):
        rows = pd.DataFrame([("a", part * 20_000 + k, 5, 1, False, "T", f"R{k % 50}", 0.5) for k in range(20_000)], columns=columns)
        assert list(machine.handleInputRows((1, 2, 3), iter([rows]), None)) == []
    assert machine.rows.puts == 10
    ends = pd.DataFrame([("b", 0, 6, 1, True, "T", "R3", 0.5), ("b", 1, 6, 7, False, None, None, None)], columns=columns)
    out = list(machine.handleInputRows((1, 2, 3), iter([ends]), None))
    assert max(map(len, out)) <= assembly.OUT_ROWS and sum(map(len, out)) == 199_999 == out[0]["event_count"][0]
    assert pd.concat(out)["event_index"].tolist() == list(range(199_999)) and not machine.rows.exists()
