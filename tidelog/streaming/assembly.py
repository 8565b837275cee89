"""Transaction assembly on a stream: state by transaction, released by its commit, not by time.

The batch twins are :func:`tidelog.operators.transactions.committed` and :func:`tidelog.plans.capture.capture`; the same log gives
the same rows. Open transactions live in the state store (RocksDB) and its checkpoints, so a long one needs no journal of
its own and survives a restart. A batch's rows are appended to their transaction's list and never rewritten; undo
rows are matched when the commit comes, in two walks over the list: the first notes which statements stand (a number
each, no rows), the second sends them on, some at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions.codes import COMMIT, ROLLBACK, START
from tidelog.functions.types import _fields
from tidelog.options import AgeAction, OrphanAction

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ["con_id", "user_id", "sqn"]
ORDER = ["rs_id", "ssn", "scn"]  # address of the record, place in it, position: rows share positions
OUT_ROWS = 10_000
CHANGE = T.StructType([*_fields("rs_id:string ssn:long scn:long op_code:int undo:boolean tab:string rid:string"), T.StructField("value", T.DoubleType())])
MINED = T.StructType([*(T.StructField(k, T.LongType()) for k in KEY), *CHANGE.fields])
#: What of a raw row is kept while its transaction is open; ``csf`` marks a statement that goes on in the next row.
RAW_CHANGE = _fields("rs_id:string ssn:long scn:long op_code:int undo:boolean csf:int thread:int owner:string tab:string username:string rid:string pdb:string ts:string sql:string")
#: Of an open transaction: when its first row was seen, its position, the position at which a probe first found it absent.
ABOUT = _fields("since:long scn:long absent:long")
GIVEN_UP = _fields("outcome:string")
#: A probe's word on one open transaction: whether it is active, at which position and time, how far the log was read, whether its session lives.
VERDICT = ["probe_active", "probe_scn", "probe_ms", "probe_mined_to", "probe_session"]
PLACE = _fields("commit_scn:long commit_rs_id:string commit_thread:int commit_ts:string event_index:long event_count:long collection_order:long outcome:string")


def _whole(rows: Iterator[dict]) -> Iterator[dict]:
    """Statements: a row, or a row and those that continue it; one that never ends is left out."""
    first: dict | None = None
    for row in rows:
        if first is None:
            first = row
        else:
            first = {**first, "sql": (first["sql"] or "") + (row["sql"] or "")}
        if not row.get("csf"):
            yield first
            first = None


class TransactionTooOld(RuntimeError):
    """An open transaction is older than it may be."""


class OrphanTransaction(RuntimeError):
    """A transaction is not open in the database, and its end was never read."""


class ReleasedTransactionCommitted(RuntimeError):
    """A transaction that was given up has committed: going on would lose what it did."""


@dataclass(frozen=True)
class Policy:
    """What becomes of transactions that stay open.

    ``max_age_ms``: one whose first row was seen so long ago is given up (``discard``) or stops the query (``fail``).
    ``orphan_ms``: one that verdicts of two probes find absent, so long after its first row, is given up (``release``) or stops the query (``fail``).
    Keys that were given up are remembered for ``ledger_ms``; a commit of one of them stops the query.
    """

    max_age_ms: int | None = None
    max_age_action: AgeAction = AgeAction.FAIL
    orphan_ms: int | None = None
    orphan_action: OrphanAction = OrphanAction.RELEASE
    ledger_ms: int = 7 * 86_400_000

    @property
    def timed(self) -> bool:
        return self.max_age_ms is not None or self.orphan_ms is not None


class Assembler(StatefulProcessor):
    """Keeps rows in order of their addresses and releases what stands of them at a commit; gives transactions up by ``Policy``.

    State of a transaction: its rows; ``about``, when its first row was seen, its position, and the position of its first
    absence; ``given_up``, the ledger, which forgets by itself. Probe rows bring ``VERDICT`` columns and nothing else.
    """

    def __init__(self, key: list[str], change: T.StructType, policy: Policy = Policy()):
        self.key, self.change, self.policy = key, change, policy
        self.fields = change.fieldNames()
        self.columns = [*key, *self.fields, *PLACE.fieldNames()]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.change)
        if self.policy.timed:
            self.about = handle.getValueState("about", ABOUT)
            self.given_up = handle.getValueState("given_up", GIVEN_UP, self.policy.ledger_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.rows.exists()
        fresh: list[dict] = []
        given = pd.concat(rows).sort_values(ORDER, kind="stable")  # verdicts have no address and come last
        verdicts = pd.DataFrame()
        if VERDICT[0] in given.columns:
            verdicts = given[given[VERDICT[0]].notna()]
            given = given[given[VERDICT[0]].isna()]
        gone = self.policy.timed and self.given_up.exists()
        for row in given[self.fields].astype(object).where(given[self.fields].notna(), None).to_dict("records"):
            op = int(row["op_code"])
            if gone:
                if op == COMMIT:
                    raise ReleasedTransactionCommitted(f"CDC-7001: transaction {self._name(key)} was given up ({self.given_up.get()[0]}) and has committed at {row['scn']}")
                if op == ROLLBACK:
                    self.given_up.clear()
                    gone = False
                continue  # rows of a transaction that was given up never make a part of one
            if op == COMMIT:
                yield from self._released(key, held, fresh, row)
            if op in (COMMIT, ROLLBACK):
                if held:
                    self._clear()
                held, fresh = False, []
            elif op != START:
                fresh.append(row)
        if fresh:
            if self.policy.timed and not held:
                now = timerValues.getCurrentProcessingTimeInMs()
                self.about.update((now, int(fresh[0]["scn"]), None))
                if self.policy.max_age_ms is not None:
                    self.handle.registerTimer(now + self.policy.max_age_ms)
            self.rows.appendList([tuple(row[f] for f in self.fields) for row in fresh])
        if len(verdicts) and self.policy.orphan_ms is not None and (held or fresh):
            for verdict in verdicts.to_dict("records"):
                out = self._judged(key, verdict)
                if out is not None:
                    yield out
                    break

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.rows.exists() and self.about.exists():
            since, scn, _ = self.about.get()
            now = timerValues.getCurrentProcessingTimeInMs()
            if now - since >= self.policy.max_age_ms:  # else the timer of an earlier transaction of this key
                if self.policy.max_age_action == AgeAction.FAIL:
                    raise TransactionTooOld(f"CDC-4004: transaction {self._name(key)}, open since position {scn}, is older than max_age_ms={self.policy.max_age_ms}")
                yield self._give_up(key, "discarded")

    def _judged(self, key, verdict: dict) -> pd.DataFrame | None:
        """A row if the verdict is the second that finds the transaction absent, its end can't lie ahead and no session holds it."""
        since, scn, absent = self.about.get()
        if verdict["probe_active"]:
            if absent is not None:
                self.about.update((since, scn, None))
            return None
        if verdict["probe_ms"] - since < self.policy.orphan_ms:
            return None
        if absent is None:
            self.about.update((since, scn, int(verdict["probe_scn"])))
            return None
        if verdict["probe_mined_to"] < absent or verdict["probe_session"]:
            return None
        reason = f"absent at {absent} and again at {int(verdict['probe_scn'])}, read to {int(verdict['probe_mined_to'])} without its end"
        if self.policy.orphan_action == OrphanAction.FAIL:
            raise OrphanTransaction(f"CDC-4003: transaction {self._name(key)}, open since position {scn}, is orphaned: {reason}")
        return self._give_up(key, "orphan")

    def _give_up(self, key, outcome: str) -> pd.DataFrame:
        count = sum(1 for _ in self.rows.get())
        self._clear()
        self.given_up.update((outcome,))
        return self._frame([{**dict.fromkeys(self.columns), **dict(zip(self.key, key, strict=True)), "event_index": 0, "event_count": count, "outcome": outcome}])

    def _clear(self) -> None:
        self.rows.clear()
        if self.policy.timed:
            self.about.clear()

    def _name(self, key) -> str:
        return ".".join(str(k) for k in key)

    def _statements(self, held: bool, fresh: list[dict]) -> Iterator[dict]:
        stored = (dict(zip(self.fields, row, strict=True)) for row in self.rows.get()) if held else ()
        return _whole(chain(stored, fresh))

    def _released(self, key, held: bool, fresh: list[dict], commit: dict) -> Iterator[pd.DataFrame]:
        stands = bytearray()
        by_row: dict[str, list[int]] = {}
        for n, row in enumerate(self._statements(held, fresh)):
            standing = by_row.setdefault(row["rid"], [])
            stands.append(not row["undo"])
            if not row["undo"]:
                standing.append(n)
            elif standing:
                stands[standing.pop()] = False
        count, event, out = sum(stands), 0, []
        by_table: Counter[tuple] = Counter()
        for n, row in enumerate(self._statements(held, fresh)):
            if stands[n]:
                table = (row.get("owner"), row["tab"])
                by_table[table] += 1
                place = {"commit_scn": int(commit["scn"]), "commit_rs_id": commit["rs_id"], "commit_thread": commit.get("thread"), "commit_ts": commit.get("ts"), "event_index": event, "event_count": count, "collection_order": by_table[table], "outcome": "committed"}
                out.append({**dict(zip(self.key, key, strict=True)), **row, **place})
                event += 1
                if len(out) >= OUT_ROWS:
                    yield self._frame(out)
                    out = []
        if out:
            yield self._frame(out)

    def _frame(self, rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def close(self) -> None:
        pass


def assemble(mined: DataFrame, policy: Policy = Policy(), key: list[str] = KEY, change: T.StructType = CHANGE, probes: DataFrame | None = None) -> DataFrame:
    """Surviving changes of committed transactions of a streaming log of ``key`` and ``change`` columns, and a row for each that is given up.

    ``probes`` is a stream of verdicts (``key`` and ``VERDICT`` columns), as ``verdicts`` makes them.
    """
    mined.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    released = T.StructType([*(T.StructField(k, T.LongType()) for k in key), *change.fields, *PLACE.fields])
    rows = mined.select(*[F.col(k).cast("long").alias(k) for k in key], *change.fieldNames())
    if probes is not None:
        rows = rows.unionByName(probes.select(*[F.col(k).cast("long").alias(k) for k in key], *VERDICT), allowMissingColumns=True)
    return rows.groupBy(*key).transformWithStateInPandas(Assembler(key, change, policy), released, "Append", "ProcessingTime" if policy.timed else "None")


def open_transactions(spark, checkpoint: str, key: list[str] = KEY) -> DataFrame:
    """``(key..., since, scn, absent)`` of the transactions that a stopped or running query holds open, from its state."""
    state = spark.read.format("statestore").option("stateVarName", "about").load(checkpoint)
    return state.select(*[F.col(f"key.{k}").alias(k) for k in key], "value.*")


def verdicts(opened: DataFrame, active: DataFrame, scn: int, at_ms: int, mined_to: int, sessions: DataFrame | None = None, key: list[str] = KEY) -> DataFrame:
    """A probe's word on each open transaction: ``active`` has the keys that the database lists, ``sessions`` those whose session lives."""
    found = opened.select(*key).join(active.select(*key).distinct().withColumn("probe_active", F.lit(True)), key, "left")
    alive = opened.select(*key).limit(0) if sessions is None else sessions.select(*key).distinct()
    found = found.join(alive.withColumn("probe_session", F.lit(True)), key, "left")
    return found.select(*key, F.coalesce("probe_active", F.lit(False)).alias("probe_active"), F.lit(scn).cast("long").alias("probe_scn"), F.lit(at_ms).cast("long").alias("probe_ms"), F.lit(mined_to).cast("long").alias("probe_mined_to"), F.coalesce("probe_session", F.lit(False)).alias("probe_session"))
