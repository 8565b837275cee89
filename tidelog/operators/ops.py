"""Operational events: what a run tells about itself, as records of one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = 1

#: The types that are emitted, and the keys that their details may have.
DETAILS = {
    "startup": ["resume_scn", "last_commit", "database", "version"],
    "stop": ["exception", "message", "code", "runbook", "operator_action"],
    "thread-state-changed": ["thread", "state", "previous", "sequence", "closed_at_scn"],
    "ddl-seen": ["pdb", "owner", "object", "scn", "sql"],
    "ddl-applied": ["pdb", "owner", "object", "scn", "version", "columns"],
    "dictionary-replay": ["from_scn", "to_scn", "tables"],
    "dictionary-build": ["status", "millis", "message"],
    "table-added": ["table", "snapshot"],
    "table-removed": ["table"],
    "ids-refreshed": ["owners"],
    "reconnected": ["cause"],
    "unsupported-row": ["table", "xid", "scn", "status", "info"],
    "decode-error-dlq": ["table", "xid", "scn", "operation", "error"],
    "transaction-discarded": ["xid", "con_id", "user", "first_scn", "last_scn", "events", "age_ms"],
    "transaction-orphan-released": ["xid", "con_id", "user", "client_id", "first_scn", "last_scn", "events", "absent_at_scn", "reason"],
    "transaction-split": ["xid", "commit_scn", "events", "kafka_transactions"],
    "snapshot-chunk-done": ["table", "scn", "rows"],
    "snapshot-complete": ["table", "stopped", "skipped"],
    "signal-ack": ["id", "type", "outcome", "message", "mined_to_scn", "open_transactions", "buffered_events", "oldest_open_scn", "largest", "snapshot_running"],
    "offsets-set": ["connector", "command", "reason", "operator", "direction", "previous_resume_scn", "new_resume_scn", "forgotten_released", "outcome", "error"],
}
#: Types that are named but never emitted.
RESERVED = ["position-committed", "log-switch-detected", "transaction-journaled"]
#: Fixed value: the greatest length of a statement in details.
SQL_LENGTH = 2000


def records(rows: DataFrame, kind: str, server: str, ts_ms: Column, resume_scn: Column, **details: Column) -> DataFrame:
    """One event a row: ``v, type, ts_ms, server, resume_scn, details``; details that are null are left out.

    A reserved or unknown type and a key that the type does not have are errors of the caller.
    """
    if kind not in DETAILS:
        raise ValueError(f"{kind} is {'reserved' if kind in RESERVED else 'no type of event'}")
    if foreign := sorted(details.keys() - DETAILS[kind]):
        raise ValueError(f"{kind} has no detail {', '.join(foreign)}")
    text = {k: (F.substring(v, 1, SQL_LENGTH) if k == "sql" else v).cast("string") for k, v in details.items()}
    pairs = [F.struct(F.lit(k).alias("key"), text[k].alias("value")) for k in DETAILS[kind] if k in text]
    known = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(
        F.lit(VERSION).alias("v"),
        F.lit(kind).alias("type"),
        ts_ms.cast("long").alias("ts_ms"),
        F.lit(server).alias("server"),
        resume_scn.cast("long").alias("resume_scn"),
        known.alias("details"),
    )
