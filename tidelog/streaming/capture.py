"""A whole capture on a stream: raw mined rows in, records and dead letters out, a folder a batch.

The assembler releases the changes of committed transactions; each batch of them is rendered by the functions of the batch capture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.options import LargeMode, Options
from tidelog.plans import capture as batch_capture
from tidelog.streaming import assembly, events, sinks


def policy(options: Options) -> assembly.Policy:
    """What the options say of transactions that stay open."""
    return assembly.Policy(options.max_age_ms, options.max_age_action, options.orphan_ms, options.orphan_action)


def changes(raw: DataFrame, options: Options, probes: DataFrame | None = None) -> DataFrame:
    """Committed changes of a stream of raw rows, numbered, with their whole statements; edits of large values among them."""
    if options.large_values in (LargeMode.RESELECT, LargeMode.TOPIC):
        raise ValueError(f"large_values: {options.large_values} reads the source or writes topics of its own")
    rows = batch_capture._kept(batch_capture._plain(raw), options)
    rows = rows.select("*", "pos.rs_id", "pos.ssn").withColumn("ts", F.col("ts").cast("string"))
    return assembly.assemble(rows, policy(options), batch_capture.TX, assembly.RAW_CHANGE, probes)


def sink(folder: str, keys: dict[str, list[str]] | None = None, options: Options = Options(), server: str = "server", layouts: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a batch's records, dead letters, given-up transactions and operational events below ``folder``; a batch that is run again replaces itself.

    A transaction is released whole in one batch, so its edits of large values are folded there, as in the batch capture. A commit at or
    below the address of its thread's last one stops the query.
    """
    floor = sinks.Floor(f"{folder}/floor", "commit_rs_id", ["con_id", "commit_thread"])
    others = {name: sinks.idempotent(f"{folder}/{name}", floor=None) for name in ("records", "dead", "discarded", "events")}

    def write(released: DataFrame, number: int) -> None:
        released.persist()
        try:
            done = released.where("outcome = 'committed'").withColumn("commit_ts", F.col("commit_ts").cast("timestamp_ntz"))
            floor.check(done, number)
            if options.large_values == LargeMode.INLINE:
                whole = done.withColumn("pos", F.struct("rs_id", "ssn", "scn")).drop("event_index", "event_count", "collection_order")
                parsed = batch_capture.numbered(batch_capture._with_large(whole))
            else:
                parsed = batch_capture._parsed(done)
            got = batch_capture.rendered(parsed, keys or {}, options, server, layouts)
            others["dead"](got.dead, number)
            others["discarded"](released.where("outcome <> 'committed'").select(*batch_capture.TX, "event_count", "outcome"), number)
            others["events"](events.of_batch(released, got.dead, batch_capture.TX, server, number), number)
            others["records"](got.records, number)
            floor.keep(done, number)
        finally:
            released.unpersist()

    return write
