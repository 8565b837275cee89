"""Transaction assembly as windows and joins: undo matching, commit release, ordering, buffer statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.codes import COMMIT, ROLLBACK

TX = ["con_id", "user_id", "sqn"]


def mark_survivors(rows: DataFrame, tx: list[str] = TX, rowid: str = "rid", order: str = "scn", undo: str = "undo") -> DataFrame:
    """Adds ``survives``: an undo row removes the latest earlier change of its row id that still stands.

    With s the running sum of +1 for a change and -1 for an undo, the depth is s less its running minimum
    where that is below 0 (an undo with nothing left to undo does nothing). A change stands if no later row
    of its row id has a smaller depth. ``unmatched`` marks undo rows that removed nothing.
    """
    at = Window.partitionBy(*tx, rowid).orderBy(order)
    so_far, after = at.rowsBetween(Window.unboundedPreceding, 0), at.rowsBetween(1, Window.unboundedFollowing)
    out = rows.withColumn("_s", F.sum(F.when(F.col(undo), -1).otherwise(1)).over(so_far))
    out = out.withColumn("_low", F.least(F.lit(0), F.min("_s").over(so_far))).withColumn("_depth", F.col("_s") - F.col("_low"))
    out = out.withColumn("_after", F.min("_depth").over(after)).withColumn("_was", F.coalesce(F.lag("_low").over(at), F.lit(0)))
    stands = ~F.col(undo) & (F.col("_after").isNull() | (F.col("_after") >= F.col("_depth")))
    return out.withColumn("survives", stands).withColumn("unmatched", F.col(undo) & (F.col("_low") < F.col("_was"))).drop("_s", "_low", "_depth", "_after", "_was")


def committed(rows: DataFrame, tx: DataFrame) -> DataFrame:
    """Surviving changes of committed transactions with event index, event count and order within the table.

    Rows are dealt out by transaction once: the windows by row id, the join and the windows by transaction
    and by table all stand on that partitioning.
    """
    kept = mark_survivors(rows.repartition(*TX)).where("survives").join(tx.where(F.col("end_code") == COMMIT), TX)
    by_tx, by_table = Window.partitionBy(*TX).orderBy("scn"), Window.partitionBy(*TX, "tab").orderBy("scn")
    return kept.select(
        *TX,
        "scn",
        "start_scn",
        F.col("end_scn").alias("commit_scn"),
        "tab",
        "rid",
        "op_code",
        "value",
        "ts",
        "event_id",
        (F.row_number().over(by_tx) - 1).cast("long").alias("event_index"),
        F.count("*").over(Window.partitionBy(*TX)).alias("event_count"),
        F.row_number().over(by_table).cast("long").alias("collection_order"),
    )


def buffer_statistics(rows: DataFrame, tx: DataFrame) -> DataFrame:
    """One row: open, committed, rolled back, buffered changes, undone and unmatched undos, oldest open position."""
    marked = mark_survivors(rows).join(tx, TX)
    open_ = F.col("end_code").isNull()
    per = marked.groupBy(*TX, "end_code", "start_scn").agg(F.sum(F.col("survives").cast("long")).alias("kept"), F.sum((~F.col("undo") & ~F.col("survives")).cast("long")).alias("undone"), F.sum(F.col("unmatched").cast("long")).alias("unmatched"))
    return per.agg(
        F.sum(open_.cast("long")).alias("open_transactions"),
        F.sum((F.col("end_code") == COMMIT).cast("long")).alias("committed"),
        F.sum((F.col("end_code") == ROLLBACK).cast("long")).alias("rolled_back"),
        F.sum(F.when(open_, F.col("kept")).otherwise(0)).alias("buffered_changes"),
        F.sum("undone").alias("undone"),
        F.sum("unmatched").alias("unmatched_undos"),
        F.min(F.when(open_, F.col("start_scn"))).alias("oldest_open_scn"),
    )


def redo_key(thread: str = "thread", rs_id: str = "rs_id", ssn: str = "ssn", scn: str = "scn") -> list[Column]:
    """Sort key of addressed rows: thread, trimmed record address, sequence in it, position."""
    return [F.col(thread), F.trim(F.col(rs_id)), F.col(ssn), F.col(scn)]
