"""Replay position, skip rules, snapshot planning, journals and batch boundaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resume_points(cursors: DataFrame, open_work: DataFrame, thread: str = "thread") -> DataFrame:
    """By thread the earlier of the cursor and the oldest open work; ``cursors(thread, scn)``, ``open_work(thread, start_scn)``."""
    oldest = open_work.groupBy(thread).agg(F.min("start_scn").alias("_open"))
    return cursors.join(oldest, thread, "left").select(thread, F.least("scn", F.coalesce("_open", "scn")).alias("resume_scn"))


def skip_applied(changes: DataFrame, last_commit: int | None, last_key: str | None, last_index: int, key: Column) -> DataFrame:
    """What a restart has to deliver: nothing of transactions before the last one, of that one what lies past its index."""
    if last_commit is None:
        return changes
    at = F.struct(F.col("commit_scn"), key.alias("k"))
    last = F.struct(F.lit(last_commit).cast("long").alias("commit_scn"), F.lit(last_key).alias("k"))
    return changes.where((at > last) | ((at == last) & (F.col("event_index") >= last_index)))


def tuple_bound(columns: list[str], lower: list | None, upper: list | None) -> Column:
    """``lower <= (columns) < upper`` in lexicographic order; None is unbounded. Bounds of the first column are said again on their own, as only those reach the scan."""
    key, first = F.struct(*columns), F.col(columns[0])
    named = lambda values: F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, values, strict=True)])
    keep = F.lit(True) if lower is None else (first >= lower[0]) & (key >= named(lower))
    return keep if upper is None else keep & (first <= upper[0]) & (key < named(upper))


def plan_key_chunks(numbered: DataFrame, key: str, place: str, size: int) -> DataFrame:
    """``chunk, lower_bound, upper_bound``: half-open key ranges of ``size`` rows; the last has no upper bound. ``place`` numbers rows from 1."""
    starts = numbered.where((F.col(place) - 1) % size == 0).select(((F.col(place) - 1) / size).cast("long").alias("chunk"), F.col(key).alias("lower_bound"))
    following = starts.select((F.col("chunk") - 1).alias("chunk"), F.col("lower_bound").alias("upper_bound"))
    return starts.join(following, "chunk", "left")


def plan_extent_chunks(extents: DataFrame, by: str, order: str, blocks: str, chunk_rows: int, rows_per_block: int = 50) -> DataFrame:
    """Adds ``chunk``: extents are gathered until their blocks reach the chunk size."""
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    limit = max(1, chunk_rows // rows_per_block)
    return extents.withColumn("chunk", F.floor(F.coalesce(F.sum(blocks).over(before), F.lit(0)) / limit).cast("long"))


#: Column types by which a table can be read in key ranges.
RANGE_TYPES = ["NUMBER", "VARCHAR2", "CHAR", "NVARCHAR2", "NCHAR", "DATE", "TIMESTAMP", "FLOAT"]


def snapshot_strategy(keys: Column, types: Column, nullable: Column, index_organised: Column) -> Column:
    ranged = (F.size(keys) > 0) & ~nullable & F.forall(types, lambda t: t.isin(RANGE_TYPES))
    return F.when(ranged, "KEY").when(index_organised, "ALL").otherwise("ROWID")


def bound_text(value: Column, kind: str) -> Column:
    """Typed text of a chunk bound: ``n:`` numbers, ``s:`` text, ``N:`` null."""
    return F.when(value.isNull(), "N:").otherwise(F.concat(F.lit({"number": "n:", "text": "s:"}[kind]), value.cast("string")))


def snapshot_marker(order: list[str], by: list[str]) -> Column:
    w = Window.partitionBy(*by).orderBy(*order)
    return F.when(F.row_number().over(w) == 1, "first").when(F.lead(order[0]).over(w).isNull(), "last").otherwise("true")


def journal_state(chunks: DataFrame, tx: str = "xid") -> DataFrame:
    """The newest acknowledged generation of each chunk while chunks run on from 0 without a hole.

    ``chunks(xid, chunk, generation, acknowledged, events)``: an unacknowledged generation is stale.
    """
    good = chunks.where("generation <= acknowledged")
    newest = good.groupBy(tx, "chunk").agg(F.max_by(F.struct("generation", "events"), "generation").alias("x")).select(tx, "chunk", "x.*")
    return newest.withColumn("_n", F.row_number().over(Window.partitionBy(tx).orderBy("chunk")) - 1).where("chunk = _n").drop("_n")


def split_marks(changes: DataFrame, tx: list[str], size: int) -> DataFrame:
    """Adds ``piece`` and ``more``: a long transaction goes out in pieces of ``size`` records, all but its last with more to come."""
    return changes.withColumn("piece", F.floor(F.col("event_index") / size).cast("long")).withColumn("more", F.floor(F.col("event_index") / size) < F.floor((F.col("event_count") - 1) / size))


def fold_boundaries(sizes: Column, limit: int) -> Column:
    """Batch number of each transaction of an ordered array of sizes: a batch closes once it holds the limit."""
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit(0).cast("long").alias("batch"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        full = a["held"] + x >= limit
        return F.struct(F.when(full, 0).otherwise(a["held"] + x).cast("long").alias("held"), (a["batch"] + full.cast("long")).alias("batch"), F.concat(a["out"], F.array(a["batch"])).alias("out"))

    return F.aggregate(sizes, start, step, lambda a: a["out"])


def adaptive_window(results: Column, cap: int) -> Column:
    """Window after an ordered array of results: ``fast`` doubles it up to a cap, ``timeout`` halves it, three at 1 stop it (-1)."""
    start = F.struct(F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("misses"))

    def step(a: Column, r: Column) -> Column:
        miss = r == "timeout"
        n = F.when(a["n"] < 0, -1).when(miss, F.when((a["n"] == 1) & (a["misses"] == 2), -1).otherwise(F.greatest(F.lit(1), F.floor(a["n"] / 2)))).when(r == "fast", F.least(F.lit(cap), a["n"] * 2)).otherwise(a["n"])
        return F.struct(n.cast("long").alias("n"), F.when(miss & (a["n"] == 1), a["misses"] + 1).otherwise(0).cast("long").alias("misses"))

    return F.aggregate(results, start, step, lambda a: a["n"])


def floor_violations(rows: DataFrame, floors: DataFrame, thread: str = "thread") -> DataFrame:
    """Rows below what was handed over of their thread: a stop, never a silent drop."""
    return rows.join(floors, thread).where(F.col("scn") < F.col("floor_scn"))


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
