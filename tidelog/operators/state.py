"""Materialisation of changes to table state, state comparison, order-independent hashes and delivery invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.codes import DELETE


def latest(changes: DataFrame, key: list[str], order: str, upto: int | None = None) -> DataFrame:
    """The last change of each key at or before a position, deleted keys left out; partial aggregates before the shuffle."""
    seen = changes if upto is None else changes.where(F.col(order) <= upto)
    rest = [c for c in changes.columns if c not in key]
    last = seen.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("x"))
    return last.select(*key, "x.*").where(F.col("op_code") != DELETE)


def carry_forward(changes: DataFrame, key: list[str], order: str, value: str, known: Column) -> DataFrame:
    """``value`` with unavailable ones (not ``known``) taken from the row's last known one; a delete ends the row's life.

    The carried thing is a struct, so that a known null is carried too.
    """
    at = Window.partitionBy(*key).orderBy(order)
    lives = changes.withColumn("_life", F.coalesce(F.sum((F.col("op_code") == DELETE).cast("int")).over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    held = F.last(F.when(known, F.struct(F.col(value).alias("v"))), ignorenulls=True).over(Window.partitionBy(*key, "_life").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return lives.withColumn("_held", held).withColumn(value, F.col("_held.v")).withColumn("resolved", F.col("_held").isNotNull()).drop("_life", "_held")


def diff(left: DataFrame, right: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """``key, status``: missing on the right, extra there, or mismatched in a value (nulls compare as equal)."""
    a, b = left.select(*key, F.struct(*values).alias("a")), right.select(*key, F.struct(*values).alias("b"))
    both = a.join(b, key, "full_outer")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "mismatch")
    return both.withColumn("status", status).where("status is not null").select(*key, "status")


LIMBS = 8


def table_hash(rows: DataFrame, key: Column, row: Column, copies: Column) -> DataFrame:
    """One row: rows and the sum of SHA-256(key 0x1E row) times copies, modulo 2 to the 256, as hex.

    Eight 32-bit limbs are summed as decimals, so partial sums combine in any order; the carry is in the last step.
    """
    digest = F.sha2(F.concat(key, F.decode(F.unhex(F.lit("1E")), "UTF-8"), row), 256)
    limb = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("decimal(20,0)")
    sums = rows.agg(F.coalesce(F.sum(copies), F.lit(0)).cast("long").alias("row_count"), *[F.coalesce(F.sum(limb(k) * copies.cast("decimal(10,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"l{k}") for k in range(LIMBS)])
    two32 = F.lit(1 << 32).cast("decimal(20,0)")
    out, carry = [], F.lit(0).cast("decimal(38,0)")
    for k in reversed(range(LIMBS)):
        sums = sums.withColumn(f"t{k}", (F.col(f"l{k}") + carry).cast("decimal(38,0)"))
        out.insert(0, F.lpad(F.lower(F.hex(F.pmod(F.col(f"t{k}"), two32).cast("long"))), 8, "0"))
        carry = F.floor(F.col(f"t{k}") / two32).cast("decimal(38,0)")
    return sums.select("row_count", F.concat(*out).alias("hash"))


def multiset(changes: DataFrame, row: list[str], delta: Column) -> DataFrame:
    """Copies of each row text of a keyless table; only rows with no copies left drop out."""
    return changes.groupBy(*row).agg(F.sum(delta).alias("copies")).where("copies <> 0")


def transaction_invariants(records: DataFrame, tx: list[str], index: str, declared: str, op: str) -> DataFrame:
    """Of each transaction: distinct indexes, gaps against the declared count, duplicates, differing declared counts."""
    one = records.groupBy(*tx, index, op).agg(F.count("*").alias("_copies"), F.max(declared).alias("_most"), F.min(declared).alias("_least"))
    return one.groupBy(*tx).agg(
        F.count_distinct(index).alias("indexes"),
        (F.max("_most") - F.count_distinct(index)).alias("gaps"),
        F.sum(F.col("_copies") - 1).alias("duplicates"),
        (F.max("_most") != F.min("_least")).alias("count_mismatch"),
    )


def mark_redeliveries(records: DataFrame, tx: list[str], index: str, op: str, order: str) -> DataFrame:
    """Adds ``redelivered``: the transaction, index and operation came before."""
    return records.withColumn("redelivered", F.row_number().over(Window.partitionBy(*tx, index, op).orderBy(order)) > 1)


def order_violations(records: DataFrame, partition: str, order: str, commit: str) -> DataFrame:
    """Records that are not redelivered and whose commit lies before that of the record ahead of them."""
    fresh = records.where("not redelivered")
    return fresh.withColumn("_before", F.lag(commit).over(Window.partitionBy(partition).orderBy(order))).where(F.col(commit) < F.col("_before")).drop("_before")


def verdict(problems: Column, missing: Column, extra: Column, mismatched: Column, same_hash: Column) -> Column:
    """Problems in the evidence beat the comparison."""
    return F.when(problems > 0, "INCONCLUSIVE").when((missing + extra + mismatched == 0) & same_hash, "PASS").otherwise("FAIL")
