"""Table state kept up to date batch by batch, readable as of a position, without going through the whole log again.

A table is a base, one row a key up to a position, and the changes of the batches behind it, both in folders by key bucket. A batch
adds its changes; after ``keep`` of them base and changes are folded into a new base. A reader takes the newest base that is
not beyond its position and the changes from there on, so reading costs the base and a bounded number of batches.
Earlier bases and changes stay until they are removed, and positions back to the oldest base can be read.

A fold needs one shuffle with partial aggregates: of each column the last value since the key's last delete counts, and a change that
does not know a column (``unavailable``) leaves it as it was.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.codes import DELETE, INSERT
from tidelog.streaming.sinks import whole_folders


def fold(changes: DataFrame, key: list[str], order: str, values: list[str]) -> DataFrame:
    """``key..., order, op_code, unavailable, values...``: one row a key that is not deleted, as a change that stands for all of its changes.

    ``changes`` have these columns; a null ``unavailable`` means that all values are known.
    """
    gone = F.col("op_code") == DELETE
    held = {}
    for c in values:
        known = gone | ~F.coalesce(F.array_contains("unavailable", c), F.lit(False))
        held[c] = F.max_by(F.struct(F.col(c).alias("v"), gone.alias("gone")), F.when(known, F.col(order))).alias(f"_{c}")
    last = changes.groupBy(*key).agg(F.max(order).alias(order), F.max_by("op_code", order).alias("_op"), *held.values()).where(F.col("_op") != DELETE)
    lost = lambda c: F.col(f"_{c}").isNull() | F.col(f"_{c}.gone")
    unknown = F.array_compact(F.array(*[F.when(lost(c), F.lit(c)) for c in values]).cast("array<string>"))
    return last.select(*key, order, F.lit(INSERT).alias("op_code"), unknown.alias("unavailable"), *[F.when(~lost(c), F.col(f"_{c}.v")).alias(c) for c in values])


class Upkeep:
    """A table's state below ``folder``; ``schema`` has the key, ``order`` (a long), ``op_code``, ``unavailable`` and the values.

    Changes of a batch lie behind those of all batches before it, which the floors of a stream see to. A batch that is run again replaces itself.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: list[str], order: str, buckets: int = 16, keep: int = 8):
        self.spark, self.folder, self.schema, self.key, self.order, self.buckets, self.keep = spark, folder.rstrip("/"), schema, key, order, buckets, keep
        self.values = [f.name for f in schema if f.name not in (*key, order, "op_code", "unavailable")]

    def _bases(self) -> list[tuple[int, int]]:
        """Batch and position of each base."""
        found = [re.fullmatch(r"upto=(\d+)_at=(-?\d+)", n) for n in whole_folders(self.spark, f"{self.folder}/base")]
        return sorted((int(m[1]), int(m[2])) for m in found if m)

    def _deltas(self, after: int, upto: int | None = None) -> list[str]:
        found = [int(n.partition("=")[2]) for n in whole_folders(self.spark, f"{self.folder}/delta") if n.startswith("batch=")]
        return [f"{self.folder}/delta/batch={n}" for n in sorted(found) if n > after and (upto is None or n <= upto)]

    def _read(self, kind: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/{kind}").parquet(*paths).select(*self.schema.fieldNames()) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, path: str) -> None:
        bucket = F.pmod(F.hash(*self.key), F.lit(self.buckets))
        rows.select(*self.schema.fieldNames()).withColumn("bucket", bucket).repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def apply(self, changes: DataFrame, number: int) -> None:
        """Takes a batch of changes in; every ``keep`` batches the base is made anew."""
        self._write(changes, f"{self.folder}/delta/batch={number}")
        base = max((b for b, _ in self._bases() if b < number), default=-1)
        if number - base >= self.keep:
            self.compact(number)

    def compact(self, number: int) -> None:
        """A base of everything up to a batch."""
        base, at = max(((b, p) for b, p in self._bases() if b < number), default=(-1, None))
        changes = self._read("delta", *self._deltas(base, number))
        top = changes.agg(F.max(self.order)).first()[0]
        position = max(p for p in (top, at, 0) if p is not None)
        rows = fold(self._base(base, at).unionByName(changes), self.key, self.order, self.values)
        self._write(rows, f"{self.folder}/base/upto={number}_at={position}")

    def _base(self, batch: int, at: int | None) -> DataFrame:
        return self._read("base", *([f"{self.folder}/base/upto={batch}_at={at}"] if at is not None else []))

    def read(self, position: int | None = None) -> DataFrame:
        """The state after all batches, or as of a position: ``key..., order, unavailable, values...``; a column that no change knew is in ``unavailable``."""
        base, at = max(((b, p) for b, p in self._bases() if position is None or p <= position), default=(-1, None))
        changes = self._read("delta", *self._deltas(base))
        if position is not None:
            changes = changes.where(F.col(self.order) <= position)
        return fold(self._base(base, at).unionByName(changes), self.key, self.order, self.values).drop("op_code")
