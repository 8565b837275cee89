"""Sinks and sources of streams: exactly-once files by batch, routing by topic, floors that stop."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def log_stream(spark: SparkSession, folder: str, schema: StructType, files: int = 1) -> DataFrame:
    """A folder of JSON lines as a stream, so many files a batch; the source's rate is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)


def topic_table(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A bounded topic: what stands in the folder now."""
    return spark.read.schema(schema).json(folder)


class FloorError(RuntimeError):
    """A commit lies below what was handed over: reading goes on from the wrong place."""


#: Fixed value: the address of rows that have none; they are not compared.
NO_ADDRESS = "0x000000.00000000.0000"


class Floor:
    """The greatest value so far of each group (a container, a thread), in a folder a batch.

    A batch is checked against the newest floors below it: a value below its group's floor (for an address: at or below) stops the query.
    Groups never compare with each other, and one without a floor passes. Floors that are missing after batch 0 are an error,
    as nothing would be checked without them.
    """

    def __init__(self, folder: str, column: str, by: list[str]):
        self.folder, self.column, self.by = folder.rstrip("/"), column, by

    def _own(self, batch: DataFrame) -> DataFrame:
        kind = batch.schema[self.column].dataType.simpleString()
        value = F.rtrim(self.column) if kind == "string" else F.col(self.column).cast("long")
        rows = batch.withColumn("_v", value).where(F.col("_v").isNotNull() & (F.trim(F.col("_v").cast("string")) != NO_ADDRESS))
        return rows.groupBy(*[F.col(c).cast("long").alias(c) for c in self.by]).agg(F.min("_v").alias("low"), F.max("_v").alias("high"))

    def _kept(self, own: DataFrame, number: int) -> DataFrame:
        spark = own.sparkSession
        schema = StructType([*(own.schema[c] for c in self.by), own.schema["high"]])
        found = [n for n in _batches(spark, self.folder) if n < number]
        if number and not found:
            raise FloorError(f"the floors below batch {number} are missing from {self.folder}")
        return spark.read.schema(schema).parquet(f"{self.folder}/batch={max(found)}") if found else spark.createDataFrame([], schema)

    def _both(self, batch: DataFrame, number: int) -> DataFrame:
        own = self._own(batch)
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"k.{c}")) for c in self.by]
        return own.alias("o").join(self._kept(own, number).alias("k"), reduce(and_, same), "full")

    def check(self, batch: DataFrame, number: int) -> None:
        low, high = F.col("o.low"), F.col("k.high")
        below = low <= high if batch.schema[self.column].dataType.simpleString() == "string" else low < high
        bad = self._both(batch, number).where(below).select(*[F.col(f"o.{c}") for c in self.by], low, high).first()
        if bad:
            group = ", ".join(f"{c} {bad[c]}" for c in self.by)
            raise FloorError(f"CDC-7003: batch {number} holds {self.column} {bad['low']} on {group}, not above those handed over, {bad['high']}")

    def keep(self, batch: DataFrame, number: int) -> None:
        both = self._both(batch, number)
        highest = both.select(*[F.coalesce(f"o.{c}", f"k.{c}").alias(c) for c in self.by], F.greatest("o.high", "k.high").alias("high"))
        highest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch={number}")  # a row a group


def whole_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder whose writing has ended."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [n.getName() for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches whose folders are whole."""
    return [int(n.partition("=")[2]) for n in whole_folders(spark, folder) if n.startswith("batch=")]


def idempotent(folder: str, floor: str | None = "commit_scn") -> Callable[[DataFrame, int], None]:
    """Writes each batch to a folder named after it, so that a batch that is run again replaces itself.

    With ``floor`` a batch whose least value lies below the greatest one of the earlier batches of its container stops the query.
    """
    floors = Floor(f"{folder.rstrip('/')}_floor", floor, ["con_id"]) if floor else None

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if floors:
                floors.check(batch, number)
            batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
            if floors:
                floors.keep(batch, number)
        finally:
            batch.unpersist()

    return write


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], timed: bool = False) -> None:
    """Runs a stream over what is there and ends.

    A ``timed`` stream waits on the clock and would go on for ever with batches without data, so it runs one batch.
    """
    writer: DataStreamWriter = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    query = writer.trigger(once=True).start() if timed else writer.trigger(availableNow=True).start()
    query.awaitTermination()


def to_topics(records: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Records ``topic, key, value`` to a message bus, each to the topic that its row names."""
    return records.select("topic", "key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
