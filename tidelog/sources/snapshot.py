"""A snapshot of a table by extents, as a Python data source.

The plan cuts a table into extents of so many rows, a partition each, from what its storage tells of itself (for Parquet the row
groups), so planning reads no rows. A task reads its extent as one piece of work and hands rows on when it has all of them. Where the read comes
too late (``StaleRead``: what the extent held at the snapshot's position is gone) the extent is halved, as often as needed and
down to a least number of rows, and each half is read anew; nothing of a failed read has been handed on, so each row comes once.

Each extent that is read leaves a row of progress: ``extents`` names what a plan holds, and ``progress`` what is left of it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

from tidelog.options import split_chunk

PROGRESS = "file string, start long, rows long, halved int"


class StaleRead(RuntimeError):
    """The rows of an extent at the snapshot's position can't be read any more."""


@dataclass(frozen=True)
class Extent:
    """Rows of one stored part of a table, by their numbers in it."""

    file: str
    start: int
    rows: int


class ParquetTable:
    """A table in Parquet files; a subclass may read another storage by extents of its own."""

    def __init__(self, path: str):
        self.path = path

    def schema(self) -> pa.Schema:
        return ds.dataset(self.path).schema

    def parts(self) -> Iterator[tuple[str, list[int]]]:
        """Each file with the rows of its groups, from their footers."""
        for fragment in ds.dataset(self.path).get_fragments():
            yield fragment.path, [g.num_rows for g in fragment.row_groups]

    def read(self, extent: Extent) -> Iterator[pa.RecordBatch]:
        """The rows of an extent; only the row groups that hold them are read."""
        with pq.ParquetFile(extent.file) as file:
            at = 0
            for k in range(file.num_row_groups):
                n = file.metadata.row_group(k).num_rows
                low, high = max(extent.start, at), min(extent.start + extent.rows, at + n)
                if low < high:
                    yield from file.read_row_group(k).slice(low - at, high - low).to_batches()
                at += n


def planned(table: ParquetTable, chunk_rows: int) -> Iterator[Extent]:
    """Extents of at most ``chunk_rows`` rows, cut at row groups where these are smaller."""
    for file, groups in table.parts():
        start = held = 0
        for n in groups:
            while n:
                if held and held + n > chunk_rows:
                    yield Extent(file, start, held)
                    start, held = start + held, 0
                took = min(n, chunk_rows - held)
                held, n = held + took, n - took
                if held == chunk_rows:
                    yield Extent(file, start, held)
                    start, held = start + held, 0
        if held:
            yield Extent(file, start, held)


class _Part(InputPartition):
    def __init__(self, extent: Extent):
        super().__init__(extent)


class _Reader(DataSourceReader):
    def __init__(self, table: ParquetTable, chunk_rows: int, least: int, progress: str | None):
        self.table, self.chunk_rows, self.least, self.progress = table, chunk_rows, least, progress

    def partitions(self) -> list[InputPartition]:
        return [_Part(e) for e in planned(self.table, self.chunk_rows)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        left = [(partition.value, 0)]
        while left:
            extent, halved = left.pop()
            try:
                rows = list(self.table.read(extent))  # an extent, whose size the plan bounds
            except StaleRead:
                half = split_chunk(extent.rows, self.least)
                if half is None:
                    raise
                left += [(Extent(extent.file, extent.start + half, extent.rows - half), halved + 1), (Extent(extent.file, extent.start, half), halved + 1)]
                continue
            yield from rows
            self._tell(extent, halved)

    def _tell(self, extent: Extent, halved: int) -> None:
        """A file an extent, named after it: a task that runs again replaces its own."""
        if self.progress:
            os.makedirs(self.progress, exist_ok=True)
            name = f"{uuid.uuid5(uuid.NAMESPACE_URL, extent.file)}-{extent.start}-{extent.rows}.json"
            held = os.path.join(self.progress, f".{name}.{uuid.uuid4().hex}")
            with open(held, "w") as out:
                json.dump(asdict(extent) | {"halved": halved}, out)
            os.replace(held, os.path.join(self.progress, name))


def source(table: ParquetTable, name: str = "snapshot_extents") -> type[DataSource]:
    """A data source of this table. Options: ``chunk_rows`` of an extent (100,000), ``least_rows`` (1,000), ``progress``, a mounted folder."""

    class Snapshot(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            return from_arrow_schema(table.schema())

        def reader(self, schema) -> DataSourceReader:
            get = self.options.get
            return _Reader(table, int(get("chunk_rows", "100000")), int(get("least_rows", "1000")), get("progress"))

    return Snapshot


def extents(spark: SparkSession, table: ParquetTable, chunk_rows: int = 100_000) -> DataFrame:
    """``(file, start, rows)`` of a plan."""
    return spark.createDataFrame([tuple(asdict(e).values()) for e in planned(table, chunk_rows)], "file string, start long, rows long")


def progress(spark: SparkSession, plan: DataFrame, folder: str) -> DataFrame:
    """``(file, start, rows, done, remaining)`` of each planned extent; halves count for the extent that they lie in."""
    told = spark.read.schema(PROGRESS).json(folder).select(F.col("file").alias("_file"), F.col("start").alias("_start"), F.col("rows").alias("_rows")).distinct()
    inside = (F.col("file") == F.col("_file")) & (F.col("_start") >= F.col("start")) & (F.col("_start") < F.col("start") + F.col("rows"))
    done = plan.join(told, inside, "left").groupBy("file", "start", "rows").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("done"))
    return done.withColumn("remaining", F.col("rows") - F.col("done"))
