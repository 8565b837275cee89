"""A Python data source over folders of mined rows, one file a log, with position bounds pushed to the file list.

Files are named ``<first_scn>-<next_scn>.json`` (half-open) and hold JSON lines of the ``MINED`` shape. Bounds on ``scn``
choose the files; each file is a partition. After ``register(spark)`` read with
``spark.read.format("redo_files").load(folder)``. The folder is one that all executors reach (a mount).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from tidelog.streaming.assembly import MINED


class RedoFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "redo_files"

    def schema(self) -> StructType:
        return MINED

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema.fieldNames())


class _Reader(DataSourceReader):
    def __init__(self, folder: str, names: list[str]):
        self.folder, self.names, self.low, self.high = folder, names, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes note of bounds on scn; all filters stay for Spark to apply to the rows."""
        for f in filters:
            if getattr(f, "attribute", None) == ("scn",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = f.value if self.low is None else max(self.low, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = f.value if self.high is None else min(self.high, f.value)
            yield f

    def partitions(self) -> list[InputPartition]:
        found = []
        for p in sorted(Path(self.folder).iterdir()):
            m = re.fullmatch(r"(\d+)-(\d+)\.json", p.name)
            if m and (self.low is None or int(m[2]) > self.low) and (self.high is None or int(m[1]) <= self.high):
                found.append(InputPartition(str(p)))
        return found or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        with open(partition.value) as lines:
            for line in lines:
                row = json.loads(line)
                yield tuple(row.get(n) for n in self.names)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session and lets Spark hand its filters over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RedoFiles)
