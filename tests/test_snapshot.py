"""A snapshot by extents: halved where reads come too late, each row once, progress by extent."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidelog.sources import snapshot


class Stale(snapshot.ParquetTable):
    """Reads of more rows than the limit come too late, after some rows have been read."""

    def __init__(self, path, limit):
        super().__init__(path)
        self.limit = limit

    def read(self, extent):
        for k, batch in enumerate(super().read(extent)):
            if extent.rows > self.limit and (k or extent.rows > 2 * self.limit):
                raise snapshot.StaleRead(f"{extent}")
            yield batch
        if extent.rows > self.limit:
            raise snapshot.StaleRead(f"{extent}")


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    for k in range(3):
        n = 5000 + 777 * k
        pq.write_table(pa.table({"id": range(k * 10_000, k * 10_000 + n), "v": [f"v{i}" for i in range(n)]}), path / f"{k}.parquet", row_group_size=1700)
    return str(path)


def test_extents_cover_all_rows(folder):
    for size in (1000, 1700, 2500, 100_000):
        plan = list(snapshot.planned(snapshot.ParquetTable(folder), size))
        assert max(e.rows for e in plan) <= size and sum(e.rows for e in plan) == 3 * 5000 + 777 * 3
        for a, b in zip(plan, plan[1:], strict=False):
            assert b.start == (a.start + a.rows if a.file == b.file else 0)


def test_late_reads_are_halved_and_rows_come_once(spark, folder, tmp_path):
    want = {(k * 10_000 + i, f"v{i}") for k in range(3) for i in range(5000 + 777 * k)}
    table = Stale(folder, 700)
    spark.dataSource.register(snapshot.source(table, "late_extents"))
    told = str(tmp_path / "progress")
    df = spark.read.format("late_extents").option("chunk_rows", 2500).option("least_rows", 100).option("progress", told).load()
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(want) and set(rows) == want
    plan = snapshot.extents(spark, table, 2500)
    left = snapshot.progress(spark, plan, told).collect()
    assert len(left) == plan.count() and {r["remaining"] for r in left} == {0}
    assert {r["rows"] for r in spark.read.schema(snapshot.PROGRESS).json(told).collect()} <= set(range(1, 701))
    again = df.where("id < 100").count()
    assert again == 100


def test_an_extent_that_stays_too_large_stops(spark, folder):
    spark.dataSource.register(snapshot.source(Stale(folder, 50), "too_late"))
    with pytest.raises(Exception, match="StaleRead"):
        spark.read.format("too_late").option("chunk_rows", 2500).option("least_rows", 1000).load().count()
