"""Large values: edits folded into the changes that they belong to.

Rows are dealt out and sorted by their group, so a task walks through its groups in Arrow batches and holds
the edits of one group at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions.redo import apply_edits

OUT_ROWS = 10_000
IN_ROWS = 64  # rows of an Arrow batch that are held as Python values at a time


def _fold_groups(rows: DataFrame, by: list[str], order: str, more: list[T.StructField], fold: Callable[[list[dict]], Iterable[dict]]) -> DataFrame:
    """``by..., more...``: what ``fold`` makes of the rows of each group in order."""
    shape = T.StructType([*(rows.schema[c] for c in by), *more])
    arrow = to_arrow_schema(shape)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        each = (row for batch in batches for at in range(0, batch.num_rows, IN_ROWS) for row in batch.slice(at, IN_ROWS).to_pylist())
        for key, group in groupby(each, key=lambda r: tuple(r[c] for c in by)):
            for out in fold(list(group)):
                yield dict(zip(by, key, strict=True)) | out

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_out = made(batches)
        while part := list(islice(rows_out, OUT_ROWS)):
            yield pa.RecordBatch.from_pylist(part, schema=arrow)

    return rows.repartition(*by).sortWithinPartitions(*by, order).mapInArrow(batches_of, shape)


def fold_edits(edits: DataFrame, by: list[str]) -> DataFrame:
    """``by..., value, known``: each large value after its edits in order; ``edits(by..., ord, edit, amount, offset, data, binary, base)``."""

    def fold(group: list[dict]) -> Iterator[dict]:
        binary, base = bool(group[0]["binary"]), group[0]["base"]
        value = apply_edits(bytes.fromhex(base) if binary and base is not None else base, group, binary)
        yield {"value": value.hex() if isinstance(value, bytes) else value, "known": value is not None}

    return _fold_groups(edits, by, "ord", [T.StructField("value", T.StringType()), T.StructField("known", T.BooleanType())], fold)


def fold_locator_updates(changes: DataFrame, tx: list[str], order: str, scalar: Column, filled: Column) -> DataFrame:
    """An insert followed at once by an update with equal scalar columns takes that update's large values; the update is gone.

    Adds ``large`` (the value with which the change goes on) and drops folded updates.
    """
    at = Window.partitionBy(*tx).orderBy(order)
    rows = changes.withColumn("_k", scalar).withColumn("_v", filled)
    follows = (F.lead("op_code").over(at) == 3) & F.lead("_k").over(at).eqNullSafe(F.col("_k")) & (F.col("op_code") == 1)
    folded = (F.lag("op_code").over(at) == 1) & F.lag("_k").over(at).eqNullSafe(F.col("_k")) & (F.col("op_code") == 3)
    rows = rows.withColumn("large", F.when(follows, F.lead("_v").over(at)).otherwise(F.col("_v"))).withColumn("_gone", F.coalesce(folded, F.lit(False)))
    return rows.where(~F.col("_gone")).drop("_k", "_v", "_gone")


def assemble(fragments: DataFrame, tx: list[str], order: str, base: str | None = None) -> DataFrame:
    """``tx..., change, value``: a locator row opens a group, the edits that follow it without a gap belong to it."""

    def fold(rows: list[dict]) -> Iterator[dict]:
        group: list[dict] = []
        change = None
        for row in [*rows, {"edit": "end"}]:
            if row["edit"] in ("write", "trim", "erase") and change is not None:
                group.append(row)
                continue
            if change is not None and group:
                yield {"change": change, "value": apply_edits(base, group, False)}
            group, change = [], row[order] if row["edit"] == "locator" else None

    return _fold_groups(fragments, tx, order, [T.StructField("change", T.LongType()), T.StructField("value", T.StringType())], fold)
