"""Cuts of ordered runs by limits that start anew at each cut: so many records, bytes, or so much time, whichever comes first.

A run of up to ``SHORT`` rows is walked through by a task, a row at a time with nothing held but the open piece. A longer one may
be a third of all rows, so no task walks through it. Its rows are dealt into stretches by quantiles of their order. In a stretch, the place where a piece that starts at a row is full is a search in running sums, and following
these pointers tells from any start where the last piece begins that does not end there. Only these last starts go from
stretch to stretch: each finds the stretch it ends in by the stretches' totals, and the place in it by a second search.
That leaves a chain of a step a stretch, which one task follows for each run, and each stretch then knows how it is entered.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT = 100_000  # rows; of longer runs there are a SHORT-th as many as rows at most
STRETCHES = 4  # by shuffle partition
NONE = -(1 << 62)  # no row: the piece begins at the next one


class _Stretch:
    """Rows of one stretch in order: running sums of each weight, and times."""

    def __init__(self, order: np.ndarray, weights: np.ndarray, limits: list[int], clock: np.ndarray | None, span: int | None):
        self.order, self.weights, self.limits, self.span = order, weights, np.array(limits, np.int64), span
        self.sums = np.cumsum(weights, axis=1)
        self.clock = None if clock is None else np.maximum.accumulate(clock)
        n = len(order)
        full = np.full(n, n)
        for w, total, limit in zip(weights, self.sums, limits, strict=True):
            full = np.minimum(full, np.searchsorted(total, total - w + limit))
        if self.clock is not None:
            full = np.minimum(full, np.searchsorted(self.clock, clock + span))
        self.full = np.maximum(full, np.arange(n))  # the row that fills a piece, n if none does
        follow = self.full.tolist()
        last = [0] * n  # the start of the last piece from here, n where one ends with the stretch
        for k in range(n - 1, -1, -1):
            after = follow[k] + 1
            last[k] = k if after > n else n if after == n else last[after]
        self.last = np.array([*last, n])

    def entered(self, left: np.ndarray, until: int | None) -> int:
        """The row that fills a piece which began before and lacks so much of each limit; n if none does."""
        n = len(self.order)
        at = min([n, *(int(np.searchsorted(total, lack)) for total, lack in zip(self.sums, left, strict=True))])
        return at if until is None or self.clock is None else min(at, int(np.searchsorted(self.clock, until)))

    def leaving(self, k: int) -> tuple[int, list[int], int | None]:
        """Of a last start: its order, what it lacks behind the stretch, and when its time is up."""
        if k == len(self.order):
            return NONE, self.limits.tolist(), None
        lack = self.limits - (self.sums[:, -1] - self.sums[:, k] + self.weights[:, k])
        return int(self.order[k]), lack.tolist(), None if self.clock is None else int(self.clock[k] + self.span)


def resetting_cuts(rows: DataFrame, by: list[str], order: str, limits: dict[str, int], clock: str | None = None, span: int | None = None) -> DataFrame:
    """Adds ``first``, the order of the first row of a row's piece, and ``cut``, whether it closes the piece.

    A piece is closed by the row with which the sum of a column of ``limits`` since its first row reaches its limit, or whose
    ``clock`` (a long) is at least ``span`` after the first row's. ``order`` is a long that differs between the rows of a run; weights are
    not negative and null counts as 0. The last piece of a run may stay open.
    """
    long_runs = rows.groupBy(*by).count().where(F.col("count") > SHORT).select(*[F.col(c).alias(f"_{c}") for c in by])
    if long_runs.isEmpty():
        return _walked(rows, by, order, limits, clock, span)
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    known = F.broadcast(long_runs)
    return _walked(rows.join(known, on, "left_anti"), by, order, limits, clock, span).unionByName(_by_stretches(rows.join(known, on, "left_semi"), by, order, limits, clock, span))


def _walked(rows: DataFrame, by: list[str], order: str, limits: dict[str, int], clock: str | None, span: int | None) -> DataFrame:
    """Cuts of runs that are not long: each run's rows pass in order."""
    begins = F.row_number().over(Window.partitionBy(*by).orderBy(order)) == 1
    weights = {f"_w{k}": F.coalesce(F.col(c).cast("long"), F.lit(0)) for k, c in enumerate(limits)}
    marked = rows.withColumns({"_begins": begins, "_o": F.col(order).cast("long"), "_t": F.col(clock).cast("long") if clock else F.lit(0).cast("long"), **weights})
    shape = T.StructType([*rows.schema.fields, T.StructField("first", T.LongType()), T.StructField("cut", T.BooleanType())])
    names, many, taken = rows.columns, list(limits.values()), ["_begins", "_o", "_t", *weights]
    until = span if clock else None

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, since, held, closed = 0, 0, [], True
        for batch in batches:
            column = lambda c: batch.column(c).to_pylist()  # noqa: E731, B023
            first, cut = [], []
            for begin, at, time, *own in zip(*map(column, taken), strict=True):
                if begin or closed:
                    begun, since, held = at, time, own
                else:
                    held = [h + w for h, w in zip(held, own, strict=True)]
                closed = any(h >= limit for h, limit in zip(held, many, strict=True)) or (until is not None and time - since >= until)
                first.append(begun)
                cut.append(closed)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(first, pa.int64()), pa.array(cut, pa.bool_())], names=[*names, "first", "cut"])

    return marked.mapInArrow(walk, shape)


def _by_stretches(rows: DataFrame, by: list[str], order: str, limits: dict[str, int], clock: str | None, span: int | None) -> DataFrame:
    """Cuts of long runs."""
    spark = rows.sparkSession
    n = STRETCHES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.agg(F.percentile_approx(order, [k / n for k in range(1, n)]).alias("q")).first()["q"] or []))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(order))) if bounds else F.lit(0)
    names = list(limits)
    thin = rows.select(*by, part.cast("long").alias("_part"), F.col(order).alias("_order"), F.array(*[F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in names]).alias("_w"), (F.col(clock) if clock else F.lit(None).cast("long")).alias("_t"))
    key = T.StructType([rows.schema[c] for c in by])
    long = lambda *cs: [T.StructField(c, T.LongType()) for c in cs]
    lack = T.StructField("_w", T.ArrayType(T.LongType()))
    many = [limits[c] for c in names]

    def by_key(df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(*by, *keys[:1]).sortWithinPartitions(*by, *keys) if keys[0] == "_part" else df.repartition(*by).sortWithinPartitions(*by, *keys)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
        each = (r for batch in batches for at in range(0, batch.num_rows, 4096) for r in batch.slice(at, 4096).to_pylist())
        for k, group in groupby(each, key=lambda r: (*[r[c] for c in by], r["_part"])):
            yield k, list(group)  # rows of one stretch

    def stretch(own: list[dict]) -> _Stretch:
        weights = np.array([r["_w"] for r in own], np.int64).reshape(len(own), len(names)).T
        return _Stretch(np.array([r["_order"] for r in own], np.int64), weights, many, np.array([r["_t"] for r in own], np.int64) if clock else None, span)

    # 1. what each stretch holds, and the last starts that may leave it
    left_shape = T.StructType([*key.fields, *long("_part", "_start"), lack, *long("_t"), T.StructField("_what", T.IntegerType())])

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, own in stretches(batches):
            s = stretch(own)
            out = [(*k, 0, s.sums[:, -1].tolist(), None if s.clock is None else int(s.clock[-1]), 0)]
            for start in np.unique(s.last).tolist():
                at, lacks, until = s.leaving(start)
                out.append((*k, at, lacks, until, 1))
            yield _batch(out, left_shape)

    left = by_key(thin, "_part", "_order").mapInArrow(leave, left_shape)

    # 2. the stretch in which each of these pieces is full
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for batch in batches for r in batch.to_pylist())
        for _, run in groupby(each, key=lambda r: tuple(r[c] for c in by)):
            parts, totals, clocks, out = [], [], [], []
            line = None
            for r in run:  # the stretches come first
                if r["_what"] == 0:
                    parts.append(r["_part"]), totals.append(r["_w"]), clocks.append(r["_t"])
                    continue
                line = line or _Line(parts, totals, clocks)
                to, lacks = line.target(r["_part"], r["_start"], r["_w"], r["_t"])
                if to is not None:
                    out.append((*[r[c] for c in by], to, r["_start"], lacks, r["_t"], r["_part"]))
                    if len(out) >= 10_000:
                        yield _batch(out, entry_shape)
                        out = []
            if out:
                yield _batch(out, entry_shape)

    entry_shape = T.StructType([*key.fields, *long("_part", "_start"), lack, *long("_t", "_from")])
    entries = by_key(left, "_what", "_part").mapInArrow(locate, entry_shape)

    # 3. where each piece that enters a stretch ends in it, and the last start from there
    both = thin.withColumns({"_start": F.lit(None).cast("long"), "_from": F.lit(None).cast("long"), "_what": F.lit(1)}).unionByName(entries.withColumns({"_order": F.lit(None).cast("long"), "_what": F.lit(0)}))
    step_shape = T.StructType([*key.fields, *long("_part", "_start"), lack, *long("_t"), T.StructField("_what", T.IntegerType()), *long("_from", "_from_start")])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, own in stretches(batches):
            entering = [r for r in own if r["_what"] == 0]
            s = stretch([r for r in own if r["_what"] == 1])
            out = [(*k, 0, s.sums[:, -1].tolist(), None if s.clock is None else int(s.clock[-1]), 0, None, None)]
            for r in [*entering, {"_start": NONE, "_from": -1}]:  # the last as if the run began here
                at = -1 if r["_start"] == NONE else s.entered(np.array(r["_w"]), r["_t"])
                to, lacks, until = s.leaving(int(s.last[min(at + 1, len(s.order))]))
                out.append((*k, to, lacks, until, 1, r["_from"], r["_start"]))
            yield _batch(out, step_shape)

    walked = by_key(by_key(both, "_part", "_what", "_order").mapInArrow(steps, step_shape), "_what", "_part")

    # 4. a run's chain of last starts, and so how each stretch is entered
    enter_shape = T.StructType([*key.fields, *long("_part", "_start"), lack, *long("_t")])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for batch in batches for r in batch.to_pylist())
        for k, run in groupby(each, key=lambda r: tuple(r[c] for c in by)):
            parts, totals, clocks, follow = [], [], [], {}
            for r in run:
                if r["_what"] == 0:
                    parts.append(r["_part"]), totals.append(r["_w"]), clocks.append(r["_t"])
                else:
                    follow[r["_part"], r["_from"], r["_from_start"]] = (r["_start"], r["_w"], r["_t"])
            line = _Line(parts, totals, clocks)
            at, held = 0, follow[parts[0], -1, NONE]
            out = [(*k, parts[0], NONE, many, None)]
            while at + 1 < len(parts):
                start, lacks, until = held
                to, _ = line.target(parts[at], start, lacks, until)
                stop = len(parts) - 1 if to is None else line.place[to]
                out += [(*k, parts[j], start, line.lacking(at, j, lacks), until) for j in range(at + 1, stop + 1)]
                if to is None:
                    break
                held = follow[to, -1, NONE] if start == NONE else follow[to, parts[at], start]
                at = stop
            yield _batch(out, enter_shape)

    enters = walked.mapInArrow(walk, enter_shape)

    # 5. the pieces of each stretch
    both = thin.withColumns({"_start": F.lit(None).cast("long"), "_what": F.lit(1)}).unionByName(enters.withColumns({"_order": F.lit(None).cast("long"), "_what": F.lit(0)}))
    cut_shape = T.StructType([*key.fields, *long("_order", "first"), T.StructField("cut", T.BooleanType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (enter, *own) in stretches(batches):
            s = stretch(own)
            n = len(own)
            at = -1 if enter["_start"] == NONE else s.entered(np.array(enter["_w"]), enter["_t"])
            first, closes = np.full(n, enter["_start"]), np.zeros(n, bool)
            if 0 <= at < n:
                closes[at] = True
            begin = at + 1
            while begin < n:
                stop = int(s.full[begin])
                first[begin : stop + 1] = s.order[begin]
                if stop < n:
                    closes[stop] = True
                begin = stop + 1
            yield _batch([(*k[:-1], o, f, c) for o, f, c in zip(s.order.tolist(), first.tolist(), closes.tolist(), strict=True)], cut_shape)

    told = by_key(both, "_part", "_what", "_order").mapInArrow(cut, cut_shape)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    on = F.col(f"r.{order}") == F.col("c._order")
    for s in same:
        on = on & s
    return rows.alias("r").join(told.alias("c"), on).select("r.*", "c.first", "c.cut")


class _Line:
    """The stretches of a run in order, with what they hold."""

    def __init__(self, parts: list[int], totals: list[list[int]], clocks: list[int | None]):
        self.parts, self.place = parts, {p: k for k, p in enumerate(parts)}
        self.sums = np.cumsum(np.array(totals, np.int64), axis=0).T
        self.clocks = None if clocks[0] is None else np.maximum.accumulate(np.array(clocks, np.int64))

    def target(self, part: int, start: int, lacks: list[int], until: int | None) -> tuple[int | None, list[int]]:
        """The stretch behind ``part`` in which a piece is full, and what it lacks there; None where it stays open."""
        at = self.place[part]
        if start == NONE:  # begins with the next stretch
            return (None, lacks) if at + 1 == len(self.parts) else (self.parts[at + 1], lacks)
        to = min([len(self.parts), *(int(np.searchsorted(total, total[at] + lack)) for total, lack in zip(self.sums, lacks, strict=True))])
        if until is not None and self.clocks is not None:
            to = min(to, int(np.searchsorted(self.clocks, until)))
        to = max(to, at + 1)
        return (None, lacks) if to >= len(self.parts) else (self.parts[to], self.lacking(at, to, lacks))

    def lacking(self, at: int, to: int, lacks: list[int]) -> list[int]:
        """What is lacking at the beginning of stretch ``to`` of what was at the end of ``at``."""
        return [int(lack - (total[to - 1] - total[at])) for lack, total in zip(lacks, self.sums, strict=True)]


def _batch(rows: list[tuple], shape: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(shape)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
