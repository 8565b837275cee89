"""Packing into windows by Karmarkar-Karp multiway differencing.

A document's ids (end id included) are cut into full windows from its start and a remainder, and the
remainder into pieces of at most ``PIECE`` ids. Full windows stand alone. Pieces are gathered into blocks
of ``BLOCK_WINDOWS`` windows' worth (or ``BLOCK_PIECES``, where they are tiny), in the order in which a task reads its documents, and each block is
packed at once: every piece starts as a partition of the block into K windows with one of them filled; the
two partitions whose windows differ most are merged, the fullest window of one onto the emptiest of the
other, until one near-equal partition is left. K starts at the least count that could hold the block and
rises while the fullest window exceeds capacity.

A task packs its own stream, so nothing is shuffled, memory is one block and one text, and a task that is
run again gives the same windows. Only a task's last block can be small; it wastes at most one window.

Defined results: a null text is empty and packs as its end id alone; repeated rows are packed each; a null
id is kept; an empty table gives no rows; other columns are ignored; a text of any length is cut.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tokens import byte_coder

PIECE = 128
BLOCK_WINDOWS = 96
BLOCK_PIECES = 1 << 14
OUT_ROWS = 20_000


def _difference(lengths: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each piece, and the windows' sums, by the largest differencing of k-way partitions.

    The longest pieces meet first, one a window; as many as fill all windows alike leave no difference and are dealt at
    once, the rest of them are one partition from the start. Partitions stand with their fullest window in front.
    """
    where = np.full(len(lengths), -1)
    at_most = np.array(lengths)
    longest = np.flatnonzero(at_most == at_most.max())
    whole = len(longest) - len(longest) % k
    where[longest[:whole]] = np.arange(whole) % k
    starts = [longest[whole:]] if whole < len(longest) else []
    starts += np.flatnonzero(at_most < at_most.max())[:, None].tolist()
    sums, node, heap = {}, {}, []
    for p, pieces in enumerate(starts):
        sums[p], node[p] = np.zeros(k, np.int64), np.full(k, -1)
        sums[p][: len(pieces)], node[p][: len(pieces)] = at_most[pieces], pieces
        heap.append((-int(sums[p][0] - sums[p][-1]), p))
    heapq.heapify(heap)
    below: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # merged nodes: own number, two children
    fresh = len(lengths)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total, left, right = sums.pop(a) + sums.pop(b)[::-1], node.pop(a), node.pop(b)[::-1]
        own = np.where(left >= 0, left, right)
        both = np.flatnonzero((left >= 0) & (right >= 0))
        if len(both):
            own[both] = np.arange(fresh, fresh + len(both))
            below.append((own[both], left[both], right[both]))
            fresh += len(both)
        down = np.argsort(-total, kind="stable")
        total = total[down]
        sums[a], node[a] = total - total[-1], own[down]  # what all windows hold makes no difference
        heapq.heappush(heap, (-int(sums[a][0]), a))
    at = np.full(fresh, -1)
    at[: len(lengths)] = where
    if heap:
        last = node[heap[0][1]]
        at[last[last >= 0]] = np.flatnonzero(last >= 0)
    for own, left, right in reversed(below):
        at[left], at[right] = at[own], at[own]
    where = at[: len(lengths)]
    return where, np.bincount(where, weights=lengths, minlength=k).astype(np.int64)


def windows(lengths: list[int], capacity: int) -> np.ndarray:
    """Window number of each piece; no window exceeds the capacity, which no piece does."""
    if not lengths:
        return np.zeros(0, np.int64)
    k = -(-sum(lengths) // capacity)
    while True:
        where, sums = _difference(lengths, k)
        if sums.max() <= capacity:
            return where
        k += 1


def cut(n: int, capacity: int, piece: int = PIECE) -> list[tuple[int, int]]:
    """``(start, length)`` of the full windows and the pieces of the remainder of n ids."""
    whole = n - n % capacity
    return [(s, capacity) for s in range(0, whole, capacity)] + [(s, min(piece, n - s)) for s in range(whole, n, piece)]


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str, capacity: int = 1024, end: int = 0) -> DataFrame:
    """A row for each piece of each row of ``docs(doc_id, text)``: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    kind = docs.schema["doc_id"].dataType

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_coder(path)
        sequence = TaskContext.get().partitionId() << 40
        block: list[tuple] = []
        filled = 0
        ready: list[tuple] = []
        arrow_id: pa.DataType | None = None

        def settle() -> None:
            nonlocal sequence, filled
            offsets: dict[int, int] = {}
            for row, window in zip(block, windows([r[2] for r in block], capacity).tolist(), strict=True):
                ready.append((*row, sequence + window, offsets.get(window, 0)))
                offsets[window] = offsets.get(window, 0) + row[2]
            sequence += len(offsets) and max(offsets) + 1
            filled = 0
            block.clear()

        def out() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True)) or [()] * len(_NAMES)
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, arrow_id if k == 0 else pa.int64()) for k, c in enumerate(columns)], names=_NAMES)

        for batch in found:
            arrow_id = batch.schema.field(0).type
            for doc, found_ids in zip(batch.column(0).to_pylist(), coder.rows(batch.column(1), end), strict=True):
                ids = coder.wide(found_ids)
                n = len(ids) // 4
                view = memoryview(ids)
                for start, length in cut(n, capacity):
                    row = (doc, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), n)
                    if length == capacity:
                        ready.append((*row, sequence, 0))
                        sequence += 1
                    else:
                        block.append(row)
                        filled += length
                        if filled >= BLOCK_WINDOWS * capacity or len(block) >= BLOCK_PIECES:
                            settle()
                if len(ready) >= OUT_ROWS:
                    yield out()
        settle()
        if ready:
            yield out()

    shape = T.StructType([T.StructField("doc_id", kind), *(T.StructField(n, T.LongType()) for n in _NAMES[1:])])
    return docs.select("doc_id", "text").mapInArrow(batches, shape)
