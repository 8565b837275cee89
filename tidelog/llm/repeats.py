"""Repeated byte strings of a corpus by enhanced suffix arrays over anchored pieces.

A text's windows of ``length`` bytes each choose an anchor: of the byte runs of ``GRAM`` in them the one with the least
hash. Windows that follow each other and choose the same anchor make a piece; equal windows choose the same anchor in
them, so they lie in pieces around the same run. That gives a sparse index of about a row for each 39 bytes:

* Copies of a piece are told by its hash (64 bits, beside the 64 bits of its run): all but the first are repeats.
* Different pieces around the same run go to one task, which sorts their suffixes (ranks of doubling lengths), takes
  the common prefixes of neighbours, scans them with a stack for intervals of common prefixes, and keeps intervals
  whose left neighbours differ: the maximal repeats within pieces, each with all of its occurrences. All occurrences
  but the first are repeats.

A run with over ``BLOCK`` different pieces is cut into blocks of so many; each block then tells the first of each of its
windows, and these are compared across blocks by their 128-bit hash. Runs that hold over a ``HEAVY``-th of all pieces
are dealt to ``SALTS`` tasks by piece. A task's own copies are taken out before the shuffle.

Disk: rows are told by run in ``ROUNDS`` rounds, each a shuffle of its share of the runs. Pieces are compared in as many
rounds as keep those of one below half of all bytes, for where most runs stand in different pieces. A stage's shuffles
go when its table stands, and a table when the stages that read it are written. The result reads the documents and ``spans``.

What is removed is each byte of a string of ``length`` bytes that also starts earlier: at a smaller id, or in the same
document before. Two different pieces around one run are taken for copies if 64 bits of XXH3 agree, which for a run
of n pieces has a chance of n * n / 2**65.

Defined results: a null text is empty; a null id is the smallest; rows of the same id are one place in the order, where
the smaller start is the earlier and equal starts are not; repeated rows each get a row; an empty table gives no rows;
other columns are ignored. Long texts are cut a stretch of ``STRETCH`` bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import Workspace, join_weighted

GRAM = 24
STRETCH = 1 << 20
COMBINED = 1 << 18  # pieces of a task whose copies are taken out together
HEAVY, SALTS = 1024, 64
ROUNDS = 2
BLOCK = 2048
FLUSH = 1 << 16  # different pieces of a run held while its size is not known
SORTED_BYTES = 3 << 18  # of pieces whose suffixes are sorted together, and a block more at most
LEAST_ID = -(1 << 63)
PIECE, COPY, HINT = 0, 1, 2  # kinds of rows
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xDA942042E4DD58B5)]
ROWS = "kind byte, g long, c long, doc long, h int, start long, n int"


# -- pieces ---------------------------------------------------------------------------------------------


def pieces(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first window, the anchor and the last window of each piece of a text."""
    windows = len(text) - length + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 3
    found = [_stretch(np.frombuffer(text[at : min(len(text), at + STRETCH + length - 1)], np.uint8), length, at) for at in range(0, windows, STRETCH)]
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _stretch(data: np.ndarray, length: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = np.lib.stride_tricks.as_strided(data[: len(data) - 7].view(np.uint8), (len(data) - 7, 8), (1, 1)).copy().view("<u8").ravel()
    n = len(data) - GRAM + 1
    z = np.zeros(n, np.uint64)
    for k in range(GRAM // 8):
        z = (z ^ words[8 * k : 8 * k + n]) * _MIX[k % 3]
        z ^= z >> np.uint64(32)
    key = ((z * _MIX[1]) & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)  # a stretch has under 2**24 places
    w = length - GRAM + 1
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = key
    padded = padded.reshape(blocks, w)
    to_here = np.minimum.accumulate(padded, axis=1).ravel()
    from_here = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(from_here[: n - w + 1], to_here[w - 1 : n])
    anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], len(anchor)) - 1
    return base + first, base + anchor[first], base + last


def _combined(g: np.ndarray, c: np.ndarray, doc: np.ndarray, h: np.ndarray, start: np.ndarray, n: np.ndarray, length: int, each: bool) -> pa.RecordBatch:
    """Rows of pieces, of which only the first of each is left to compare; runs that may be heavy are hinted at.

    Copies that meet in a text are one row, without run and piece; where ``each`` is set every copy has its own.
    """
    order = np.lexsort((start, doc, c, g))
    g, c, doc, h, start, n = (x[order] for x in (g, c, doc, h, start, n))
    new = np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (doc == doc[head]) & (start == start[head])  # the first itself, or a repeated row
    copies = [x[~new & ~same] for x in (g, c, doc, h, start, n)]
    if len(copies[0]) and not each:
        order = np.lexsort((copies[4], copies[3], copies[2]))
        rows = [x[order] for x in copies[2:]]
        where, stop = _merged(*rows[:3], rows[2] + rows[3] + length)
        none = np.zeros(len(where), np.int64)
        copies = [none, none, *(x[where] for x in rows[:3]), (stop - length - rows[2][where]).astype(np.int32)]
    runs, count = np.unique(g[new], return_counts=True)
    often = count >= max(4, len(count) // (2 * HEAVY))
    more = np.zeros(int(often.sum()), np.int64)
    columns = [np.full(int(new.sum()), PIECE, np.int8), *(x[new] for x in (g, c, doc, h, start, n))]
    copies = [np.full(len(copies[0]), COPY, np.int8), *copies]
    hints = [np.full(len(more), HINT, np.int8), runs[often], count[often].astype(np.int64), more, more.astype(np.int32), more, more.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(columns, copies, hints, strict=True)], names=[x.split()[0] for x in ROWS.split(", ")])


def _merged(doc: np.ndarray, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of spans sorted by document, text and start: where those begin that meet no span before, and the end of all that meet them."""
    of = np.cumsum(np.append(False, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
    wide = int(stop.max()) + 1
    reach = np.maximum.accumulate(of * wide + stop)  # a later document's are above all of those before
    where = np.flatnonzero(np.append(True, (of * wide + start)[1:] > reach[:-1]))
    return where, reach[np.append(where[1:], len(doc)) - 1] - of[where] * wide


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of a row in the order and the hash of its text."""
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc"), F.hash(F.coalesce("text", F.lit(""))).alias("h"))


def all_pieces(docs: DataFrame, length: int, each: bool = False) -> DataFrame:
    """The pieces of ``placed`` documents: run, hash, document, first window and how many follow it. ``each`` as in ``_combined``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in found:
            for text, doc, h in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text.as_py() or "").encode()
                first, anchor, last = pieces(data, length)
                if not len(first):
                    continue
                rel = anchor - first
                run = [xxhash.xxh3_64_intdigest(data[a : a + GRAM]) for a in anchor.tolist()]
                own = [xxhash.xxh3_64_intdigest(data[s : e + length], r) for s, e, r in zip(first.tolist(), last.tolist(), rel.tolist(), strict=True)]
                k = len(first)
                held.append((np.array(run, np.uint64).view(np.int64), np.array(own, np.uint64).view(np.int64), np.full(k, doc), np.full(k, h, np.int32), first, (last - first).astype(np.int32)))
                size += k
                if size >= COMBINED:
                    yield _combined(*map(np.concatenate, zip(*held, strict=True)), length, each)
                    held, size = [], 0
        if held:
            yield _combined(*map(np.concatenate, zip(*held, strict=True)), length, each)

    return docs.select("text", "doc", "h").mapInArrow(batches, ROWS)


# -- copies of pieces, and the pieces that are left to compare -------------------------------------------

GROUPED = "kind byte, g long, c long, block long, multi boolean, doc long, h int, start long, n int"


class _Runs:
    """Rows sorted by run and piece; a run that goes on in the next batch is held back, of each piece the first."""

    def __init__(self) -> None:
        self.held: tuple[np.ndarray, ...] | None = None
        self.told = 0  # pieces of the held run that are out already

    def take(self, rows: tuple[np.ndarray, ...], final: bool) -> Iterator[pa.RecordBatch]:
        if self.held is not None:
            rows = tuple(map(np.concatenate, zip(self.held, rows, strict=True)))
        g, sub, c, doc, h, start, n = rows
        if not len(g):
            return
        run = np.append(True, (g[1:] != g[:-1]) | (sub[1:] != sub[:-1]))
        new = run | np.append(True, c[1:] != c[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        copy = (doc != doc[head]) | (start != start[head])
        none = np.zeros(int(copy.sum()), np.int64)
        out = [self._rows(COPY, [none, none, none, *(x[copy] for x in rows[3:])], none, none.astype(bool))]
        rows = tuple(x[new] for x in rows)
        at = np.flatnonzero(run[new])
        number = np.cumsum(run[new]) - 1
        count = np.diff(np.append(at, len(rows[0])))
        place = np.arange(len(rows[0])) - at[number]
        told = np.where(number == 0, self.told, 0)
        total = count[number] + told
        done = number < len(at) - 1 if not final else np.ones(len(number), bool)
        tail = int(at[-1])
        if not final and len(number) - tail > FLUSH:
            done[tail:-1] = True
            total[tail:] = np.maximum(total[tail:], BLOCK + 1)
        last = int(done.sum())
        ask = done & ((rows[1] >= 0) | (total >= 2))
        block = np.maximum(rows[1], 0).astype(np.int64) * (1 << 32) + (place + told) // BLOCK
        out.append(self._rows(PIECE, [x[ask] for x in rows], block[ask], ((rows[1] >= 0) | (total > BLOCK))[ask]))
        self.told = 0 if final else (int(self.told) if len(at) == 1 else 0) + max(0, last - tail)
        self.held = None if final else tuple(x[last:] for x in rows)
        yield from (x for x in out if x.num_rows)

    @staticmethod
    def _rows(kind: int, rows: list[np.ndarray], block: np.ndarray, multi: np.ndarray) -> pa.RecordBatch:
        g, _, c, doc, h, start, n = rows
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(g), kind, np.int8), g, c, block, multi, doc, h, start, n)], names=[x.split()[0] for x in GROUPED.split(", ")])


def heavy_runs(rows: DataFrame, total: int) -> DataFrame:
    """The runs that may hold a ``HEAVY``-th of all pieces or more, ``HEAVY`` of them at most."""
    return rows.where(F.col("kind") == HINT).groupBy("g").agg(F.sum("c").alias("k")).where(F.col("k") * HEAVY >= total).select("g", F.lit(True).alias("heavy"))


def grouped(rows: DataFrame, heavy: DataFrame, length: int) -> DataFrame:
    """Copies of pieces, and the pieces to compare with others of their run."""
    dealt = rows.where(F.col("kind") == PIECE).join(F.broadcast(heavy), "g", "left")
    # a piece has under ``length`` windows; the fewer the columns, the shorter the rows that are shuffled
    dealt = dealt.select(F.when(F.col("heavy"), F.pmod("c", F.lit(SALTS))).otherwise(-1).cast("int").alias("sub"), "g", "c", "h", "doc", (F.col("start") * length + F.col("n")).alias("place"))
    dealt = dealt.repartition("g", "sub").sortWithinPartitions("g", "sub", "c", "doc", "place")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs()
        empty = None
        for batch in found:
            sub, g, c, h, doc, place = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            columns = (g, sub, c, doc, h, place // length, (place % length).astype(np.int32))
            empty = tuple(x[:0] for x in columns)
            yield from runs.take(columns, False)
        if empty is not None:
            yield from runs.take(empty, True)

    return dealt.mapInArrow(batches, GROUPED)


def texts_of(asked: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the pieces to compare, from the ``placed`` documents that hold them."""
    by_doc = asked.groupBy("doc", "h").agg(F.collect_list(F.struct("g", "c", "block", "multi", "start", "n")).alias("asked"))
    joined = docs.join(by_doc, ["doc", "h"]).select("doc", "h", "text", "asked")
    names = ["g", "c", "block", "multi", "doc", "h", "start", "piece"]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for row in range(batch.num_rows):
                data = batch.column(2)[row].as_py().encode()
                own = batch.column(3)[row].values
                g, c, block, multi, start, n = (own.field(k) for k in range(6))
                cut = pa.array([data[s : s + k + length] for s, k in zip(start.to_pylist(), n.to_pylist(), strict=True)], pa.binary())
                size = len(own)
                columns = [g, c, block, multi, pa.array([batch.column(0)[row].as_py()] * size, pa.int64()), pa.array([batch.column(1)[row].as_py()] * size, pa.int32()), start, cut]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(batches, "g long, c long, block long, multi boolean, doc long, h int, start long, piece binary")


# -- suffix arrays --------------------------------------------------------------------------------------


class Suffixes:
    """An enhanced suffix array of the windows of some texts: order, common prefixes, left neighbours.

    Texts of different groups never share a prefix.
    """

    def __init__(self, texts: list[bytes], group: np.ndarray, length: int):
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.text = np.repeat(np.arange(len(texts)), sizes)
        rest = self.ends[self.text] - np.arange(len(data))
        self.rest = rest
        ranks = [np.unique(group[self.text] * 256 + data, return_inverse=True)[1]]
        step = 1
        while step < sizes.max(initial=0):
            rank = ranks[-1]
            behind = np.zeros(len(rank), np.int64)
            inside = np.flatnonzero(rest > step)
            behind[inside] = rank[inside + step] + 1
            ranks.append(np.unique(rank * (rank.max() + 2) + behind, return_inverse=True)[1])
            step *= 2
        windows = np.flatnonzero(rest >= length)
        self.array = windows[np.argsort(ranks[-1][windows], kind="stable")]
        self.common = self._common(ranks)
        left = np.where(windows == self.starts[self.text[windows]], -1, data[windows - 1])  # a piece may go on to the left of its first window
        by_place = np.zeros(len(data), np.int64)
        by_place[windows] = left
        self.left = by_place[self.array]

    def _common(self, ranks: list[np.ndarray]) -> np.ndarray:
        """The common prefix of each suffix with the one before it, 0 for the first."""
        p, q = self.array[:-1], self.array[1:]
        most = np.minimum(self.rest[p], self.rest[q])
        found = np.zeros(len(p), np.int64)
        for level in reversed(range(len(ranks))):
            on = np.flatnonzero(found < most)
            on = on[ranks[level][p[on] + found[on]] == ranks[level][q[on] + found[on]]]
            found[on] += 1 << level
        return np.append(0, np.minimum(found, most)) if len(self.array) else found

    def intervals(self, least: int) -> Iterator[tuple[int, int, int]]:
        """``(first, last, depth)`` of each interval of the array with a common prefix of ``least`` or more and differing left neighbours."""
        stack: list[list[int]] = []  # depth, first, left neighbour or -1 where they differ
        common, left = [*self.common.tolist(), 0], self.left.tolist()
        for j in range(1, len(common)):
            first, own, now = j - 1, left[j - 1], common[j]
            while stack and now < stack[-1][0]:
                depth, first, other = stack.pop()
                own = own if own == other else -1
                if own < 0:
                    yield first, j - 1, depth
            if now >= least:
                if stack and now == stack[-1][0]:
                    stack[-1][2] = own if own == stack[-1][2] else -1
                else:
                    stack.append([now, first, own])


def _repeated(texts: list[bytes], group: np.ndarray, length: int) -> np.ndarray:
    """Which groups have two windows with the same rolling hash; others have no repeat."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    windows = np.flatnonzero(ends[owner] - np.arange(len(data)) >= length)
    power = np.cumprod(np.full(len(data), _MIX[0]))  # odd, so a window's factor has an inverse
    back = np.cumprod(np.full(len(data), np.uint64(pow(int(_MIX[0]), -1, 1 << 64))))
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * power))
    key = (sums[windows + length] - sums[windows]) * back[windows]
    key = (key ^ (key >> np.uint64(29))) * _MIX[1] + group[owner[windows]].astype(np.uint64) * _MIX[2]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    return np.unique(group[owner[windows[order[1:][same]]]])


FOUND = "kind byte, doc long, h int, start long, stop long, a long, b long, seq int, g long, c long"
SPAN, WINDOW, MEMBER = 0, 1, 2


def _compared(rows: list[tuple], length: int, members: bool) -> Iterator[pa.RecordBatch]:
    """Spans that repeat an earlier place, of rows ``(g, c, block, multi, doc, h, start, piece)`` of whole blocks; first windows of blocks of larger runs."""
    g, c, block, multi, doc, h, start = (np.array([r[k] for r in rows]) for k in range(7))
    texts = [r[7] for r in rows]
    group = np.cumsum(np.append(False, (g[1:] != g[:-1]) | (block[1:] != block[:-1])))
    some = np.isin(group, _repeated(texts, group, length)) | multi
    if not some.any():
        return
    g, c, block, multi, doc, h, start, group = (x[some] for x in (g, c, block, multi, doc, h, start, group))
    texts = [t for t, s in zip(texts, some.tolist(), strict=True) if s]
    found = Suffixes(texts, group, length)
    of = found.text[found.array]
    place = start[of] + found.array - found.starts[of]
    order = np.lexsort((place, doc[of]))
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.cumsum(np.append(False, (doc[of][order][1:] != doc[of][order][:-1]) | (place[order][1:] != place[order][:-1])))
    cover = np.zeros(len(found.rest), np.int64)
    inner = []
    for seq, (first, last, depth) in enumerate(sorted(found.intervals(length), key=lambda x: x[2])):
        own = rank[first : last + 1]
        later = found.array[first : last + 1][own > own.min()]
        cover[later] = depth  # what is deeper comes later and reaches further
        if members:
            inner.append((np.full(last + 1 - first, seq), np.full(last + 1 - first, depth), np.arange(first, last + 1)))
    at = np.flatnonzero(cover)
    names = [x.split()[0] for x in FOUND.split(", ")]

    def batch(kind: int, which: np.ndarray, at: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray, seq: np.ndarray) -> pa.RecordBatch:
        named = [x[which] if kind == MEMBER else np.zeros(len(which), np.int64) for x in (g, c)]
        columns = [np.full(len(which), kind, np.int8), doc[which], h[which].astype(np.int32), at, stop, a, b, seq.astype(np.int32), *named]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    if len(at):
        reach = np.maximum.accumulate(at + cover[at])
        new = np.append(True, at[1:] >= reach[:-1])
        begin = at[new]
        stop = reach[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
        which = found.text[begin]
        none = np.zeros(len(which), np.int64)
        shift = start[which] - found.starts[which]
        yield batch(SPAN, which, begin + shift, stop + shift, none, none, none)
    if multi.any():
        same = np.cumsum(found.common < length) - 1
        least = np.minimum.reduceat(rank, np.flatnonzero(found.common < length))
        firsts = np.flatnonzero((rank == least[same]) & multi[of])
        which = of[firsts]
        cut = [texts[k][p : p + length] for k, p in zip(which.tolist(), (found.array[firsts] - found.starts[which]).tolist(), strict=True)]
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, cut)), "<i8").reshape(-1, 2)
        yield batch(WINDOW, which, place[firsts], place[firsts] + length, digests[:, 0].copy(), digests[:, 1].copy(), np.zeros(len(which), np.int64))
    if inner:
        seq, depth, where = map(np.concatenate, zip(*inner, strict=True))
        which = of[where]
        off = found.array[where] - found.starts[which]
        yield batch(MEMBER, which, off, off + depth, block[which], np.full(len(which), 0), seq)


def compared(texts: DataFrame, length: int, members: bool = False) -> DataFrame:
    """Repeats among the pieces of each run, a block at a time."""
    dealt = texts.select("g", "c", "block", "multi", "doc", "h", "start", "piece").repartition("g", "block").sortWithinPartitions("g", "block", "doc", "start")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in found:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if held and held[-1][0] == row[0] and held[-1][2] == row[2]:
                    if held[-1][1] == row[1] and held[-1][4] == row[4] and held[-1][6] == row[6]:
                        continue  # from a repeated row
                elif size >= SORTED_BYTES:
                    yield from _compared(held, length, members)
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held:
            yield from _compared(held, length, members)

    return dealt.mapInArrow(batches, FOUND)


# -- results --------------------------------------------------------------------------------------------

SPANS = "doc long, h int, start long, stop long"


def joined(spans: DataFrame) -> DataFrame:
    """``(doc, h, start, stop)`` of the maximal spans, of spans that may overlap."""
    dealt = spans.select("doc", "h", "start", "stop").repartition("doc", "h").sortWithinPartitions("doc", "h", "start")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in found:
            rows = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            if held is not None:
                rows = [np.append(x, y) for x, y in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            where, stop = _merged(*rows)
            out = [*(x[where] for x in rows[:3]), stop]
            held = [x[-1:] for x in out]  # may go on in the next batch
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1]) for x in out], names=["doc", "h", "start", "stop"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["doc", "h", "start", "stop"])

    return dealt.mapInArrow(batches, SPANS)


class Repeats:
    """The repeats of ``length`` bytes or more in ``docs(doc_id, text)``, found in written stages.

    With ``members`` the tables that ``groups`` reads stay.
    """

    def __init__(self, docs: DataFrame, length: int = 100, members: bool = False):
        if length < GRAM:
            raise ValueError(f"repeats have {GRAM} bytes at least")
        self.docs, self.length, self.members = placed(docs), length, members
        self.ws = ws = Workspace(docs.sparkSession)
        self.pieces = ws.save_freed(all_pieces(self.docs, length, members), "pieces")
        total = self.pieces.where(F.col("kind") == PIECE).count()
        heavy = ws.save_freed(heavy_runs(self.pieces, total), "heavy")
        for k in range(ROUNDS):
            self.grouped = ws.save_freed(grouped(self.pieces.where(F.pmod("g", F.lit(ROUNDS)) == k), heavy, length), "grouped", append=True)
        self.copies = ws.save_freed(self.pieces.where(F.col("kind") == COPY).select("doc", "h", "start", "n"), "copies")
        if not members:
            ws.drop("pieces")
        asked = self.grouped.where(F.col("kind") == PIECE)
        size = asked.agg(F.sum(F.col("n") + length)).first()[0] or 0
        rounds = max(1, -(-4 * size // max(1, total * (length - GRAM + 2))))  # a piece stands for (length - GRAM + 2) / 2 bytes of text, so a round has half of a text's bytes
        for k in range(rounds):
            texts = texts_of(asked.where(F.pmod("g", F.lit(rounds)) == k), self.docs, length)
            self.found = ws.save_freed(compared(texts, length, members), "found", append=True)

    def spans(self) -> DataFrame:
        """``(doc, h, start, stop)`` of the maximal spans of bytes that also stand at an earlier place; what only they read goes."""
        copies = self.copies.unionByName(self.grouped.where(F.col("kind") == COPY).select("doc", "h", "start", "n"))
        copies = copies.select("doc", "h", "start", (F.col("start") + F.col("n") + self.length).alias("stop"))
        within = self.found.where(F.col("kind") == SPAN).select("doc", "h", "start", "stop")
        windows = self.found.where(F.col("kind") == WINDOW).select("a", "b", "doc", "h", "start")
        place = F.rank().over(Window.partitionBy("a", "b").orderBy("doc", "start"))  # a row a block at most, but for repeated rows, which are one place
        again = windows.withColumn("place", place).where("place > 1").select("doc", "h", "start", (F.col("start") + self.length).alias("stop"))
        spans = self.ws.save_freed(joined(copies.unionByName(within).unionByName(again)), "spans")
        if not self.members:
            for name in ("heavy", "grouped", "copies", "found"):
                self.ws.drop(name)
        return spans

    def groups(self) -> DataFrame:
        """``(group, length, doc_id, start)``: the maximal repeats within pieces, each with all of its occurrences.

        Copies of a piece are a group; so is each interval of a run's suffix array, by the copies of its pieces. A null id is ``LEAST_ID``.
        """
        if not self.members:
            raise ValueError("groups are held with members only")
        every = self.pieces.where(F.col("kind") != HINT).select("g", "c", "doc", "start", "n")
        held = every.groupBy("g", "c").count().where("count > 1")
        whole = join_weighted(every, held, ["g", "c"], "count", every.count())
        whole = whole.select(F.concat_ws(":", "g", "c").alias("group"), (F.col("n") + self.length).cast("long").alias("length"), F.col("doc").alias("doc_id"), "start")
        inner = self.found.where(F.col("kind") == MEMBER).select("g", "c", F.col("start").alias("off"), "stop", F.col("a").alias("block"), "seq")
        inner = inner.join(every.select("g", "c", "doc", F.col("start").alias("at")), ["g", "c"])
        inner = inner.select(F.concat_ws(":", "g", F.lit("block"), "block", "seq").alias("group"), (F.col("stop") - F.col("off")).alias("length"), F.col("doc").alias("doc_id"), (F.col("at") + F.col("off")).alias("start"))
        return whole.unionByName(inner)


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for each row of ``docs(doc_id, text)``: ``kept`` holds its bytes without repeats."""
    found = Repeats(docs, length)
    spans = found.spans().groupBy("doc", "h").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    joined = found.docs.join(spans, ["doc", "h"], "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out: list[list] = [[], [], [], []]
            for text, own in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                kept, at, runs = [], 0, 0
                if own.is_valid:
                    start, stop = (own.values.field(k).to_pylist() for k in range(2))
                    for a, b in zip(start, stop, strict=True):
                        kept.append(data[at:a])
                        at = b
                    runs = len(start)
                kept.append(data[at:])
                left = b"".join(kept)
                for x, y in zip(out, (len(data), len(data) - len(left), runs, left), strict=True):
                    x.append(y)
            columns = [*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    shape = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    return joined.mapInArrow(batches, shape)


def digests(docs: DataFrame, length: int = 100) -> DataFrame:
    return without_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
