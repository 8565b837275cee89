"""Embedding near-duplicates by inverted lists with product-quantised residuals and exact reranking.

Vectors of the same bits are one node with a weight. Coarse centroids, the cells that divide each list and the
codebooks of the residuals' subspaces are fitted on a bounded sample (``SAMPLE`` vectors, those with the least hashes);
the number of cells grows with the rows, so that lists of unlike vectors stay near ``LIST_AIM`` members. Every node is
then indexed: it is a member of its nearest list (a centroid and a cell), stored with its residual's code and that
code's error, and a visitor of the next nearest ``PROBES`` lists. In each list the distance of a visitor
(and of each member) to the members' codes is summed from lookup tables; a member passes when that distance
is within the linking distance plus its own code error, so the codes lose nothing, and the passed pairs are
reranked by cosine in double precision. A link is found when either end probes the other's list, and counts
for both.

Lists of more members or visitors than a block of ``BLOCK_BYTES`` holds (near copies, which no cell divides) are cut into
blocks that meet in tasks of their own, so a vector is dealt once for each block of its list; rows to deal are made a slice
at a time. Lengths that only ``FEW`` nodes have are compared in one job without an index. Tasks emit counts and a spanning forest, a row a node at most. Recall against brute force is in the README.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are components of their own; vectors of different lengths never link; equal vectors link; repeated rows
count as other vectors; a null id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, components, forest, join_weighted

SAMPLE = 16_384
MOST_LISTS = 4096
MOST_CELLS = 1024
LIST_AIM = 4096
PROBES = 24
LIST_ROWS = 16_384  # rows of a block at most
BLOCK_BYTES = 1 << 23
SLICE_BYTES = 1 << 23
FEW = 64
SUBSPACE = 4
ROUNDS = 8
MEASURED = 1 << 22  # cells of one table of distances
SLACK = 1e-4  # more than single precision loses
DENSE = 0.1  # share of pairs within reach from which all cosines are taken at once


@dataclass
class Index:
    """Centroids, codebooks and what follows from the cosine that links."""

    centroids: np.ndarray  # coarse lists x dimensions
    cells: np.ndarray  # cells of each list x dimensions, about its centroid
    books: np.ndarray  # subspaces x codes x SUBSPACE
    cosine: float

    @property
    def reach(self) -> float:
        """Distance of unit vectors at the linking cosine."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))

    @property
    def lists(self) -> int:
        return len(self.centroids) * len(self.cells)

    def nearest(self, unit: np.ndarray, k: int) -> np.ndarray:
        """The k nearest lists of each row, among the cells of the k nearest centroids, nearest first."""
        coarse = _nearest(unit, self.centroids, k)
        if len(self.cells) == 1:
            return coarse
        n, wide = len(self.cells), min(k, coarse.shape[1] * len(self.cells))
        out = np.empty((len(unit), wide), np.int64)
        size = (self.cells**2).sum(axis=1)
        step = max(1, MEASURED // (coarse.shape[1] * n))
        for at in range(0, len(unit), step):
            rest = unit[at : at + step, None, :] - self.centroids[coarse[at : at + step]]
            far = ((rest**2).sum(axis=2)[:, :, None] - 2 * rest @ self.cells.T + size).reshape(len(rest), -1)
            near = np.argpartition(far, wide - 1, axis=1)[:, :wide]
            near = np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(axis=1, kind="stable"), 1)
            out[at : at + step] = np.take_along_axis(coarse[at : at + step], near // n, 1) * n + near % n
        return out

    def residuals(self, unit: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = unit - self.centroids[lists // len(self.cells)] - self.cells[lists % len(self.cells)]
        wide = np.zeros((len(rest), self.books.shape[0] * SUBSPACE))
        wide[:, : rest.shape[1]] = rest
        return wide.reshape(len(rest), -1, SUBSPACE)

    def encode(self, unit: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = self.residuals(unit, lists)
        code = np.stack([_nearest(rest[:, m], self.books[m], 1)[:, 0] for m in range(len(self.books))], axis=1).astype(np.uint8)
        stored = self.books[np.arange(len(self.books)), code]
        return code, np.sqrt(((rest - stored) ** 2).sum(axis=(1, 2)))

    def lookups(self, unit: np.ndarray, lists: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Squared distances of each of ``unit`` (all of one list) to each stored code, in single precision, a row a code."""
        rest = self.residuals(unit, lists)
        out = np.zeros((len(code), len(unit)), np.float32)
        for m, book in enumerate(self.books):
            out += ((book[:, None, :] - rest[None, :, m]) ** 2).sum(axis=2, dtype=np.float32)[code[:, m]]
        return out


def _nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first."""
    out = np.empty((len(x), min(k, len(centres))), np.int64)
    size = (centres**2).sum(axis=1)
    step = max(1, MEASURED // max(1, len(centres)))
    for at in range(0, len(x), step):
        far = size - 2 * x[at : at + step] @ centres.T
        if k == 1:
            out[at : at + step, 0] = far.argmin(axis=1)
        else:
            near = np.argpartition(far, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
            out[at : at + step] = np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(axis=1, kind="stable"), 1)
    return out


def _means(x: np.ndarray, k: int) -> np.ndarray:
    """k-means from evenly spaced rows; an empty cell keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        cell = _nearest(x, centres, 1)[:, 0]
        count = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def fit(sample: np.ndarray, rows: int, cosine: float) -> Index:
    """An index for ``rows`` vectors; ``sample`` holds raw vectors."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    lists = int(min(MOST_LISTS, max(1, len(unit) // 16), max(1, 4 * np.sqrt(rows))))
    centroids = _means(unit, lists)
    cells = int(min(MOST_CELLS, max(1, len(unit) // 16), -(-rows // (lists * LIST_AIM))))
    rest = unit - centroids[_nearest(unit, centroids, 1)[:, 0]]
    index = Index(centroids, _means(rest, cells) if cells > 1 else np.zeros((1, unit.shape[1])), np.zeros((-(-unit.shape[1] // SUBSPACE), 1, SUBSPACE)), cosine)
    rest = index.residuals(unit, index.nearest(unit, 1)[:, 0])
    index.books = np.stack([_means(np.ascontiguousarray(rest[:, m]), 256) for m in range(rest.shape[1])])
    return index


# -- indexing -------------------------------------------------------------------------------------------

_CODED = "node long, weight long, own int, probes binary, vector binary, code binary, error double"
_DEALT = f"{_CODED}, list int, task long, role int"
_FOUND = "u long, v long, links long"
#: Roles in a task: a block of members with itself, the two sides of two blocks, visitors and those they visit.
SELF, LEFT, RIGHT, VISITOR, VISITED = range(5)


def _matrix(column: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _coded(nodes: DataFrame, index: Index) -> DataFrame:
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            raw = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(batch.num_rows, -1)
            unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
            probes = index.nearest(unit, PROBES + 1).astype("<i4")
            code, error = index.encode(unit, probes[:, 0])
            rows = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), pa.array(probes[:, 0]), rows(probes), rows(raw), rows(code), pa.array(error)], names=[x.split()[0] for x in _CODED.split(", ")])

    return nodes.select("node", "weight", "embedding").mapInArrow(batches, _CODED)


def _steps(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _places(node: np.ndarray, probes: np.ndarray, members: np.ndarray, visitors: np.ndarray) -> list[np.ndarray]:
    """``row, list, task, role`` of all tasks that the nodes take part in; members and visitors are numbers of blocks, by list."""
    every, own, there = np.arange(len(node)), probes[:, 0], probes[:, 1:].ravel()
    m, v = members[own], visitors[own]
    mine = node % m
    row, other = np.repeat(every, m), _steps(m)
    a, wide = mine[row], m[row]
    parts = [(row, own[row], np.minimum(a, other) * wide + np.maximum(a, other), np.where(a == other, SELF, np.where(a < other, LEFT, RIGHT)))]
    row, block = np.repeat(every, v), _steps(v)
    parts.append((row, own[row], m[row] ** 2 + mine[row] * v[row] + block, np.full(len(row), VISITED)))
    m, v, from_row = members[there], visitors[there], np.repeat(every, probes.shape[1] - 1)
    at, block = np.repeat(np.arange(len(there)), m), _steps(m)
    row = from_row[at]
    parts.append((row, there[at], m[at] ** 2 + block * v[at] + node[row] % v[at], np.full(len(row), VISITOR)))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _dealt(coded: DataFrame, members: np.ndarray, visitors: np.ndarray) -> DataFrame:
    """Each node to the tasks of the lists that it is in."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            node, probes = batch.column("node").to_numpy(), _matrix(batch.column("probes"), "<i4").astype(np.int64)
            row, one, task, role = _places(node, probes, members, visitors)
            table = pa.Table.from_batches([batch])
            step = max(1, SLICE_BYTES // (batch.nbytes // batch.num_rows + 1))
            for cut in range(0, len(row), step):
                out = table.take(pa.array(row[cut : cut + step]))
                for name, values, kind in (("list", one, pa.int32()), ("task", task, pa.int64()), ("role", role, pa.int32())):
                    out = out.append_column(name, pa.array(values[cut : cut + step], kind))
                yield from out.combine_chunks().to_batches()

    return coded.mapInArrow(batches, _DEALT)


# -- a task's links ---------------------------------------------------------------------------------------


def _pairs(index: Index, one: int, ask: tuple, held: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked (asking, held) pairs, some at a time: by lookups within reach, then by cosine."""
    unit, raw, norm = ask
    code, error, raw2, norm2 = held
    step = max(1, MEASURED // (4 * max(256, len(code))))
    bound = ((index.reach + error + SLACK) ** 2)[:, None]
    for at in range(0, len(unit), step):
        part = slice(at, at + step)
        near = index.lookups(unit[part], np.full(len(unit[part]), one), code) <= bound
        if near.mean() > DENSE:
            b, a = np.nonzero(near & (raw2 @ raw[part].T / (norm2[:, None] * norm[part]) >= index.cosine))
        else:
            b, a = np.nonzero(near)
            good = np.einsum("ij,ij->i", raw[at + a], raw2[b]) / (norm[at + a] * norm2[b]) >= index.cosine
            a, b = a[good], b[good]
        if len(a):
            yield at + a, b


def _task_links(index: Index, rows: pa.Table) -> pa.RecordBatch:
    column = lambda c: rows.column(c).to_numpy()
    role, node, weight, own, error = map(column, ("role", "node", "weight", "own", "error"))
    raw, code, probes = _matrix(rows.column("vector"), "<f8"), _matrix(rows.column("code"), np.uint8), _matrix(rows.column("probes"), "<i4")
    norm = np.linalg.norm(raw, axis=1)
    unit = raw / norm[:, None]
    one = int(rows.column("list")[0].as_py())
    asking, kept = (np.flatnonzero(np.isin(role, x)) for x in ((SELF, LEFT, VISITOR), (SELF, RIGHT, VISITED)))
    links, label = np.zeros(len(node)), np.arange(len(node))
    for a, b in _pairs(index, one, (unit[asking], raw[asking], norm[asking]), (code[kept], error[kept], raw[kept], norm[kept])):
        a, b = asking[a], kept[b]
        once = (role[a] != SELF) | (a < b)
        a, b = a[once], b[once]
        links += np.bincount(a, weights=weight[b], minlength=len(node))
        visits = np.flatnonzero(role[a] == VISITOR)
        back = np.ones(len(a), bool)
        back[visits] = ~(probes[b[visits]] == own[a[visits]][:, None]).any(axis=1)  # else it is found where b visits
        links += np.bincount(b[back], weights=weight[a[back]], minlength=len(node))
        new = label[a] != label[b]
        if new.any():
            label = forest(len(node), [np.arange(len(node)), a[new]], [label, b[new]])
    some = np.flatnonzero((links > 0) | (label != np.arange(len(node))))
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[label[some]]), pa.array(links[some].astype(np.int64))], names=["u", "v", "links"])


def _links(dealt: DataFrame, index: Index) -> DataFrame:
    """``(u, v, links)``: u reaches v, and has so many links in a task; rows come sorted by task."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at: tuple | None = None
        for batch in found:
            if not batch.num_rows:
                continue
            one, task = batch.column("list").to_numpy(), batch.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(one) != 0) | (np.diff(task) != 0)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                key = (one[start], task[start])
                if held and key != at:
                    yield _task_links(index, pa.Table.from_batches(held))
                    held = []
                at = key
                held.append(batch.slice(start, stop - start))
        if held:
            yield _task_links(index, pa.Table.from_batches(held))

    return dealt.repartition("list", "task").sortWithinPartitions("list", "task").mapInArrow(batches, _FOUND)


def _visits(coded: DataFrame) -> DataFrame:
    """The list of each visit."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_matrix(batch.column("probes"), "<i4")[:, 1:].ravel())], names=["list"])

    return coded.select("probes").mapInArrow(batches, "list int")


def _of_one_length(nodes: DataFrame, size: int, cosine: float, ws: Workspace) -> DataFrame:
    sample = nodes.orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE).select("embedding").toArrow().column("embedding").combine_chunks()
    rows = nodes.count()
    index = fit(sample.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size), rows, cosine)
    coded = ws.save(_coded(nodes, index), f"coded_{size}")
    block = min(LIST_ROWS, max(256, BLOCK_BYTES // (8 * size)))
    blocks = []
    for counts in (coded.groupBy(F.col("own").alias("list")).count(), _visits(coded).groupBy("list").count()):
        found = counts.toArrow()  # a row a list, MOST_LISTS times MOST_CELLS at most
        n = np.zeros(index.lists, np.int64)
        n[found.column("list").to_numpy()] = found.column("count").to_numpy()
        blocks.append(-(-n // block))
    return _links(_dealt(coded, np.maximum(blocks[0], 1), blocks[1]), index)


def _of_rare_lengths(nodes: DataFrame, cosine: float) -> DataFrame:
    """Links among the nodes of each length, FEW of a length at most, all with all."""

    def links(rows: list[tuple[int, int, list[float]]]) -> pa.RecordBatch:
        node, weight = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        raw = np.array([r[2] for r in rows], float)
        norm = np.linalg.norm(raw, axis=1)
        near = raw @ raw.T / (norm[:, None] * norm) >= cosine
        np.fill_diagonal(near, False)
        label = forest(len(node), [np.nonzero(near)[0]], [np.nonzero(near)[1]])
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label]), pa.array(near @ weight)], names=["u", "v", "links"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in found:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "weight", "embedding")), strict=True):
                if held and len(row[2]) != len(held[0][2]):
                    yield links(held)
                    held = []
                held.append(row)
        if held:
            yield links(held)

    rows = nodes.select("node", "weight", "embedding", F.size("embedding").alias("n"))
    return rows.repartition("n").sortWithinPartitions("n").mapInArrow(batches, _FOUND)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    ws = Workspace(spark)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    given = vectors.select("vec_id", "embedding", F.coalesce(fine, F.lit(False)).alias("fine"))
    usable = given.where("fine").select("vec_id", "embedding")
    nodes = ws.save(usable.groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    lengths = nodes.groupBy(F.size("embedding").alias("n")).count()
    often = sorted(r["n"] for r in lengths.where(F.col("count") > FEW).collect())
    parts = [_of_one_length(nodes.where(F.size("embedding") == n), n, cosine, ws) for n in often]
    parts.append(_of_rare_lengths(nodes.where(~F.size("embedding").isin(often)) if often else nodes, cosine))
    found = ws.save(reduce(DataFrame.union, parts), "links")
    joined = components(found.select("u", "v"), ws)
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts.withColumnRenamed("u", "node"), "node", "left")
    named = ws.save(named.select("embedding", "weight", "least", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "named")
    rows, total = named.agg(F.count("*"), F.sum("weight")).first()
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes"))
    named = join_weighted(named, least, ["component"], "nodes", rows).select("embedding", "weight", "n_links", "component_id")
    good = join_weighted(usable, named, ["embedding"], "weight", total or 0).select("vec_id", "n_links", "component_id")
    alone = given.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
