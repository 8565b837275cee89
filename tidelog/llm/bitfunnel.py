"""Ranked lexical search over bit-sliced Bloom signatures.

The index is a table of blocks. A block holds documents of like numbers of different terms: their signatures as
slices (one bitmap over the documents for each signature bit), their ids, lengths and texts. A term sets
``HASHES`` bits of a document's signature, and again with each power of two that its count in the document reaches,
so slices overestimate presence and counts: the and of a term's slices at the highest level met bounds its count
from above, exactly where the count is one.

A search adds up the bounded contributions of an item's terms for all documents of a block at once, as a matrix
product. Each task keeps an item's best documents by exact score, and scores exactly every document whose bound is not
below the last of them; only documents proven to be below are left out. The best of all tasks are ranked at the end.
Items are a stated query set and go in groups of about ``ITEMS`` to the tasks, with the whole index read for each group.

Defined results: a null text has no terms, an item without terms no rows; null ids rank before others among equal
scores; repeated rows, ids and items each count as rows of their own; an empty table gives no rows; other columns
are ignored. Whole texts are read, however long; a block holds as few as one document.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace, small_batches

HASHES = 6
BITS = 16  # of a signature for each setting of a term, at least
LEVELS = 16  # powers of two of a term's count; beyond, a count is unbounded
BLOCK_DOCS, BLOCK_BITS, BLOCK_BYTES = 1024, 1 << 25, 1 << 22
PENDING_BYTES = 16 << 20  # of texts that a task holds for unfinished blocks
GROUP_BYTES = 4 << 20  # compressed, of a row group; a block may be larger
#: A block is one large row, so the file's row groups and pages must end by size from the first row on: both sides of the
#: exchange hold a row group, and Parquet by itself looks at the size only after 100 rows, which is a whole file of blocks.
BY_SIZE = {"parquet.block.size": str(GROUP_BYTES), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
ITEMS = 256
TERMS = 1024  # of a query whose bitmaps are held at a time
INDEX = "bits long, docs array<long>, lengths array<long>, slices binary, texts array<binary>"
#: Letters and digits of ASCII, A-Z as a-z, and all bytes of other characters make terms; other bytes part them.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def counted(text: bytes) -> Counter:
    return Counter(terms(text))


def _places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The ``HASHES`` signature bits of each term hash at a level, a row a term."""
    z = hashes * np.uint64(2 * level + 1)
    z = (z ^ (z >> np.uint64(31))) * _GOLDEN
    z ^= z >> np.uint64(29)
    first, step = z & np.uint64(0xFFFFFFFF), (z >> np.uint64(32)) | np.uint64(1)
    return (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)


# -- index ----------------------------------------------------------------------------------------------


class _Blocks:
    """Documents waiting for a full block, by signature length."""

    def __init__(self) -> None:
        self.held: dict[int, list[tuple]] = defaultdict(list)
        self.sizes: Counter = Counter()

    def add(self, doc: int | None, text: bytes) -> Iterator[pa.RecordBatch]:
        found = counted(text)
        if not found:
            return
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        counts = np.fromiter(found.values(), np.int64, len(found))
        settings = sum(int((counts >= 1 << level).sum()) for level in range(LEVELS))
        bits = 64
        while bits < BITS * settings:
            bits = bits * 3 // 2 if bits & (bits - 1) == 0 else bits * 4 // 3  # 64, 96, 128, 192, ...
        self.held[bits].append((doc, int(counts.sum()), text, hashes, np.minimum(counts, 1 << LEVELS - 1).astype(np.uint16)))
        self.sizes[bits] += len(text)
        if len(self.held[bits]) >= BLOCK_DOCS or bits * len(self.held[bits]) >= BLOCK_BITS or self.sizes[bits] >= BLOCK_BYTES:
            yield self.out(bits)
        elif sum(self.sizes.values()) > PENDING_BYTES:
            yield self.out(max(self.sizes, key=self.sizes.__getitem__))

    def out(self, bits: int) -> pa.RecordBatch:
        docs = self.held.pop(bits)
        del self.sizes[bits]
        table = np.zeros((bits, len(docs)), bool)
        for k, (_, _, _, hashes, counts) in enumerate(docs):
            for level in range(LEVELS):
                held = hashes[counts >= 1 << level]
                if not len(held):
                    break
                table[_places(held, level, bits).ravel(), k] = True
        columns = [pa.array([bits], pa.int64()), pa.array([[d[0] for d in docs]], pa.list_(pa.int64())), pa.array([[d[1] for d in docs]], pa.list_(pa.int64()))]
        columns += [pa.array([np.packbits(table, axis=1).tobytes()], pa.binary()), pa.array([[d[2] for d in docs]], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["bits", "docs", "lengths", "slices", "texts"])


def index(docs: DataFrame) -> DataFrame:
    """The blocks of ``docs(doc_id, text)``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        for batch in found:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                yield from blocks.add(doc.as_py(), (text.as_py() or "").encode())
        for bits in list(blocks.held):
            yield blocks.out(bits)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, INDEX)


def document_frequencies(docs: DataFrame, asked: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the asked terms; tasks count, and the driver gets a row an asked term."""
    held = docs.sparkSession.sparkContext.broadcast(frozenset(asked))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in found:
            for text in batch.column(0):
                total.update(held.value.intersection(terms((text.as_py() or "").encode())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(batches, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["term"]): r["n"] for r in rows}


# -- search ---------------------------------------------------------------------------------------------


class Queries:
    """A group of items: their terms, and weights by item and term (a term's repeats are in its weight)."""

    def __init__(self, items: list[tuple[int, Counter]], df: dict[bytes, int], n_docs: int, n_terms: int, top: int):
        self.n_docs, self.n_terms, self.top = n_docs, n_terms, top
        self.terms = sorted({t for _, found in items for t in found if df.get(t)})
        place = {t: k for k, t in enumerate(self.terms)}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in self.terms}
        self.asked = frozenset(self.terms)
        self.numbers = [k for k, _ in items]
        self.weights = [{t: weight[t] * c for t, c in found.items() if t in weight} for _, found in items]
        self.matrix = np.zeros((len(items), len(self.terms)))
        for k, own in enumerate(self.weights):
            for t, w in own.items():
                self.matrix[k, place[t]] = w
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)

    def spread(self, lengths: np.ndarray) -> np.ndarray:
        """12 times a document's m."""
        return 12 * (75 + 25 * lengths * self.n_docs // self.n_terms)

    def bounds(self, bits: int, slices: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """An upper bound of each item's score in each document of a block; sums stay below 2**53, where doubles are exact."""
        spread = self.spread(lengths)
        total = np.zeros((len(self.weights), len(lengths)))
        for at in range(0, len(self.terms), TERMS):
            rows = np.arange(at, min(at + TERMS, len(self.terms)))
            part = np.bitwise_and.reduce(slices[_places(self.hashes[rows], 0, bits)], axis=1)
            some = part.any(axis=1)
            rows, part = rows[some], part[some]
            if not len(rows):
                continue
            values = np.zeros((len(rows), len(lengths)))
            own = np.arange(len(rows))
            for level in range(LEVELS):
                most = (2 << level) - 1  # the count is below the next level
                worth = 10**9 * most // (1000 * most + spread) if level < LEVELS - 1 else np.full(len(lengths), 10**6)
                present = np.unpackbits(part, axis=1, count=len(lengths)).view(bool)
                values[own] = np.where(present, worth, values[own])
                if level < LEVELS - 1:
                    part = part & np.bitwise_and.reduce(slices[_places(self.hashes[rows[own]], level + 1, bits)], axis=1)
                    more = part.any(axis=1)
                    own, part = own[more], part[more]
                    if not len(own):
                        break
            total += self.matrix[:, rows] @ values
        return total

    def counted(self, text: bytes) -> Counter:
        """Counts of the asked terms alone, of which a task holds a block's."""
        return Counter(filter(self.asked.__contains__, terms(text)))

    def exact(self, item: int, found: Counter, spread: int) -> int:
        total = 0
        for t, w in self.weights[item].items():
            tf = found.get(t)
            if tf:
                total += w * (10**9 * tf // (1000 * tf + spread))
        return total


class _Best:
    """Of each item the best documents so far, by exact score and then by id."""

    def __init__(self, queries: Queries):
        self.queries = queries
        self.found: list[list[tuple]] = [[] for _ in queries.weights]
        self.least = np.ones(len(queries.weights))  # a document must reach it to stand among the best
        self.scored = 0

    def block(self, bits: int, docs: list, lengths: np.ndarray, slices: np.ndarray, text) -> None:
        bounds = self.queries.bounds(bits, slices, lengths)
        spread = self.queries.spread(lengths).tolist()
        counts: dict[int, Counter] = {}
        for item in np.flatnonzero((bounds >= self.least[:, None]).any(axis=1)).tolist():
            near = np.flatnonzero(bounds[item] >= self.least[item])
            for k in near[np.argsort(-bounds[item, near], kind="stable")].tolist():
                if bounds[item, k] < self.least[item]:
                    break
                if k not in counts:
                    counts[k] = self.queries.counted(text(k))
                self.scored += 1
                score = self.queries.exact(item, counts[k], spread[k])
                if score > 0:
                    self.put(item, score, docs[k])

    def put(self, item: int, score: int, doc: int | None) -> None:
        own = self.found[item]
        own.append((-score, doc is not None, doc or 0))
        if len(own) >= 2 * self.queries.top or len(own) == self.queries.top:
            own.sort()
            del own[self.queries.top :]
            self.least[item] = -own[-1][0]

    def rows(self) -> pa.RecordBatch:
        rows = [(self.queries.numbers[item], doc if some else None, -score) for item, own in enumerate(self.found) for score, some, doc in own]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["number", "doc_id", "score"])


def search(blocks: DataFrame, queries: Queries) -> DataFrame:
    """``(number, doc_id, score)``: of each task's blocks an item's best documents."""
    held = blocks.sparkSession.sparkContext.broadcast(queries)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(held.value)
        for batch in found:
            for row in range(batch.num_rows):
                bits, docs, lengths, slices, texts = (batch.column(k)[row] for k in range(5))
                lengths = np.array(lengths.as_py(), np.int64)
                table = np.frombuffer(slices.as_buffer(), np.uint8).reshape(bits.as_py(), -1)
                best.block(bits.as_py(), docs.as_py(), lengths, table, lambda k, t=texts: t[k].as_py())
        yield best.rows()

    return blocks.mapInArrow(batches, "number long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items(item_id, text)`` its ``top`` rows of ``docs(doc_id, text)`` with a score above 0."""
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession)
    small_batches(spark)
    blocks = ws.save(index(docs), "index", **BY_SIZE)
    n_docs, n_terms = blocks.agg(F.sum(F.size("docs")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y))).first()
    asked = ws.save(items.select("item_id", "text", F.monotonically_increasing_id().alias("number")), "items")
    parts = []
    groups = -(-asked.count() // ITEMS) if n_docs else 0
    for k in range(groups):
        group = asked.where(F.pmod(F.xxhash64("number"), F.lit(groups)) == k).select("number", "text")
        own = [(r["number"], counted((r["text"] or "").encode())) for r in group.collect()]
        df = document_frequencies(docs, {t for _, found in own for t in found})
        parts.append(ws.save(search(blocks, Queries(own, df, n_docs, n_terms, top)), f"best_{k}"))
    best = spark.createDataFrame([], "number long, doc_id long, score long")
    for p in parts:
        best = best.unionByName(p)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(asked.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
