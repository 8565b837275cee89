"""SimHash fingerprints and near-duplicate groups by a byte-position inverted index with count filtering.

A fingerprint is a row of positional bytes. A posting key joins the bytes of some positions, so that lists stay
short (a list of one byte would hold a 256th of all fingerprints). In each list the shared positional bytes of each
pair are tallied, pairs below the least number are let go, and the rest are verified by their differing bits.
Two settings stand here:

* ``BITS_4``, of the digest query: 4-word shingles, 64 bits, a link at 4 or fewer differing bits. Such pairs differ
  in at most 4 of 8 bytes, and the 20 triples of ``TRIPLES`` meet every set of four positions, so no link is lost.
* ``COPIES``, of corpora: 5-word shingles, 256 bits. Pairs that differ in at most 56 bits are candidates, and each is
  verified by the exact Jaccard of its shingles: a link has 0.8 or more. Keys join two of the 32 bytes; a pair at 0.8
  shares about eight bytes, so most but not all meet in one of the 64 lists (recall is in the README).

Lists longer than ``LIST_ROWS`` are cut into blocks that meet block by block in tasks of their own. A task compares
rows near each other first; what is then one group in a list is not compared again with itself, only the other rows
with all, so a group of near copies takes time in proportion to its rows. Tasks emit spanning forests, never the pairs.

Defined results: null, empty and blank texts have fingerprint zero, which links like any other (in ``COPIES`` with
its like only); repeated rows and repeated ids each get a row; a null id is kept and never names a component unless it
is alone; an empty table gives no rows; other columns are ignored. Long texts are hashed a piece of ``PIECE`` bytes at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Workspace, components, forest, join_weighted

LIST_ROWS = 16_384
TEXTS = 2_048  # of a component that meet in one task
CHUNK = 1 << 17  # hashes whose bits are counted at a time
PIECE = 1 << 20
SETTLE = 64  # neighbours of a row that are compared before groups are told apart
CELLS = 1 << 20  # pairs compared at a time
HELD_LINKS = 1 << 21
BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xDA942042E4DD58B5)  # multipliers of further lanes


def _triples() -> list[tuple[int, ...]]:
    """Position triples such that any 4 of the 8 positions hold one: positions in three rings of 3, 3 and 2;
    triples inside a ring, and two of one ring with one of the next."""
    rings = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [r for r in rings if len(r) == 3]
    for k, ring in enumerate(rings):
        found += [(*two, one) for two in combinations(ring, 2) for one in rings[(k + 1) % 3]]
    assert all(any(set(t) <= set(four) for t in found) for four in combinations(range(8), 4))
    return found


TRIPLES = _triples()


@dataclass(frozen=True)
class Setting:
    """What a fingerprint is made of, which pairs link, and the positions that posting keys join."""

    words: int
    lanes: int  # of 64 bits
    bits: int
    least_bytes: int  # shared positional bytes that a link has
    ratio: float  # Jaccard of the shingles that a link has, 0 where bits alone decide
    keys: tuple[tuple[int, ...], ...]

    @property
    def columns(self) -> list[str]:
        return ["fp", *(f"fp{q}" for q in range(1, self.lanes))]


BITS_4 = Setting(words=4, lanes=1, bits=4, least_bytes=4, ratio=0.0, keys=tuple(TRIPLES))
COPIES = Setting(words=5, lanes=4, bits=56, least_bytes=2, ratio=0.8, keys=tuple((k, (k + step) % 32) for step in (1, 7) for k in range(32)))


# -- fingerprints ---------------------------------------------------------------------------------------


def _hashes(words: list[bytes], n: int) -> list[int]:
    """XXH64 (seed 42) of each run of n words; of the whole sequence where there are fewer."""
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(line, 42)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-n]]
    return list(map(xxhash.xxh64_intdigest, map(line.__getitem__, map(slice, starts, [e - 1 for e in ends[n - 1 :]])), repeat(42)))


def _pieces(text: bytes, n: int) -> Iterator[list[int]]:
    """The hashes of a text's shingles, a piece of it at a time; the last words of a piece begin the next."""
    if len(text) <= PIECE:
        yield _hashes(text.lower().split(), n)  # of bytes: A-Z only, and \x20 \x09-\x0D only
        return
    at, words, none = 0, [], True
    while at < len(text):
        cut = BLANK.search(text, min(len(text), at + PIECE))
        stop = cut.start() if cut else len(text)
        words += text[at:stop].lower().split()
        at = stop
        if len(words) >= n:
            yield _hashes(words, n)
            words, none = words[len(words) - n + 1 :], False
    if none:
        yield _hashes(words, n)


def text_fingerprints(texts: Iterable[str | None], n: int, setting: Setting = BITS_4) -> tuple[np.ndarray, np.ndarray]:
    """For n texts the fingerprints (a column a lane) and the numbers of shingles: a bit is set where over half of the hashes have it."""
    counts = np.zeros((n, 64 * setting.lanes), np.int32)
    sizes = np.zeros(n, np.int64)
    held: list[int] = []
    rows: list[int] = []
    starts: list[int] = []

    def settle() -> None:
        if not rows:
            return
        hashes, at = np.array(held, np.uint64), np.array(starts)
        sizes[rows] += np.diff(np.append(at, len(hashes)))
        for q in range(setting.lanes):
            z = hashes
            if q:
                z = z * np.uint64(_ODD[q - 1])
                z ^= z >> np.uint64(31)
                z *= np.uint64(_ODD[0])
                z ^= z >> np.uint64(29)
            bits = np.unpackbits(z.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[rows, 64 * q : 64 * q + 64] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        held.clear(), rows.clear(), starts.clear()

    for k, text in enumerate(texts):
        for found in _pieces(text.encode() if text else b"", setting.words):
            if not found:
                continue
            if not rows or rows[-1] != k:
                rows.append(k)
                starts.append(len(held))
            held += found
            if len(held) >= CHUNK:
                settle()
    settle()
    return np.packbits(2 * counts.astype(np.int64) > sizes[:, None], axis=1, bitorder="little").view(np.uint64).reshape(n, setting.lanes), sizes


def fingerprints(docs: DataFrame, setting: Setting = BITS_4) -> DataFrame:
    """``(doc_id, h, size, fp, ...)`` for each row: the text's hash, its number of shingles, and each lane as a signed long with the same 64 bits."""
    names = ["doc_id", "h", "size", *setting.columns]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fps, sizes = text_fingerprints((x.as_py() for x in batch.column(2)), batch.num_rows, setting)
            lanes = [pa.array(np.ascontiguousarray(fps[:, q]).view(np.int64)) for q in range(setting.lanes)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sizes), *lanes], names=names)

    shape = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in names[1:])])
    return docs.select("doc_id", _text_hash().alias("h"), "text").mapInArrow(batches, shape)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def as_hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


# -- links ----------------------------------------------------------------------------------------------


def _keys(setting: Setting) -> Column:
    byte = lambda k: F.shiftrightunsigned(setting.columns[k // 8], 8 * (k % 8)).bitwiseAND(F.lit(255).cast("long"))

    def key(n: int, positions: tuple[int, ...]) -> Column:
        out = F.lit(n).cast("long")
        for p in positions:
            out = F.shiftleft(out, 8) + byte(p)
        return out

    return F.array(*[key(n, positions) for n, positions in enumerate(setting.keys)])


def _close(setting: Setting, x: list[np.ndarray]) -> np.ndarray:
    """Tally the shared positional bytes of pairs, given as the differences of their lanes; verify those that reach the least number by bits."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    differing = sum(np.bitwise_count((((lane & low) + low) | lane) & ~low) for lane in x)
    near = np.flatnonzero(differing <= 8 * setting.lanes - setting.least_bytes)
    return near[sum(np.bitwise_count(lane.ravel()[near]).astype(np.int64) for lane in x) <= setting.bits]


class _Lists:
    """Rows sorted by list, and the links among them; equal sides (0 or more) are compared in their own block."""

    def __init__(self, setting: Setting, settle: int, key: np.ndarray, lanes: list[np.ndarray], size: np.ndarray, side: np.ndarray):
        self.setting, self.settle, self.key, self.lanes, self.size, self.side = setting, settle, key, lanes, size, side
        self.label = np.arange(len(key))
        self.us: list[np.ndarray] = []
        self.vs: list[np.ndarray] = []
        self.held = 0

    def join(self) -> None:
        every = np.arange(len(self.key))
        self.label = forest(len(self.key), [*self.us, every], [*self.vs, self.label])
        self.us, self.vs, self.held = [], [], 0

    def put(self, u: np.ndarray, v: np.ndarray) -> None:
        """Close pairs that may link: those of other sides."""
        fine = (self.side[u] < 0) | (self.side[u] != self.side[v])
        self.us.append(u[fine])
        self.vs.append(v[fine])
        self.held += len(u)
        if self.held > HELD_LINKS:
            self.join()

    def neighbours(self) -> np.ndarray:
        """Compare each row with the next ``settle`` of its list; the rows whose lists are longer."""
        at = np.arange(len(self.key))
        for step in range(1, self.settle + 1):
            at = at[at + step < len(self.key)]
            at = at[self.key[at] == self.key[at + step]]
            near = at[_close(self.setting, [lane[at] ^ lane[at + step] for lane in self.lanes])]
            self.put(near, near + step)
            if not len(at):
                break
        return at

    def others(self, a: int, b: int) -> None:
        """Compare the rows of list a:b outside its greatest group with all of it."""
        groups, sizes = np.unique(self.label[a:b], return_counts=True)
        rest = a + np.flatnonzero(self.label[a:b] != groups[sizes.argmax()])
        step = max(1, CELLS // (b - a))
        for cut in range(0, len(rest), step):
            part = rest[cut : cut + step]
            cells = _close(self.setting, [lane[part, None] ^ lane[None, a:b] for lane in self.lanes])
            u, v = part[cells // (b - a)], a + cells % (b - a)
            new = self.label[u] != self.label[v]
            self.put(u[new], v[new])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of forest edges."""
        more = self.neighbours()
        self.join()
        if len(more):
            starts = np.append(np.flatnonzero(np.append(True, self.key[1:] != self.key[:-1])), len(self.key))
            for k in np.unique(np.searchsorted(starts, more, "right") - 1):
                self.others(int(starts[k]), int(starts[k + 1]))
            self.join()
        moved = np.flatnonzero(self.label != np.arange(len(self.key)))
        return moved, self.label[moved]


class _TextLists(_Lists):
    """Lists whose close pairs are verified by their shingles, unless they are joined already."""

    def __init__(self, setting: Setting, settle: int, key: np.ndarray, lanes: list[np.ndarray], size: np.ndarray, side: np.ndarray, shingles: np.ndarray):
        super().__init__(setting, settle, key, lanes, size, side)
        self.shingles = [np.frombuffer(x, np.uint64) for x in shingles]
        self.root = list(range(len(key)))

    def _find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = k = self.root[self.root[k]]
        return k

    def put(self, u: np.ndarray, v: np.ndarray) -> None:
        fine = (self.side[u] < 0) | (self.side[u] != self.side[v])
        for a, b in zip(u[fine].tolist(), v[fine].tolist(), strict=True):
            x, y = self._find(a), self._find(b)
            if x != y and jaccard(self.shingles[a], self.shingles[b]) >= self.setting.ratio:
                self.root[max(x, y)] = min(x, y)
                super().put(np.array([a]), np.array([b]))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two sets, given as ascending arrays; two empty ones are the same."""
    both = np.concatenate((a, b))
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same / (len(both) - same) if len(both) else 1.0


def _shingle_set(text: str | None, n: int) -> bytes:
    return np.unique(np.array([h for part in _pieces(text.encode() if text else b"", n) for h in part], np.uint64)).tobytes()


def verified(candidates: DataFrame, docs: DataFrame, ws: Workspace, setting: Setting) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of the close pairs with a Jaccard of ``setting.ratio`` or more.

    ``candidates(node, component, h, doc_id, size, fp...)`` have a text of each node that is close to another. Only those texts travel, in
    components; a component of more than ``TEXTS`` of them is cut into blocks that meet each other.
    """
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("c.h"))
    held = docs.select("doc_id", "text").alias("d").join(candidates.alias("c"), same).select("c.node", "c.component", "c.size", *[f"c.{x}" for x in setting.columns], "d.text")
    names = ["node", "key", "size", *setting.columns, "shingles"]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sets = pa.array([_shingle_set(x.as_py(), setting.words) for x in batch.column(batch.num_columns - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sets], names=names)

    texts = held.mapInArrow(batches, "node long, key long, size long, " + ", ".join(f"{x} long" for x in setting.columns) + ", shingles binary")
    texts = ws.save(texts.dropDuplicates(["node"]), "texts")  # a repeated row counts once
    counts = texts.groupBy("key").count()
    dealt = _dealt(texts, counts, TEXTS, ws, "large_components", ["node", "size"], [*setting.columns, "shingles"])
    return _starred(dealt.mapInArrow(_link_batches(_TextLists, setting, SETTLE), "u long, v long"))


def _link_batches(lists: type[_Lists], setting: Setting, settle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by list; a list that runs on into the next batch is carried over (it has 2 blocks at most)."""

    def out(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        listed, pair, node, size, side, *more = rows
        key = np.cumsum(np.append(0, (np.diff(listed) != 0) | (np.diff(pair) != 0)))
        u, v = lists(setting, settle, key, [f.view(np.uint64) for f in more[: setting.lanes]], size, side, *more[setting.lanes :]).links()
        return pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["u", "v"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in found:
            if not batch.num_rows:
                continue
            rows = tuple(np.ascontiguousarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns)
            cut = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            same = bool(kept) and (kept[-1][0][-1], kept[-1][1][-1]) == (rows[0][-1], rows[1][-1])
            if cut or not same:
                done = [*kept, tuple(x[:cut] for x in rows)]
                kept = []
                if sum(len(x[0]) for x in done):
                    yield out(tuple(map(np.concatenate, zip(*done, strict=True))))
            kept.append(tuple(x[cut:] for x in rows))
        if kept:
            yield out(tuple(map(np.concatenate, zip(*kept, strict=True))))

    return batches


def links(fps: DataFrame, ws: Workspace, setting: Setting = BITS_4) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all linked pairs of ``fps(fp, ...)``; nodes are named by ``node``, or else by ``fp``."""
    node = F.col("node" if "node" in fps.columns else "fp").alias("node")
    size = (F.col("size") if "size" in fps.columns else F.lit(0).cast("long")).alias("size")
    rows = fps.select(node, size, *setting.columns)
    postings = rows.select("*", F.explode(_keys(setting)).alias("key"))
    counts = rows.select(F.explode(_keys(setting)).alias("key")).groupBy("key").count()
    dealt = _dealt(postings, counts, LIST_ROWS, ws, "long_lists", ["node", "size"], setting.columns)
    return _starred(dealt.mapInArrow(_link_batches(_Lists, setting, SETTLE), "u long, v long"))


def _dealt(postings: DataFrame, counts: DataFrame, most: int, ws: Workspace, tag: str, first: list[str], last: list[str]) -> DataFrame:
    """Lists in tasks, by ``key`` and ``pair`` and sorted by node; a list of more than ``most`` rows is cut into blocks that meet each other."""
    blocks = counts.where(F.col("count") > most).select("key", F.ceil(F.col("count") / most).cast("int").alias("n"))
    blocks = ws.save(blocks, tag)
    cut = postings.join(blocks, "key", "left")
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("n")).cast("int")
    meet = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).alias("pair"), F.lit(-1).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda other: F.struct((F.least(other, own) * F.col("n") + F.greatest(other, own)).alias("pair"), F.when(other == own, -1).otherwise(own).alias("side")),
        )
    )
    dealt = cut.withColumn("meet", F.explode(meet)).select("key", F.col("meet.pair").alias("pair"), *first, F.col("meet.side").alias("side"), *last)
    return dealt.repartition("key", "pair").sortWithinPartitions("key", "pair", "node")  # the least node of a group is its root


def _starred(edges: DataFrame) -> DataFrame:
    """The same components in fewer edges: each node's least root, and its other roots joined with that one.

    A node has a root at most in each list that it is in, so the sets are bounded; the roots of a group are few and
    their edges the same from all of its nodes.
    """
    roots = edges.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("roots"))
    return roots.select(F.explode(F.array_union(F.array("u"), "roots")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, setting: Setting = BITS_4) -> DataFrame:
    """``(doc_id, h, fp, component, component_id)`` for each row of ``docs(doc_id, text)``; component names a group of fingerprints."""
    ws = Workspace(docs.sparkSession)
    lanes = setting.columns
    prints = ws.save(fingerprints(docs, setting), "fingerprints")
    own = ["size", *lanes] if setting.ratio else lanes
    text = [F.min(F.struct("h", "doc_id")).alias("rep")] if setting.ratio else []
    each = prints.groupBy(*own).agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"), *text)
    each = ws.save(each.withColumn("node", F.monotonically_increasing_id() if len(own) > 1 else F.col("fp")), "distinct")
    found = components(links(each, ws, setting), ws)
    if setting.ratio:
        found = components(verified(each.join(found, "node").select("node", "component", "rep.*", *own), docs, ws, setting), ws, "verified")
    named = each.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = ws.save(named.select(*own, "least", "rows", "component"), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("held"))
    named = join_weighted(named, least, ["component"], "held", named.count())
    return join_weighted(prints, named.select(*own, "rows", "component", "component_id"), own, "rows", prints.count()).select("doc_id", "h", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, setting: Setting = BITS_4) -> DataFrame:
    """One row of ``docs`` of each component, of those that name it the one with the least text hash; the columns stay.

    Of rows of one id and text that differ in other columns it is the one least as JSON.
    """
    naming = near_duplicates(docs, setting).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = naming.groupBy("component").agg(F.min(F.struct("h", "doc_id")).alias("row"), F.count("*").alias("rows"))
    keep = Workspace(docs.sparkSession).save(keep.select("row.*", "rows"), "kept")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("k.h"))
    once = docs.alias("d").join(keep.where("rows = 1").alias("k"), same, "left_semi")
    again = docs.alias("d").join(keep.where("rows > 1").alias("k"), same, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = again.groupBy("doc_id", F.coalesce("text", F.lit("")).alias("_text")).agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    return once.unionByName(again)
