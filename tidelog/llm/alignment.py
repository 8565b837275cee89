"""Alignment of two tokenizers' tokens over a corpus: links, their counts, and each document's share of the best.

``A`` is a byte-level file of the tokenizers library, ``B`` a sentencepiece file; both encode a space and the text.
Byte offsets where tokens of both end cut a text into groups, and two tokens whose byte ranges end together are linked.

Most groups are one token of each side over the same bytes. The identity map, made from the two vocabularies before
any text is read, names for each A id the B id of the same bytes, so such a group is told by its A id alone: tasks
count them in a vector as long as the vocabulary, and a document keeps only its own counts by A id. The
links of all other groups are pairs, which are counted by a shuffle; frequent pairs are broadcast.

A worker remembers A's pre-tokens; texts of ``TOGETHER`` bytes are aligned at once.

Defined results: texts that are null, empty, or whose joined A or B bytes differ from space and text have no tokens
(zeros and an empty digest); special strings are plain text; repeated rows and ids and null ids each get a row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Workspace, join_weighted
from .tokens import BYTE_LETTERS, byte_coder

SPACE = "▁"
TOGETHER = 1 << 20
IDS = T.ArrayType(T.IntegerType())
PAIRS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in "abn"]))


def byte_pieces(tokenizer) -> list[bytes | None]:
    """The bytes of each A id; None where an entry is not of byte letters."""
    back = {ord(v): k for k, v in BYTE_LETTERS.items()}
    found: list[bytes | None] = [None] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if all(ord(c) in back for c in token):
            found[number] = bytes(back[ord(c)] for c in token)
    return found


def sentence_pieces(model) -> list[bytes]:
    """The bytes of each B id: a byte entry is its byte, another its characters with spaces for their stand-ins."""
    size = model.get_piece_size()
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]


class Aligner:
    """Groups of two tokenizers over texts."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.coder = byte_coder(path_a)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_pieces(self.coder.tokenizer), sentence_pieces(self.model)
        self.length_a, self.length_b = (np.array([len(x or b"") for x in own]) for own in (self.bytes_a, self.bytes_b))
        special = lambda i: self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)
        self.ordinary = [i for i in range(len(self.bytes_b)) if not special(i)]
        self.same = self.identity()
        numbers = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.digits, self.digits_bar, self.digits_end = (np.array([f"{i}{mark}".encode() for i in numbers]) for mark in ",|;")

    def identity(self) -> np.ndarray:
        """For each A id the B id of the same bytes, -1 where there is none; of entries with the same bytes a character's own comes before a byte's."""
        by_bytes: dict[bytes, int] = {}
        for i in [*self.ordinary, *(i for i in range(len(self.bytes_b)) if self.model.is_byte(i))]:
            by_bytes.setdefault(self.bytes_b[i], i)
        return np.array([by_bytes.get(x, -1) if x else -1 for x in self.bytes_a], np.int32)

    def ids_a(self, text: str) -> bytes:
        return b"".join(map(self.coder.memory.__getitem__, self.coder.cutter.segment(" " + text)))

    def tokens(self, text: str | None, ids_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both sides; none where their bytes are not those of the text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        a, b = np.frombuffer(self.ids_a(text), self.coder.dtype).astype(np.int64), np.array(ids_b, np.int64)
        want = (" " + text).encode()
        same = b"".join([self.bytes_a[i] or b"" for i in a.tolist()]) == want and b"".join([self.bytes_b[i] for i in ids_b]) == want
        return (a, b) if same else (none, none)

    def batch(self, texts: list[str | None]) -> list[pa.Array]:
        """Columns ``n_a, n_b, n_groups, groups_sha256, plain, n_plain, pairs`` of some texts, all at once."""
        both = list(map(self.tokens, texts, self.model.encode([t or "" for t in texts], num_threads=1)))
        counts = np.array([(len(a), len(b)) for a, b in both], np.int64).reshape(-1, 2)
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*both, strict=True))
        of_a = np.repeat(np.arange(len(both)), counts[:, 0])
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        meet = np.zeros((2, int(ends_a[-1]) + 1 if len(a) else 1), bool)  # no entry has no bytes, so ends differ on a side
        meet[0, ends_a] = meet[1, ends_b] = True
        both_end = meet.all(axis=0)
        last_a, last_b = both_end[ends_a], both_end[ends_b]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(group_a, minlength=0), np.bincount(group_b, minlength=0)
        link_a, link_b, doc = a[last_a], b[last_b], of_a[last_a]
        plain = (size_a == 1) & (size_b == 1) & (self.same[link_a] == link_b)
        before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
        text = np.zeros(len(a) + len(b), self.digits.dtype)  # numbers and what follows them, padded
        text[np.arange(len(a)) + before_b[group_a]] = np.where(last_a, self.digits_bar[a], self.digits[a])
        text[np.arange(len(b)) + before_a[group_b]] = np.where(last_b, self.digits_end[b], self.digits[b])
        raw, width = text.tobytes(), text.dtype.itemsize
        stops = (np.cumsum(counts.sum(axis=1)) * width).tolist()
        digests = [hashlib.sha256(raw[x:y].translate(None, b"\0")[:-1]).hexdigest() if y > x else "" for x, y in zip([0, *stops[:-1]], stops, strict=True)]
        groups = np.bincount(doc, minlength=len(both))
        keys, times = np.unique(doc[plain] * len(self.same) + link_a[plain], return_counts=True)
        starts = pa.array(np.searchsorted(keys, np.arange(len(both) + 1) * len(self.same)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(starts, pa.array(x.astype(np.int32))) for x in (keys % len(self.same), times)]
        wide = len(self.same) * len(self.bytes_b)
        keys, times = np.unique((doc[~plain] * len(self.same) + link_a[~plain]) * len(self.bytes_b) + link_b[~plain], return_counts=True)
        starts = pa.array(np.searchsorted(keys, np.arange(len(both) + 1) * wide).astype(np.int32))
        fields = [keys // len(self.bytes_b) % len(self.same), keys % len(self.bytes_b), times]
        pairs = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in fields], ["a", "b", "n"]))
        return [pa.array(counts[:, 0]), pa.array(counts[:, 1]), pa.array(groups), pa.array(digests, pa.string()), *lists, pairs]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: ``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, plain, n_plain, pairs)``.

    ``plain`` holds A ids of identity groups and ``n_plain`` how often each stands; ``pairs`` the links of other groups.
    """
    fields = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "plain", "n_plain", "pairs"]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in found:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.append(np.flatnonzero(np.append(True, size[1:] // TOGETHER != size[:-1] // TOGETHER)), len(size))
            for x, y in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                part = batch.slice(x, y - x)
                yield pa.RecordBatch.from_arrays([part.column(0), *both.batch(part.column(1).to_pylist())], names=fields)

    shape = T.StructType().add("doc_id", docs.schema["doc_id"].dataType)
    for c in fields[1:4]:
        shape.add(c, "long")
    shape.add("groups_sha256", "string").add("plain", IDS).add("n_plain", IDS).add("pairs", PAIRS)
    return docs.select("doc_id", "text").mapInArrow(batches, shape).withColumn("n_links", F.col("n_groups"))


def _plain_counts(each: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(a, b, n)`` of identity groups: each task adds up one vector as long as A's vocabulary."""

    def vectors(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = aligner(path_a, path_b).same
        total = np.zeros(len(same), np.int64)
        for batch in found:
            ids, n = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(2))
            total += np.bincount(ids, n, len(same)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(same[at]), pa.array(total[at])], names=["a", "b", "n"])

    return each.select("plain", "n_plain").mapInArrow(vectors, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def link_counts(each: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(a, b, n, rows, best)`` for each linked id pair: its links, the rows of ``aligned`` that hold it as a pair, and whether it is the B id's most frequent."""
    pairs = each.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("n"), F.count("*").alias("rows"))
    every = _plain_counts(each, path_a, path_b).withColumn("rows", F.lit(0).cast("long")).unionByName(pairs)
    total = every.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    most = total.groupBy("b").agg(F.max("n").alias("most"))  # a row a B id: the vocabulary bounds it
    return total.join(F.broadcast(most), "b").select("a", "b", "n", "rows", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for each row of ``docs(doc_id, text)``."""
    ws = Workspace(docs.sparkSession)
    each = ws.save(aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = ws.save(link_counts(each, path_a, path_b), "counts")
    both = aligner(path_a, path_b)
    # A row an A id: the vocabulary bounds what the driver reads and the tasks get.
    identity = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(a, b) for a, b in enumerate(both.same.tolist()) if b >= 0], "a int, b int")), ["a", "b"]).select("a", "n", "best").toArrow()
    size = len(both.same)
    n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ids = identity.column("a").to_numpy()
    n[ids], best[ids] = identity.column("n").to_numpy(), identity.column("best").to_numpy().astype(np.int64)
    held = docs.sparkSession.sparkContext.broadcast((n, best))
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]

    def look_up(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = held.value
        for batch in found:
            plain, times = batch.column(7), batch.column(8)
            ids, k = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (plain, times))
            of = np.repeat(np.arange(batch.num_rows), plain.value_lengths().to_numpy(zero_copy_only=False))
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for out, weights in zip(sums, (best, n), strict=True):
                np.add.at(out, of, weights[ids] * k)
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *map(pa.array, sums)], names=names)

    shape = T.StructType([*(each.schema[c] for c in names[:7]), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    plain = each.select(*names[:7], "plain", "n_plain").mapInArrow(look_up, shape)
    uses = each.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    used = join_weighted(uses.withColumnRenamed("n", "k"), counts.where("rows > 0"), ["a", "b"], "rows", total)
    more = used.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("m_best"), F.sum(F.col("n") * F.col("k")).alias("m_sum"))
    joined = plain.join(more, "row", "left")
    add = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0).cast("long"))).alias(x)
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "m_best"), add("count_sum", "m_sum"), "groups_sha256")
