"""Token ids in flat binary files, memory-mapped.

File format, one shard for each range of ids, all little-endian:
``<shard>.ids`` the token ids of its documents one after the other, unsigned 16-bit where the vocabulary has
at most 65,536 ids and 32-bit beyond; ``<shard>.off`` signed 64-bit offsets into it, one more than
documents; ``<shard>.doc`` the signed 64-bit document ids; ``<shard>.set`` a byte a document, 0 where it has
no id. Shards follow each other in ascending document
id, and a shard's base, the ids of all shards before it, is a prefix sum over the shards' sizes. A writer
fills files named after its attempt and renames them when whole, so an attempt that is lost, repeated or
raced leaves the same final files.

Folders are reached through Arrow's file systems (local or mounted paths, HDFS, S3, GCS), as Python tasks
have no access to the JVM's; mounted files are memory-mapped, others read by range.

Defined results: a null text is empty and stored as its end id alone; repeated rows are stored each, by text
among equal ids; documents without an id come first and read back without one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import byte_coder

PARTS = ("ids", "off", "doc", "set")
SHARD = "shard string, dtype string, part int, n_docs long, n_ids long"


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(path: str) -> str:
    """file:/x and file:///x alike."""
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path


def write(docs: DataFrame, folder: str, path: str, end: int = 0, shards: int | None = None) -> DataFrame:
    """Write ``docs(doc_id, text)`` below ``folder``; a lazy row for each shard, which the caller keeps as its manifest."""
    folder = _uri(folder)
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next((b for b in found if b.num_rows), None)
        if batch is None:
            return
        coder, part = byte_coder(path), TaskContext.get().partitionId()
        fs, root = _folder(folder)
        fs.create_dir(root, recursive=True)
        names = {x: f"{root}/shard-{part:06d}.{x}" for x in PARTS}
        own = f".{uuid.uuid4().hex}.tmp"
        offsets, at = [0], 0
        ids_out, doc_out, set_out = (fs.open_output_stream(names[x] + own) for x in ("ids", "doc", "set"))
        while batch is not None:
            doc_out.write(batch.column(0).fill_null(0).to_numpy().astype("<i8").tobytes())
            set_out.write(batch.column(0).is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            for ids in coder.rows(batch.column(1), end):
                ids_out.write(ids)
                at += len(ids) // coder.dtype.itemsize
                offsets.append(at)
            batch = next(found, None)
        ids_out.close(), doc_out.close(), set_out.close()
        with fs.open_output_stream(names["off"] + own) as out:
            out.write(np.array(offsets, "<i8").tobytes())
        for x in PARTS:
            fs.move(names[x] + own, names[x])
        yield pa.RecordBatch.from_pylist([{"shard": f"shard-{part:06d}", "dtype": coder.dtype.str, "part": part, "n_docs": len(offsets) - 1, "n_ids": at}], schema=pa.schema([("shard", pa.string()), ("dtype", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(batches, SHARD)


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest (a row a shard) with ``base``: the ids of all shards before each."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


class Shard:
    """A shard read in place: ``ids(k)`` are those of its document k."""

    def __init__(self, folder: str, name: str, dtype: str):
        self.fs, root = _folder(_uri(folder))
        self.name = f"{root}/{name}"
        self.docs, self.known, self.offsets = self._all("doc", "<i8"), self._all("set", "u1") > 0, self._all("off", "<i8")
        self.dtype = np.dtype(dtype)
        self.flat = None if not isinstance(self.fs, pafs.LocalFileSystem) or not self.offsets[-1] else np.memmap(f"{self.name}.ids", self.dtype, "r")
        self.file = None if self.flat is not None else self.fs.open_input_file(f"{self.name}.ids")

    def _all(self, part: str, dtype: str) -> np.ndarray:
        with self.fs.open_input_file(f"{self.name}.{part}") as f:
            return np.frombuffer(f.read(), dtype)

    def ids(self, k: int) -> np.ndarray:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        if self.flat is not None:
            return self.flat[a:b]
        size = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((b - a) * size, a * size), self.dtype)


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each stored document, from the files alone."""

    def batches(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in found:
            for row in rows.itertuples():
                shard = Shard(folder, row.shard, row.dtype)
                crc = [zlib.crc32(shard.ids(k).astype("<u4").tobytes()) for k in range(len(shard.docs))]
                yield pd.DataFrame({"doc_id": pd.Series(shard.docs, dtype="Int64").where(shard.known), "start": row.base + shard.offsets[:-1], "n_tokens": np.diff(shard.offsets), "ids_crc32": np.array(crc, np.int64)})

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_bases(manifest).repartition(n, "shard")
    return dealt.mapInPandas(batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
