"""Shared storage and graph helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent a local master gets a folder of its own; on a cluster that would be
    machine-local storage, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints"


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session's Python tasks end at ``BATCH_BYTES``, where the session names no bound.

    Spark ends them at 10,000 rows only: tens of MB of whole texts, held in the executor's and in the worker's memory at
    once, which both keep for later stages. Results don't depend on it.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Workspace:
    """A run's own folder under the shared root; tables written there cut lineage and survive executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/tidelog/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def save_freed(self, df: DataFrame, name: str, append: bool = False) -> DataFrame:
        """``save`` of a frame that is not run again: the files of its shuffles go once the table stands.

        Spark else keeps them until the driver happens to collect its garbage, beside all later ones.
        """
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key, None)
        self.spark.conf.set(key, "true")
        try:
            df.write.mode("append" if append else "error").parquet(self.path(name))
        finally:
            if before is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def forest(n: int, us: list[np.ndarray], vs: list[np.ndarray]) -> np.ndarray:
    """Label of each of n nodes: the smallest node that its links reach."""
    label = np.arange(n)
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        label = label[label]
        if (label == before).all():
            return label


HEAVY = 512


def join_weighted(many: DataFrame, one: DataFrame, keys: list[str], weight: str, rows: int) -> DataFrame:
    """``many`` joined with ``one``, which has a row a key and in ``weight`` how many of the ``rows`` of ``many`` hold it.

    Keys of more than a ``HEAVY``-th of all rows, ``HEAVY`` of them at most, are broadcast, so that no task gets
    all the rows of one; the rest are shuffled. Rows without a partner drop out; ``weight`` goes.
    """
    least = max(1, rows // HEAVY)
    heavy = one.where(F.col(weight) > least).drop(weight)
    hot = many.join(F.broadcast(heavy), keys)
    cold = many.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(one.where(F.col(weight) <= least).drop(weight), keys)
    return hot.unionByName(cold)


BLOCK_LINKS = 1 << 19


def components(edges: DataFrame, ws: Workspace, tag: str = "components") -> DataFrame:
    """Connected components of ``edges(u, v)`` as ``(node, component)``, the smallest node naming each.

    Tasks contract blocks of at most ``BLOCK_LINKS`` edges to stars of their smallest nodes. Where there is more than
    one block, the stars that meet in a node are linked by their centres, and the graph of these, which has fewer edges,
    is settled likewise; what many nodes need to know of a centre is broadcast. A level is a few plans, so the driver
    keeps few of them. Nodes without an edge to another node are absent.
    """
    edges = ws.save(edges.where("u <> v").select("u", "v"), f"{tag}_links")
    blocks = max(1, -(-edges.count() // BLOCK_LINKS))
    stars = edges.coalesce(blocks).mapInArrow(_contracted(BLOCK_LINKS), "node long, component long")
    if blocks == 1:
        found = ws.save(stars, tag)
        ws.drop(f"{tag}_links")
        return found
    met = stars.groupBy("node").agg(F.min("component").alias("m"), F.collect_set("component").alias("centres"))  # a centre a block at most
    met = ws.save(met, f"{tag}_stars")
    ws.drop(f"{tag}_links")
    links = met.select(F.explode("centres").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    named = components(links, ws, f"{tag}_").withColumnRenamed("node", "m")
    held = met.groupBy("m").agg(F.count("*").alias("n")).join(named, "m", "left").withColumn("component", F.coalesce("component", "m"))
    found = ws.save(join_weighted(met.select("node", "m"), held, ["m"], "n", met.count()).select("node", "component"), tag)
    ws.drop(f"{tag}_stars")
    return found


def _contracted(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The smallest node that each node reaches in its block of at most ``most`` edges."""

    def settle(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([*us, *vs]), return_inverse=True)
        label = forest(len(nodes), [at[: len(at) // 2]], [at[len(at) // 2 :]])
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []
        held = 0
        for batch in found:
            u, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            while len(u):
                room = most - held
                us.append(u[:room])
                vs.append(v[:room])
                held += len(us[-1])
                u, v = u[room:], v[room:]
                if held == most:
                    yield settle(us, vs)
                    us, vs, held = [], [], 0
        if held:
            yield settle(us, vs)

    return batches
