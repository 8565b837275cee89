"""What a running query tells about itself: operational events of its batches, its start and stop, and figures of its progress."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.operators import ops

FIGURES = "name string, batch long, ts_ms long, input_rows long, rows_per_second double, state_rows long, state_bytes long, released long, committed long, given_up long"


def of_batch(released: DataFrame, dead: DataFrame, key: list[str], server: str, number: int) -> DataFrame:
    """Events of one batch as ``ops.records``: transactions given up for their age or as orphans, and dead letters.

    ``released`` are the rows of ``assembly.assemble``, ``dead`` those that could not be decoded. A batch that is run again tells the same but for the time.
    """
    now, none, c = F.lit(int(time.time() * 1000)), F.lit(None), F.col
    xid = F.concat_ws(".", *[c(k).cast("string") for k in key[1:]])
    own = {"xid": xid, "con_id": c(key[0]), "events": c("event_count")}
    given = [
        ops.records(released.where("outcome = 'discarded'"), "transaction-discarded", server, now, none, **own),
        ops.records(released.where("outcome = 'orphan'"), "transaction-orphan-released", server, now, none, **own),
        ops.records(dead, "decode-error-dlq", server, now, c("scn"), table=F.concat_ws(".", "owner", "tab"), xid=xid, scn=c("scn"), operation=c("op_code"), error=c("exception")),
    ]
    return reduce(DataFrame.unionByName, given).withColumn("batch", F.lit(number).cast("long"))


def observed(released: DataFrame) -> DataFrame:
    """The released rows of a stream, with counts that its progress carries to ``Listener``."""
    outcome = F.col("outcome")
    return released.observe("released", F.count("*").alias("released"), F.count_if(outcome == "committed").alias("committed"), F.count_if(outcome != "committed").alias("given_up"))


class Listener(StreamingQueryListener):
    """Appends ``startup`` and ``stop`` events and a row of figures a batch to folders below ``folder``.

    Rows are few, one or two a batch, and written from the driver.
    """

    def __init__(self, spark: SparkSession, folder: str, server: str, put: Callable[[DataFrame, str], None] | None = None):
        self.spark, self.folder, self.server = spark, folder.rstrip("/"), server
        self.put = put or (lambda rows, path: rows.coalesce(1).write.mode("append").json(path))

    def _event(self, kind: str, **details: str | None) -> None:
        one = self.spark.range(1)
        told = ops.records(one, kind, self.server, F.lit(int(time.time() * 1000)), F.lit(None), **{k: F.lit(v) for k, v in details.items()})
        self.put(told, f"{self.folder}/events")

    def onQueryStarted(self, event) -> None:
        self._event("startup", version=str(ops.VERSION))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = sum(int(s.numRowsTotal) for s in p.stateOperators)
        size = sum(int(s.memoryUsedBytes) for s in p.stateOperators)
        seen = p.observedMetrics.get("released")
        counts = tuple(int(seen[k]) for k in ("released", "committed", "given_up")) if seen is not None else (None, None, None)
        row = (p.name, int(p.batchId), int(time.time() * 1000), int(p.numInputRows), float(p.processedRowsPerSecond), rows, size, *counts)
        self.put(self.spark.createDataFrame([row], FIGURES), f"{self.folder}/figures")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        said = event.exception
        code = re.search(r"CDC-\d{4}", said or "")
        self._event("stop", exception=said and said.split(":", 1)[0][:200], message=said and said[:2000], code=code and code[0])
