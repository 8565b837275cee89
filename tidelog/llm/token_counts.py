"""Token counts by whole-token lookup.

Before any text is read, every vocabulary string is encoded alone; those that stay one pre-token and one
token are proven whole. A pre-token that equals one of them counts 1 without a merge; only the rest is merged
(by the library's model, once for each different pre-token that a worker remembers).

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings inside texts count as the
library takes them by default; repeated rows and null ids each get their row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import BYTE_LETTERS, BYTE_SPLIT, Cutter, _Memory, byte_level, load


def whole_tokens(tokenizer, cutter: Cutter) -> dict[str, int]:
    """``{string: 1}`` of the vocabulary strings that encode alone as the one token they are."""
    back = {ord(v): k for k, v in BYTE_LETTERS.items()}
    proven = {}
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(back[ord(c)] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: no pre-token equals it
        if cutter.segment(text) == [text] and [t.id for t in tokenizer.model.tokenize(token)] == [number]:
            proven[text] = 1
    return proven


@lru_cache(maxsize=2)
def _counter(path: str) -> tuple[Cutter, _Memory]:
    tokenizer = load(path)
    cutter = Cutter(tokenizer, BYTE_SPLIT)
    fixed = whole_tokens(tokenizer, cutter) | dict.fromkeys(cutter.special, 1)
    return cutter, _Memory(lambda word: len(tokenizer.model.tokenize(byte_level(word))), fixed)


def count(path: str, text: str | None) -> int:
    if not text:
        return 0
    cutter, counts = _counter(path)
    return sum(map(counts.__getitem__, cutter.words(text)))


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row of ``docs(doc_id, text)``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            tokens = pa.array([count(path, x.as_py()) for x in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), tokens], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    shape = T.StructType([T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(batches, shape).withColumn("over_limit", F.col("n_tokens") > limit)
