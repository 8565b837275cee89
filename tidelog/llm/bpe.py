"""BPE encoding and decoding with word ends; long unsplit text by tree concatenation.

A text is normalised and cut into words as the library does; each different word is merged once a worker.
A word of more than ``LEAF`` symbols is halved until its parts are short, the parts are encoded as a batch of the
library's, by its threads where the word has ``THREADED`` symbols or more, and neighbours are joined upward: a window of tokens around the join, one a
side at first and twice as many each time, is encoded afresh until its two ends agree with what stands
beside it. Two tokens agree when their joint text encodes to just the two; an encoding whose neighbours all
agree is the encoding of the whole, so the joined parts equal those of one pass.

Defined results: a null text is empty (0 tokens, empty decoded text); special strings inside texts are the
library's tokens; repeated rows and null ids each get their row; an empty table gives no rows; other columns
are ignored. A word's cost grows with its length times its logarithm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tokens import BYTE_LETTERS, Cutter, _Memory, byte_level, load, threads

LEAF = 64
THREADED = 1 << 14
#: The pattern that the vocabulary file names, over classes of letters L, digits D and others O; what it does not match is dropped.
WORD_SPLIT = r"L+|'(?:s|t|re|ve|m|ll|d)|D|O+"


class WordCoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = load(path)
        self.cutter = Cutter(self.tokenizer, WORD_SPLIT)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.end = self.tokenizer.model.end_of_word_suffix or ""
        self.names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.text_of = {i: (t[: -len(self.end)] if self.end and t.endswith(self.end) else t) for t, i in vocab.items()}
        self.closes = {i for t, i in vocab.items() if self.end and t.endswith(self.end)}
        import json

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in json.loads(self.tokenizer.to_str())["model"]["merges"]]
        self.inner = Tokenizer(BPE(vocab=vocab, merges=merges))  # the same merges for text that doesn't end a word
        fixed = {word: np.array([i], "<u4").tobytes() for word, i in self.cutter.special.items()}
        self.memory = _Memory(lambda word: np.array(self.word(word), "<u4").tobytes(), fixed)
        self.plain: set[str] = set()

    # -- one word -----------------------------------------------------------------------------------

    def _merge(self, symbols: str, last: bool) -> list[int]:
        return [t.id for t in (self.tokenizer if last else self.inner).model.tokenize(symbols)]

    def _agree(self, left: int, right: int) -> bool:
        return self._merge(self.text_of[left] + self.text_of[right], right in self.closes) == [left, right]

    def _join(self, a: list[int], b: list[int], last: bool) -> list[int]:
        """``a`` and ``b`` as the encoding of their joint text; last: b ends the word."""
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self._merge("".join(self.text_of[t] for t in (*a[i:], *b[:j])), last and j == len(b))
            if (i == 0 or self._agree(a[i - 1], window[0])) and (j == len(b) or self._agree(window[-1], b[j])):
                return a[:i] + window + b[j:]
            k *= 2

    def tree(self, symbols: str) -> list[int]:
        parts = [symbols]
        while len(parts[0]) > LEAF:
            parts = [half for p in parts for half in (p[: len(p) // 2], p[len(p) // 2 :])]
        with threads(len(symbols) >= THREADED):
            inner = self.inner.encode_batch([[p] for p in parts[:-1]], is_pretokenized=True, add_special_tokens=False)
        level = [e.ids for e in inner] + [self._merge(parts[-1], True)]
        while len(level) > 1:
            n = len(level) // 2
            level = [self._join(level[2 * k], level[2 * k + 1], k == n - 1) for k in range(n)]
        return level[0]

    def word(self, word: str) -> list[int]:
        symbols = byte_level(word)
        return self.tree(symbols) if len(symbols) > LEAF else self._merge(symbols, True)

    # -- whole texts --------------------------------------------------------------------------------

    def _plain(self, text: str) -> bool:
        """Whether Python's lower() normalises the text as the library does: of characters below U+0300, each seen to."""
        new = set(text) - self.plain
        for c in new:
            if c >= "̀" or self.tokenizer.normalizer.normalize_str(f"a{c}a") != f"a{' ' if c.isspace() else c.lower()}a":
                return False
            self.plain.add(c)
        return True

    def words(self, text: str) -> list[str]:
        if not self.cutter.at_special.search(text):
            return self.segment(text)
        return [w for k, x in enumerate(self.cutter.at_special.split(text)) for w in ([x] if k % 2 else self.segment(x))]

    def segment(self, text: str) -> list[str]:
        """The words between special strings, which the library finds before it normalises."""
        return self.cutter.segment(text.lower() if self._plain(text) else self.tokenizer.normalizer.normalize_str(text))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.memory.__getitem__, self.words(text))) if text else b"", "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode, special tokens kept: this vocabulary file has no decoder, so tokens stand apart."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(path)
        for batch in found:
            n, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    shape = T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(batches, shape)
