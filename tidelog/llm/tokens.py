"""Exact pre-tokens and token ids of public tokenizer files, by pre-token lookup.

The library walks every character of every text through its pre-tokenizer and merges. Here a plain regular
expression cuts a text into the same pre-tokens, and each different pre-token is merged by the library's own
model once a worker. The expression's character classes are those of Python (plain ranges where a text is ASCII
or Latin, which are faster), so a character is used with it only after the library's pre-tokenizer was seen to
cut the same around it; a text that holds any other character is cut by the library itself.

``ByteCoder.rows`` does this for a column at a time: pre-tokens begin where the character classes change, so they are
found in the column's bytes, told apart by Arrow's dictionary encoding, and only different ones are looked up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the unit of parallelism

#: Pre-tokens remembered by a worker, half of them in the older of two generations; results don't depend on it.
REMEMBERED = 700_000
#: The pre-token pattern that byte_bpe files name by "use_regex", over classes of letters L, digits D and others O.
BYTE_SPLIT = r" ?L+|'(?:s|t|re|ve|m|ll|d)| ?D+| ?O+|\s+(?!\S)|\s+"
#: Of a column's texts that are cut at a time; a longer text stands alone.
COLUMN_BYTES, COLUMN_ROWS = 4 << 20, 4096
LETTER, DIGIT, OTHER, SPACE, REFUSED, UNKNOWN = range(6)
#: Letters of texts below U+02B0, where every letter is in these ranges.
LATIN, LATIN_END = "[A-Za-zªµºÀ-ÖØ-öø-ʯ]", "ʰ"


def _over(split: str, letters: str, digits: str, others: str, flags: int = 0) -> re.Pattern:
    return re.compile(split.replace("L", letters).replace("D", digits).replace("O", others), flags)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies use for each byte: itself where it prints, else the next from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in prints else next(spare)) for b in range(256)}


BYTE_LETTERS = _byte_letters()


@contextmanager
def threads(on: bool) -> Iterator[None]:
    """Let the library use its threads within, where one piece of text is worth them."""
    before = os.environ["TOKENIZERS_PARALLELISM"]
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if on else before
    try:
        yield
    finally:
        os.environ["TOKENIZERS_PARALLELISM"] = before


def byte_level(text: str) -> str:
    return text.encode().decode("latin-1").translate(BYTE_LETTERS)


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Memory(dict):
    """Values by pre-token, made when first asked for.

    A full generation becomes the old one, from which what is asked for again moves back, so common pre-tokens stay.
    """

    def __init__(self, make, fixed: dict):
        super().__init__(fixed)
        self.make, self.fixed, self.old = make, fixed, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= REMEMBERED // 2 + len(self.fixed):
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        self[word] = value
        return value


def _offsets(texts: pa.Array) -> np.ndarray:
    """Bounds of the rows of a column of large strings in its bytes."""
    held = texts.buffers()[1]
    return np.frombuffer(held, np.int64)[texts.offset : texts.offset + len(texts) + 1] if held and len(texts) else np.zeros(1, np.int64)


class Cutter:
    """Pre-tokens of whole texts, special strings as pieces of their own."""

    def __init__(self, tokenizer, split: str):
        self.tokenizer = tokenizer
        self.general = _over(split, r"[^\W\d_]", r"\d", r"(?:[^\s\w]|_)")
        self.latin = _over(split, LATIN, r"\d", r"(?:[^\s\w]|_)")
        self.ascii = _over(split, "[A-Za-z]", "[0-9]", r"[^\sA-Za-z0-9]", re.ASCII)
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.proven: set[str] = set()
        self.refused: set[str] = set()
        self.ascii_proven = all(self._same(chr(c), self.ascii) for c in range(128))
        self.kinds: np.ndarray | None = None  # class of each character, where it is known
        self.special_bytes = re.compile("|".join(map(re.escape, self.special)).encode()) if self.special else None

    def by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _same(self, c: str, pattern: re.Pattern) -> bool:
        probes = [f"a{c}a", f"1{c}1", f"!{c}!", f" {c} ", f"a {c}{c} a"]
        return all(pattern.findall(x) == self.by_library(x) for x in probes)

    def segment(self, text: str) -> list[str]:
        if self.ascii_proven and text.isascii():
            return self.ascii.findall(text)
        chars = set(text)
        new = chars - self.proven
        for c in new - self.refused:
            same = self._same(c, self.general) and (c >= LATIN_END or self._same(c, self.latin))
            (self.proven if same else self.refused).add(c)
        if new and not new <= self.proven:
            return self.by_library(text)
        return (self.latin if max(chars, default="") < LATIN_END else self.general).findall(text)

    def words(self, text: str) -> list[str]:
        if not self.at_special or not self.at_special.search(text):
            return self.segment(text)
        return list(chain.from_iterable([x] if k % 2 else self.segment(x) for k, x in enumerate(self.at_special.split(text))))


    # -- columns, by ``BYTE_SPLIT`` -------------------------------------------------------------------

    @cached_property
    def columns_proven(self) -> bool:
        """Whether ``starts`` cuts as the library does where all rules meet."""
        probe = " it's we'll I've  'd ''s x'sy's\n\n a \t\nb\n12ab!?'re \u00e9'm 'llama'l ' t\u00a0 \u00a0c "
        data = np.frombuffer(probe.encode(), np.uint8)
        starts, refused = self.starts(data, np.array([0, len(data)]))
        found = [bytes(x).decode() for x in np.split(data, starts[1:])]
        return self.ascii_proven and not refused and found == self.by_library(probe)

    def _kind(self, c: str) -> int:
        if not self._same(c, self.general):
            return REFUSED
        return SPACE if re.match(r"\s", c) else LETTER if re.match(r"[^\W\d_]", c) else DIGIT if re.match(r"\d", c) else OTHER

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The class of each byte's character."""
        if self.kinds is None:
            self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
            self.kinds[:128] = [self._kind(chr(c)) for c in range(128)]
        kinds = self.kinds[:256][data]
        for least, beyond, n in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
            at = np.flatnonzero((data >= least) & (data < beyond))
            if len(at):
                code = data[at].astype(np.int64) & (0x7F >> n)
                for k in range(1, n):
                    code = code << 6 | data[at + k] & 0x3F
                for c in np.unique(code[self.kinds[code] == UNKNOWN]).tolist():
                    self.kinds[c] = self._kind(chr(c))
                for k in range(n):
                    kinds[at + k] = self.kinds[code]
        return kinds

    def starts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Where pre-tokens begin in texts that stand one after the other, and the numbers of texts that must be cut on their own."""
        kinds = self._kinds(data)
        fresh = np.zeros(len(data) + 3, bool)  # a text begins, or all have ended
        fresh[bounds] = fresh[len(data) :] = True
        begins = fresh.copy()
        begins[1 : len(data)] |= kinds[1:] != kinds[:-1]
        # the last of a run of white space stands apart from it, and joins what follows if it is a space
        after = np.flatnonzero(begins[1 : len(data)] & ~fresh[1 : len(data)] & (kinds[:-1] == SPACE)) + 1
        last = after - 1
        for _ in range(3):
            last = last - ((data[last] & 0xC0) == 0x80)
        begins[last] = True
        begins[after[data[last] == 0x20]] = False
        quote = np.flatnonzero(begins[: len(data)] & (data == 0x27))
        if len(quote):
            padded = np.append(data, np.zeros(3, np.uint8))
            one, two = padded[quote + 1], padded[quote + 1].astype(np.int64) << 8 | padded[quote + 2]
            short = np.isin(one, list(b"stmd")) & ~fresh[quote + 1]
            long = np.isin(two, [a << 8 | b for a, b in (b"re", b"ve", b"ll")]) & ~fresh[quote + 1] & ~fresh[quote + 2]
            for held, n in ((short, 1), (long, 2)):
                begins[quote[held] + 1] = False
                begins[quote[held] + 1 + n] = True
        apart = {int(x) for x in np.unique(np.searchsorted(bounds, np.flatnonzero(kinds == REFUSED), "right") - 1)}
        for m in self.special_bytes.finditer(data.data) if self.special_bytes else ():
            apart.update(int(x) for x in np.searchsorted(bounds, [m.start(), m.end() - 1], "right") - 1)
        return np.flatnonzero(begins[: len(data)]), apart


class ByteCoder:
    """Token ids of a byte-level file, as little-endian integers of the narrowest width that holds them."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.cutter = Cutter(self.tokenizer, BYTE_SPLIT)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        fixed = {word: np.array([i], self.dtype).tobytes() for word, i in self.cutter.special.items()}
        self.memory = _Memory(lambda word: np.array([t.id for t in self.merge(word)], self.dtype).tobytes(), fixed)
        self.model = self.tokenizer.model

    def merge(self, word: str) -> list:
        return self.model.tokenize(byte_level(word))

    def ids(self, text: str | None, end: int | None = None) -> bytes:
        found = b"".join(map(self.memory.__getitem__, self.cutter.words(text))) if text else b""
        return found if end is None else found + np.array([end], self.dtype).tobytes()

    def wide(self, ids: bytes) -> bytes:
        """The same ids as unsigned 32-bit integers."""
        return np.frombuffer(ids, self.dtype).astype("<u4").tobytes()


    # -- columns ------------------------------------------------------------------------------------

    def rows(self, texts: pa.Array, end: int | None = None) -> Iterator[bytes]:
        """``ids`` of each text, of ``COLUMN_BYTES`` of texts at a time."""
        texts = texts.cast(pa.large_string()).fill_null("")
        lengths = np.diff(_offsets(texts))
        at = 0
        while at < len(texts):
            n = max(1, int(np.searchsorted(np.cumsum(lengths[at : at + COLUMN_ROWS]), COLUMN_BYTES, "right")))
            yield from self._rows(texts.slice(at, n), b"" if end is None else np.array([end], self.dtype).tobytes())
            at += n

    def _rows(self, texts: pa.Array, end: bytes) -> Iterator[bytes]:
        bounds = _offsets(texts)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        if not self.cutter.columns_proven or not len(data):
            yield from (self.ids(t.as_py()) + end for t in texts)
            return
        starts, refused = self.cutter.starts(data, bounds)
        whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data))
        words = whole.dictionary_encode()
        found = list(map(self.memory.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        flat = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        firsts = np.cumsum(sizes) - sizes
        own = words.indices.to_numpy()
        n = sizes[own]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(firsts[own] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cuts = (ends[np.searchsorted(starts, bounds)] * self.dtype.itemsize).tolist()
        for k in range(len(texts)):
            yield (self.ids(texts[k].as_py()) if k in refused else ids[cuts[k] : cuts[k + 1]]) + end


@lru_cache(maxsize=2)
def byte_coder(path: str) -> ByteCoder:
    return ByteCoder(path)
