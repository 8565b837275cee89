"""Alignment held against a plain version over the libraries' own encodings of whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidelog.llm import alignment
from tidelog.llm.tokens import BYTE_LETTERS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {v: k for k, v in BYTE_LETTERS.items()}
    found, counts = [], Counter()
    for i, text in rows:
        links, groups = [], []
        if text:
            enc = library.encode(" " + text, add_special_tokens=False)
            of_a = [(n, bytes(back[c] for c in t)) for n, t in zip(enc.ids, enc.tokens, strict=True)]
            of_b = [(n, bytes([int(p[3:5], 16)]) if model.is_byte(n) else p.replace("▁", " ").encode()) for n in model.encode(text) for p in [model.id_to_piece(n)]]
            want = (" " + text).encode()
            if b"".join(x for _, x in of_a) == want == b"".join(x for _, x in of_b):
                ends = []
                for side in (of_a, of_b):
                    at, own = 0, defaultdict(list)
                    for n, x in side:
                        at += len(x)
                        own[at].append(n)
                    ends.append(own)
                held = [[], []]
                for at in range(1, len(want) + 1):
                    for side in (0, 1):
                        held[side] += ends[side].get(at, [])
                    if at in ends[0] and at in ends[1]:
                        links += [(a, b) for a in ends[0][at] for b in ends[1][at]]
                        groups.append("|".join(",".join(map(str, h)) for h in held))
                        held = [[], []]
                counts.update(links)
                n_a, n_b = len(of_a), len(of_b)
        found.append((i, *((n_a, n_b) if groups else (0, 0)), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(i, n_a, n_b, len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, n_a, n_b, g, x in found]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_against_plain(docs, rows):
    got = alignment.alignment(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = plain(rows)
    assert order(got.collect()) == order(want)
    assert sum(r[1] == 0 for r in want) >= 3


def test_given_documents(spark, sf_dir):
    from tidelog.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert order(QUERIES["op13_alignment"](spark, sf_dir).collect()) == order(plain(docs))


def test_odd_tables(spark, none, no_id):
    assert alignment.alignment(none, A, B).count() == 0
    assert order(alignment.alignment(no_id, A, B).collect()) == order(plain([(None, "a text without an id of some words"), (None, None), (3, None)]))
    odd = ["a  b ", "  lead", "x▁y z", "a\n b", "a \n b", "tab\t x", "\x00 nul", "<s> </s> <0x41>", "é ﬁ ①", "a　 b", "a \x1c b", " ", "  x \u0085y", "=" * 300 + " " * 40 + "end"]
    assert order(alignment.alignment(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), A, B).collect()) == order(plain(list(enumerate(odd))))


def test_identity_map_has_the_same_bytes():
    both = alignment.aligner(A, B)
    assert (both.same >= 0).sum() > 5000
    for a, b in enumerate(both.same.tolist()):
        assert b < 0 or both.bytes_a[a] == both.bytes_b[b]
