"""Secrets, personal data and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from tidelog.llm import pii, secrets, spotsigs

from .conftest import frame


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, kinds.index(k), k, b) for a, k, b in spans))


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), "assign", m.end()))
    out += [(m.start(), "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return out + [(m.start(), "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]


def plain_pii(text):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), "phone", m.end()))
    return out


def test_base_secrets(docs, none, no_id, rows):
    got = sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in secrets.report(docs).collect())
    kinds = ["assign", "access", "hex"]
    want = []
    for i, t in rows:
        spans = plain_secrets(t or "")
        want.append((i, *(sum(s[1] == k for s in spans) for k in kinds), sha(joined(spans, kinds))))
    assert got == sorted(want)
    assert secrets.report(none).count() == 0 and secrets.report(no_id).count() == 3


def test_weak_parts_only_where_they_co_occur(spark):
    texts = {
        1: "user: bob password: hunter22 at https://h.example.com/x",
        2: "user: bob and nothing else, https://h.example.com/x",
        3: "password: hunter22",
        4: "account=joe " + "z " * 300 + " password: hunter22",
        5: "client_id=abc AbcdefGhijk1mnopqrstuvwx",
        6: None,
    }
    got = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in secrets.report(frame(spark, texts.items())).collect()}
    assert got == {1: ["id", "key", "host"], 2: [], 3: [], 4: [], 5: ["id", "key"], 6: []}


def plain_links(text):
    """The weak spans whose complementary parts co-occur, all parts with all."""
    base = plain_secrets(text)
    found = [(m.start(), kind, m.end()) for kind, pattern in secrets.WEAK for m in re.finditer(pattern, text)]
    weak = [w for w in found if not any(a < w[2] and w[0] < b for a, _, b in base)]
    every = base + weak
    kinds = lambda *names: [x for x in every if x[1] in names]
    near = lambda x, y: 0 <= max(y[0] - x[2], x[0] - y[2]) <= secrets.SCOPE
    pairs = [(x, y) for x in kinds("key", "assign", "hex") for y in kinds("id", "access", "host") if near(x, y)]
    out = {z for pair in pairs for z in pair}
    out |= {h for h in kinds("host") for z in out if z[1] in ("id", "access") and near(z, h)}
    return {x for x in out if x[1] in ("id", "key", "host")}


def test_links_against_all_pairs(spark):
    rng = random.Random(6)
    parts = ["user: bob", "client_id=abc", "AKIAABCDEFGH", "password: hunter22", "token=abcdefghijklmnop", "AbcdefGhijk1mnopqrstuvwx", "https://h.example.com/x", "db.example.com:5432", "0123456789abcdef0123", "é🙂"]
    texts = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randint(1, 9)):
            text += rng.choice(parts) + " " + "z " * rng.choice((0, 1, 40, 95, 99, 100, 101, 250))
        texts.append(text)
    texts += ["token=" + "Jw9" * 300 + " user: bob", "user: bob " + "y" * 300, "redis://:pw@h.example.com password: hunter22", "password: hunter22 " * 400 + "user: bob"]
    order = ["assign", "access", "hex", "id", "key", "host"]
    for r in secrets.report(frame(spark, enumerate(texts))).collect():
        text = texts[r["doc_id"]]
        assert r["spans"] == joined([*plain_secrets(text), *plain_links(text)], order)


def test_redaction(spark, docs, rows):
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert secrets.redact(docs).columns == docs.columns and secrets.redact(docs).count() == len(rows)
    for i, t in rows:
        spans = plain_secrets(t or "")
        assert (got[i] == t) if not spans and "[SECRET]" not in (got[i] or "") else "[SECRET]" in got[i]
        assert not plain_secrets((got[i] or "").replace("[SECRET]", " "))
    one = frame(spark, [(1, "é🙂 user: bob password: hunter22 end")]).withColumn("n_chars", F.lit(99))
    row = secrets.redact(one).first()
    assert row["text"] == "é🙂 [SECRET] [SECRET] end" and row["n_chars"] == len(row["text"])


def test_base_personal_data(docs, none, no_id, rows):
    got = sorted((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.report(docs).collect())
    kinds = ["email", "ip", "card", "phone"]
    want = []
    for i, t in rows:
        # of the 5000 digits none is told: one run of over 19 digits is no card, and what stands before the signs no address
        spans = [] if (t or "").startswith("1" * 5000) else plain_pii(t or "")
        want.append((i, *(sum(s[1] == k for s in spans) for k in kinds), sha(joined(spans, kinds))))
    assert got == sorted(want)
    assert pii.report(none).count() == 0 and pii.report(no_id).count() == 3


def test_long_texts_of_personal_data_take_time_in_proportion():
    begun = time.monotonic()
    text = "ab.c@d.example.org words " * 40_000
    spans = pii.base_spans(text)
    found = pii.scope(text, spans)
    assert len(spans) == 40_000 and len(found) == 1 and len(found[0]["at"]) == 40_000 and time.monotonic() - begun < 5


def plain_terms(texts):
    """The spans of disclosing terms of each text, from counts over all texts."""
    word = re.compile(r"[^\W\d_]{3,}")
    value = lambda t, s: (s[1], t[s[0] : s[2]].lower() if s[1] in ("email", "ip") else re.sub("[^0-9]", "", t[s[0] : s[2]]))
    corpus, together, size = Counter(), Counter(), Counter()
    for t in texts:
        corpus.update(w.lower() for w in word.findall(t or ""))
    scopes = {}
    for t in dict.fromkeys(t or "" for t in texts):
        spans = plain_pii(t)
        places = [(m.start(), m.end()) for m in word.finditer(t) if not any(a < m.end() and m.start() < b for a, _, b in spans)]
        scopes[t] = ({value(t, s) for s in spans}, places)
        for e in scopes[t][0]:
            together.update((t[a:b].lower(), e) for a, b in places)
            size[e] += len(places)
    total = sum(corpus.values())
    share = {pair: n / corpus[pair[0]] for pair, n in together.items()}
    told = {pair for pair, s in share.items() if s >= 0.5 and math.log2(s / (size[pair[1]] / total)) >= 6}
    return {t: {(a, "term", b) for a, b in places for e in entities if (t[a:b].lower(), e) in told} for t, (entities, places) in scopes.items()}


def test_terms_against_a_plain_version(spark, sf_dir, rows):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += [t for _, t in rows if not (t or "").startswith("1" * 5000)]
    texts += [f"{who} of number {k} writes from x.y{k}@mail.example.org and 10.1.{k}.{n}" for n, who in enumerate(("zorblat", "İquuxly", "ZORBLAT")) for k in range(3)]
    texts += [" ".join(f"u{k}@dump.example.org" for k in range(300)) + " an İquuxly dumpfile of addresses"]
    want = plain_terms(texts)
    got = pii.report(frame(spark, enumerate(texts))).collect()
    kinds = ["email", "ip", "card", "phone", "term"]
    assert len(got) == len(texts) and sum(map(len, want.values())) > 20
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["spans"] == joined([*plain_pii(text), *want[text]], kinds)


def test_disclosing_terms(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    told = [(k, f"{words[k]} zorblat writes from z.b@mail.example.org about {words[k + 1]}") for k in range(4)]
    plain = [(100 + k, " ".join(words) + f" filler{'abcdefgh'[k % 8]} about writes from " * 6) for k in range(160)]
    copies = [(500 + k, "quuxly is at q@copies.example.org today") for k in range(6)]  # copies of one text prove nothing
    df = frame(spark, told + plain + copies)
    got = {r["doc_id"]: r["spans"] for r in pii.report(df).collect()}
    for k, text in told:
        at = text.index("zorblat")
        assert f"term:{at}:{at + 7}" in got[k].split(",") and got[k].count("term") == 1
    assert all("term" not in got[i] for i, _ in plain + copies)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[0] == "alpha  writes from [EMAIL] about beta" and clean[100] == plain[0][1]


def test_a_term_of_one_text(spark):
    told = [(1, "write to zorblat at z.b@mail.example.org about words")]
    plain = [(100 + k, f"write about words filler{'abcdefgh'[k % 8]} " * 6) for k in range(100)]
    df = frame(spark, told + plain)
    at = told[0][1].index("zorblat")
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.report(df).collect()}
    assert [s for s in got[1] if s.startswith("term")] == [f"term:{at}:{at + 7}"]
    assert pii.sanitise(df).where("doc_id = 1").first()["text"] == "write to  at [EMAIL] about words"


def test_terms_far_from_their_entity(spark):
    far = "about words " * 20
    told = [(1, f"zorblat {far} write to z.b@mail.example.org {far} zorblat"), (2, f"z.b@mail.example.org {far} Zorblat"), (2, f"z.b@mail.example.org {far} Zorblat")]
    plain = [(100 + k, f"write about words filler{'abcdefgh'[k % 8]} " * 60) for k in range(200)]
    got = pii.report(frame(spark, told + plain)).collect()
    assert len(got) == 203
    for i, text in told:
        want = [f"term:{a}:{a + 7}" for a in range(len(text)) if text[a : a + 7].lower() == "zorblat"]
        assert all([s for s in r["spans"].split(",") if s.startswith("term")] == want for r in got if r["doc_id"] == i)


def plain_signatures(spark, text):
    one = spark.createDataFrame([(text,)], "t string")
    return set(spotsigs.with_signatures(one, "t", "s").first()["s"])


def _next(rows):
    """For each row, the text of the next document by descending id; of equal ids by the texts' hashes."""
    signed = lambda t: (v := _h((t or "").encode())) - (1 << 64 if v >> 63 else 0)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    return [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts(spark, docs, none, no_id, rows):
    got = [tuple(r) for r in spotsigs.compare_edited(docs).collect()]
    want = []
    for i, text, follows in _next(rows):
        n = len(text) // 3
        edited = text[: len(text) - n] + follows[:n]
        own, changed, after = (_signatures(x) for x in (text, edited, follows))
        want.append((i, len(text), sha(edited), _hex(own), _hex(changed), _jaccard(own, changed), _jaccard(own, after)))
    assert [r[:5] for r in sorted(got)] == [r[:5] for r in sorted(want)]
    assert all(abs(x - y) < 1e-12 for a, b in zip(sorted(got), sorted(want), strict=True) for x, y in zip(a[5:], b[5:], strict=True))
    assert spotsigs.compare_edited(none).count() == 0 and spotsigs.compare_edited(no_id).count() == 3


def test_ranges_of_ids(spark, monkeypatch):
    texts = [(None, "no id")] + [(k * k % 10_007 if k % 3 else 77, f"text {k} of the {k % 50} words") for k in range(3000)]
    df = frame(spark, texts)
    for size in (1 << 28, 500):  # as many ranges as tasks ask for, and a range each 500 bytes
        monkeypatch.setattr(spotsigs, "BUCKET_BYTES", size)
        got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in spotsigs.compare_edited(df).collect()}
        assert got == {(i, len(t), sha(t[: len(t) - len(t) // 3] + f[: len(t) // 3])) for i, t, f in _next(texts)}


def test_halving(spark):
    bounds = [-5, 0, 3, 9, 10, 400]
    df = spark.createDataFrame([(x,) for x in (None, -9, -5, -4, 0, 1, 3, 9, 10, 11, 400, 401)], "x long")
    got = [(r["x"], r["n"]) for r in df.select("x", spotsigs._below(bounds, F.col("x")).alias("n")).collect()]
    assert got == [(x, 0 if x is None else sum(b < x for b in bounds)) for x, _ in got]


def _h(*xs):
    import xxhash

    value = 42
    for x in xs:
        value = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else x.to_bytes(8, "little"), value)
    return value


def _hex(signatures):
    return "".join(f"{x:08x}" for x in sorted(signatures))


def _by_hand(words):
    hashed = [_h(w.encode()) for w in words]
    anchors = [w in spotsigs.COMMON or v % spotsigs.SHARE == 0 for w, v in zip(words, hashed, strict=True)]
    after = lambda p, n: [v for v, a in zip(hashed[p:], anchors[p:], strict=True) if not a][:n]
    found = {_h(hashed[p], *after(p, spotsigs.CHAIN)) for p, a in enumerate(anchors) if a}
    if not all(anchors):
        found |= {_h(b"start", *after(0, n)) for n in range(1, spotsigs.CHAIN + 1)}
    return {x % (1 << 32) for x in found}


def _signatures(text):
    import regex

    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    if not words:
        return {_h(b"text", text.encode()) % (1 << 32)} if text else set()
    return _by_hand(words)


def test_signatures_by_hand(spark):
    few = "the quick brown fox of lazy dogs and cats sleep soundly".split()
    many = [w for k in range(40) for w in ("the", f"word{chr(97 + k % 26)}{chr(97 + k // 26)}", "of", "it", f"more{chr(97 + k % 26)}")]
    for words in (few, many, ["the", "of"], ["single"], ["single", "the"], ["two", "words"]):
        assert plain_signatures(spark, " ".join(words).upper() + "!") == _by_hand(words)
    assert plain_signatures(spark, " ?! ") == {_h(b"text", b" ?! ") % (1 << 32)} and plain_signatures(spark, "") == set()


def test_a_very_long_text_of_anchors(spark):
    df = frame(spark, [(2, "the " * 250_000), (1, "the of " * 200_000)])
    begun = time.monotonic()
    got = {r["doc_id"]: r for r in spotsigs.compare_edited(df).collect()}
    assert time.monotonic() - begun < 30
    assert got[2]["fingerprint"] == _hex({_h(_h(b"the")) % (1 << 32)}) and got[2]["near_next"] == 0.5 and got[2]["near_edited"] > 0


def test_short_texts_keep_likeness(spark):
    name = lambda k: f"w{chr(97 + k % 26)}{chr(97 + k // 26)}q"
    texts = [(k, " ".join(name(30 * k + j) for j in range(9 + k))) for k in range(20)]
    got = spotsigs.compare_edited(frame(spark, texts)).collect()
    assert all(r["near_edited"] > 0.2 and r["near_next"] < 0.1 for r in got)


def test_a_floor_prunes_only_below_it(spark):
    sets = [(list(range(a)), list(range(a - c, a - c + b))) for a in (0, 1, 5, 40, 300) for b in (0, 1, 5, 40, 300) for c in (0, 1, 3)]
    df = spark.createDataFrame(sets, "a array<long>, b array<long>")
    for r in df.select("a", "b", spotsigs.likeness("a", "b").alias("x"), spotsigs.likeness("a", "b", 0.3).alias("y")).collect():
        want = _jaccard(set(r["a"]), set(r["b"]))
        assert abs(r["x"] - want) < 1e-12 and (abs(r["y"] - want) < 1e-12 or (r["y"] == 0 and want < 0.3))
