"""Whitening, ranked lexical search and the scan for personal data against plain versions of themselves."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sentloom.llm import lexical_search
from sentloom.llm.lexical_search import Segment, search
from sentloom.llm.pii_scan import scan_pii
from sentloom.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<double>, x string, d int, copies string, w int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, "b", 2, 3) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening(spark, weights):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((9, 9)) * np.linspace(3, 0.5, 9)
    rows = [(i, (rng.standard_normal(9) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)] + [(3, rows[3][1]), (None, rows[4][1])]
    odd = [(2000, None), (2001, []), (2002, [math.nan] * 9), (2003, [None] + [1.0] * 8), (2004, [math.inf] * 9)]
    got = whiten(vectors(spark, rows + odd), weights=weights).collect()
    assert Counter(r["vec_id"] for r in got) == Counter({i: 4 * n for i, n in Counter(i for i, _ in rows).items()})
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    fit, copies = np.unique(x, axis=0, return_counts=True)
    fit = fit if weights == "one" else np.repeat(fit, copies, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, directions = np.linalg.eigh(np.cov((fit - s / n).T, ddof=0))
    values, directions = values[::-1][:4], directions[:, ::-1][:, :4]
    whitened = (x - s / n) @ directions / np.sqrt(values)
    where = {i: k for k, (i, _) in enumerate(rows)}
    signs = {}
    for r in got:
        k, c = where[r["vec_id"]], r["component"] - 1
        sign = signs.setdefault(c, 1 if r["whitened"] * whitened[k, c] > 0 else -1)
        assert r["whitened"] * sign == pytest.approx(whitened[k, c], abs=1e-9)
        assert r["n"] == n and r["deviation"] == int(((n * x[k] - s) ** 2).sum())
        assert r["explained"] == pytest.approx(values[c] / np.trace(np.cov(fit.T, ddof=0)), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9


def test_whitening_of_odd_tables(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.5, 2.0]), (4, [7.0]), (5, [1e300, 0.0, 1.0]), (6, [-1e300, 0.0, 1.0]), (7, [-0.0, 0.0, 1.0])]
    got = {(r["vec_id"], r["component"]): r for r in whiten(vectors(spark, rows)).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 1), *((i, c) for i in (5, 6, 7) for c in (1, 2, 3))}
    assert abs(got[1, 1]["whitened"]) == pytest.approx(1) and got[1, 1]["n"] == 2 and got[1, 1]["deviation"] == 128**2
    # No variance: no component, but a row. Beyond 64 bits: no deviation.
    assert got[1, 2]["whitened"] == got[1, 2]["explained"] == got[4, 1]["whitened"] == 0
    assert got[5, 1]["deviation"] is None
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [(1, None)])).collect() == []


DIGITS_AND_LETTERS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_search(docs, items, k=10):
    def terms(text):
        return re.findall(DIGITS_AND_LETTERS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, len(w), Counter(w)) for i, w in counted if w]
    total, length = len(counted), sum(n for _, n, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, n, c in counted:
            m = 10 + 90 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted & set(c))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("segment", "item_terms"), [(1_000_000, 500_000), (60, 500_000), (500, 12)])
def test_search_equals_plain(spark, odd_documents, monkeypatch, segment, item_terms):
    monkeypatch.setattr(lexical_search, "SEGMENT", segment)
    monkeypatch.setattr(lexical_search, "ITEM_TERMS", item_terms)
    monkeypatch.setattr(lexical_search, "FIRST_READ", 2)
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(60)] + ["Größe", "日本", "X9"]
    chance = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(1, 40), p=chance / chance.sum())) + "." for _ in range(300)]
    rows = [(10 + i, t) for i, t in enumerate(texts)] + [(10, texts[0]), (11, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_documents.select("doc_id", "text"))
    items = [(i, " ".join(rng.choice(words, 8))) for i in range(12)] + [(1, "plain TEXT"), (None, "w1 w2 soup"), (20, None), (21, "--"), (22, "nowhere"), (23, "of a few")]
    got = search(docs.withColumnsRenamed({}).selectExpr("*", "1 AS n", "2 AS item_id", "3 AS score"), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS doc_id"))
    want = plain_search([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_search_of_empty_tables(spark, no_documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(no_documents, items).collect() == []
    assert search(no_documents.selectExpr("1L AS doc_id", "'a' AS text"), items.limit(0)).collect() == []


def test_best_positions_stop_before_the_ends():
    """Of lists with steep impacts few positions are read, and the result is that of a full scan."""
    rng = np.random.default_rng(2)
    docs, terms = 20_000, 4
    impact = (1e6 / rng.permuted(np.tile(np.arange(1, docs + 1), (terms, 1)), axis=1)).astype(np.int64)
    impact[:, 77] = 10**6
    segment = Segment(np.repeat(np.arange(terms), docs), np.tile(np.arange(docs), terms), impact.ravel(), docs, terms)
    weights = np.array([5, 3, 2, 1])
    found, scores, read = segment.best(np.arange(terms), weights, 10, 1)
    order = np.lexsort((found, -scores))[:10]
    whole = (impact * weights[:, None]).sum(axis=0)
    want = np.lexsort((np.arange(docs), -whole))[:10]
    assert found[order].tolist() == want.tolist() and scores[order].tolist() == whole[want].tolist()
    assert read < docs * terms / 20


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = r"(?<![A-Za-z0-9])[A-Za-z]{0,8}+[0-9](?:[\x20(]?[0-9]|[._%+@:/#()-]{0,2}[A-Za-z0-9])*+"


def digits(text):
    return re.sub("[^0-9]", "", text)


def valid(kind, text):
    d = [int(c) for c in digits(text)]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(sum(divmod(2 * c, 10)) if i % 2 else c for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def lowered_tokens(text):
    return re.findall(r"[^\W_]+|[:=#]", text.lower())


def plain_pii(rows):
    """Spans per row, by the rules of the module written out."""
    spans, found, slots = [], [], defaultdict(dict)
    for text in rows:
        text = text or ""
        mine = [(k, m.start(), m.end(), m[0].lower()) for k in KINDS for m in re.finditer(KINDS[k], text) if valid(k, m[0])]
        spans.append([f"{k}:{a}:{b}" for k, a, b, _ in mine])
        more = [(None, m.start(), m.end(), m[0].lower()) for m in re.finditer(CANDIDATES, text)]
        mine += [c for c in more if not any(c[1] < b and a < c[2] for _, a, b, _ in mine)]
        for k, a, b, value in mine:
            tokens = lowered_tokens(text[:a])
            if len(tokens) > 1:
                found.append((len(spans) - 1, k, a, b, value, " ".join(tokens[-2:])))
                slots[" ".join(tokens[-2:])].setdefault(value, set()).add(k)
        tokens = lowered_tokens(re.sub(KINDS["email"], " 0 ", text))
        for x, y, word in zip(tokens, tokens[1:], tokens[2:], strict=False):
            if word.isalpha():
                slots[f"{x} {y}"].setdefault(word, set())
    positive = {v for s in slots.values() for v, kinds in s.items() if kinds - {None}}
    while True:
        accepted = {c for c, s in slots.items() if sum(v in positive for v in s) >= 3 and 100 * sum(v in positive for v in s) >= 80 * len(s)}
        new = {v for c in accepted for v, kinds in slots[c].items() if kinds and len(digits(v)) >= 5} - positive
        if not new:
            break
        positive |= new
    near = {}
    for c in accepted:
        seeds = Counter(min(kinds - {None}, key=list(KINDS).index) for kinds in slots[c].values() if kinds - {None})
        near[c] = max(KINDS, key=lambda k: (seeds[k], -list(KINDS).index(k)))
    for i, k, a, b, value, c in found:
        if k is None and c in near and len(digits(value)) >= 5:
            spans[i].append(f"near_{near[c]}:{a}:{b}")
    order = [*KINDS, *(f"near_{k}" for k in KINDS)]
    return [sorted(s, key=lambda x: (order.index(x.split(":")[0]), int(x.split(":")[1]))) for s in spans]


PII_TEXTS = [
    *(f"call phone: +1 (20{k}) 555-01{k}{k} now, mail to ann.{k}@site{k}.example.org soon" for k in range(4)),
    "call phone: 555-0199-77 and then",
    "our desk: 555-0199-77, 😀 desk: 555-0200-11 and desk: 555-0201-12 or desk: 90210-77-1",
    "our desk: word, the desk: 12",
    "card no: 4111 1111 1111 1111; card no: 4111111111111112; 5500-0000-0000-0004",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 0001.002.03.255",
    "a@b.cc_x@d.ee %+@x.y-z.1 @@ a@.b a@b +12 +1 () - 22222222 + +123",
    "version 2024 of 12 items in 2024, order 1234567",
    None, "", "1" * 40, "+" * 30 + "1 2",
]


def test_pii_equals_plain(spark, odd_documents):
    rows = [(100 + i, t) for i, t in enumerate(PII_TEXTS)] + [(100, PII_TEXTS[0]), (None, PII_TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_documents.select("doc_id", "text")).selectExpr("*", "1 AS key", "2 AS kind", "'x' AS context", "3 AS value")
    held = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = [(i, ",".join(s)) for (i, _), s in zip(held, plain_pii([t for _, t in held]), strict=True)]
    got = scan_pii(docs.repartition(3)).collect()
    assert sorted([(r["doc_id"], r["spans"]) for r in got], key=str) == sorted(want, key=str)
    # A discovered number lifts a second pattern, whose numbers follow in the next round.
    assert any("near_phone:12:23" in s for _, s in want)
    for r in got:
        base = [s for s in r["spans"].split(",") if s and not s.startswith("near_")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(f"{k}:") for s in base) for k in KINDS]


def test_pii_equals_plain_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = [tuple(r) for r in docs.collect()]
    want = {i: ",".join(s) for (i, _), s in zip(held, plain_pii([t for _, t in held]), strict=True)}
    assert {r["doc_id"]: r["spans"] for r in scan_pii(docs).collect()} == want


def test_pii_on_long_odd_texts(spark, no_documents):
    """Runs that could be scanned again from each of their characters, and deep repetitions."""
    long = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" + "b." * 150_000, "a@b" + ".c" * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "x1-" * 100_000, "é " * 150_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_pii(docs).collect()}
    assert len(got) == len(long) and got[4]["spans"] == f"email:0:{len(long[4])}" and got[2]["n_ip"] == 37_500
    assert scan_pii(no_documents).collect() == []
