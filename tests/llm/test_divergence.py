"""The divergence audit against sums over every kept term."""

import random
import re
from collections import Counter, defaultdict

import pytest

from chatloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, top=200):
    counts, texts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        texts[lang or ""].update(set(terms))
        groups.add((lang or "", source or ""))
    price = lambda n, total, v: 1 + 10**9 * (n + 1) // (total + v)
    out = []
    for lang, source in groups:
        kept = [t for t, n in texts[lang].items() if n >= least]
        v, own = len(kept), {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        total = {s: sum(c.values()) for s, c in own.items()}
        p = {s: {t: price(n, total[s], v) for t, n in c.items()} for s, c in own.items()}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        q = {t: price(n, sum(whole.values()), v) for t, n in whole.items()}
        f = lambda a, b: (a - b) ** 2 // b
        pairs = [(sum(f(p[source][t], p[s][t]) for t in kept), s) for s in own if s != source]
        terms = [(f(p[source][t], q[t]), t) for t in kept if own[source][t] > 0 and p[source][t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def rows_of(rng, n):
    words = ["a", "Ab", "aB", "é", "É", "中文", "x1y", "z-z", "ſ", "K", "long" * 9, *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]]
    out = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice([None, "", "s", "S", "é", *[f"s{i}" for i in range(12)]])
        text = None if rng.random() < 0.1 else " ".join(rng.choice(words[: rng.choice([5, 71])]) for _ in range(rng.randint(0, 30)))
        out.append((text, lang, source))
    return out + [("Solo only only", "fr", "one"), ("", "it", "a"), (None, "it", "b"), ("word " * 3, "pt", "a"), ("word", "pt", "a"), ("word Word", "pt", "b")]


@pytest.mark.parametrize("most,block,cells", [(400_000, 1 << 20, 1 << 20), (7, 20, 3)])
def test_audit_equals_plain_sums(spark, monkeypatch, most, block, cells):
    monkeypatch.setattr(divergence, "ROWS", cells)
    monkeypatch.setattr(divergence, "MOST", most)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = rows_of(random.Random(most), 400)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, value int, term string").repartition(6)
    for least, top in ((3, 200), (1, 4)):
        got = sorted(tuple(r) for r in divergence.audit(docs, least=least, top=top).collect())
        assert got == plain(rows, least, top)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "small", lambda df: df)
    rows = rows_of(random.Random(2), 100)
    got = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), top=9).collect()
    assert sorted(map(tuple, got)) == plain(rows, top=9)


def test_no_rows(spark, no_documents):
    assert divergence.audit(no_documents).collect() == []


def test_prices_are_exact_beyond_64_bits(spark):
    rows = [(n, total, v) for n in (0, 1, 10**12, 9 * 10**15) for total, v in ((10**13, 3), (9 * 10**15 + 7, 10**9), (1, 1))]
    df = spark.createDataFrame(rows, "n long, total long, v long")
    from pyspark.sql import functions as F

    near = df.filter("n <= total")
    for r in near.select("*", divergence.price(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.n + 1) // (r.total + r.v)


def test_runs_are_sorted_and_split_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 8)
    text = b"aa bbbbbbbbbbbbbbbbbbbbbbbbbbb c " * 5 + b"\xc3\xa9" * 20
    parts = list(divergence.blocks(text))
    assert b"".join(parts) == text
    assert [t for p in parts for t in divergence.FIND(p)] == divergence.FIND(text)
    block = divergence.Block()
    assert list(block.add("en", "s", "b a B c")) == [] and list(block.add("en", "r", "B b")) == [] and list(block.add("de", "s", "")) == []
    run, = block.spilled()
    assert run.to_pylist() == [
        {"lang": "en", "term": "a", "sources": ["s"], "texts": [1], "places": [1]}, {"lang": "en", "term": "b", "sources": ["r", "s"], "texts": [1, 1], "places": [2, 2]},
        {"lang": "en", "term": "c", "sources": ["s"], "texts": [1], "places": [1]},
    ]
    assert list(block.spilled()) == []
