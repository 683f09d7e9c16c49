"""Operators whose work is spread in an unusual way, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.functions import grams as G
from chatloom.operators import contamination as C
from chatloom.operators import preferences as P
from chatloom.operators import trees
from chatloom.operators import vectors as V


def test_deep_trees_take_few_rounds(spark):
    rows = [(i, i - 1 if i else None, "prompter" if i % 2 == 0 else "assistant", f"t{i}", None, None, "en-x", False, 1.0) for i in range(1000)]
    rows += [(2000, None, "prompter", "q", None, None, "de", False, 0.0), (2001, 2000, "assistant", "dead", 1, None, None, True, 0.0), (2002, 2001, "prompter", "below", 1, None, None, False, 0.0)]
    rows += [(3000, 3002, "assistant", "x", 1, None, None, False, 0.0), (3001, 3000, "prompter", "y", 1, None, None, False, 0.0), (3002, 3001, "assistant", "z", 1, None, None, False, 0.0), (3003, 3002, "assistant", "w", 2, None, None, False, 0.0)]
    schema = "message_id long, parent_id long, role string, text string, rank int, labels array<string>, lang string, deleted boolean, quality double"
    nodes = spark.createDataFrame(rows, schema).repartition(4)
    best = {r.root: r for r in trees.best_paths(nodes).collect()}
    assert [m.content for m in best[0].messages] == [f"t{i}" for i in range(1000)] and best[0].language == "en"
    assert [m.content for m in best[2000].messages] == ["q", "dead", "below"] and set(best) == {0, 2000}
    paths = {(r.root, r.tip): len(r.messages) for r in trees.reply_paths(nodes).collect()}
    assert paths == {(0, 999): 1000}


@pytest.mark.parametrize("block,cells", [(1024, 1 << 22), (4, 20)])
def test_top_matches_equal_brute_force(spark, monkeypatch, block, cells):
    monkeypatch.setattr(V, "CELLS", cells)
    monkeypatch.setattr(V, "BROADCAST_BYTES", 1 << 20 if block > 4 else 0)
    rng = np.random.default_rng(block)
    corpus = [(f"k{i:03}", x.tolist()) for i, x in enumerate(rng.integers(-2, 3, (90, 3)).astype("float64"))] + [("zero", [0.0] * 3)]
    queries = [(i, x.tolist()) for i, x in enumerate(rng.integers(-2, 3, (17, 3)).astype("float64"))]
    unit = lambda x: np.asarray(x) / (np.linalg.norm(x) or 1)
    want = set()
    for q, x in queries:
        ranked = sorted((-round(float(unit(x) @ unit(y)), 6), key) for key, y in corpus)[:5]
        want |= {(q, key, -s) for s, key in ranked}
    found = V.top_matches(
        spark.createDataFrame(corpus, "id string, v array<double>").repartition(5), spark.createDataFrame(queries, "id long, v array<double>"), "id", "v", 5, block
    )
    assert {(r["query"], r["key"], round(r["score"], 6) + 0.0) for r in found.collect()} == {(q, k, s + 0.0) for q, k, s in want}
    none = spark.createDataFrame([], "id long, v array<double>")
    assert V.top_matches(spark.createDataFrame(corpus, "id string, v array<double>"), none, "id", "v").collect() == []


def test_advantages_equal_a_backward_loop(spark):
    rng = random.Random(4)
    rows = []
    for n in [0, 1, 2, 7, 32_000, *[rng.randint(0, 40) for _ in range(60)]]:
        steps = lambda p: [float(rng.random() < p) for _ in range(n)]
        rows.append(([rng.random() for _ in range(n)], [rng.random() for _ in range(n)], steps(0.1), steps(0.8)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v array<double>, r array<double>, d array<double>, m array<double>")
    got = {r.i: r.x for r in df.select("i", P.gae(0.99, 0.9)("v", "r", "d", "m").alias("x")).collect()}
    for i, (v, r, d, m) in enumerate(rows):
        adv, last = [0.0] * len(v), 0.0
        for t in reversed(range(len(v))):
            p = (1 - d[t]) * m[t] if t + 1 < len(v) else 0.0
            last = r[t] + 0.99 * (v[t + 1] if t + 1 < len(v) else 0.0) * p - v[t] + 0.99 * 0.9 * p * last
            adv[t] = last
        assert np.allclose(got[i].advantages, adv, atol=1e-9) and np.allclose(got[i].returns, np.add(adv, v), atol=1e-9)


def test_filter_holds_every_gram(spark):
    rows = spark.range(300).select(F.expr("transform(sequence(0, cast(id % 23 as int)), i -> concat('w', cast((id * 7 + i * i) % 91 as string)))").alias("t"))
    some = rows.select(F.explode(C.token_grams(F.col("t"), 3)).alias("gram")).distinct().filter(F.xxhash64("gram") % 3 == 0)
    known = G.GramFilter(some.select(G.gram_of(F.col("gram"), 3).alias("h")))
    passed = known.attach(rows).select("t", known.surviving(F.col("t"), [3]).alias("p")).collect()
    wanted = {r.gram for r in some.collect()}
    for r in passed:
        own = {" ".join(r.t[i : i + 3]) for i in range(len(r.t) - 2)}
        assert own & wanted <= set(r.p) <= own


def test_equal_hits_are_one_class(spark):
    train = spark.createDataFrame([(i, "a b c d e" if i < 50 else "x a b c y" if i < 60 else "none of it") for i in range(70)], "id long, text string")
    test = spark.createDataFrame([(1, "a b c d e"), (2, "c d e f")], "item long, q string")
    found = C.ngram_matches(train, test, "id", "text", "item", ["q"], 3)
    assert found.members.count() == 60 and found.scores.select("cls").distinct().count() == 2
    scores = {(r.id, r.item): round(r.score, 6) for r in C.all_pairs(found, "id", "item").collect()}
    assert scores == {**{(i, 1): 1.0 for i in range(50)}, **{(i, 2): 0.75 for i in range(50)}, **{(i, 1): 0.6 for i in range(50, 60)}}
    above = C.ngram_matches(train, test, "id", "text", "item", ["q"], 3, 0.7)
    assert {r.id for r in C.contaminated(above, "id").collect()} == set(range(50))


def test_chats_are_encoded_once_for_the_accounts(spark):
    from types import SimpleNamespace

    from chatloom.catalog.statistics import accounting

    docs = spark.createDataFrame([("a", "one two."), ("a", "word " * 2100), ("b", None), (None, "x")], "source string, text string")
    out = accounting(SimpleNamespace(documents=docs))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Filter" in line and "regexp_extract_all" in line for line in plan)
    got = {r.source: (r.initial, r.final) for r in out.collect()}
    assert got["a"] == (2, 1) and got["b"] == (1, 1) and got["overall"][0] == 4


def test_packs_do_not_depend_on_what_is_handed_back_at_once(spark, monkeypatch):
    from chatloom.operators import nextfit, packing

    rows = [([i + 1] * (i % 5), [i + 2] * (1 + i % 7), [1] * (1 + i % 7), [-0.5] * (1 + i % 7), f"{i * 7919 % 65536:04x}{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "query array<int>, response array<int>, mask array<int>, logprobs array<float>, h string")
    packs = lambda: sorted((tuple(map(str, r)) for r in packing.pack(df, 12, -1, F.col("h")).collect()))
    first = packs()
    assert any("None" in r[-1] for r in first) and not any("nan" in r[-1] for r in first)
    monkeypatch.setattr(packing, "WEIGHT", 1)
    monkeypatch.setattr(nextfit, "TABLES", 1)
    assert packs() == first


def test_matches_read_matrices_where_they_lie(spark):
    import numpy as np

    from chatloom.operators import vectors

    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(f"k{i}", x.tolist()) for i, x in enumerate(v)], "id string, v array<float>")
    found = vectors.top_matches(df.filter("id NOT LIKE '%0'"), df.filter("id LIKE '%0'"), "id", "v", k=3, block=2)
    assert "MapInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    unit = v.astype("float32").astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    score = unit @ unit.T
    keys = [i for i in range(60) if i % 10]
    expected = {(f"k{q}", f"k{c}") for q in range(0, 60, 10) for c in sorted(keys, key=lambda c: -score[q, c])[:3]}
    assert {(r["query"], r["key"]) for r in found.collect()} == expected
    assert 8 * vectors.CELLS <= 4 << 20
