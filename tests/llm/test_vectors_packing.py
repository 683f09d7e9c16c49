"""Packing, mixing and embeddings against brute force."""

import math
import random

import itertools

import numpy as np
import pytest

from chatloom.llm import budget, pq, queries, slack


def check_plan(lengths, capacity):
    counts = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    intervals, used = slack.plan(counts, capacity)
    filled = {}
    for x, n in counts.items():
        for rank in range(n):
            pieces = list(slack.places(intervals, x, rank))
            assert [p[0] for p in pieces] == list(np.cumsum([0, *[p[1] for p in pieces]]))[:-1] and sum(p[1] for p in pieces) == x
            for _, n_tokens, sequence, offset in pieces:
                filled.setdefault(sequence, []).append((offset, n_tokens))
    assert len(filled) == used == -(-sum(lengths) // capacity)  # no plan can use fewer
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_gapless_and_smallest(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 16, 64, 2048])
    lengths = [rng.randint(1, capacity - 1) for _ in range(rng.choice([1, 3, 30, 400]))]
    check_plan(lengths if seed % 3 else [max(1, capacity * 3 // 4)] * len(lengths), capacity)


def test_best_fill_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(1, 30)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        total, take = slack.best_fill(sorted(counts, reverse=True), counts, room)
        assert total == max(s for s in sums if s <= room) == sum(n * k for n, k in take.items())
        assert all(k <= counts[n] for n, k in take.items())


def pieces_hold(rows, texts, capacity=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = {}
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        want.setdefault(key, []).append(ids)
    got, filled = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        got.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, each in want.items():
        assert sum(map(len, each)) == sum(len(x) for _, x in got[key])
        if len(set(each)) == 1:  # documents that repeat an id and a text have the same pieces, as often
            n, at = len(each), 0
            for start, pieces in itertools.groupby(sorted(got[key]), key=lambda p: p[0]):
                pieces = [x for _, x in pieces]
                if len(pieces) == n and len(set(pieces)) == 1:
                    assert 4 * start == at and each[0][at : at + len(pieces[0])] == pieces[0]
                    at += len(pieces[0])
                else:  # cut at different places: each piece is what stands there
                    assert all(each[0][4 * start : 4 * start + len(x)] == x for x in pieces)
    total = 0
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        total += at
    assert len(filled) == -(-total // capacity)


def test_pack(documents):
    rows = slack.pack(documents, queries.tokenizer_path()).collect()
    pieces_hold(rows, [(r.doc_id, r.text) for r in documents.collect()])


def test_pack_odd(odd_documents, no_documents):
    rows = slack.pack(odd_documents, queries.tokenizer_path()).collect()
    pieces_hold(rows, [(r.doc_id, r.text) for r in odd_documents.collect()])
    assert slack.pack(no_documents, queries.tokenizer_path()).collect() == []


def test_remembered_words_give_the_same_ids():
    from tokenizers import Tokenizer

    from chatloom.llm.tokenize import Words

    tokenizer, words = Tokenizer.from_file(queries.tokenizer_path()), Words(queries.tokenizer_path())
    parts = ["a", "é", "é", " ", "́", "\x1c", "\x85", "\xa0", " ", "İ", "Σ", "'s", "'", "​", "1", "!!", "\n", "<|endoftext|>", "中", "the", "😀", "ﬁ", "　", "\x00"]
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(words.encode([text])[0], "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_knapsack_is_nearest():
    rng = random.Random(3)
    for _ in range(200):
        lengths = sorted({rng.randint(1, 15) for _ in range(4)})
        counts = [rng.randint(0, 3) for _ in lengths]
        goal = rng.randint(1, 40)
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        take = budget.knapsack(lengths, counts, goal, 2 * goal)
        assert all(t <= c for t, c in zip(take, counts, strict=True))
        total = sum(n * t for n, t in zip(lengths, take, strict=True))
        assert abs(total - goal) == min(abs(s - goal) for s in sums if s <= 2 * goal)


def test_targets_share_the_excess():
    sizes = {"a": 10, "b": 1000, None: 0, "c": 500}
    goal = budget.targets(sizes)
    assert goal["a"] == 30 and goal[None] == 0
    assert math.isclose(sum(goal.values()), 1510) and all(goal[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    assert math.isclose(goal["b"] / goal["c"], 2 / 1)


def mixed_right(rows, slack_words):
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        by.setdefault(r["source"], []).append(r)
    for each in by.values():
        size = sum(r["size"] for r in each)
        assert {r["source_size"] for r in each} == {size} and len({r["target"] for r in each}) == 1
        assert abs(sum(r["taken"] for r in each) - each[0]["target"]) <= slack_words


def test_mix(documents, no_documents):
    from pyspark.sql import functions as F

    sizes = budget.with_sizes(documents).select("doc_id", "source", "size")
    mixed = budget.mix(sizes).withColumn("taken", F.col("size") * F.col("copies"))
    first = sorted(mixed.collect(), key=repr)
    assert len(first) == documents.count()
    mixed_right(first, max(r["size"] for r in first))
    assert first == sorted(mixed.repartition(5).collect(), key=repr)  # reruns agree
    assert budget.mix(budget.with_sizes(no_documents)).collect() == []


def test_mix_hits_the_target_of_a_hot_length(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", 7 if i % 3 == 0 else 1 + i % 11) for i in range(3000)]
    from pyspark.sql import functions as F

    mixed = budget.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).withColumn("taken", F.col("size") * F.col("copies"))
    mixed_right(mixed.collect(), 7)


def test_mix_odd(odd_documents):
    from pyspark.sql import functions as F

    mixed = budget.mix(budget.with_sizes(odd_documents)).withColumn("taken", F.col("size") * F.col("copies")).collect()
    assert len(mixed) == odd_documents.count()
    mixed_right(mixed, 30_000)
    repeated = budget.repeated(budget.mix(budget.with_sizes(odd_documents)))
    assert repeated.count() == sum(r["copies"] for r in mixed)


def links_brute(rows, cosine=0.95):
    """Number of links and smallest id reachable, by comparing all pairs."""
    good = []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.append((i, np.asarray(np.float32(v), float)))
    near = {i: set() for i in range(len(rows))}
    for a, x in good:
        for b, y in good:
            if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                near[a].add(b)
                near[b].add(a)
    out = []
    for i in near:
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return out


def vectors(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(scale=rng.choice([0.05, 0.2, 0.5]), size=24)).astype("float32").tolist()) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] + [1.0] * 23), (2004, [None] + [1.0] * 23), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, rows[3][1])]
    return rows + [rows[5], (2007, [float("inf")] * 24)]


@pytest.mark.parametrize("seed, block", [(0, 1024), (1, 16)])
def test_near_duplicates(spark, seed, block, monkeypatch):
    monkeypatch.setattr(pq, "LIST_BLOCK", block)
    monkeypatch.setattr(pq, "QUERY_BLOCK", 2 * block)
    rows = vectors(seed)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pq.near_duplicates(table).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=repr) == sorted(links_brute(rows), key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_near_duplicates_without_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pq.near_duplicates(empty).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None)], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, pq.near_duplicates(nulls).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("step", [1, 7, 128])
def test_table_lookups_are_distances_to_the_coded_vectors(step):
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(400, 10))  # ten columns over eight subspaces: uneven parts
    index = pq.Index(sample, 5)
    x, y, centre = sample[:30], sample[300:], index.centres[2]
    codes, error = index.code(y, centre)
    coded = centre + np.concatenate([w[codes[:, i]] for i, w in enumerate(index.words)], 1)
    assert np.allclose(error, np.linalg.norm(y - coded, axis=1))
    assert np.allclose(index.distances(x, centre, codes, step), ((coded[:, None] - x[None]) ** 2).sum(2))
    assert index.distances(x[:0], centre, codes, step).shape == (len(y), 0)
