"""The Jaccard join and the pipeline against brute force."""

import collections
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from chatloom.llm import jaccard, shingles
from chatloom.llm.components import components


def shingle_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(id, size, component) by comparing all pairs of distinct sets."""
    by_set = collections.defaultdict(list)
    for i, (_, text) in enumerate(rows):
        by_set[shingle_set(text)].append(i)
    parent = {}

    def root(s):
        while parent.setdefault(s, s) != s:
            s = parent[s]
        return s

    all_sets = [s for s in by_set if s]
    for k, a in enumerate(all_sets):
        for b in all_sets[:k]:
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                parent[root(a)] = root(b)
    members = collections.defaultdict(list)
    for s in all_sets:
        members[root(s)] += [rows[i][0] for i in by_set[s] if rows[i][0] is not None]
    return sorted(((k, len(s), k if not s else min(members[root(s)], default=None)) for k, s in ((r[0], shingle_set(r[1])) for r in rows)), key=repr)


def joined(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()), key=repr)


def family(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 6, 30, 120]))] for _ in range(8)]
    common = " ".join(f"c{i}" for i in range(12))
    texts = [family(rng, rng.choice(bases), rng.choice([0, 0, 1, 2, 3])) for _ in range(160)]
    texts += [common + " " + " ".join(f"z{rng.randrange(50)}" for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts += [t.upper() for t in texts[:10]] + ["", None, " \n", "one", "one two", "one  two"] + texts[:5]
    rng.shuffle(texts)
    return [(i if i % 37 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]


@pytest.mark.parametrize("seed, small, frequent, near", [(0, 64, 48, 0.6), (1, 4, 10**6, 0.6), (2, 4, 4, 0.3), (3, 2, 10**6, 0.6)])
def test_join(spark, monkeypatch, seed, small, frequent, near):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "NEAR", near)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 600)
    rows = corpus(seed)
    assert joined(spark, rows) == brute(rows)


def test_join_of_tables(spark, documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert joined(spark, rows) == brute(rows)
    assert jaccard.join(no_documents).collect() == []
    assert joined(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_sets_and_sketches():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 4, 5, 6, 50, 900]))) for _ in range(60)]
    got = list(shingles.sets(texts))
    assert [len(s) for s in got] == [len(shingle_set(t)) for t in texts]
    for a, x in zip(got, texts, strict=True):
        for b, y in zip(got, texts, strict=True):
            common = len(np.intersect1d(a, b))
            assert common == len(shingle_set(x) & shingle_set(y))
            if len(a) and len(b):
                bound = shingles.most_common(shingles.counts_of(shingles.sketch(a), len(a)), shingles.counts_of(shingles.sketch(b), len(b)))
                assert bound >= common
    one = list(shingles.sets(["x y z a b c d e", "q"]))
    assert all(np.array_equal(a, next(shingles.sets([t]))) for a, t in zip(one, ["x y z a b c d e", "q"], strict=True))  # not of what stands beside


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (2000, 2001), (2001, 2000)]
    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for i in near:
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        if min(reach) != i:
            want[i] = min(reach)
    assert dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "jaccard_join", "budget_mixture", "bin_packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]

    good = stages["quality_classifier"](spark, docs, sf_dir)
    assert good.columns == docs.columns
    left = set(ids(good))
    assert all(i in left for i, q in labels.items() if q == 1)

    clean = stages["line_dedup"](spark, good, sf_dir)
    assert clean.columns == docs.columns and set(ids(clean)) <= left
    assert all(r.n_chars == len(r.text) for r in clean.collect())

    single = stages["jaccard_join"](spark, clean, sf_dir)
    groups = {i: c for i, _, c in brute([(r.doc_id, r.text) for r in clean.collect()])}
    assert sorted(ids(single)) == sorted(set(groups.values()))

    mixed = stages["budget_mixture"](spark, single, sf_dir)
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(single))
    assert max(collections.Counter(ids(mixed)).values()) <= 3

    packed = stages["bin_packing"](spark, mixed, sf_dir).collect()
    filled = collections.Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and len(filled) == -(-sum(filled.values()) // 2048)
    assert {r.doc_id for r in packed} == set(ids(mixed))
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, packed))


def test_stages_of_odd_rows(spark, odd_documents, no_documents):
    sf_dir = "/root/testdata/sf0.001"
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert name == "bin_packing" or out.columns == docs.columns
            have = collections.Counter(r.doc_id for r in docs.collect())
            got = collections.Counter(r.doc_id for r in (out if name != "bin_packing" else out.filter("start = 0")).collect())
            most = 3 if name == "budget_mixture" else 1
            assert all(n <= most * have[k] for k, n in got.items())
            if name == "bin_packing":
                assert got == have  # every document begins in some sequence
            if name == "jaccard_join" and have:
                texts = collections.Counter(r.text for r in out.collect())
                assert texts["same words again " * 60] == 1 and got[5] + got[6] == 1 and got[4] == 1


def test_entries_of_first_regions_are_only_shuffled(spark, monkeypatch):
    kept, real = [], jaccard.cut
    monkeypatch.setattr(jaccard, "cut", lambda df: kept.append(df.columns) or real(df))
    rows = corpus(5)
    assert joined(spark, rows) == brute(rows)
    assert kept and not any("bucket" in columns for columns in kept)


def near_copies(rng, n, words=300):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    return [family(rng, base, rng.choice([1, 2])) for _ in range(n)]


def test_near_copies_are_not_paired_with_each_other(spark, monkeypatch):
    """60 near copies are 1770 pairs, which every shingle they share made before."""
    made, real = [], jaccard.join_first
    monkeypatch.setattr(jaccard, "join_first", lambda *args: made.append(real(*args)) or made[-1])
    rng = random.Random(6)
    texts = near_copies(rng, 60) + near_copies(rng, 60) + ["one text alone of its kind", "w1 w2"]
    rows = list(enumerate(texts))
    assert joined(spark, rows) == brute(rows)
    assert made[0].filter("region IS NULL").distinct().count() < 2 * len(rows)
    assert made[0].filter("region IS NOT NULL").count() == 0


def test_labels_join_nothing_that_links_do_not(spark):
    """Texts that share their smallest or largest shingle with near copies of something else, and large regions with few pairs to make."""
    rng = random.Random(7)
    copies = near_copies(rng, 90)
    ends = [next(shingles.sets([copies[0]]))[i] for i in (0, -1)]
    words = copies[0].split()
    parts = [w for i in range(len(words) - 4) if next(shingles.sets([" ".join(w := words[i : i + 5])]))[0] in ends]
    assert len(parts) == 2
    others = [" ".join([*rng.choice(parts), *(f"v{rng.randrange(10**6)}" for _ in range(rng.choice([0, 3, 200])))]) for _ in range(60)]
    rows = list(enumerate(copies + others + near_copies(rng, 3, 12) + [copies[1].upper(), others[0].upper()]))
    rng.shuffle(rows)
    assert joined(spark, rows) == brute(rows)


def test_waves_decide_all(spark, monkeypatch):
    """Where pairs and blocks move more than the texts, they are dealt over waves; before, one query moved them all."""
    parts, real = [], jaccard.waves

    def dealt(rows, key, load, classes):
        found = real(rows, key, 40 * load, classes)
        parts.append(len(found))
        assert sorted(map(repr, rows.collect())) == sorted(repr(r) for p in found for r in p.collect())
        assert not found[1:] or all(p.join(q, key).count() == 0 for p, q in zip(found, found[1:], strict=False))
        return found

    monkeypatch.setattr(jaccard, "waves", dealt)
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = corpus(6)[:150]
    assert joined(spark, rows) == brute(rows)
    assert max(parts) > 1


def test_pairs_without_a_label_in_common():
    rng = np.random.default_rng(8)
    for k, names in ((2, 1), (9, 2), (70, 3), (70, 40), (300, 2)):
        labels = rng.integers(0, names, (k, 2)) * (rng.random((k, 2)) < 0.1)
        want = {(i, j) for i in range(k) for j in range(i + 1, k) if (labels[i] != labels[j]).all()}
        assert set(zip(*map(list, jaccard.apart(labels, 10**6)), strict=True)) == want
        assert not want or jaccard.apart(labels, len(want) - 1) is None


def test_shuffle_files_go_and_the_setting_comes_back(spark):
    from chatloom.llm.frames import DROPPED, shuffles_dropped

    for before in ("false", "true"):
        spark.conf.set(DROPPED, before)
        with pytest.raises(ValueError), shuffles_dropped(spark):
            assert spark.conf.get(DROPPED) == "true"
            raise ValueError
        assert spark.conf.get(DROPPED) == before
    spark.conf.unset(DROPPED)


def test_kept_texts_go_to_python_in_small_batches(spark):
    from chatloom.llm import quality

    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.8)
    rows = [(i, t) for i, t in enumerate([None, "", "a", "good words here", "bad", "x" * 5000, "été à la"] * 3)]
    kept = quality.kept(spark.createDataFrame(rows, "doc_id long, text string"), model, threshold=0.5)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in rows if model.score(t) >= 0.5]
