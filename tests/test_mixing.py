import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.operators import mixing as X
from chatloom.operators import sampling as S


def md5(k, seed=42):
    return hashlib.md5(f"{seed}:{k}".encode()).hexdigest()


def test_quotas_of_a_small_mixture():
    mix = X.LanguageMix(0.9, {"de": 0.025, "fr": 0.02}, 0.055)
    q = mix.quotas(1000)
    assert (q["de"], q["fr"], q["en"]) == (25, 20, 900)
    assert sum(q.values()) <= 1000


@pytest.mark.parametrize(
    "args", [dict(english_ratio=-0.1, others_ratio=1.1), dict(english_ratio=0.9, explicit={"en": 0.1}), dict(english_ratio=0.9, explicit={"xx": 0.1}), dict(english_ratio=0.5)]
)
def test_bad_ratios(args):
    with pytest.raises(ValueError):
        X.LanguageMix(**args)


@given(st.integers(0, 10**6), st.floats(0, 1), st.floats(0, 1))
def test_quota_properties(total, a, b):
    en, de = a, (1 - a) * b
    mix = X.LanguageMix(en, {"de": de}, 1 - en - de if 1 - en - de > 0 else 0.0)
    q = mix.quotas(total)
    assert all(v >= 0 for v in q.values()) and sum(q.values()) <= total + 1
    assert q["en"] == int(total * en)


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_take_is_exact_under_skew(spark, parts):
    # one group holds most rows
    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 3)).alias("g")).repartition(parts)
    quotas = spark.createDataFrame([("hot", 700), ("g0", 5), ("g1", 0), ("g2", 10**6)], "g string, quota long")
    got = S.take(rows, ["g"], quotas, "id").collect()
    want = {"hot": 700, "g0": 5, "g1": 0, "g2": 10**6}
    for g, n in want.items():
        ids = [i for i in range(3000) if ("hot" if i % 10 < 8 else f"g{i % 3}") == g]
        assert sorted(r["id"] for r in got if r["g"] == g) == sorted(sorted(ids, key=md5)[:n])


def test_priority_fill_takes_sources_in_order(spark):
    rows = spark.createDataFrame([(i, "de", "source1") for i in range(10)] + [(100 + i, "de", "source2") for i in range(100)], "id long, lang string, source string")
    q = X.quota_table(spark, {"de": 15})
    got = X.priority_fill(rows, q, "id", "lang", "source", ["source1", "source2"]).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {"source1": 10, "source2": 5}
    short = X.shortfall(rows.limit(0), q, "lang").first()
    assert (short["actual"], short["pct"]) == (0, 0.0)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 40))
def test_resize(spark, target):
    got = X.resize(spark.range(12), target, "id").groupBy("id").count().collect()
    assert sum(r["count"] for r in got) == target
    assert {r["count"] for r in got} <= {target // 12, target // 12 + 1}


def test_target_rows():
    assert X.target_rows("0.29", 100) == 28 and X.target_rows("1.0", 7) == 7 and X.target_rows("50", 7) == 50


def test_stratified_pick_matches_greedy_model(spark):
    rows = [(i, "de" if i % 5 else "fr", [c for c, d in (("a", 2), ("b", 3), ("c", 7)) if i % d == 0]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, lang string, cats array<string>")
    got = {(r["id"], r["lang"]) for r in X.stratified_pick(df, "id", "lang", "cats", ["a", "b", "c"], 8, 30).collect()}
    want = set()
    for lang in ("de", "fr"):
        pool = sorted([r for r in rows if r[1] == lang], key=lambda r: md5(r[0]))
        n, picked = dict.fromkeys("abc", 0), []
        for label in "abc":
            for r in pool:
                if n[label] >= 8:
                    break
                if label in r[2] and r not in picked:
                    picked.append(r)
                    for c in r[2]:
                        n[c] += 1
        for r in pool:
            if len(picked) >= 30:
                break
            if r not in picked:
                picked.append(r)
        want |= {(r[0], lang) for r in picked}
    assert got == want
