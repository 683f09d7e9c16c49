import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from chatloom.operators import evaluation as E
from chatloom.operators import statistics as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def battles(spark, counts):
    rows, i = [], 0
    for a, b, wins, losses in counts:
        for k in range(wins + losses):
            rows.append((i, a, b, "model_a" if k < wins else "model_b"))
            i += 1
    return spark.createDataFrame(rows, "battle long, model_a string, model_b string, winner string")


def test_ratings_recover_the_odds(spark):
    # a beats b three times out of four: 400 * log10(3) = 190.8 points apart
    df = battles(spark, [("a", "b", 1500, 500), ("b", "c", 1000, 1000)])
    got = {r["model"]: r for r in E.bradley_terry(df, "a", at_least=10, replicates=6).collect()}
    assert got["a"]["rating"] - got["b"]["rating"] == pytest.approx(190.8, abs=15)
    assert got["b"]["rating"] - got["c"]["rating"] == pytest.approx(0, abs=15)
    assert 0 < got["a"]["half_width"] < 30


def test_ratings_need_enough_battles(spark):
    got = E.bradley_terry(battles(spark, [("a", "b", 30, 20)]), "a", at_least=1).collect()
    assert all(r["rating"] is None for r in got)


def test_rare_models_are_left_out_but_the_target_stays(spark):
    df = battles(spark, [("a", "b", 100, 100), ("t", "a", 5, 5), ("x", "a", 3, 2)])
    names = {r["model"] for r in E.bradley_terry(df, "t", at_least=100).collect()}
    assert names == {"a", "b", "t"}


def test_rolling_band_does_not_depend_on_blocks(spark):
    series = spark.range(500).select(F.lit(0).alias("run"), F.col("id").alias("step"), ((F.col("id") * 37) % 101).cast("double").alias("v"))
    runs = [
        {tuple(r) for r in E.rolling_band(series, "run", "step", "v", block=b).collect()} for b in (7, 60, 5000)
    ]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 500


def test_short_runs_use_a_third_of_their_length(spark):
    series = spark.range(9).select(F.lit(0).alias("run"), F.col("id").alias("step"), F.col("id").cast("double").alias("v"))
    got = {r["step"]: r["median"] for r in E.rolling_band(series, "run", "step", "v").collect()}
    assert got[0] == 0.5 and got[4] == 4.0  # a window of three: one row to each side


@pytest.mark.parametrize("points", [[0.5], [0.0, 0.25, 1.0]])
def test_exact_quantiles_with_a_dominant_value(spark, points):
    import numpy as np

    values = [5.0] * 600 + [float(i) for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["p"]: r["value"] for r in S.exact_quantiles(df, "v", points).collect()}
    assert got == {p: pytest.approx(float(np.quantile(values, p))) for p in points}


def test_kernels_run_where_the_package_cannot_be_imported(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e\nfrom chatloom.session import local_session\n"
        "spark = local_session('2', 'elsewhere')\nq = e.queries()\n"
        "for n in ('jn_vector', 'tr_protect', 'tk_packs', 'tk_chunk_boundaries', 'mx_stratified_pick', 'pf_gae', 'st_rollout_groups', 'ev_ratings'):\n"
        "    assert q[n](spark, '/root/testdata/sf0.001').count() > 0, n\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def sales(spark):
    from types import SimpleNamespace

    part = spark.createDataFrame([(i, f"Brand#{i % 3}") for i in range(7)] + [(7, None), (None, "Brand#1")], "p_partkey long, p_brand string")
    lines = [(i // 5, (i * 3) % 8, i % 5, float(i * 7 % 11)) for i in range(400)] + [(3, 2, 1, None), (None, 1, 1, 5.0), (None, 2, 2, 9.0), (4, 1, None, 5.0)]
    docs = spark.createDataFrame([(i, "en" if i % 2 else "de") for i in range(9)], "doc_id long, lang string")
    return SimpleNamespace(part=part, lineitem=spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double"), documents=docs)


def test_battles_are_stored_and_made_once(spark, monkeypatch):
    from chatloom.catalog import evaluation as C

    t = sales(spark)
    fought = C.arena(t)
    plan = fought._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    brand = {r.p_partkey: r.p_brand for r in t.part.collect() if r.p_partkey is not None}
    best = {}
    for r in t.lineitem.collect():
        if r.l_partkey in brand and r.l_orderkey is not None and r.l_linenumber is not None:
            side = ((r.l_quantity is not None, r.l_quantity or 0), (brand[r.l_partkey] is not None, brand[r.l_partkey] or ""), brand[r.l_partkey], r.l_quantity)
            best[r.l_orderkey, r.l_linenumber] = max(best.get((r.l_orderkey, r.l_linenumber), side), side)
    expected = []
    for (o, n), a in best.items():
        b = best.get((o, n + 1))
        if b and a[2] is not None and b[2] is not None and a[2] != b[2]:
            d = None if a[3] is None or b[3] is None else a[3] - b[3]
            winner = "tie" if d is not None and abs(d) < 3 else "model_a" if d is not None and d > 0 else "model_b"
            expected.append((o * 8 + n, a[2], b[2], winner))
    assert sorted(map(tuple, fought.collect())) == sorted(expected)
    calls = []
    monkeypatch.setattr(C, "arena", lambda t: calls.append(1) or fought)
    C.category_ratings(t).collect()
    assert len(calls) == 1


def test_bootstrap_weights_are_those_of_the_distribution(spark):
    from hashlib import md5
    from math import exp

    from chatloom.operators import evaluation as E

    rows = [(i, "a" if i % 3 else "b", "c", "model_a") for i in range(300)]
    rated = E.bradley_terry(spark.createDataFrame(rows, "battle long, model_a string, model_b string, winner string"), "a", at_least=1, replicates=2, rounds=1)
    plan = rated._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan  # the pairs are kept, no battle is drawn again
    # one round from strength 1: wins over half the games, divided by the geometric mean

    def weight(i, rep):
        u, total, prob, k = int(md5(f"42:{i}:{rep}".encode()).hexdigest()[:8], 16) / 2**32, 0.0, exp(-1.0), 0
        while total + prob <= u:
            total, k = total + prob, k + 1
            prob /= k
        return k

    from math import log10

    got = {r.model: r.rating for r in rated.collect()}
    mean = {m: 0.0 for m in "abc"}
    for rep in range(2):
        n = {m: sum(weight(i, rep) for i, a, _, _ in rows if a == m) for m in "ab"}
        raw = {"a": (n["a"] + 1e-9) / (n["a"] / 2), "b": (n["b"] + 1e-9) / (n["b"] / 2), "c": 1e-9 / ((n["a"] + n["b"]) / 2)}
        centre = sum(map(log10, raw.values())) / 3
        for m in mean:
            mean[m] += (1000 + 400 * (log10(raw[m]) - centre)) / 2
    assert all(abs(got[m] - mean[m]) < 1e-6 for m in mean)
