"""Writers: files follow rows, and a write that does not end leaves the old table."""

import glob

import pytest
from pyspark.sql import functions as F

from chatloom.functions import verifiers as V
from chatloom.operators import sampling as S
from chatloom.operators import translation as R
from chatloom.sources import sinks as W


def test_files_follow_the_rows_of_a_language(spark, tmp_path):
    rows = spark.range(1000, numPartitions=16).select("id", F.when(F.col("id") % 10 < 8, "en").when(F.col("id") % 10 == 8, "de").otherwise(" ").alias("lang"), F.lit("x").alias("x"))
    path = str(tmp_path / "out")
    counts = {r.lang: r.n for r in W.write_by_language(rows, path, "lang", "d", rows_per_file=300).collect()}
    files = glob.glob(f"{path}/dataset=d/lang=*/*.parquet")
    assert counts == {"en": 800, "de": 100} and len(files) <= 4
    assert {(r.lang, r["count"]) for r in spark.read.parquet(path).groupBy("lang").count().collect()} == {("en", 800), ("de", 100)}


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert W.write_if_changed(spark.range(10), path, ["a"]) and not W.write_if_changed(spark.range(10).repartition(3), path, ["a"])
    broken = spark.range(20).select(F.when(F.col("id") > 15, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        W.write_if_changed(broken, path, ["a"])
    assert W.read_written(spark, path).count() == 10 and W.manifest(spark, path)["rows"] == 10
    assert W.write_if_changed(spark.range(20), path, ["b"]) and W.read_written(spark, path).count() == 20
    assert W.write_if_changed(spark.range(20), path, ["b"], force=True)
    with pytest.raises(FileNotFoundError):
        W.read_written(spark, str(tmp_path / "none"))


def test_first_rows_beyond_the_row_number_limit(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 2).alias("g")).withColumn("h", F.md5(F.concat(F.lit("42:"), F.col("id").cast("string"))))
    want = {g: {r.id for r in rows.filter(F.col("g") == g).orderBy("h").limit(1500).collect()} for g in (0, 1)}
    got = S.first_by_hash(rows, ["g"], "h", 1500, "id").collect()
    assert {g: {r.id for r in got if r.g == g} for g in (0, 1)} == want


def test_marks_inside_marks_come_back(spark):
    texts = ["see `a` and mail x`b`@c.d.e now", "```\ncode http://x.y\n``` http://z.w `q`", None, "plain", " ".join(f"http://a.b/{i}" for i in range(20_000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", R.protect("t").alias("p"))
    assert all(r.t == r.back for r in df.select("t", R.restore("p.text", "p.kept").alias("back")).collect())


def test_labels_of_constraints(spark):
    labels = [
        """[{"instruction_id": ["A:b", "c:d"], "kwargs": [null, {"n": 3, "words": ["x", "y"], "none": null}]}]""",
        """[{'instruction_id': ['a:b'], 'kwargs': [{'n': None, 'k': "it's", 'yes': True}]}]""",
        """["{\\"instruction_id\\": [\\"a:b\\"], \\"kwargs\\": [{\\"k\\": \\"v\\"}]}"]""", "nothing", None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, x string").select("i", V.constraint_list("x").alias("c"))
    got = {r.i: None if r.c is None else [(c.kind, c.args) for c in r.c] for r in df.collect()}
    assert got[0] == [("a:b", {}), ("c:d", {"n": ["3"], "words": ["x", "y"]})]
    assert got[1] == [("a:b", {"k": ["it's"], "yes": ["true"]})] and got[2] == [("a:b", {"k": ["v"]})] and got[3] is None and got[4] is None


def test_files_are_bounded_in_bytes(spark, tmp_path):
    from chatloom.sources.sinks import write_by_language

    rows = spark.createDataFrame([(i, "de" if i % 4 else "en", "x" * 1000) for i in range(400)] + [(400, "fr", None)], "id long, lang string, text string")
    counts = write_by_language(rows, str(tmp_path / "out"), "lang", "d", bytes_per_file=30_000)
    assert {r.lang: r.n for r in counts.collect()} == {"de": 300, "en": 100, "fr": 1} and counts.columns == ["lang", "n"]
    files = {lang: len(list((tmp_path / "out" / "dataset=d" / f"lang={lang}").glob("*.parquet"))) for lang in ("de", "en", "fr")}
    assert files["de"] > files["en"] > 1 == files["fr"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 401
