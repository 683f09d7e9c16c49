"""Repeated passages that begin and end inside a line, against brute force."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm import passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_passages(rows, least=passages.LEAST):
    """Kept words by comparing all runs of words, documents in order of id."""
    seen, out = set(), []
    for key, text in rows:
        words, gone = WORD.findall(text or ""), set()
        for a in range(len(words) - least + 1):
            run = tuple(words[a : a + least])
            if run in seen:
                gone.update(range(a, a + least))
            seen.add(run)
        out.append((key, [w for i, w in enumerate(words) if i not in gone], bool(gone)))
    return out


def found(docs, **options):
    rows = passages.dedup_passages(docs, **options).orderBy("doc_id").collect()
    return [(r.doc_id, WORD.findall(r.text or ""), r.cut_words) for r in rows], {r.doc_id: r.text for r in rows}


def test_passage_that_begins_and_ends_inside_lines(spark):
    passage = [f"p{i}" for i in range(52)]
    split = " ".join(passage[:20]) + "\n" + " ".join(passage[20:])
    rows = [
        (1, f"one a\nb c {split} d e\nf  g"), (2, f"two x\ny z {' '.join(passage)} u\nv"), (3, f"{split}\nthree"), (4, f"four\n {split}"), (5, " ".join(passage[:50])),
        (6, "six " + " ".join(f"q{i}" for i in range(60)) + " tail"), (7, None), (8, ""), (9, f"nine h {split} k\n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, texts = found(docs)
    assert words == plain_passages(rows)
    assert texts[1] == rows[0][1] and texts[2] == "two x\ny z u\nv" and texts[3] == "three" and texts[4] == "four" and texts[9] == "nine h\nk\n"
    assert [texts[i] for i in (5, 6, 7, 8)] == [rows[i - 1][1] for i in (5, 6, 7, 8)]
    # the stage of the pipeline: lines alone do not see it
    full = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("a").alias("source"), F.length("text").cast("long").alias("n_chars"))
    stage = {r.doc_id: (r.text, r.n_chars) for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, full, "").collect()}
    assert stage[2] == ("two x\ny z u\nv", 13) and stage[1][0] == rows[0][1]


def test_random_passages(spark):
    rng = random.Random(5)
    pool = [rng.choice("abcdefgh") + str(i) for i in range(400)]
    rows = []
    for key in range(60):
        parts = [f"{key}s"]
        for _ in range(rng.randint(0, 5)):
            a = rng.randrange(380)
            parts += pool[a : a + rng.randint(1, 40)] if rng.random() < 0.8 else ["x", "y"] * rng.randint(1, 20)
        rows.append((key, "".join(w + rng.choice((" ", " ", "\n", "  ")) for w in parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least, shingle in ((12, 4), (9, 1), (51, 16)):
        got, _ = found(docs, least=least, shingle=shingle)
        want = plain_passages(rows, least)
        assert got == want and (least > 20 or any(w[2] for w in want))


def test_passages_of_odd_rows(spark, documents, odd_documents, no_documents):
    got, _ = found(documents)
    assert got == plain_passages([(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()])
    assert passages.dedup_passages(odd_documents).count() == odd_documents.count()
    assert passages.dedup_passages(no_documents).collect() == []
    text = " ".join(f"u{i}" for i in range(60))
    twice = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    assert sorted(r.text for r in passages.dedup_passages(twice).collect()) == ["", "", "", text]
