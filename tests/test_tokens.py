import random
import re

import pytest
from pyspark.sql import functions as F

from chatloom.functions import tokens as T
from chatloom.functions.templates import TEMPLATES, render
from chatloom.operators import packing as P
from chatloom.operators.nextfit import chunk_boundaries

WORD = re.compile(r"[^\W]+|[^\w\s]")


def tokens(s):
    return re.findall(r"\w+|[^\w\s]", s)


def greedy(parts, target, long_part=None):
    out, cur, n = [], [], 0
    for s in parts:
        k = len(tokens(s))
        if long_part and k > target:
            if cur:
                out.append(" ".join(cur))
            cur, n = [], 0
            out += long_part(s)
        elif n + k > target and cur:
            out.append(" ".join(cur))
            cur, n = [s], k
        else:
            cur.append(s)
            n += k
    return out + ([" ".join(cur)] if cur else [])


def chunks(text, top, margin):
    if len(tokens(text)) <= top:
        return [text]
    parts = [text] if len(text) < 50 else [s.strip() for p in re.split(r"\n\s*\n", text) if p.strip() for s in re.split(r"(?<=[.!?])\s+", p) if s.strip()] or [text]
    words = lambda s: greedy(s.split(), top - margin)
    if len(parts) <= 1:
        return words(text)
    return greedy(parts, top - margin, lambda s: [s] if len(tokens(s)) <= top else words(s))


def test_sentence_chunks_match_the_plain_model(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        ends = [".", "!", "?", "", ".\n\n", ","]
        texts.append(" ".join("w" * rng.randint(1, 6) + rng.choice(ends if rng.random() < 0.3 else [""]) for _ in range(rng.randint(1, 200))))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.sentence_chunks("t", 30, 8).alias("c")).collect()
    for r in rows:
        assert r["c"] == chunks(texts[r["i"]], 30, 8)
        assert all(len(tokens(c)) <= 30 for c in r["c"])


def test_masks(spark):
    chat = [("system", "be kind"), ("user", "hi"), ("assistant", "yes sir"), ("user", "ok"), ("assistant", "bye")]
    df = spark.createDataFrame([([dict(role=r, content=c) for r, c in chat],)], "messages array<struct<role:string,content:string>>")
    row = df.select(T.masked_chat("messages", TEMPLATES["tagged"], 10_000).alias("x"), render("messages", TEMPLATES["tagged"]).alias("t")).first()
    words = tokens(row["t"])
    assert len(words) == len(row["x"]["input_ids"]) == len(row["x"]["labels"])
    open_words = [w for w, l in zip(words, row["x"]["labels"]) if l != -100]
    end = ["<", "|", "endoftext", "|", ">"]
    assert open_words == ["yes", "sir", *end, "bye", *end]
    cut = df.select(T.masked_chat("messages", TEMPLATES["tagged"], 7).alias("x")).first()["x"]
    assert len(cut["input_ids"]) == 7 and not any(x != -100 for x in cut["labels"])


def test_thinking_is_cut_from_earlier_turns(spark):
    chat = [("user", "q"), ("assistant", "<think>a</think>\nb"), ("user", "q"), ("assistant", "<think>c</think>d")]
    df = spark.createDataFrame([([dict(role=r, content=c) for r, c in chat],)], "messages array<struct<role:string,content:string>>")
    t = df.select(render("messages", TEMPLATES["im_thinker_cut_earlier"]).alias("t")).first()["t"]
    assert "<think>a" not in t and "assistant\nb<|im_end|>" in t and "<think>c</think>d" in t and t.startswith("<|im_start|>system")


def test_file_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tok = Tokenizer(models.WordLevel({"a": 0, "b": 1, "<": 2, "|": 3, ">": 4, "user": 5, "assistant": 6, "endoftext": 7, "[UNK]": 8}, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    df = spark.createDataFrame([([dict(role="user", content="a b"), dict(role="assistant", content="b a")],)], "messages array<struct<role:string,content:string>>")
    x = df.select(T.masked_chat("messages", TEMPLATES["tagged"], 100, "assistant", T.file_tokenizer(path)).alias("x")).first()["x"]
    assert 0 in x["input_ids"] and any(l != -100 for l in x["labels"])


def test_truncate_to_context(spark):
    chat = [("system", "s s"), ("user", "a b c d"), ("assistant", "e f g h i j"), ("user", "zz")]
    df = spark.createDataFrame([([dict(role=r, content=c) for r, c in chat],)], "messages array<struct<role:string,content:string>>")
    got = df.select(T.truncate_to_context("messages", 0, 23, 0).alias("m")).first()["m"]
    # 23 - (2 + 4) = 17 left; 4 + 3 for the user; 10 left, 3 for the role, so 7 tokens would fit: the turn has 6 and fits
    assert [(m["role"], m["content"]) for m in got][:3] == [("system", "s s"), ("user", "a b c d"), ("assistant", "e f g h i j")]
    got = df.select(T.truncate_to_context("messages", 0, 20, 0).alias("m")).first()["m"]
    assert [(m["role"], m["content"]) for m in got] == [("system", "s s"), ("user", "a b c d"), ("assistant", "e f g h")]
    only = df.select(T.truncate_to_context("messages", 0, 6, 0).alias("m")).first()["m"]
    assert [m["role"] for m in only] == ["system"]


@pytest.mark.parametrize("seed", [1, 2])
def test_chunk_boundaries(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 9, 60]) for _ in range(80)]
    df = spark.createDataFrame([(f"{i:04x}", s) for i, s in enumerate(sizes)], "o string, size long")
    block = F.substring("_o", 1, 4 - seed)
    got = sorted((r["start"], r["end"]) for r in chunk_boundaries(df, F.col("o"), F.col("size"), 20, block).collect())
    want, start, cur, total = [], 0, 0, 0
    for s in sizes:
        if cur + s > 20 and cur > 0:
            want.append((start, total))
            start, cur = total, s
        else:
            cur += s
        total += s
    want.append((start, total))
    assert got == want


def test_pack(spark):
    rows = [("00", [1, 2], [3, 4, 0], [1, 1, 1], [0.1, 0.2, 0.3]), ("01", [5], [6], [0], [0.4]), ("02", [7, 8, 9], [10, 11], [1, 0], [0.5, 0.6])]
    df = spark.createDataFrame(rows, "o string, query array<int>, response array<int>, mask array<int>, logprobs array<float>")
    a, b = P.pack(df, 6, 0, F.col("o")).orderBy("pack").collect()
    assert a["ids"] == [1, 2, 3, 4, 5, 6] and b["ids"] == [7, 8, 9, 10, 11]
    assert a["attention"] == [1, 1, 1, 1, 2, 2] and b["attention"] == [1] * 5
    assert a["response_mask"] == [0, 0, 1, 1, 0, 2] and a["dones"] == [0, 0, 0, 1, 0, 2] and b["dones"] == [0, 0, 0, 0, 3]
    assert a["positions"] == [0, 1, 2, 3, 0, 1] and a["num_actions"] == [2, 1] and a["lengths"] == [4, 2]
    assert a["logprobs"][0] is None and abs(a["logprobs"][2] - 0.1) < 1e-6
    m = P.pack(df, 6, 0, F.col("o"), use_mask=True).orderBy("pack").collect()
    assert m[0]["response_mask"] == [0, 0, 1, 1, 0, 0] and m[1]["response_mask"] == [0, 0, 0, 3, 0]


def test_positions_do_not_depend_on_partitions(spark):
    from chatloom.functions.text import hash_key

    base = spark.range(500).withColumn("n", F.col("id") % 7)
    runs = [
        {(r["id"], r["start"], r["end"]) for r in P.document_offsets(base.repartition(p), hash_key("id"), F.col("n")).collect()} for p in (1, 7, 60)
    ]
    assert runs[0] == runs[1] == runs[2]


def plain_packs(rows, capacity):
    """(numbers of the rows, tokens) of every pack, one row after the other."""
    packs, used = [], capacity + 1
    for i, n in enumerate(rows):
        if used + n > capacity:
            packs.append([])
            used = 0
        packs[-1].append(i)
        used += n
    return packs


@pytest.mark.parametrize("digits,partitions", [(1, 1), (3, 7), (4, 50)])
def test_packs_do_not_depend_on_blocks(spark, digits, partitions):
    rng = random.Random(digits)
    sizes = [rng.choice([0, 0, 1, 3, 7, 19, 20, 21, 60]) for _ in range(400)]
    lengths = [(rng.randint(0, n), n) for n in sizes]
    rows = [(f"{i * 13:04x}", list(range(1, q + 1)) + [0], list(range(q + 1, n + 1)), [i % 2] * (n - q), [0.5] * (n - q)) for i, (q, n) in enumerate(lengths)]
    df = spark.createDataFrame(rows, "o string, query array<int>, response array<int>, mask array<int>, logprobs array<float>").repartition(partitions)
    got = P.pack(df, 20, 0, F.col("o"), block=F.substring("_o", 1, digits)).orderBy("pack").collect()
    want = plain_packs(sizes, 20)
    assert [r["pack"] for r in got] == list(range(len(want)))
    for r, pack in zip(got, want):
        assert r["lengths"] == [sizes[i] for i in pack] and r["num_actions"] == [sizes[i] - lengths[i][0] for i in pack]
        assert r["attention"] == [s + 1 for s, i in enumerate(pack) for _ in range(sizes[i])]
        assert r["ids"] == [x for i in pack for x in range(1, sizes[i] + 1)] and r["positions"] == [x for i in pack for x in range(sizes[i])]
        assert r["response_mask"] == [0 if x < lengths[i][0] else i + 1 for i in pack for x in range(sizes[i])]
        assert r["dones"] == [i + 1 if x == sizes[i] - 1 else 0 for i in pack for x in range(sizes[i])]
    full = [n for n in sizes if n]
    spans, at = [], 0
    for pack in plain_packs(full, 20):
        spans.append((len(spans), at, at + sum(full[i] for i in pack)))
        at = spans[-1][2]
    found = chunk_boundaries(df, F.col("o"), F.size("query") - 1 + F.size("response"), 20, F.substring("_o", 1, digits))
    assert sorted(map(tuple, found.collect())) == spans


def test_long_rows_are_packed_one_pack_at_a_time(spark):
    rows = spark.range(200, numPartitions=3).select(
        F.lpad(F.hex("id"), 8, "0").alias("o"), F.array_repeat(F.lit(7), 100).alias("query"), F.array_repeat(F.lit(8), 32_000).alias("response"),
        F.array_repeat(F.lit(1), 32_000).alias("mask"), F.array_repeat(F.lit(0.5), 32_000).cast("array<float>").alias("logprobs"))
    got = P.pack(rows, 65_000, -1, F.col("o"), block=F.substring("_o", 1, 7)).select("pack", F.size("ids").alias("n"), F.size("lengths").alias("k")).collect()
    assert sorted(map(tuple, got)) == [(i, 64_200, 2) for i in range(100)]
