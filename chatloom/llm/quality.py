"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax output.

A text becomes counts over hashed features: its words and the n-grams of its characters (UTF-8 bytes, with a space at either end) for n of
3 to 5. Each bucket has a learned vector; a document is the mean of its vectors, and a linear layer with softmax scores the labels. Training is
stochastic gradient descent in numpy on a bounded sample of labelled rows. For scoring, the vectors are folded with the output layer into one
weight per bucket, which is the same sum in another order; the model is a table of fixed size.

Bounds: at most ``MAX_ROWS`` labelled rows train the model, the first by a hash of their id; every text is scored whole. With fewer than two
kinds of labels every score is the share of label 1 (0.5 without labels).

Edge cases: a null text is empty; an empty text has only the end mark as its feature, and so a learned score; labels that are null teach nothing; repeated
rows are scored each; an empty table gives an empty result. Only the key and the results are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import released

BUCKETS, DIM = 1 << 16, 16
GRAMS = (3, 4, 5)
MAX_ROWS = 3000
EPOCHS, RATE, BATCH = 12, 0.5, 16
CHUNK = 1 << 20  # bytes of text that are hashed at once
MIX = 0x9E3779B97F4A7C15


def buckets(raw: bytes) -> np.ndarray:
    """Buckets of all features of a text, in order of kind and place; the end mark is bucket 0."""
    out = [np.zeros(1, np.int64)]
    step = CHUNK
    data = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            for a in range(0, len(data) - n + 1, step):
                part = data[a : min(len(data), a + step + n - 1)]
                h = np.full(len(part) - n + 1, np.uint64(n))
                for i in range(n):
                    h = h * np.uint64(0x100000001B3) + part[i : len(part) - n + 1 + i]
                out.append(fold(h))
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(space)
        begin, end = edge[:-1] + 1, edge[1:]
        begin, end = begin[end > begin], end[end > begin]
        if len(begin):
            # a word's hash: the difference of running sums of byte * odd power, brought back to the word's first place
            power, inverse = powers(len(data))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power)])
            out.append(fold((total[end] - total[begin]) * inverse[begin] + np.uint64(77)))
    return np.concatenate(out)


def powers(n: int, made: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of an odd base and of its inverse, as many as the longest text of the task needs."""
    if not made or len(made[0]) < n:
        size = max(n, 1 << 16)
        made[:] = [np.cumprod(np.full(size, np.uint64(b))) for b in (0x100000001B3, pow(0x100000001B3, -1, 1 << 64))]
    return made[0][:n], made[1][:n]


def fold(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(MIX)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return 1 + ((h >> np.uint64(33)) % np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    """``weights`` per bucket and ``bias``; a score is the logistic of the mean weight of a text's features."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = self.weights[buckets((text or "").encode("utf-8", "replace"))]
        return float(1 / (1 + np.exp(-(found.mean() + self.bias))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """``rows``: (buckets, counts, label) per document. The vectors that are learned, folded with the output layer."""
    share = np.mean([y for *_, y in rows]) if rows else 0.5
    if len({y for *_, y in rows}) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(np.clip(share, 1e-3, 0.999) / np.clip(1 - share, 1e-3, 0.999))))
    vectors, out, bias = learned(rows, seed)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def learned(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, output layer and bias, by stochastic gradient descent over shuffled mini-batches, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), BATCH):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            batch = [rows[i] for i in order[a : a + BATCH]]
            for ids, counts, label in batch:
                weight = (counts / counts.sum()).astype(np.float32)
                mean = weight @ vectors[ids]
                logits = mean @ out + bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[label] -= 1
                back = out @ p
                out -= rate * np.outer(mean, p)
                bias -= rate * p
                vectors[ids] -= (rate * np.sqrt(len(ids), dtype=np.float32) * weight)[:, None] * back
    return vectors, out, bias


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """Train on the first ``max_rows`` labelled rows by hash of the key, in one task: it holds at most ``max_rows`` count vectors of at most
    ``BUCKETS`` entries. The driver gets the model, a weight per bucket."""

    def fitted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = []
        for part in parts:
            for k, t, y in zip(part["_key"], part["_text"], part["_label"], strict=True):
                ids, counts = np.unique(buckets((t or "").encode("utf-8", "replace")), return_counts=True)
                got.append((pd.isna(k), k, int(y), ids.astype(np.uint16).tobytes(), counts.astype(np.float32)))
        got.sort(key=lambda r: (r[0], 0 if r[0] else r[1], *r[2:4]))
        model = train([(np.frombuffer(ids, np.uint16), counts, y) for _, _, y, ids, counts in got])
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    rows = labelled.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), F.col(label).cast("int").alias("_label"))
    chosen = rows.filter("_label IN (0, 1)").orderBy(F.xxhash64(F.lit(3), "_key"), "_key", "_label", F.xxhash64("_text")).limit(max_rows)
    made = chosen.coalesce(1).mapInPandas(released(fitted), "weights binary, bias double").collect()
    return Model(np.frombuffer(made[0]["weights"], np.float32), made[0]["bias"]) if made else train([])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """(key, score, predicted) of every whole text, in one pass without a shuffle."""

    def scored(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            s = np.array([model.score(t) for t in part["_text"]], float)
            yield pd.DataFrame({"_key": part["_key"], "score": s, "predicted": (s >= threshold).astype("int32")})

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {docs.schema[key].dataType.simpleString()}, score double, predicted int"
    return rows.mapInPandas(released(scored), schema).withColumnRenamed("_key", key)


def kept(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, unchanged, in one pass without a shuffle.

    A plain function gets a hundred texts at a time, where an Arrow batch holds up to 64 MB of them on either side; scoring a text takes far longer than handing it over.
    """
    scored = F.udf(model.score, "double", useArrow=False)
    return docs.filter(scored(F.col(text)) >= threshold)


def held_out(key: str = "doc_id"):
    """Rows that never teach: CRC-32 of the id as text, remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled texts. The rows are chosen from the narrow ``labels`` first, so that no text is shuffled."""
    marks = labels.select(F.col(key).alias("_mark"), F.col(label).alias("_label")).filter(~held_out("_mark")).filter("_label IS NOT NULL AND _mark IS NOT NULL").distinct()
    present = marks.join(docs.select(F.col(key).alias("_mark")).filter("_mark IS NOT NULL").distinct(), "_mark", "left_semi")
    chosen = present.orderBy(F.xxhash64(F.lit(3), "_mark"), "_mark", "_label").limit(max_rows)
    return docs.select(F.col(key).alias("_mark"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_mark").select(
        F.col("_mark").alias(key), F.col("_text").alias(text), F.col("_label").alias(label)
    )
