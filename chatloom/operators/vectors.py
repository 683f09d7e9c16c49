"""Nearest training vectors per evaluation vector by cosine similarity.

Both sides may be large. Corpus rows are packed into matrices where they are read, queries into blocks of bounded size; one join gives each corpus matrix every
query block (broadcast if all blocks are small), and a product of two matrices keeps the k best of each query. Only those are shuffled to the final cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.sampling import first_k
from chatloom.session import cut_lineage

QUERY_BLOCK = 1024  # queries in a block
BROADCAST_BYTES = 64 << 20  # of all query blocks together
CELLS = 1 << 18  # products that are held at once


def top_matches(corpus: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5, block: int = QUERY_BLOCK) -> DataFrame:
    """(query, key, score) of the k best corpus vectors per query, ties by key. Keys of any type; vectors of one length."""

    # kernels carry what they need, so executors do not have to import this package
    def unit(m: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norm == 0, 1, norm)

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf):
                yield pd.DataFrame({"ids": [pdf["id"].tolist()], "rows": [unit(np.stack(pdf["v"].to_numpy()).astype("float64")).tobytes()]})

    def best(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            # matrices are read where the batch holds them: a worker has one batch and ``CELLS`` products, however many pairs of blocks there are
            for q_ids, q, c_ids, c in zip(*(part.column(x) for x in ("q_ids", "q_rows", "ids", "rows"))):
                q_ids, c_ids = q_ids.values, c_ids.values
                q, c = (np.frombuffer(raw.as_buffer()).reshape(len(i), -1) for raw, i in ((q, q_ids), (c, c_ids)))
                rank = np.unique(c_ids.to_numpy(zero_copy_only=False), return_inverse=True)[1]
                step = max(1, CELLS // len(c))
                for a in range(0, len(q), step):
                    scores = np.round(q[a : a + step] @ c.T, 9)
                    least = -np.partition(-scores, min(k, len(c)) - 1, axis=1)[:, min(k, len(c)) - 1]
                    row, at = np.nonzero(scores >= least[:, None])
                    order = np.lexsort((rank[at], -scores[row, at], row))
                    row, at = row[order], at[order]
                    place = np.arange(len(row)) - np.searchsorted(row, row)
                    row, at = row[place < k], at[place < k]
                    yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(a + row)), c_ids.take(pa.array(at)), pa.array(scores[row, at])], ["query", "key", "score"])

    kind = corpus.schema[key].dataType.simpleString()
    asked = cut_lineage(queries.select(F.col(key).alias("q"), F.col(vector).cast("array<double>").alias("v")))
    n, width = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = max(1, -(-n // block))
    number = F.pmod(F.xxhash64("q", "v"), F.lit(blocks)).cast("int")
    grouped = asked.groupBy(number.alias("block")).agg(F.collect_list("q").alias("q_ids"), F.collect_list("v").alias("m"))

    def matrices(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [unit(np.stack([np.asarray(x, dtype="float64") for x in m])).tobytes() for m in pdf["m"]]
            yield pd.DataFrame({"block": pdf["block"], "q_ids": pdf["q_ids"], "q_rows": rows})

    asked = grouped.mapInPandas(matrices, f"block int, q_ids array<{queries.schema[key].dataType.simpleString()}>, q_rows binary")
    if n * width * 8 <= BROADCAST_BYTES:
        asked = F.broadcast(asked)
    rows = corpus.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.mapInPandas(packed, f"ids array<{kind}>, rows binary").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = rows.join(asked, "block").select("q_ids", "q_rows", "ids", "rows").mapInArrow(best, f"query {queries.schema[key].dataType.simpleString()}, key {kind}, score double")
    return first_k(found, ["query"], [F.desc("score"), "key"], k)


def query_scores(matches: DataFrame) -> DataFrame:
    """Best score per query, as the cosine and as the (1 + cosine) / 2 a vector index reports."""
    return matches.groupBy("query").agg(F.max("score").alias("score")).withColumn("index_score", (1 + F.col("score")) / 2)


def row_scores(matches: DataFrame) -> DataFrame:
    return matches.groupBy("key").agg(F.max("score").alias("score"))
