"""Document boundaries, chunking, packing and padded batches of token rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.operators.nextfit import in_blocks
from chatloom.operators.ordering import running_total
from chatloom.session import cut_lineage


def document_offsets(df: DataFrame, order: Column, size: Column) -> DataFrame:
    """Global (start, end) token offsets in hash order."""
    return running_total(df, order, size.cast("long"), "start").withColumn("end", F.col("start") + size)


def shard_boundaries(offsets: DataFrame, shard_tokens: int, keep: list[str]) -> DataFrame:
    """One row per document and shard it touches, with the range inside the shard."""
    shards = F.sequence(F.floor(F.col("start") / shard_tokens), F.floor((F.col("end") - 1) / shard_tokens))
    base = F.col("shard") * shard_tokens
    return (
        offsets.filter("end > start")
        .withColumn("shard", F.explode(shards))
        .select(
            *keep, "shard",
            F.greatest(F.col("start") - base, F.lit(0)).alias("from"),
            F.least(F.col("end") - base, F.lit(shard_tokens)).alias("to"),
            F.greatest(base - F.col("start"), F.lit(0)).alias("skip"),
        )
    )


def shard_pieces(offsets: DataFrame, shard_tokens: int, key: str, ids: str, mask: str) -> DataFrame:
    """Token and mask pieces per shard, ready for the shard sink."""
    b = shard_boundaries(offsets, shard_tokens, [key, ids, mask])
    n = (F.col("to") - F.col("from")).cast("int")
    at = (F.col("skip") + 1).cast("int")
    return b.select(key, "shard", "from", "to", F.slice(ids, at, n).alias("tokens"), F.slice(mask, at, n).alias("mask"))


PACK_SCHEMA = (
    "pack long, ids array<int>, attention array<int>, response_mask array<long>, dones array<long>, "
    "positions array<int>, num_actions array<int>, lengths array<int>, logprobs array<float>"
)
WEIGHT = 1 << 15  # tokens of the packs that a task hands back at once
PACK_ARRAYS = ["ids", "attention", "response_mask", "dones", "positions", "num_actions", "lengths", "logprobs"]


def pack(df: DataFrame, pack_length: int, pad: int, order: Column, use_mask: bool = False, block: Column | None = None) -> DataFrame:
    """Next-fit packs over all rows (query, response, mask, logprobs) in ``order``, a unique hash; pad tokens are removed.

    Inside a pack every sequence has its own attention number and restarting positions; response tokens carry the
    one-based number of their row in the order, and the last token of a row is marked as done with it. Query tokens
    have no log probability (null). A task holds one pack at a time; a pack that goes on in the next block of rows is put together from its pieces.
    """
    size = F.size(F.filter("query", lambda x: x != pad)) + F.size(F.filter("response", lambda x: x != pad))
    state = ["used", "held", "pack", "first"]
    rows = in_blocks(df.select("query", "response", "mask", "logprobs", order.alias("_order")), F.col("_order"), size, pack_length, block)
    rows = rows.select("_b", "query", "response", "mask", "logprobs", *state)

    def arrays(pack: int, held: int, first: int, whole: bool, rows: list[tuple]) -> dict:
        """The piece of a pack; ``held`` rows of it stand in earlier blocks, and ``first`` is the number of its first row here."""
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, "int32")
        sizes = [len(q) + len(a) for q, a, _, _ in rows]
        marks = [np.where(m != 0, i, 0) if use_mask else np.full(len(a), i) for i, (_, a, m, _) in enumerate(rows, first + 1)]
        return {
            "pack": pack, "piece": first, "whole": whole,
            "ids": join([np.concatenate([q, a]) for q, a, _, _ in rows]),
            "attention": join([np.full(n, held + s + 1) for s, n in enumerate(sizes)]),
            "response_mask": join([np.concatenate([np.zeros(len(q), "int64"), x]) for (q, _, _, _), x in zip(rows, marks)]),
            "dones": join([np.concatenate([np.zeros(n - 1, "int64"), [i]]) for i, n in enumerate(sizes, first + 1) if n]),
            "positions": join([np.arange(n) for n in sizes]),
            "num_actions": [len(a) for _, a, _, _ in rows], "lengths": sizes,
            # only numbers of a list that are missing become null
            "logprobs": join([np.concatenate([np.full(len(q), np.nan, "float32"), x]) for q, _, _, x in rows]).tolist(),
        }

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, open_, used, held, number, first, own = None, [], 0, 0, 0, 0, False
        for pdf in parts:
            out, weight = [], 0
            for b, q, a, mask, logprobs, *state in zip(*(pdf[c] for c in ("_b", "query", "response", "mask", "logprobs", "used", "held", "pack", "first"))):
                if b != block:
                    if open_:
                        out.append(arrays(number, held, first, False, open_))
                    block, open_, own = b, [], False
                    used, held, number, first = map(int, state)
                q, a = np.asarray(q, dtype="int32"), np.asarray(a, dtype="int32")
                q, keep = q[q != pad], a != pad
                row = (q, a[keep], np.asarray(mask, dtype="int32")[keep], np.asarray(logprobs, dtype="float32")[keep])
                n = len(row[0]) + len(row[1])
                if used + n > pack_length:
                    if open_:
                        out.append(arrays(number, held, first, own, open_))
                        first += len(open_)
                    open_, used, held, number, own = [], 0, 0, number + 1, True
                open_.append(row)
                used += n
                weight += n
                if weight > WEIGHT and out:
                    yield pd.DataFrame(out)
                    out, weight = [], 0
            if out:
                yield pd.DataFrame(out)
        if open_:
            yield pd.DataFrame([arrays(number, held, first, False, open_)])

    pieces = cut_lineage(rows.mapInPandas(build, PACK_SCHEMA + ", piece long, whole boolean"))
    broken = pieces.filter("NOT whole").groupBy("pack").agg(F.array_sort(F.collect_list(F.struct("piece", *PACK_ARRAYS))).alias("p"))
    joined = broken.select("pack", *[F.flatten(F.col(f"p.{c}")).alias(c) for c in PACK_ARRAYS])
    return pieces.filter("whole").select(joined.columns).unionByName(joined)


def pack_efficiency(packs: DataFrame, pack_length: int) -> DataFrame:
    return packs.agg(
        F.count(F.lit(1)).alias("packs"),
        F.sum(F.size("lengths")).alias("sequences"),
        F.round(F.sum(F.size("ids")) / (F.count(F.lit(1)) * pack_length), 6).alias("efficiency"),
    )


def pad_preferences(df: DataFrame, batch: str, chosen: str, rejected: str, pad: int) -> DataFrame:
    """Both sides right-padded to the longest sequence of their batch (a batch is a few rows)."""
    longest = F.max(F.greatest(F.size(chosen), F.size(rejected))).over(Window.partitionBy(batch))
    padded = lambda c: F.concat(F.col(c), F.array_repeat(F.lit(pad), F.col("_m") - F.size(c)))
    return df.withColumn("_m", longest).withColumn(chosen, padded(chosen)).withColumn(rejected, padded(rejected)).drop("_m")


def flatten_batch(df: DataFrame, batch: str, pos: str, ids: str, labels: str, separator: int = -100) -> DataFrame:
    """Padding-free batches: concatenated ids and labels, cumulative lengths, position and sequence ids."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(ids).alias("i"), F.col(labels).alias("l"))))
    grouped = df.groupBy(batch).agg(rows.alias("r"))
    lengths = F.transform("r", lambda x: F.size(x["i"]))
    cumulative = F.aggregate(
        lengths, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )
    return grouped.select(
        batch,
        F.flatten(F.transform("r", lambda x: x["i"])).alias("input_ids"),
        F.flatten(F.transform("r", lambda x: F.transform(x["l"], lambda t, j: F.when(j == 0, F.lit(separator)).otherwise(t)))).alias("labels"),
        cumulative.alias("cu_seq_lens"),
        F.array_max(lengths).alias("max_length"),
        F.flatten(F.transform("r", lambda x: F.transform(x["i"], lambda t, j: j))).alias("position_ids"),
        F.flatten(F.transform("r", lambda x, s: F.transform(x["i"], lambda t: s))).alias("seq_idx"),
    )
