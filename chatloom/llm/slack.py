"""Packing by minimum bin slack: the multiset of remaining lengths that fills a sequence best, found by bitset subset sums.

A document's tokens are cut into full sequences and a remainder. Only the number of remainders of each length matters for
the plan, so it is made from at most ``capacity`` counts, whatever the corpus. The longest remaining length opens a sequence; the sums that the other lengths can
reach are the bits of an integer, each length offered in parts of 1, 2, 4 ... pieces; the best sum is walked back to counts per length. The
same multiset is repeated as often as the counts allow. Where even the best sum leaves room and pieces remain, one of them is
cut to fill it, and its rest returns to the lengths, so that only the last sequence is padded.

Documents find their place by their rank among the remainders of their length, numbered in salted cells; the plan is a short table of rank intervals.

Edge cases: a null or empty text has the end id only, or no piece without one; a text of a multiple of the capacity has no remainder; repeated rows are packed
each, and equal ones are interchangeable; an empty table gives an empty result. Only the named columns and the results are returned.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import ranked, saved, small_batches
from chatloom.llm.tokenize import token_rows


def best_fill(lengths: list[int], counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``room`` of at most ``counts`` pieces per length, and its pieces. ``lengths`` falls."""
    reach, mask, states = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room or not counts[length]:
            continue
        count, part = min(counts[length], room // length), 1
        while count > 0:
            n = min(part, count)
            states.append((length, n, reach))
            reach |= reach << (n * length) & mask
            count, part = count - n, part * 2
        if reach >> room & 1:
            break
    total = left = reach.bit_length() - 1
    take: dict[int, int] = {}
    for length, n, before in reversed(states):
        if not before >> left & 1:
            left -= n * length
            take[length] = take.get(length, 0) + n
    return total, take


def plan(counts: dict[int, int], capacity: int, cut: bool = True) -> tuple[dict[int, list[tuple]], int]:
    """Per length, intervals of ranks (first, pieces a sequence, sequence, offset, cut, first rank of the rests); and the sequences used.

    ``cut`` is 0, or the tokens of the piece that lie in the sequence; the rests are pieces of their own length with later ranks.
    """
    left = {n: c for n, c in counts.items() if n > 0 and c > 0}
    made = dict(left)  # pieces of a length so far: ranks are given in this order
    used = dict.fromkeys(left, 0)
    out: dict[int, list[tuple]] = {}
    sequence = 0
    while left:
        lengths = sorted(left, reverse=True)
        seed = lengths[0]
        left[seed] -= 1
        filled, take = best_fill(lengths, left, capacity - seed)
        left[seed] += 1
        take[seed] = take.get(seed, 0) + 1
        gap = capacity - seed - filled
        spare = next((n for n in lengths if n > gap and left[n] > take.get(n, 0)), None) if cut and gap else None
        need = dict(take)
        if spare:
            need[spare] = need.get(spare, 0) + 1
        times = min(left[n] // c for n, c in need.items())
        offset = 0
        for n in sorted(take, reverse=True):
            out.setdefault(n, []).append((used[n], take[n], sequence, offset, 0, 0))
            used[n] += take[n] * times
            offset += n * take[n]
        if spare:
            rest = spare - gap
            out.setdefault(spare, []).append((used[spare], 1, sequence, offset, gap, made.get(rest, 0)))
            used[spare] += times
            used.setdefault(rest, 0)
            made[rest] = made.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
        for n, c in need.items():
            left[n] -= c * times
        left = {n: c for n, c in left.items() if c}
        sequence += times
    return out, sequence


def places(intervals: dict[int, list[tuple]], length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of the remainder of this length and rank."""
    start = 0
    while length:
        rows = intervals[length]
        first, each, sequence, offset, part, rests = rows[bisect_right(rows, rank, key=lambda x: x[0]) - 1]
        copy, slot = divmod(rank - first, each)
        if not part:
            yield start, length, sequence + copy, offset + slot * length
            return
        yield start, part, sequence + copy, offset
        start, length, rank = start + part, length - part, rests + copy


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 1, text: str = "text", key: str = "doc_id", cut: bool = True) -> DataFrame:
    """One row per piece: (key, start, length, ids, doc_tokens, sequence_id, offset); ``ids`` are little-endian unsigned 32-bit numbers.

    The texts are encoded once, into a table in the shared folder; that table is shuffled once, by (length, salt). The driver gets the
    counts per length, at most ``capacity`` of them.
    """
    with small_batches(docs.sparkSession):
        encoded = saved(token_rows(docs, tokenizer, end_id, text, key), "tokens")
    rows = encoded.withColumns({
        "_rem": (F.col("_n") % capacity).cast("int"), "_full": F.floor(F.col("_n") / capacity).cast("long"), "_hash": F.xxhash64("_ids"),
    })
    counts = encoded.select((F.col("_n") % capacity).cast("int").alias("_rem"), F.floor(F.col("_n") / capacity).cast("long").alias("_full"))
    counts = counts.groupBy("_rem").agg(F.count(F.lit(1)).alias("rows"), F.sum("_full").alias("full")).collect()
    intervals, sequences = plan({r["_rem"]: r["rows"] for r in counts}, capacity, cut)
    first_full, at = {}, sequences
    for r in sorted(counts, key=lambda r: r["_rem"]):
        first_full[r["_rem"]] = at
        at += r["full"]
    numbered = ranked(rows, ["_rem"], ["_key", "_hash"], sums=["_full"])

    def cut_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["_key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for part in parts:
            out, size = [], 0
            for k, n, raw, rem, full, rank, before in zip(*[part[c] for c in ("_key", "_n", "_ids", "_rem", "_full", "_rank", "_sum__full")], strict=True):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                spans = [(j * capacity, capacity, first_full[rem] + before + j, 0) for j in range(full)]
                spans += [(full * capacity + s, m, q, o) for s, m, q, o in places(intervals, int(rem), int(rank))]
                out += [(k, s, m, ids[s : s + m].tobytes(), n, q, o) for s, m, q, o in spans]
                size += n
                if size > 1 << 20:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)

    columns = ["_key", "_n", "_ids", "_rem", "_full", "_rank", "_sum__full"]
    schema = f"_key {docs.schema[key].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return numbered.select(*columns).mapInPandas(cut_up, schema).withColumnRenamed("_key", key)
