"""Global next-fit: rows in order fill packs of a capacity; a row that does not fit begins the next pack, and one larger than a pack stands alone.

What a pack holds depends on where the one before it ends, through all rows; yet nothing is done row after row. Rows are dealt into blocks by their order.
Inside a block, prefix sums and a range search give for each row the row that the next pack would begin with; doubling these pointers gives for each row
the last pack that begins in the block and the number of packs up to it, in a logarithm of steps. Only the rows within one capacity of the block's begin can
follow a pack from before, and most of them lead to the same end; so a block is a short table from the tokens the open pack holds to those it holds
after the block. These tables, one row per block of a fixed number of blocks, are applied one after the other, and every block then knows the state it begins in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.ordering import hash_block
from chatloom.session import broadcast_if_small, cut_lineage

TABLES = 1024  # blocks whose tables a worker holds as Python numbers
ENTRY = "_b string, used long, held long, pack long, first long, offset long"


def block_sizes(df: DataFrame, order: Column, size: Column, block: Column | None = None) -> DataFrame:
    """(_b, sizes): the sizes of each block's rows in order. ``order`` is unique, and ``block`` rises with it (by default the prefix of a hexadecimal hash)."""
    rows = df.select(order.alias("_o"), size.cast("long").alias("_n"))
    rows = rows.withColumn("_b", hash_block(F.col("_o")) if block is None else block)
    ordered = F.array_sort(F.collect_list(F.struct("_o", "_n")))
    return cut_lineage(rows.groupBy("_b").agg(F.transform(ordered, lambda r: r["_n"]).alias("sizes")))


def block_entries(sizes: DataFrame, capacity: int) -> DataFrame:
    """The state before each block: tokens and rows that the open pack holds, its number, and the rows and tokens before the block."""

    def first_starts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row, the row that the next pack begins with if a pack begins at this one."""
        ends = np.cumsum(n)
        return ends, np.maximum(np.arange(len(n)) + 1, np.searchsorted(ends, ends - n + capacity, side="right"))

    def summaries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the tables of some blocks at a time
        for part in (p.slice(a, TABLES) for p in parts for a in range(0, p.num_rows, TABLES)):
            out = {"rows": [], "total": [], "ends": [], "used": [], "held": [], "packs": []}
            for n in part.column("sizes"):
                n = n.values.to_numpy(zero_copy_only=False)
                ends, follow = first_starts(n)
                last, count, jump = np.arange(len(n)), np.ones(len(n), np.int64), np.minimum(follow, len(n))
                while (jump < len(n)).any():
                    on = np.flatnonzero(jump < len(n))
                    to = jump[on]
                    # all at once: each row goes on from the row its pointer has reached
                    last[on], count[on], jump[on] = last[to], count[on] + count[to], jump[to]
                top = min(int(np.searchsorted(ends, capacity, side="right")), len(n) - 1)
                used, held = ends[-1] - (ends - n)[last], len(n) - last
                change = np.flatnonzero(np.append((np.diff(used[: top + 1]) != 0) | (np.diff(count[: top + 1]) != 0), True))
                # the first row also begins a pack after one that is over its capacity
                for name, value in (("ends", ends), ("used", used), ("held", held), ("packs", count)):
                    out[name].append([int(value[0]), *value[change].tolist()])
                out["rows"].append(len(n))
                out["total"].append(int(ends[-1]))
            kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([part.column("_b"), *(pa.array(out[n], k) for n, k in zip(out, kinds))], ["_b", *out])

    def applied(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, held, pack, first, offset = capacity + 1, 0, -1, 0, 0
        names = ["_b", "rows", "total", "ends", "used", "held", "packs"]
        for part in (p.slice(a, TABLES) for p in parts for a in range(0, p.num_rows, TABLES)):
            states = []
            for b, rows, total, ends, after, held_after, packs in zip(*(part.column(n).to_pylist() for n in names)):
                states.append((b, used, held, pack, first, offset))
                i = 0 if used > capacity else 1 + int(np.searchsorted(ends[1:], capacity - used, side="right"))
                if i < len(ends):
                    used, held, pack = after[i], held_after[i], pack + packs[i]
                else:
                    used, held = used + total, held + rows
                first, offset = first + rows, offset + total
            kinds = [pa.string()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*states), kinds)], ["_b", "used", "held", "pack", "first", "offset"])

    table = "_b string, rows long, total long, ends array<long>, used array<long>, held array<long>, packs array<long>"
    tables = cut_lineage(sizes.mapInArrow(summaries, table))
    return cut_lineage(tables.coalesce(1).sortWithinPartitions("_b").mapInArrow(applied, ENTRY))


def chunk_boundaries(df: DataFrame, order: Column, size: Column, capacity: int, block: Column | None = None) -> DataFrame:
    """(chunk, start, end): token ranges of greedy chunks that never split an item, over all rows in ``order``. Items of size 0 are in no chunk of their own."""
    sizes = block_sizes(df.filter(size > 0), order, size, block)

    def spans(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for n, used, pack, offset in zip(part.column("sizes"), *(part.column(c).to_pylist() for c in ("used", "pack", "offset"))):
                ends = np.cumsum(n.values.to_numpy(zero_copy_only=False))
                at, base, chunk = 0, -used, pack
                while at < len(ends):
                    to = int(np.searchsorted(ends, base + capacity, side="right"))
                    if to <= at:  # it does not fit
                        base, chunk = int(ends[at - 1]) if at else 0, chunk + 1
                        to = max(at + 1, int(np.searchsorted(ends, base + capacity, side="right")))
                    out.append((chunk, offset + (int(ends[at - 1]) if at else 0), offset + int(ends[to - 1])))
                    at = to
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))], ["chunk", "start", "end"])

    pieces = sizes.join(broadcast_if_small(block_entries(sizes, capacity)), "_b").mapInArrow(spans, "chunk long, start long, end long")
    return pieces.groupBy("chunk").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def in_blocks(df: DataFrame, order: Column, size: Column, capacity: int, block: Column | None = None) -> DataFrame:
    """``df`` with the state before its block (ENTRY), dealt by block and sorted by ``_o`` inside it: each block can be packed as a stream."""
    entries = block_entries(block_sizes(df, order, size, block), capacity)
    rows = df.withColumn("_o", order).withColumn("_b", hash_block(F.col("_o")) if block is None else block)
    return rows.join(broadcast_if_small(entries), "_b").repartition("_b").sortWithinPartitions("_b", "_o")
