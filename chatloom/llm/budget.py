"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is met by whole passes over its documents, then by one more copy of some of them. The documents are counted by exact
length. Every length first gives its share of what remains (largest remainders next), and a bounded-knapsack dynamic program
over the counts that are left closes the last window. Which documents of a length are taken follows a seeded hash of their id.

Edge cases: a null text has size 0 and is taken 0 times; a null source is a source of its own, last in order; an empty table gives an empty
result; repeated rows are rows of their own; documents of equal length are told apart by the seeded hash, identical rows are
interchangeable. Input columns pass through unless they have the name of a result column, which then replaces them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import keeps_underscored, n_words, null_safe, ranked

MAX_SOURCES = 100_000  # a mixture lists its sources; more than this is refused, never cut
WINDOW = 4096  # the last words of a budget are closed exactly by the dynamic program


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3) -> dict[str | None, float]:
    """Share the total size by weight; what exceeds ``max_copies`` times a source's size is shared among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, free = float(sum(sizes.values())), {}, list(order)
    while free:
        share = total / sum(weight[s] for s in free)
        full = [s for s in free if share * weight[s] > max_copies * sizes[s]]
        if not full:
            return out | {s: share * weight[s] for s in free}
        for s in full:
            out[s] = float(max_copies * sizes[s])
            total -= out[s]
        free = [s for s in free if s not in out]
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int, cap: int) -> list[int]:
    """Copies per length (at most ``counts``) whose total is as near to ``budget`` as any total up to ``cap``; the lower of two.

    Reachable totals are the bits of an integer. Each length is offered in parts of 1, 2, 4 ... pieces, so that any count can be
    made; the states before each part are kept and walked back.
    """
    take, mask, reach, states = [0] * len(lengths), (1 << (cap + 1)) - 1, 1, []
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count = min(count, cap // length)
        part = 1
        while count > 0 and not reach >> budget & 1:
            n = min(part, count)
            states.append((i, n, reach))
            reach |= reach << (n * length) & mask
            count, part = count - n, part * 2
    low = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    high = budget + 1 + (above & -above).bit_length() - 1 if above else None
    total = high if high is not None and high - budget < budget - low else low
    for i, n, before in reversed(states):
        if not before >> total & 1:
            total -= n * lengths[i]
            take[i] += n
    return take


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """Documents of each length that take one more copy, so that their words come to ``budget``."""
    total = sum(x * n for x, n in zip(lengths, counts, strict=True))
    if budget <= 0 or total == 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    take = [n * budget // total for n in counts]
    left = budget - sum(x * n for x, n in zip(lengths, take, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: (-(counts[i] * budget % total), lengths[i])):
        if take[i] < counts[i] and lengths[i] <= left - WINDOW:
            take[i] += 1
            left -= lengths[i]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):  # where few lengths hold most documents
        n = min(counts[i] - take[i], (left - WINDOW) // lengths[i]) if lengths[i] and left > WINDOW else 0
        take[i] += n
        left -= n * lengths[i]
    rest = [i for i in range(len(lengths)) if 0 < lengths[i] <= 2 * max(left, WINDOW) and take[i] < counts[i]]
    rest.sort(key=lambda i: lengths[i])
    more = knapsack([lengths[i] for i in rest], [counts[i] - take[i] for i in rest], left, 2 * max(left, WINDOW)) if left and rest else []
    for i, n in zip(rest, more, strict=False):
        take[i] += n
    return take


@keeps_underscored
def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 42, source: str = "source", key: str = "doc_id", size: str = "size") -> DataFrame:
    """``docs`` with ``source_size``, ``target`` (of the document's source) and ``copies`` (0 to ``max_copies``).

    ``docs`` is read three times (sizes by source, counts by length, the rows themselves); hand over a written table. It is shuffled once, by
    (source, length, salt), so that a source or a length with most of the rows is split. Only counts per source reach the driver.
    """
    is_null, name = null_safe(source)
    rows = docs.drop("source_size", "target", "copies").withColumns(
        {"_null": is_null, "_name": name, "_size": F.col(size), "_hash": F.xxhash64(F.lit(seed), F.col(key))}
    )
    counts = rows.groupBy("_null", "_name", "_size").agg(F.count(F.lit(1)).alias("_count"))
    found = rows.groupBy("_null", "_name").agg(F.sum("_size").alias("s")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mixture of more than {MAX_SOURCES} sources")
    sizes = {None if r["_null"] else r["_name"]: r["s"] for r in found}
    goal = targets(sizes, weights, max_copies)

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        s = None if pdf["_null"].iloc[0] else pdf["_name"].iloc[0]
        pdf = pdf.sort_values("_size")
        passes = min(max_copies, int(goal[s] // sizes[s])) if sizes[s] else 0
        budget = round(goal[s] - passes * sizes[s]) if passes < max_copies else 0
        more = fit(pdf["_size"].tolist(), pdf["_count"].tolist(), budget)
        return pdf[["_null", "_name", "_size"]].assign(source_size=sizes[s], target=goal[s], _passes=passes, _more=more)

    # one row per (source, length): a source's group is its distinct lengths, however many documents it has
    plan = counts.groupBy("_null", "_name").applyInPandas(
        quotas, "_null boolean, _name string, _size long, source_size long, target double, _passes long, _more long"
    )
    out = ranked(rows, ["_null", "_name", "_size"], ["_hash", key], extra=plan)
    taken = F.when(F.col("_size") > 0, F.col("_passes") + (F.col("_rank") < F.col("_more")).cast("long")).otherwise(F.lit(0))
    return out.withColumn("copies", taken).drop("_null", "_name", "_size", "_hash", "_rank", "_passes", "_more")


def with_sizes(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """``docs`` with the number of words of the text."""
    return docs.withColumn(size, n_words(F.col(text)))


@keeps_underscored
def repeated(mixed: DataFrame) -> DataFrame:
    """One row per copy; documents that the mix leaves out go."""
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("_copy")

