"""Global positions and running totals without one global task.

Rows get a block from their order key; block totals are summed over the small block table and added to a running
sum inside each block. The blocks are a function of the key, so a lost task recomputes the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import broadcast_if_small, cut_lineage

BLOCK_DIGITS = 4


def hash_block(order: Column, digits: int = BLOCK_DIGITS) -> Column:
    """Block of a hexadecimal hash: its leading digits, in hash order and of even size."""
    return F.substring(order, 1, digits)


def running_total(df: DataFrame, order: Column, value: Column, name: str, block: Column | None = None, groups: list[str] = ()) -> DataFrame:
    """Sum of ``value`` over all earlier rows in ``order`` (exclusive), per group if any.

    ``block`` must rise with ``order``; by default the order is a hexadecimal hash and the block its prefix.
    """
    block = hash_block(order) if block is None else block
    rows = df.withColumn("_o", order).withColumn("_v", value).withColumn("_b", block)
    keys = [*groups, "_b"]
    totals = rows.groupBy(*keys).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # the block table is kept: it is read for the size check and for the join
    offsets = cut_lineage(totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*keys).orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_s", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return local.join(broadcast_if_small(offsets), keys).withColumn(name, F.col("_off") + F.col("_s")).drop("_o", "_v", "_b", "_off", "_s")


def row_numbers(df: DataFrame, order: Column, name: str, block: Column | None = None, groups: list[str] = (), start: int = 0) -> DataFrame:
    return running_total(df, order, F.lit(1), name, block, groups).withColumn(name, F.col(name) + start)
