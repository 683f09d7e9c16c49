"""Exact seeded sampling without a global sort and without one task per group.

Every random draw is the rank of ``md5(seed:id)``. "The first k rows of a group in hash order" is found in three
narrow passes over (group, id): a histogram over hash prefixes, the prefix in which the quota runs out, and the
exact hash at the quota inside that prefix. The wide rows then pass a plain filter and are never shuffled, however
much of the data one group holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import hash_key
from chatloom.session import broadcast_if_small, cut_lineage

PREFIX = 4  # hexadecimal digits of the histogram: 65 536 buckets per group
ALL, NONE = "g", ""  # above and below every hexadecimal hash


def thresholds(df: DataFrame, groups: list[str], quotas: DataFrame, key, seed: int = 42, quota: str = "quota") -> DataFrame:
    """(groups, cut): rows with a hash up to ``cut`` are exactly the first ``quota`` of their group. ``key`` is unique."""
    keyed = df.select(*groups, hash_key(key, seed).alias("h")).withColumn("b", F.substring("h", 1, PREFIX))
    histogram = keyed.groupBy(*groups, "b").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(*groups).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    placed = histogram.withColumn("upto", F.sum("n").over(running)).join(broadcast_if_small(quotas), groups)
    limits = cut_lineage(
        placed.groupBy(*groups)
        .agg(
            F.max(quota).alias("q"),
            F.sum("n").alias("total"),
            F.min(F.when(F.col("upto") >= F.col(quota), F.col("b"))).alias("edge"),
            F.min_by(F.col(quota) - F.col("upto") + F.col("n"), F.when(F.col("upto") >= F.col(quota), F.col("b"))).alias("rest"),
        )
    )
    open_groups = limits.filter("q > 0 AND q < total")
    at_edge = keyed.join(broadcast_if_small(open_groups), groups).filter(F.col("b") == F.col("edge"))
    by_hash = Window.partitionBy(*groups).orderBy("h")
    exact = (
        at_edge.withColumn("rn", F.row_number().over(by_hash))
        .filter(F.col("rn") == F.col("rest"))
        .select(*groups, F.col("h").alias("found"))
    )
    return limits.join(exact, groups, "left").select(
        *groups,
        F.when(F.col("q") <= 0, NONE).when(F.col("q") >= F.col("total"), ALL).otherwise(F.col("found")).alias("cut"),
    )


def take(df: DataFrame, groups: list[str], quotas: DataFrame, key, seed: int = 42, quota: str = "quota") -> DataFrame:
    """Exactly ``quota`` rows of each group named in ``quotas`` (all rows where there are fewer)."""
    cuts = cut_lineage(thresholds(df, groups, quotas, key, seed, quota))
    return df.join(broadcast_if_small(cuts), groups).filter(hash_key(key, seed) <= F.col("cut")).drop("cut")


def cut_hash(df: DataFrame, n: int, key, seed: int = 42) -> str:
    """The hash up to which a table has exactly ``n`` rows.

    Only the prefix histogram, of fixed size, and one hash reach the driver.
    """
    if n <= 0:
        return NONE
    keyed = df.select(hash_key(key, seed).alias("h"))
    histogram = keyed.groupBy(F.substring("h", 1, PREFIX).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    reached = 0
    for b, count in sorted((r["b"], r["n"]) for r in histogram):
        if reached + count >= n:
            edge = keyed.filter(F.substring("h", 1, PREFIX) == b).orderBy("h").limit(n - reached)
            return edge.agg(F.max("h")).first()[0]
        reached += count
    return ALL


def take_n(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows of a table."""
    return df.filter(hash_key(key, seed) <= cut_hash(df, n, key, seed))


def take_fraction(df: DataFrame, fraction: float, key, seed: int = 42) -> DataFrame:
    """``max(1, int(n * fraction))`` rows."""
    return take_n(df, max(1, int(df.count() * fraction)), key, seed)


def bucket(key, buckets: int, seed: int = 42) -> Column:
    """Stable bucket number of a row."""
    return (F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def train_test(df: DataFrame, key, test_percent: int = 10, seed: int = 42) -> DataFrame:
    return df.withColumn("split", F.when(bucket(key, 100, seed) < test_percent, "test").otherwise("train"))


def first_k(df: DataFrame, groups: list[str], order: list, k: int) -> DataFrame:
    """The first k rows per group; the row-number limit is applied before the shuffle as well (k up to 1000)."""
    if k > 1000:
        raise ValueError("the limit works before the shuffle up to 1000 rows per group; use take() for more")
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def first_by_hash(df: DataFrame, groups: list[str], h: str, k: int, key: str, seed: int = 42) -> DataFrame:
    """The first k rows per group in the order of ``h``, the seeded hash of ``key``, for any k."""
    if k <= 1000:
        return first_k(df, groups, [h], k)
    quotas = df.select(*groups).distinct().withColumn("quota", F.lit(k))
    return take(df, groups, quotas, key, seed).drop("quota").select(df.columns)


def shuffled(df: DataFrame, key, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Global seeded order: a range exchange on the hash and a sort inside each partition."""
    h = hash_key(key, seed)
    ranged = df.withColumn("_h", h)
    ranged = ranged.repartitionByRange(partitions, "_h") if partitions else ranged.repartitionByRange("_h")
    return ranged.sortWithinPartitions("_h").drop("_h")
