"""Shared helpers: tables cut off in the shared folder, and exact ranks without a task per group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.session import broadcast_if_small, shared_dir, work_path

# The white space of the contracts, space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: computed once, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Broadcast within a measured bound that leaves a small driver room; beyond it the join shuffles."""
    return broadcast_if_small(df, max_rows=200_000, max_bytes=16 * 1024 * 1024)


def released(batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A kernel whose worker gives its free memory back when a task ends; workers live on from stage to stage."""

    def kernel(parts: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow

        try:
            yield from batches(parts)
        finally:
            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library has no such call
                pass

    return kernel


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Hand texts to Python in batches of at most ``rows``, for the jobs that run inside; the session's own setting comes back after them."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go when a query ends, not when the driver happens to collect its garbage; for operators that run many
    queries and read each result from where ``cut`` wrote it. The session's own setting comes back after them."""
    before = spark.conf.get(DROPPED, "false")
    spark.conf.set(DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(DROPPED, before)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with those of ``names`` that it has as columns called otherwise, and the way back."""
    wanted = {n.lower() for n in names}
    moved = {c: f"{c} of the input" for c in df.columns if c.lower() in wanted}
    return df.withColumnsRenamed(moved), lambda out: out.withColumnsRenamed({new: old for old, new in moved.items()})


def keeps_underscored(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose own columns begin with an underscore, made safe for input columns that do; those it is told to read stay as they are."""

    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        read = {a for a in (*args, *kwargs.values()) if isinstance(a, str)}
        df, back = set_aside(df, [c for c in df.columns if c.startswith("_") and c not in read])
        return back(operator(df, *args, **kwargs))

    return run


def text_of(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def n_words(c: Column) -> Column:
    """Number of words of a text: places where a word begins."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def null_safe(c: str) -> tuple[Column, Column]:
    """A nullable string key as two columns that are never null."""
    return F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))


def salted(df: DataFrame, order: list[str], cell_rows: int, rows: int | None = None) -> DataFrame:
    """``df`` with ``_salt``: rows of a key are dealt over so many cells that a cell holds about ``cell_rows`` rows, even if one
    key has them all. The salt is a hash of ``order``, so reruns and retries agree."""
    total = df.count() if rows is None else rows
    cells = max(1, -(-total // cell_rows))
    return df.withColumn("_salt", F.pmod(F.xxhash64(F.lit(17), *order), F.lit(cells)))


def ranked(df: DataFrame, keys: list[str], order: list[str], extra: DataFrame | None = None, sums: list[str] = (), cell_rows: int = 256) -> DataFrame:
    """``df`` with ``_rank``, the 0-based position of a row among the rows of equal ``keys``.

    Rows of a key are dealt over cells by a hash of ``order``; a cell's first position is the sum of the cells before it, and rows
    are numbered inside their cell only. ``df`` is shuffled once, by cell; the cells are a narrow table. ``keys`` must not be null.
    ``extra`` (one row per key) is attached to the cells. For each name in ``sums``, ``_sum_<name>`` is the sum of that column over
    the rows of the key before this one.
    """
    parts = salted(df, order, cell_rows)
    cell = [*keys, "_salt"]
    cells = parts.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *cell,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
    )
    if extra is not None:
        cells = cells.join(extra, keys, "left")
    inside = Window.partitionBy(*cell).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumns(
        {"_row": F.row_number().over(inside)} | {f"_in_{s}": F.coalesce(F.sum(s).over(upto), F.lit(0)) for s in sums}
    )
    out = numbered.join(cells, cell).withColumns(
        {"_rank": F.col("_first") + F.col("_row") - 1} | {f"_sum_{s}": F.col(f"_before_{s}") + F.col(f"_in_{s}") for s in sums}
    )
    return out.drop("_salt", "_row", "_first", *[f"_before_{s}" for s in sums], *[f"_in_{s}" for s in sums])
