"""Writers: partitioned languages, token shards, request files, fingerprinted tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import is_blank
from chatloom.session import broadcast_if_small, cut_lineage


def write_by_language(
    df: DataFrame, path: str, language: str, dataset: str, min_samples: int = 1, rows_per_file: int = 1_000_000, bytes_per_file: int = 64 << 20
) -> DataFrame:
    """One folder per language, blanks and rare languages left out; returns the counts of what was written.

    Rows are dealt by (language, part), a part for every ``rows_per_file`` rows or ``bytes_per_file`` of texts of a language; so there are as many files as
    the rows need, not tasks times languages, and a dominant language is written by many tasks, each of a bounded number of bytes.
    """
    named = df.filter(~is_blank(language))
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, kind in df.dtypes if kind in ("string", "binary")), F.lit(0).cast("long"))
    held = cut_lineage(named.groupBy(language).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("_bytes")).filter(F.col("n") >= min_samples))
    counts = held.drop("_bytes")
    needed = F.greatest(F.ceil(F.col("n") / rows_per_file), F.ceil(F.col("_bytes") / bytes_per_file), F.lit(1))
    parts = held.select(language, needed.alias("_parts"))
    files = parts.agg(F.coalesce(F.sum("_parts"), F.lit(1))).first()[0]
    kept = named.join(broadcast_if_small(parts), language)
    # equal rows do not meet: the place of a row is part of what it is dealt by
    dealt = kept.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts"))).repartition(files, language, "_part")
    dealt.drop("_part", "_parts").withColumn("dataset", F.lit(dataset)).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(
        "dataset", language
    ).parquet(path)
    return counts


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows and an order-insensitive content hash (exact integer sums of two row hashes), in one aggregate."""
    cols = sorted(df.columns)
    a = F.xxhash64(*cols).cast("decimal(38,0)")
    b = F.xxhash64(F.lit("second"), *cols).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", F.sum(a), F.sum(b), F.count(F.lit(1))), 256).alias("hash"))


MANIFEST = "rows long, hash string, sources array<string>, folder string"


def manifest(spark: SparkSession, path: str) -> Row | None:
    """The newest entry of a table's manifest: rows, hash, sources, and the folder of its data."""
    try:
        entries = spark.read.schema(MANIFEST + ", entry int").json(path.rstrip("/") + "_manifest")
        return entries.orderBy(F.desc("entry")).first()
    except AnalysisException:  # no entry yet
        return None


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """The table as its manifest has it; what a write that did not end has left is not seen."""
    entry = manifest(spark, path)
    if entry is None:
        raise FileNotFoundError(f"nothing has been written to {path}")
    return spark.read.parquet(entry["folder"])


def write_if_changed(df: DataFrame, path: str, sources: list[str], force: bool = False) -> bool:
    """Write a table unless its manifest already has this content; returns whether it wrote.

    The input is computed once, into a folder of its own below ``path``; its content is fingerprinted there. Only then a new entry, a folder of its own
    too, is added to the manifest, and readers (``read_written``) see the new table; a write that is killed before leaves them the old one.
    """
    spark = df.sparkSession
    old = manifest(spark, path)
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    new = fingerprint(spark.read.schema(df.schema).parquet(folder)).first()
    if old is not None and not force and old["hash"] == new["hash"]:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        return False
    entry = 1 + (old["entry"] if old is not None else 0)
    row = spark.createDataFrame([(new["rows"], new["hash"], sources, folder)], MANIFEST)
    row.coalesce(1).write.json(f"{path.rstrip('/')}_manifest/entry={entry}")
    return True


def write_token_shards(pieces: DataFrame, path: str, key: str = "doc_id") -> None:
    """Pieces of a shard in one task, in order; shards are of equal size, so tasks are as well."""
    pieces.repartition("shard").sortWithinPartitions("shard", "from").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def token_type(vocabulary: int) -> str:
    """Smallest unsigned type that holds every token id."""
    for bits in (8, 16, 32):
        if vocabulary - 1 < 2**bits:
            return f"uint{bits}"
    return "uint64"


def write_aspect_files(df: DataFrame, path: str, aspect: str = "aspect", rows: int = 250) -> None:
    """JSON lines of fixed size, one folder per aspect."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy(aspect).json(path)
