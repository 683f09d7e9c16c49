"""The corpus pipeline: quality classifier, line deduplication, near-duplicate join, source mixture, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm import budget, jaccard, lines, passages, quality
from chatloom.llm.frames import WORD, cut, saved, set_aside
from chatloom.llm.queries import packed, table
from chatloom.session import broadcast_if_small


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labelled rows of ``docs`` that are not held out."""
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels")))
    return quality.kept(docs, model, threshold=0.7)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, then later repeated passages that begin or end inside a line; documents that lose their last word with them go too."""
    docs, back = set_aside(docs, ("n_lines", "n_removed", "cut_words"))
    out = saved(lines.dedup_lines(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD)), "lines")
    out = passages.dedup_passages(out).filter(~F.col("cut_words") | F.col("text").rlike(WORD))
    changed = (F.col("n_removed") > 0) | F.col("cut_words")
    return back(out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one of the smallest id. Documents without an id name no group and stay."""
    found = cut(jaccard.join(docs, percent=80, words=5))
    gone = found.filter((F.col("component_id") != F.col("doc_id"))).select("doc_id").distinct()
    left = docs.join(broadcast_if_small(gone), "doc_id", "left_anti")
    # rows that repeat an id: one of them stays for each group of texts without words, or the whole group
    again = found.filter("doc_id IS NOT NULL AND component_id = doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    again = cut(again)
    if again.limit(1).count() == 0:
        return left.select(docs.columns)
    again = broadcast_if_small(again)
    copies = left.join(again, "doc_id", "left_semi").withColumn("_row", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))))
    return left.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(copies.filter("_row = 1").select(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights; documents that the mix takes more than once repeat."""
    docs, back = set_aside(docs, ("source_size", "target", "copies", "_words"))
    sized = budget.with_sizes(docs, size="_words")
    return back(budget.repeated(budget.mix(sized, weights=(5, 2, 1), max_copies=3, size="_words")).select(docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packed(docs)


STAGES = [
    ("quality_classifier", classify), ("line_dedup", dedup_lines), ("jaccard_join", near_duplicates), ("budget_mixture", mix_sources), ("bin_packing", pack),
]

# The classifier is trained and the mixture is drawn by a seeded hash, which SQL does not say; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
