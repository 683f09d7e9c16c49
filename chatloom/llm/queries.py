"""One query per operator over its whole table, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import budget, divergence, jaccard, licences, lines, pq, quality, repair, rules, secret_scan, slack, template, warc
from chatloom.llm.frames import cut

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model, threshold=0.7)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secrets")).alias("spans"),
    )


def op3_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = slack.pack(docs, tokenizer_path(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), percent=80, words=5)


def op7_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract(table(spark, sf_dir, "pages"))


def op8_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op9_budget_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(budget.with_sizes(table(spark, sf_dir, "documents")).select("doc_id", "source", "size"))
    mixed = budget.mix(sizes, weights=(5, 2, 1), max_copies=3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        licences.listed(base).alias("base_labels"), licences.listed(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(rows))
    ids = rows.select("conv_id").distinct().withColumn("_c", F.struct("conv_id"))
    audits = found.audits.withColumn("_c", F.struct("conv_id")).drop("conv_id")
    hashes = repair.digests(found.turns).withColumn("_c", F.struct("conv_id")).drop("conv_id")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return ids.join(audits, "_c", "left").join(hashes, "_c", "left").select(
        "conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=3, top=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_secret_scan, op3_bin_packing, op4_warc_derivatives, op5_decision_list, op6_jaccard_join, op7_template_extraction,
        op8_product_quantisation, op9_budget_mixture, op10_line_dedup, op11_licence_scan, op12_conversation_repair,
        op13_divergence_audit,
    )
}
