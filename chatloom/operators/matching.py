"""Equi-joins on ids, hashes and prompts; duplicate rules that reduce before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import col, hash_key
from chatloom.operators.sampling import first_k


# --- joins -----------------------------------------------------------------------------------

def clean_prompt(text) -> Column:
    c = F.regexp_replace(col(text), r"(?iU)\A\s*Human:\s*", "")
    return F.regexp_replace(c, r"(?iU)\s*Assistant:\s*\z", "")


def drop_known_prompts(df: DataFrame, known: DataFrame, prompt: str, known_prompt: str) -> DataFrame:
    """Rows whose cleaned prompt occurs in the other corpus are dropped. The other side is made distinct first."""
    seen = known.select(clean_prompt(known_prompt).alias("_p")).distinct()
    return df.withColumn("_p", clean_prompt(prompt)).join(seen, "_p", "left_anti").drop("_p")


def common_ids(df: DataFrame, key: str, model: str) -> DataFrame:
    """Rows of the ids that every model has."""
    models = df.select(model).distinct().count()
    full = df.groupBy(key).agg(F.count_distinct(model).alias("n")).filter(F.col("n") == models).select(key)
    return df.join(full, key, "left_semi")


def with_ratings(df: DataFrame, ratings: DataFrame, key: str) -> DataFrame:
    return df.join(ratings, key, "left")


def sample_per_id(df: DataFrame, key: str, sample: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in hash order of the ids that have at least n, with the number of matches."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("matches")).filter(F.col("matches") >= n)
    drawn = first_k(df.withColumn("_h", hash_key(F.concat_ws(":", key, sample), seed)), [key], ["_h"], n).drop("_h")
    return drawn.join(counts, key)


def outcome_by_hash(df: DataFrame, results: DataFrame, text: str, rate: str, threshold: float = 1.0) -> DataFrame:
    """passed / failed / skipped per row, looked up by the SHA-256 of the text. Results hold one row per hash."""
    looked_up = df.withColumn("hash", F.sha2(col(text), 256)).join(results, "hash", "left")
    return looked_up.withColumn(
        "outcome", F.when(F.col(rate).isNull(), "skipped").when(F.col(rate) >= threshold, "passed").otherwise("failed")
    )


def align_rows(original: DataFrame, translated: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on explicit row ids; a row missing on one side shows up as such."""
    a = original.select(*keys, F.col("text").alias("original"), F.lit(1).alias("_a"))
    b = translated.select(*keys, F.col("text").alias("translated"), F.lit(1).alias("_b"))
    return a.join(b, keys, "full_outer").select(
        *keys, "original", "translated",
        F.when(F.col("_a").isNull(), "no_original").when(F.col("_b").isNull(), "no_translation").otherwise("both").alias("presence"),
    )


def completion_pairs(df: DataFrame, prompt: str, idx: str, completion: str) -> DataFrame:
    """All unordered pairs of the completions of a prompt; the pairs are the work list of the judge.

    The pairs are formed per prompt from (index, completion) rows by an equi-join on the prompt, so a prompt with
    very many samples is split by the skew join instead of landing in one task.
    """
    left = df.select(prompt, F.col(idx).alias("idx_a"), F.col(completion).alias("completion_a"))
    right = df.select(prompt, F.col(idx).alias("idx_b"), F.col(completion).alias("completion_b"))
    return left.join(right, (left[prompt] == right[prompt]) & (F.col("idx_a") < F.col("idx_b"))).drop(right[prompt])


# --- duplicates ------------------------------------------------------------------------------

def last_per_id(df: DataFrame, key: str, order) -> DataFrame:
    """The last row of each id: an aggregate, so hot ids shrink before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def first_per_id(df: DataFrame, key: str, order, required: str | None = None) -> DataFrame:
    """The first row of each id; a missing required value drops the id afterwards."""
    rest = [c for c in df.columns if c != key]
    out = df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
    return out if required is None else out.filter(F.col(required).isNotNull())


def longest_per_parent(df: DataFrame, parent: str, size, key: str) -> DataFrame:
    rest = [c for c in df.columns if c != parent]
    best = F.struct(col(size).cast("long"), -F.col(key))
    return df.groupBy(parent).agg(F.max_by(F.struct(*rest), best).alias("r")).select(parent, "r.*")


def one_per_parent(df: DataFrame, parent: str, key: str, seed: int = 42) -> DataFrame:
    rest = [c for c in df.columns if c != parent]
    return df.groupBy(parent).agg(F.min_by(F.struct(*rest), hash_key(key, seed)).alias("r")).select(parent, "r.*")


def latest_annotations(df: DataFrame, instance: str, evaluator: str, time: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (instance, evaluator)]
    return df.groupBy(instance, evaluator).agg(F.max_by(F.struct(*rest), F.col(time)).alias("r")).select(instance, evaluator, "r.*")


def prompt_id(text, key) -> Column:
    return F.sha2(F.concat(col(text), col(key).cast("string")), 256)
