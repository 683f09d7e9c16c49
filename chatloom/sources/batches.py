"""Batch inference: request tables out, result tables in. No service is called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import message
from chatloom.functions.text import col
from chatloom.functions.tokens import token_count
from chatloom.operators.matching import last_per_id
from chatloom.operators.sampling import take_n

RESULT_DDL = """custom_id string, response struct<body struct<
  choices array<struct<finish_reason string, message struct<content string>>>,
  usage struct<prompt_tokens bigint, completion_tokens bigint, total_tokens bigint>>>"""


def request_table(df: DataFrame, key: str, prompt: str, order, model: str, prefix: str, limit: int | None = None, seed: int = 42) -> DataFrame:
    """(custom_id, body): the last row per id, optionally an exact sample, as JSON requests."""
    rows = last_per_id(df.select(key, prompt, F.col(order).alias("_order") if isinstance(order, str) else order.alias("_order")), key, F.col("_order"))
    if limit is not None:
        rows = take_n(rows, limit, key, seed)
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.array(message("user", prompt)).alias("messages")))
    return rows.select(F.concat(F.lit(prefix + "_"), F.col(key).cast("string")).alias("custom_id"), body.alias("body"))


def estimated_cost(df: DataFrame, prompt: str, output: str, input_rate: float, output_rate: float) -> DataFrame:
    """Input and output tokens and their cost at rates per million tokens."""
    t = df.agg(F.sum(token_count(prompt)).alias("input_tokens"), F.sum(token_count(output)).alias("output_tokens"))
    return t.withColumn("cost", (F.col("input_tokens") * input_rate + F.col("output_tokens") * output_rate) / 1e6)


def result_id(custom_id) -> Column:
    """The id behind the prefix: everything after the first underscore."""
    return F.regexp_replace(col(custom_id), r"\A[^_]*_", "")


def parse_results(lines: DataFrame, line: str = "value") -> DataFrame:
    """(id, finish_reason, content, tokens); blank and unreadable lines are dropped."""
    parsed = lines.filter(F.trim(line) != "").select(F.from_json(line, RESULT_DDL).alias("r")).filter("r.custom_id IS NOT NULL")
    first = F.get("r.response.body.choices", F.lit(0))
    return parsed.select(
        result_id("r.custom_id").alias("id"), first["finish_reason"].alias("finish_reason"), first["message"]["content"].alias("content"),
        F.col("r.response.body.usage").alias("usage"),
    )


def accepted(results: DataFrame) -> DataFrame:
    """Results that no content filter stopped."""
    return results.filter(~F.col("finish_reason").eqNullSafe("content_filter"))


def token_usage(results: DataFrame) -> DataFrame:
    return results.agg(*[F.sum(f"usage.{c}").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])


def join_results(df: DataFrame, results: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with content, rows without a result)."""
    found = results.select("id", "content").groupBy("id").agg(F.max("content").alias("content"))
    keyed = df.withColumn("id", F.col(key).cast("string"))
    return keyed.join(found, "id").drop("id"), keyed.join(found, "id", "left_anti").drop("id")


def with_difficulty(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Difficulty and explanation out of JSON replies, joined back by id."""
    reply = F.from_json("content", "difficulty double, explanation string")
    rows, _ = join_results(df, results, key)
    return rows.withColumn("_r", reply).withColumn("difficulty", F.col("_r.difficulty")).withColumn("explanation", F.col("_r.explanation")).drop("_r", "content")
