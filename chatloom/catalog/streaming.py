"""Queries: streaming jobs over the given tables, compared with their batch twins."""

from pyspark.sql import functions as F

from chatloom.catalog.filters import sql_text
from chatloom.catalog.registry import query
from chatloom.catalog.tokens import toks
from chatloom.functions import tokens as T
from chatloom.operators import filters as L
from chatloom.session import work_path
from chatloom.streaming import jobs as J


def stream(t, name):
    # the braces make it a pattern, which takes a table of one file and a folder of files alike
    return J.file_stream(t.spark, f"{t.sf_dir}/{{{name}.parquet}}", t.spark.read.parquet(t.path(name)).schema)


def folders(t, name):
    base = work_path(t.spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query("st_incremental", f"SELECT doc_id, lang, len({toks('text')}) AS n FROM documents WHERE lang <> 'en'")
def incremental(t):
    out, checkpoint = folders(t, "incremental")
    plan = lambda s: s.filter("lang <> 'en'").select("doc_id", "lang", T.token_count("text").cast("long").alias("n"))
    J.process_incrementally(stream(t, "documents"), plan, out, checkpoint)
    J.process_incrementally(stream(t, "documents"), plan, out, checkpoint)  # a second run finds nothing new
    return t.spark.read.parquet(out)


@query(
    "st_filter",
    f"SELECT conv_id, turn FROM conversations WHERE role = 'assistant' AND NOT regexp_matches(lower(text), {sql_text(L.vendor_pattern())}) AND len({toks('text')}) <= 120",
)
def stream_filter(t):
    out, checkpoint = folders(t, "filter")
    keep = (F.col("role") == "assistant") & ~L.mentions_vendor("text") & (T.token_count("text") <= 120)
    J.keep_rows(stream(t, "conversations"), keep, out, checkpoint)
    return t.spark.read.parquet(out).select("conv_id", "turn")


GROUPS = """WITH s AS (SELECT user_id, event_id, CASE WHEN user_id % 3 = 0 THEN 5 ELSE value END::DOUBLE AS score, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 4 AS g FROM events),
  c AS (SELECT *, count(*) OVER w AS n, avg(score) OVER w AS m, stddev_pop(score) OVER w AS d FROM s WINDOW w AS (PARTITION BY user_id, g))
"""


def groups(t):
    out, checkpoint = folders(t, "groups")
    rows = stream(t, "events").withColumn("score", F.when(F.col("user_id") % 3 == 0, 5.0).otherwise(F.col("value")))
    J.rollout_groups(rows, "user_id", "event_id", "score", "ts", 4, out, checkpoint)
    return t.spark.read.parquet(out)


@query(
    "st_rollout_groups",
    GROUPS + "SELECT user_id AS prompt, event_id AS sample, round((score - m) / (d + 1e-8::DOUBLE), 6) AS advantage FROM c WHERE n = 4 AND d > 0",
)
def rollout_groups(t):
    return groups(t).filter("NOT dropped AND NOT timed_out").select("prompt", "sample", F.round("advantage", 6).alias("advantage"))


@query("st_dropped_groups", GROUPS + "SELECT count(*) // 4 AS dropped, 0::BIGINT AS zero, count(*) // 4 AS solved, 0::BIGINT AS other FROM c WHERE n = 4 AND d = 0")
def dropped(t):
    return J.dropped_tally(groups(t), 4, 5.0)


@query("st_solved_prompts", "SELECT user_id FROM events GROUP BY user_id HAVING avg(value) / 20 >= 0.5")
def solved(t):
    out, checkpoint = folders(t, "solved")
    J.solved_table(stream(t, "events"), "user_id", F.col("value"), out, checkpoint)
    return J.solved(t.spark, out, "user_id", 20.0, 0.5)


@query("st_accounting", f"SELECT source, count(*) AS rows, sum(len({toks('text')}))::BIGINT AS tokens FROM documents GROUP BY source")
def accounting(t):
    out, checkpoint = folders(t, "accounting")
    J.accounting_table(stream(t, "documents"), "source", T.token_count("text"), out, checkpoint)
    return J.current(t.spark, out, ["source"])


@query("st_latest_votes", "SELECT user_id, event_id % 4 AS evaluator, arg_max(event_type, ts) AS event_type FROM events GROUP BY ALL")
def votes(t):
    out, checkpoint = folders(t, "votes")
    rows = J.event_time(stream(t, "events"), "ts").withColumn("evaluator", F.col("event_id") % 4)
    J.latest_votes(rows, "user_id", "evaluator", "ts", "event_type", out, checkpoint)
    return J.newest_votes(t.spark, out, "user_id", "evaluator", "ts", "event_type").select("user_id", "evaluator", "event_type")
