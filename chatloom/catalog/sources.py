"""Queries: readers, writers, batch requests and results."""

from pyspark.sql import functions as F

from chatloom.catalog.registry import query
from chatloom.catalog.tokens import toks
from chatloom.session import work_path
from chatloom.sources import batches as B
from chatloom.sources import sinks as W
from chatloom.sources import tables as R


@query("io_read_parquet", "SELECT doc_id, lang FROM documents")
def read_parquet(t):
    return R.read_table(t.spark, t.path("documents"), "doc_id long, lang string")


@query("io_read_jsonl", "SELECT conv_id, turn, role, text FROM conversations")
def read_jsonl(t):
    path = work_path(t.spark, "turns") + ".jsonl"
    t.conversations.write.json(path)
    return R.read_table(t.spark, path, "conv_id long, turn long, role string, text string")


@query(
    "io_by_language",
    "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents WHERE doc_id % 10 <> 0 GROUP BY lang HAVING count(*) >= 20",
)
def by_language(t):
    path = work_path(t.spark, "languages")
    rows = t.documents.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, " ").otherwise(F.col("lang")))
    W.write_by_language(rows, path, "lang", "docs", min_samples=20)
    back = t.spark.read.parquet(path)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("io_fingerprint", "SELECT count(*) AS rows, true AS order_free, true AS sees_change FROM documents")
def fingerprint(t):
    a, b, c = (
        W.fingerprint(d).first()
        for d in (t.documents, t.documents.repartition(5, "text"), t.documents.withColumn("n_chars", F.col("n_chars") + F.expr("int(doc_id = 3)")))
    )
    one = W.fingerprint(t.documents)
    return one.select("rows", F.lit(a["hash"] == b["hash"]).alias("order_free"), F.lit(a["hash"] != c["hash"]).alias("sees_change"))


@query(
    "io_write_if_changed",
    """SELECT 'first' AS step, true AS wrote, count(*) AS rows FROM documents UNION ALL SELECT 'same', false, count(*) FROM documents
       UNION ALL SELECT 'changed', true, count(*) FROM documents WHERE doc_id > 5""",
)
def write_if_changed(t):
    path = work_path(t.spark, "mixture")
    steps = []
    for step, rows in (("first", t.documents), ("same", t.documents), ("changed", t.documents.filter("doc_id > 5"))):
        wrote = W.write_if_changed(rows, path, ["docs"])
        steps.append(W.read_written(t.spark, path).agg(F.lit(step).alias("step"), F.lit(wrote).alias("wrote"), F.count(F.lit(1)).alias("rows")))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query(
    "io_aspect_files",
    "SELECT a AS aspect, count(*) AS n, true AS small_files FROM documents, (VALUES ('honesty'), ('helpfulness')) v(a) GROUP BY a",
)
def aspect_files(t):
    path = work_path(t.spark, "aspects")
    rows = t.documents.select("doc_id", F.explode(F.array(F.lit("honesty"), F.lit("helpfulness"))).alias("aspect"))
    W.write_aspect_files(rows, path)
    per_file = t.spark.read.schema("doc_id long, aspect string").json(path).groupBy("aspect", F.col("_metadata.file_path").alias("f")).count()
    return per_file.groupBy("aspect").agg(F.sum("count").alias("n"), (F.max("count") <= 250).alias("small_files"))


@query(
    "io_requests",
    """SELECT 'job_' || user_id AS custom_id, to_json({'model': 'm', 'messages': [{'role': 'user', 'content': 'say ' || arg_max(event_type, event_id)}]})::VARCHAR AS body
       FROM events GROUP BY user_id""",
)
def requests(t):
    rows = t.events.select("user_id", F.concat(F.lit("say "), "event_type").alias("prompt"), "event_id")
    return B.request_table(rows, "user_id", "prompt", "event_id", "m", "job")


@query(
    "io_request_cost",
    f"""SELECT sum(len({toks('source')}))::BIGINT AS input_tokens, sum(len({toks('text')}))::BIGINT AS output_tokens,
        round((sum(len({toks('source')})) * 2.5::DOUBLE + sum(len({toks('text')})) * 10) / 1e6, 6) AS cost FROM documents""",
)
def cost(t):
    return B.estimated_cost(t.documents, "source", "text", 2.5, 10.0).withColumn("cost", F.round("cost", 6))


LINE = """CASE doc_id % 6 WHEN 0 THEN '  ' WHEN 1 THEN 'no json' ELSE concat('{"custom_id": "job_', doc_id, '", "response": {"body": {"choices": [{"finish_reason": "',
  CASE doc_id % 6 WHEN 2 THEN 'content_filter' ELSE 'stop' END, '", "message": {"content": "{\\\\"difficulty\\\\": ', doc_id % 10, '}"}}], "usage": {"prompt_tokens": ', doc_id, ', "completion_tokens": 2, "total_tokens": ', doc_id + 2, '}}}}') END"""


def results(t):
    return B.parse_results(t.documents.select(F.expr(LINE).alias("value")))


@query("io_results", "SELECT doc_id, '{\"difficulty\": ' || doc_id % 10 || '}' AS content FROM documents WHERE doc_id % 6 NOT IN (0, 1, 2)")
def joined(t):
    return B.join_results(t.documents, B.accepted(results(t)), "doc_id")[0].select("doc_id", "content")


@query("io_results_unmatched", "SELECT doc_id FROM documents WHERE doc_id % 6 IN (0, 1, 2)")
def unmatched(t):
    return B.join_results(t.documents, B.accepted(results(t)), "doc_id")[1].select("doc_id")


@query(
    "io_token_usage",
    "SELECT sum(doc_id)::BIGINT AS prompt_tokens, sum(2)::BIGINT AS completion_tokens, sum(doc_id + 2)::BIGINT AS total_tokens FROM documents WHERE doc_id % 6 NOT IN (0, 1, 2)",
)
def usage(t):
    return B.token_usage(B.accepted(results(t)))


@query("io_difficulty", "SELECT doc_id, (doc_id % 10)::DOUBLE AS difficulty FROM documents WHERE doc_id % 6 NOT IN (0, 1, 2)")
def difficulty(t):
    return B.with_difficulty(t.documents.select("doc_id"), B.accepted(results(t)), "doc_id").select("doc_id", "difficulty")


@query(
    "io_summary_metrics",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 11 WHEN 2 THEN 14 END::INT AS place, CASE doc_id % 4 WHEN 0 THEN 'alpaca_eval' WHEN 1 THEN 'truthfulqa' WHEN 2 THEN 'xstest' END AS task,
         CASE doc_id % 4 WHEN 0 THEN 'win_rate:model-greedy-long' WHEN 1 THEN 'truth-info acc' WHEN 2 THEN 'gpt4_label:refusal_prf:f1' END AS metric,
         round(CASE doc_id % 4 WHEN 0 THEN n_chars / 100.0::DOUBLE / 100 ELSE n_chars / 100.0::DOUBLE END, 4) AS value FROM documents WHERE doc_id % 4 <> 3""",
)
def summary(t):
    text = """CASE doc_id % 4 WHEN 0 THEN concat('{"win_rate": {"model-greedy-long": ', n_chars / 100, '}}') WHEN 1 THEN concat('{"truth-info acc": ', n_chars / 100, '}')
      WHEN 2 THEN concat('{"gpt4_label": {"refusal_prf": {"f1": ', n_chars / 100, '}}}') ELSE '{}' END"""
    task = "CASE doc_id % 4 WHEN 0 THEN 'alpaca_eval' WHEN 1 THEN 'truthfulqa' WHEN 2 THEN 'xstest' ELSE 'other' END"
    d = t.documents.select("doc_id", F.expr(task).alias("task"), F.expr(text).alias("metrics"))
    return R.summary_metrics(d, "task", "metrics", ["doc_id"])


@query(
    "io_read_results",
    """SELECT doc_id, n_chars, 'A' || doc_id % 4 || '-75en' AS experiment, CASE WHEN doc_id % 4 = 1 THEN 'rubric' ELSE 'winrate' END AS mode,
         CASE WHEN doc_id % 4 = 3 THEN 'final' ELSE (doc_id % 4 * 500)::VARCHAR END AS step, CASE WHEN doc_id % 4 <> 3 THEN (doc_id % 4 * 500)::INT END AS step_number
       FROM documents WHERE doc_id % 5 < 4""",
)
def read_results(t):
    root = work_path(t.spark, "results")
    rows = t.documents.select("doc_id", "n_chars")
    for i in range(4):  # one folder per run, as evaluations leave them, and one that is none
        step, mode = "final" if i == 3 else str(500 * i), "rubric" if i == 1 else "winrate"
        rows.filter((F.col("doc_id") % 4 == i) & (F.col("doc_id") % 5 < 4)).write.json(f"{root}/multilingual-eu-A{i}-75en-{mode}-step{step}-x/part")
    rows.filter("doc_id % 5 = 4").write.json(f"{root}/other")
    return R.read_results(t.spark, root, "doc_id long, n_chars long")


@query(
    "io_result_paths",
    """SELECT doc_id, 'A' || doc_id % 9 || '-75en' AS experiment, CASE WHEN doc_id % 2 = 0 THEN 'winrate' ELSE 'rubric' END AS mode,
         CASE WHEN doc_id % 5 = 0 THEN 'final' ELSE doc_id::VARCHAR END AS step, CASE WHEN doc_id % 5 <> 0 THEN doc_id::INT END AS step_number FROM documents""",
)
def result_paths(t):
    path = "concat('/results/multilingual-eu-A', doc_id % 9, '-75en-', CASE WHEN doc_id % 2 = 0 THEN 'winrate' ELSE 'rubric' END, '-step', CASE WHEN doc_id % 5 = 0 THEN 'final' ELSE string(doc_id) END, '-', lang, '/r.json')"
    d = t.documents.select("doc_id", F.expr(path).alias("p"))
    return d.select("doc_id", *[c.alias(n) for n, c in R.result_coordinates("p").items()])
