"""Queries: joins, duplicates and vector matches."""

from pyspark.sql import functions as F

from chatloom.catalog.registry import query
from chatloom.operators import matching as M
from chatloom.operators import vectors as V

UNIT = "list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))))"
TOP = f"""WITH e AS (SELECT vec_id, {UNIT} AS u FROM embeddings),
  p AS (SELECT q.vec_id AS query, c.vec_id AS key, round(list_dot_product(q.u, c.u), 6) AS score
        FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id % 50 <> 0),
  t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS rn FROM p)
"""


def matches(t):
    q = t.embeddings.filter("vec_id % 50 = 0")
    return V.top_matches(t.embeddings.filter("vec_id % 50 <> 0"), q, "vec_id", "embedding")


@query("jn_vector", TOP + "SELECT query, key, score FROM t WHERE rn <= 5")
def vector(t):
    return matches(t).select("query", "key", F.round("score", 6).alias("score"))


@query("jn_vector_scores", TOP + "SELECT query, score, round((1 + score) / 2, 5) AS index_score FROM t WHERE rn = 1")
def vector_scores(t):
    return V.query_scores(matches(t)).select("query", F.round("score", 6).alias("score"), F.round((1 + F.round("score", 6)) / 2, 5).alias("index_score"))


@query("jn_vector_rows", TOP + "SELECT key, max(score) AS score FROM t WHERE rn <= 5 GROUP BY key")
def vector_rows(t):
    return V.row_scores(matches(t)).select("key", F.round("score", 6).alias("score"))


@query(
    "jn_known_prompts",
    "SELECT doc_id FROM documents WHERE trim(text) NOT IN (SELECT trim(text) FROM documents WHERE source = 'src1') AND source <> 'src1'",
)
def known_prompts(t):
    docs = t.documents.select("doc_id", "source", F.trim("text").alias("p"))
    mine = docs.filter("source <> 'src1'").withColumn("prompt", F.concat(F.lit("Human: "), "p", F.lit(" Assistant: ")))
    return M.drop_known_prompts(mine, docs.filter("source = 'src1'"), "prompt", "p").select("doc_id")


@query(
    "jn_common_ids",
    """SELECT user_id, event_type, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id
       HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)) GROUP BY ALL""",
)
def common(t):
    rows = M.common_ids(t.events.select("user_id", "event_type"), "user_id", "event_type")
    return rows.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("jn_ratings", "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def ratings(t):
    return M.with_ratings(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query(
    "jn_sample_per_id",
    """SELECT o_custkey, o_orderkey, matches FROM (SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS matches,
         row_number() OVER (PARTITION BY o_custkey ORDER BY md5('42:' || o_custkey || ':' || o_orderkey)) AS rn FROM orders)
       WHERE matches >= 5 AND rn <= 5""",
)
def per_id(t):
    return M.sample_per_id(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 5)


@query(
    "jn_outcome_by_hash",
    """WITH r AS (SELECT sha256(text) AS hash, avg(quality) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY 1)
       SELECT CASE WHEN rate IS NULL THEN 'skipped' WHEN rate >= 1 THEN 'passed' ELSE 'failed' END AS outcome, count(*) AS n
       FROM documents d LEFT JOIN r ON sha256(d.text) = r.hash GROUP BY 1""",
)
def by_hash(t):
    results = t.documents.join(t.labels, "doc_id").groupBy(F.sha2("text", 256).alias("hash")).agg(F.avg("quality").alias("rate"))
    return M.outcome_by_hash(t.documents, results, "text", "rate").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "jn_aligned",
    """SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn,
         CASE WHEN a.conv_id IS NULL THEN 'no_original' WHEN b.conv_id IS NULL THEN 'no_translation' ELSE 'both' END AS presence
       FROM (SELECT * FROM conversations WHERE (conv_id + turn) % 7 <> 0) a FULL JOIN (SELECT * FROM conversations WHERE (conv_id + turn) % 5 <> 0) b
         ON a.conv_id = b.conv_id AND a.turn = b.turn""",
)
def aligned(t):
    c = t.conversations
    both = M.align_rows(c.filter("(conv_id + turn) % 7 <> 0"), c.filter("(conv_id + turn) % 5 <> 0"), ["conv_id", "turn"])
    return both.select("conv_id", "turn", "presence")


@query(
    "jn_completion_pairs",
    """SELECT a.conv_id, a.turn AS idx_a, b.turn AS idx_b, a.text AS completion_a, b.text AS completion_b FROM conversations a
       JOIN conversations b ON a.conv_id = b.conv_id AND a.turn < b.turn WHERE a.role = 'assistant' AND b.role = 'assistant'""",
)
def pairs(t):
    return M.completion_pairs(t.conversations.filter("role = 'assistant'"), "conv_id", "turn", "text")


@query("dd_last_per_id", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last(t):
    return M.last_per_id(t.events.select("user_id", "event_id", "event_type"), "user_id", F.col("event_id"))


FIRST_VALUE = "CASE WHEN event_type = 'error' THEN NULL ELSE value END"


@query(
    "dd_first_per_id",
    f"""SELECT user_id, event_id, v FROM (SELECT user_id, event_id, {FIRST_VALUE} AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        WHERE rn = 1 AND v IS NOT NULL""",
)
def first(t):
    rows = t.events.select("user_id", "event_id", F.expr(FIRST_VALUE).alias("v"))
    return M.first_per_id(rows, "user_id", F.col("event_id"), "v")


@query(
    "dd_longest_per_parent",
    "SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1",
)
def longest(t):
    return M.longest_per_parent(t.documents.select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id")


@query(
    "dd_one_per_parent",
    "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id)) AS rn FROM documents) WHERE rn = 1",
)
def one(t):
    return M.one_per_parent(t.documents.select("source", "doc_id"), "source", "doc_id")


@query(
    "dd_latest_annotation",
    """SELECT instance, evaluator, preference FROM (SELECT user_id AS instance, event_id % 4 AS evaluator, event_type AS preference,
         row_number() OVER (PARTITION BY user_id, event_id % 4 ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest(t):
    rows = t.events.select(F.col("user_id").alias("instance"), (F.col("event_id") % 4).alias("evaluator"), F.col("event_type").alias("preference"), "ts")
    return M.latest_annotations(rows, "instance", "evaluator", "ts").select("instance", "evaluator", "preference")


@query("dd_prompts", "SELECT text, min(conv_id) AS conv_id FROM conversations WHERE role = 'user' AND turn = 0 GROUP BY text")
def prompts(t):
    first_turns = t.conversations.filter("role = 'user' AND turn = 0").select("text", "conv_id")
    return M.first_per_id(first_turns, "text", F.col("conv_id"))


@query("dd_prompt_hash", "SELECT doc_id, sha256(text || doc_id::VARCHAR) AS id FROM documents")
def hashes(t):
    return t.documents.select("doc_id", M.prompt_id("text", "doc_id").alias("id"))
