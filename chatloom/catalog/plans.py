"""Queries: whole plans and the step registry."""

from pyspark.sql import functions as F

from chatloom import registry
from chatloom.catalog.registry import query
from chatloom.catalog.tokens import SEGS, toks
from chatloom.functions.chat import chat_rows
from chatloom.plans.shards import build_shards
from chatloom.session import work_path


def chats_of(t, rest):
    return chat_rows(t.conversations.filter(F.col("conv_id") % 2 == rest))


COUNTS = f"""c AS (SELECT conv_id, sum(len({toks('seg')})) AS n, sum(CASE WHEN role <> 'assistant' THEN 0 WHEN prev <> 'assistant' THEN len({toks('seg')}) - 5 ELSE len({toks('seg')}) END) AS t,
    sum((role = 'assistant')::INT) AS a FROM {SEGS} GROUP BY conv_id)"""


@query(
    "plan_token_shards",
    f"""WITH {COUNTS}, x AS (SELECT 'even' AS s, conv_id, row_number() OVER (ORDER BY md5('42:' || conv_id)) AS rn, count(*) OVER () AS total FROM c WHERE conv_id % 2 = 0),
      m AS (SELECT s, conv_id FROM x WHERE rn <= floor(total * 0.5::DOUBLE) UNION ALL SELECT 'odd', conv_id FROM c, generate_series(0, 1) WHERE conv_id % 2 = 1),
      f AS (SELECT s, n, t, a FROM m JOIN c USING (conv_id)),
      g AS (SELECT s, count(*) AS initial, count(*) FILTER (n <= 900 AND a > 0) AS final, coalesce(sum(n) FILTER (n <= 900 AND a > 0), 0)::BIGINT AS tokens, coalesce(sum(t) FILTER (n <= 900 AND a > 0), 0)::BIGINT AS trainable FROM f GROUP BY s)
      SELECT s AS dataset_source, initial, final, tokens, trainable FROM g UNION ALL SELECT 'overall', sum(initial)::BIGINT, sum(final)::BIGINT, sum(tokens)::BIGINT, sum(trainable)::BIGINT FROM g""",
)
def token_shards(t):
    steps = [("tokenize_mask_assistant", {"max_length": 100000}), ("length_filter", {"max_total": 900})]
    base = work_path(t.spark, "plan")
    report = build_shards([("even", chats_of(t, 0), "0.5"), ("odd", chats_of(t, 1), "2.0")], "conv_id", steps, f"{base}/shards", 5000, f"{base}/rows")
    return report.select("dataset_source", "initial", "final", "tokens", "trainable")


@query(
    "plan_registry_run",
    f"""WITH {COUNTS}, v AS (SELECT conv_id, bool_or(role = 'assistant' AND length(trim(text)) = 0) AS bad FROM conversations GROUP BY conv_id)
      SELECT conv_id, 'talks' AS dataset_source, n::INT AS n_tokens FROM c JOIN v USING (conv_id) WHERE NOT bad AND n <= 700 AND a > 0""",
)
def registry_run(t):
    steps = [
        ("drop_vendor_turns", {}), ("drop_empty_turns", {}), ("tokenize_mask_assistant", {"max_length": 100000}), ("length_filter", {"max_total": 700}),
    ]
    out = registry.run(chat_rows(t.conversations), steps, source="talks", keep=["conv_id", "messages", "input_ids", "labels"])
    return out.select("conv_id", registry.SOURCE, F.size("input_ids").alias("n_tokens"))


@query(
    "plan_reward_prompts",
    """WITH c AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id),
       p AS (SELECT conv_id, CASE WHEN len(m) > 1 AND list_last(m).role = 'assistant' THEN m[:len(m) - 1] ELSE m END AS m FROM c)
       SELECT conv_id, array_to_string([x.role || ': ' || x.content FOR x IN m], chr(10)) AS raw_prompt, 'x' AS truth, 'math,flan' AS verifier FROM p""",
)
def reward_prompts(t):
    rows = chat_rows(t.conversations).withColumn("ground_truth", F.lit("x")).withColumn("dataset", F.array(F.lit("math"), F.lit("flan")))
    out = registry.run(rows, [("prompt_for_rewards", {})])
    return out.select("conv_id", "raw_prompt", F.array_join("ground_truth", ",").alias("truth"), F.array_join("dataset", ",").alias("verifier"))
