"""Queries: statistics of chats, tokens and languages."""

from pyspark.sql import functions as F

from chatloom.catalog.data import SAMPLES_SQL, samples
from chatloom.catalog.registry import query
from chatloom.catalog.tokens import toks
from chatloom.functions import tokens as T
from chatloom.functions.templates import TEMPLATES
from chatloom.functions.text import word_tokens
from chatloom.operators import language as G
from chatloom.operators import statistics as S

LIMITS = ", ".join(f"count(*) FILTER (value > {n}) AS over_{n}" for n in S.LENGTH_LIMITS)
DESCRIBE = """count(value) AS value_count, round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_std, min(value) AS value_min,
  round(quantile_cont(value, 0.25), 6) AS value_p25, round(quantile_cont(value, 0.5), 6) AS value_p50, round(quantile_cont(value, 0.75), 6) AS value_p75, max(value) AS value_max"""


@query(
    "ag_chat_summary",
    f"""WITH t AS (SELECT conv_id, role, len({toks('text')})::BIGINT AS n FROM conversations WHERE role <> 'system'),
      c AS (SELECT conv_id, count(*) AS turns, sum(n)::BIGINT AS total FROM t GROUP BY conv_id),
      v AS (SELECT 'turns' AS measure, turns AS value FROM c UNION ALL SELECT 'total', total FROM c UNION ALL SELECT role, n FROM t)
      SELECT measure, {DESCRIBE}, {LIMITS} FROM v GROUP BY measure""",
)
def chat_summary(t):
    return S.chat_summary(t.conversations, "conv_id", "role", T.token_count("text"))


@query(
    "ag_pair_summary",
    f"""WITH d AS (SELECT len({toks("concat(lang, ' ', source, ': ', text)")})::BIGINT AS p, len({toks('text')})::BIGINT AS c FROM documents),
      v AS (SELECT 'prompt' AS measure, p AS value FROM d UNION ALL SELECT 'completion', c FROM d UNION ALL SELECT 'total', p + c FROM d)
      SELECT measure, {DESCRIBE}, {LIMITS} FROM v GROUP BY measure""",
)
def pair_summary(t):
    d = t.documents.select(T.token_count(F.concat("lang", F.lit(" "), "source", F.lit(": "), "text")).cast("long").alias("p"), T.token_count("text").cast("long").alias("c"))
    return S.pair_summary(d, "p", "c")


@query("ag_longest", f"SELECT doc_id, len({toks('text')}) AS length FROM documents ORDER BY length DESC, doc_id LIMIT 100")
def longest(t):
    return S.longest(t.documents, "doc_id", T.token_count("text").cast("long"))


@query(
    "ag_dataset_table",
    f"""WITH t AS (SELECT conv_id, role, len({toks('text')}) AS n FROM conversations WHERE role <> 'system'),
      c AS (SELECT conv_id, count(*) AS turns, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (role = 'user'), 0) AS u, coalesce(sum(n) FILTER (role = 'assistant'), 0) AS a,
              count(*) FILTER (role = 'user') AS nu, count(*) FILTER (role = 'assistant') AS na FROM t GROUP BY conv_id)
      SELECT conv_id % 4 AS dataset, count(*) AS instances, round(avg(total), 2) AS avg_total, max(total) AS max_total,
        round(sum(u)::DOUBLE / sum(nu), 2) AS avg_user, round(sum(a)::DOUBLE / sum(na), 2) AS avg_assistant, round(avg(turns), 2) AS avg_turns,
        {", ".join(f"round(100.0::DOUBLE * count(*) FILTER (total > {k}) / count(*), 2) AS over_{k}_pct" for k in (512, 1024, 2048, 4096))}
      FROM c GROUP BY 1""",
)
def dataset_table(t):
    n = T.token_count("text").cast("long")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    per = t.conversations.filter("role <> 'system'").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.sum(n).alias("total"), F.sum(F.when(user, n).otherwise(0)).alias("user"),
        F.sum(F.when(assistant, n).otherwise(0)).alias("assistant"), F.count_if(user).alias("user_turns"), F.count_if(assistant).alias("assistant_turns"),
    )
    return S.dataset_table(per.withColumn("dataset", F.col("conv_id") % 4), "dataset")


EDGES = [0.0, 50.0, 100.0, 200.0, 500.0, 1000.0, 4000.0]
BIN = "CASE " + " ".join(
    f"WHEN n >= {EDGES[i]} AND n {'<=' if i == len(EDGES) - 2 else '<'} {EDGES[i + 1]} THEN {i}" for i in range(len(EDGES) - 1)
) + " END"


@query(
    "ag_histogram",
    f"""WITH d AS (SELECT source, len({toks('text')}) AS n FROM documents), r AS (SELECT source FROM d GROUP BY source HAVING count(*) >= 10),
      c AS (SELECT CASE WHEN source IN (SELECT source FROM r) THEN source ELSE 'Other' END AS category, ({BIN})::INT AS bin FROM d)
      SELECT category, bin, count(*) AS n FROM c WHERE bin IS NOT NULL GROUP BY ALL""",
)
def histogram(t):
    d = t.documents.select(F.col("source").alias("category"), T.token_count("text").alias("n"))
    return S.histogram(S.merge_rare(d, "category", 10), "category", F.col("n"), EDGES)


@query(
    "ag_histogram_categories",
    """WITH d AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'Other' ELSE source END AS category, n_chars AS n FROM documents),
       b AS (SELECT category, least(floor(n / (24000.0 / 24))::INT, 23) AS bin FROM d WHERE n <= 24000)
       SELECT category, bin, count(*) AS n FROM b GROUP BY ALL""",
)
def histogram_categories(t):
    name = F.when(F.col("doc_id") % 5 == 0, F.col("source")).otherwise(F.concat(F.lit("org/"), "source"))
    d = t.documents.select(S.short_category(name).alias("category"), F.col("n_chars").alias("n"))
    return S.histogram(d, "category", F.col("n"), S.linear_edges(24000.0))


PCT = ", ".join(f"round(quantile_cont(n, {i / 10}), 6) AS p{10 * i}" for i in range(1, 10))


@query(
    "ag_percentiles",
    f"SELECT {PCT}, min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean, round(median(n), 6) AS median FROM (SELECT len({toks('text')}) AS n FROM documents)",
)
def percentiles(t):
    return S.length_percentiles(t.documents, T.token_count("text").cast("long"))


SEGMENTS = "'<|user|>' || chr(10) || source || chr(10) || '<|assistant|>' || chr(10)"


@query(
    "ag_accounting",
    f"""WITH d AS (SELECT source, len({toks(f"{SEGMENTS} || text || '<|endoftext|>'")}) AS n FROM documents),
      f AS (SELECT source, n, n - len({toks(SEGMENTS)}) AS t FROM d, (SELECT 1) WHERE n <= 2000),
      g AS (SELECT source, count(*) AS final, sum(n)::BIGINT AS tokens, sum(t)::BIGINT AS trainable FROM f GROUP BY source),
      s AS (SELECT source, count(*) AS initial, coalesce(any_value(g.final), 0) AS final, coalesce(any_value(tokens), 0) AS tokens, coalesce(any_value(trainable), 0) AS trainable
            FROM d LEFT JOIN g USING (source) GROUP BY source),
      a AS (SELECT source, initial, final, tokens, trainable FROM s UNION ALL SELECT 'overall', sum(initial)::BIGINT, sum(final)::BIGINT, sum(tokens)::BIGINT, sum(trainable)::BIGINT FROM s)
      SELECT source, initial, final, initial - final AS filtered, tokens, trainable, round(final / initial::DOUBLE, 6) AS factor, round(tokens / nullif(final, 0)::DOUBLE, 6) AS avg_tokens,
        round(100::DOUBLE * tokens / max(tokens) OVER (), 4) AS token_pct, round(100::DOUBLE * final / max(final) OVER (), 4) AS instance_pct FROM a""",
)
def accounting(t):
    from chatloom.operators.conversions import user_assistant

    # made by a generator, which no filter is pushed below: a chat is encoded once, in the tasks that the documents are spread over
    coded = t.documents.select("source", F.explode(F.array(T.masked_chat(user_assistant("source", "text"), TEMPLATES["tagged"], 1_000_000))).alias("x"))
    # rows beyond 2000 tokens are filtered: they count as initial and not as final
    short = coded.filter(F.size("x.input_ids") <= 2000).select("source", F.col("x.input_ids").alias("ids"), F.col("x.labels").alias("labels"))
    return S.pipeline_accounting(t.documents, short, "source", "ids", "labels")


@query(
    "ag_language_shares",
    "SELECT lang AS language, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY lang",
)
def shares(t):
    return S.language_shares(t.documents, "lang")


@query(
    "ag_language_breakdown",
    """SELECT 'all' AS level, NULL AS part, lang AS language, count(*) AS n FROM documents GROUP BY lang
       UNION ALL SELECT 'source', source, lang, count(*) FROM documents GROUP BY source, lang
       UNION ALL SELECT 'domain', 'd' || doc_id % 3, lang, count(*) FROM documents GROUP BY doc_id % 3, lang""",
)
def breakdown(t):
    d = t.documents.withColumn("domain", F.concat(F.lit("d"), (F.col("doc_id") % 3).cast("string")))
    return S.language_breakdown(d, "lang", "source", "domain")


SCORE = "(doc_id * 37 % 101)::DOUBLE / 101"


@query(
    "ag_confidence",
    f"""WITH d AS (SELECT {SCORE} AS s, length(text) AS n FROM documents),
      r AS (SELECT avg(s) AS mean, median(s) AS median, stddev_pop(s) AS std, min(s) AS min, max(s) AS max, (count(*) FILTER (s < 0.5))::DOUBLE AS low,
            round(100.0::DOUBLE * count(*) FILTER (s < 0.5) / count(*), 4) AS low_pct, avg(n) AS length_mean, median(n) AS length_median, stddev_pop(n) AS length_std FROM d)
      SELECT measure, round(value, 6) AS value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME measure VALUE value)""",
)
def confidence(t):
    d = t.documents.withColumn("s", (F.col("doc_id") * 37 % 101).cast("double") / 101)
    return S.confidence(d, "s", "text")


@query("ag_low_confidence", f"SELECT lang AS language, count(*) AS n FROM documents WHERE {SCORE} < 0.5 GROUP BY lang")
def low(t):
    d = t.documents.withColumn("s", (F.col("doc_id") * 37 % 101).cast("double") / 101)
    return S.low_confidence_languages(d, "s", "lang")


@query(
    "ag_shard_merge",
    "SELECT count(DISTINCT source) AS shards, count(*) AS total, round(avg(n_chars), 6) AS mean, min(n_chars) AS min, max(n_chars) AS max FROM documents",
)
def shard_merge(t):
    return S.merge_shards(t.documents, "source", "lang", "n_chars")


@query(
    "ag_language_profile",
    """WITH d AS (SELECT CASE WHEN doc_id % 9 = 0 THEN 'unknown' ELSE lang END AS language FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) = 0)
       SELECT language, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct, language IN ('de', 'fr') AS target FROM d GROUP BY language""",
)
def profile(t):
    d = t.documents.join(t.labels, "doc_id", "left").withColumn("lang", F.expr("CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE lang END"))
    return S.language_profile(d, "lang", F.col("toxic") == 1, ["de", "fr"])


@query(
    "ag_feature_lengths",
    f"""SELECT 'words' AS feature, min(n)::INT AS min, max(n)::INT AS max, round(avg(n), 6) AS mean FROM (SELECT len({toks('text')}) AS n FROM documents)
        UNION ALL SELECT 'lines', min(n)::INT, max(n)::INT, round(avg(n), 6) FROM (SELECT len(string_split(text, chr(10))) AS n FROM documents)""",
)
def features(t):
    return S.feature_lengths(t.documents.select(word_tokens("text").alias("words"), F.split("text", "\n").alias("lines")), ["words", "lines"])


@query(
    "ag_combine_metrics",
    "SELECT event_type, round(avg(value), 6) AS mean, arg_max(props, event_id) AS last FROM events GROUP BY event_type",
)
def combine(t):
    rows = t.events.withColumn("items", F.array("value", "value"))
    return S.combine_metrics(rows, "event_type", "value", "items", "props", "event_id")


@query(
    "ag_combined_items",
    "SELECT event_type, event_id, unnest([0, 1])::INT AS place, unnest([value, value * 2]) AS item FROM events",
)
def combined_items(t):
    return S.combined_items(t.events.withColumn("items", F.array(F.col("value"), F.col("value") * 2)), "event_type", "items", "event_id")


@query(
    "ag_rollout_report",
    f"""WITH s AS (SELECT CASE WHEN score < 15 THEN 0 WHEN score > 35 THEN 10 ELSE 5 END::DOUBLE AS s, sample % 300 AS n, finish FROM {SAMPLES_SQL})
      SELECT round(avg(s), 6) AS mean_score, round(avg((finish = 'O')::INT), 6) AS stop_rate, count(*) FILTER (s <> 10) AS unsolved,
        round(count(*) FILTER (s <> 10) / count(*)::DOUBLE, 6) AS unsolved_ratio, round(avg(n), 6) AS length_mean, min(n) AS length_min, max(n) AS length_max,
        round(coalesce(avg(n) FILTER (s = 0), 0), 6) AS length_unsolved, round(coalesce(avg(n) FILTER (s = 10), 0), 6) AS length_solved FROM s""",
)
def rollouts(t):
    s = samples(t).select(
        F.expr("CASE WHEN score < 15 THEN 0D WHEN score > 35 THEN 10D ELSE 5D END").alias("s"), (F.col("sample") % 300).alias("n"),
        F.expr("CASE finish WHEN 'O' THEN 'stop' ELSE 'length' END").alias("f"),
    )
    return S.rollout_report(s, "s", "n", "f", 10.0)


def detected(t):
    model = G.train(t.documents.filter("doc_id % 2 = 0"), "lang", "text")
    return G.detect(t.documents, "doc_id", "text", model)


PAD = "' ' || trim(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g')) || ' '"


@query(
    "ag_detect_language",
    f"""WITH x AS (SELECT doc_id, lang, trim(text, concat(' ', chr(9), chr(10), chr(13))) AS text FROM documents), p AS (SELECT doc_id, lang, text, {PAD} AS t FROM x),
      g AS (SELECT doc_id, lang, substr(t, i, 3) AS gram FROM p, LATERAL (SELECT unnest(generate_series(1, length(t) - 2)) AS i)),
      c AS (SELECT lang AS language, gram, count(*) AS n FROM g WHERE doc_id % 2 = 0 GROUP BY ALL),
      v AS (SELECT count(DISTINCT gram) AS v FROM c), tot AS (SELECT language, sum(n) + (SELECT v FROM v) AS d FROM c GROUP BY language),
      dg AS (SELECT doc_id, gram, count(*) AS k FROM g WHERE doc_id IN (SELECT doc_id FROM x WHERE length(text) >= 20) GROUP BY ALL),
      s AS (SELECT doc_id, tot.language, sum(k * ln((coalesce(c.n, 0) + 1) / d::DOUBLE)) AS s FROM dg CROSS JOIN tot LEFT JOIN c ON c.language = tot.language AND c.gram = dg.gram GROUP BY ALL)
      SELECT doc_id, coalesce(best, 'unknown') AS detected, CASE WHEN length(text) = 0 THEN 'empty' WHEN length(text) < 20 THEN 'short' ELSE 'detected' END AS reason
      FROM x LEFT JOIN (SELECT doc_id, arg_max(language, s) AS best FROM s GROUP BY doc_id) USING (doc_id)""",
)
def detect(t):
    return detected(t)


@query("ag_quantiles_exact", "SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS p, round(unnest(quantile_cont(l_extendedprice, [0.1, 0.5, 0.9])), 6) AS value FROM lineitem")
def quantiles(t):
    return S.exact_quantiles(t.lineitem, "l_extendedprice", [0.1, 0.5, 0.9]).withColumn("value", F.round("value", 6))
