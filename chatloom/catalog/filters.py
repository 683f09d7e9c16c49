"""Queries: filters over chat rows and texts."""

from pyspark.sql import functions as F

from chatloom.catalog.data import MARKED_CHATS, MARKED_TURNS, SAMPLES_SQL, marked_chats, marked_turns, samples
from chatloom.catalog.registry import query
from chatloom.operators import filters as L

Q = "'"


def sql_text(s):
    return Q + s.replace(Q, Q + Q) + Q


def _flagged(t, name, flag):
    return L.flag_conversations(marked_turns(t), "conv_id", {name: flag}).filter(~F.col(name)).select("conv_id")


@query(
    "fl_vendor_keywords",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id HAVING NOT coalesce(bool_or(role = 'assistant' AND
        regexp_matches(lower(text), {sql_text(L.vendor_pattern())})), false)""",
)
def vendor(t):
    return _flagged(t, "bad", (F.col("role") == "assistant") & L.mentions_vendor("text"))


@query(
    "fl_vendor_keywords_chats",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id HAVING NOT coalesce(bool_or(role = 'assistant' AND
        regexp_matches(lower(text), {sql_text(L.vendor_pattern())})), false)""",
)
def vendor_chats(t):
    return marked_chats(t).filter(~L.has_vendor_turn("messages")).select("conv_id")


@query(
    "fl_vendor_keywords_legacy",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id HAVING NOT coalesce(bool_or(
        {" OR ".join(f"contains(lower(text), {sql_text(n.lower())})" for n in L.VENDOR_NAMES_LEGACY)}), false)""",
)
def vendor_legacy(t):
    return _flagged(t, "bad", L.mentions_vendor_legacy("text"))


@query(
    "fl_empty_turns",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id
        HAVING NOT bool_or(text IS NULL OR trim(text, concat(' ', chr(9), chr(10), chr(13))) = '')""",
)
def empty_turns(t):
    return _flagged(t, "bad", L.is_blank("text"))


@query(
    "fl_identity",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id HAVING NOT coalesce(bool_or(role = 'assistant' AND (text IS NULL OR
        {" OR ".join(f"regexp_matches(text, {sql_text('(?i)' + p)})" for p in L.identity_patterns())})), false)""",
)
def identity(t):
    return _flagged(
        t, "bad", (F.col("role") == "assistant") & (F.col("text").isNull() | L.identifies_itself("text"))
    )


@query(
    "fl_identity_with_users",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id HAVING NOT coalesce(bool_or(role IN ('assistant', 'user') AND (text IS NULL OR
        {" OR ".join(f"regexp_matches(text, {sql_text('(?i)' + p)})" for p in L.identity_patterns())})), false)""",
)
def identity_users(t):
    return marked_chats(t).filter(~L.has_identity_turn("messages", user_turns=True)).select("conv_id")


@query(
    "fl_cutoff_mentions",
    f"""SELECT conv_id, turn, unnest(regexp_extract_all(text, {sql_text(L.CUTOFF_PATTERN)})) AS mention FROM {MARKED_TURNS}""",
)
def cutoff(t):
    return marked_turns(t).select("conv_id", "turn", F.explode(L.cutoff_mentions("text")).alias("mention"))


@query(
    "fl_cutoff_kept",
    f"""SELECT conv_id FROM {MARKED_TURNS} GROUP BY conv_id
        HAVING NOT coalesce(bool_or(regexp_matches(text, {sql_text(L.CUTOFF_PATTERN)})), false)""",
)
def cutoff_kept(t):
    chats = marked_chats(t)
    return L.drop_by_matches(chats, "conv_id", L.all_cutoff_mentions("messages")).select("conv_id")


@query(
    "fl_cutoff_counts",
    f"""SELECT conv_id % 5 AS source, count(*) AS mentions FROM
        (SELECT conv_id, unnest(regexp_extract_all(text, {sql_text(L.CUTOFF_PATTERN)})) FROM {MARKED_TURNS}) GROUP BY 1""",
)
def cutoff_counts(t):
    found = marked_turns(t).select((F.col("conv_id") % 5).alias("source"), F.size(L.cutoff_mentions("text")).alias("n"))
    return found.filter("n > 0").groupBy("source").agg(F.sum("n").alias("mentions"))


@query(
    "fl_cjk_ratio",
    f"""SELECT conv_id, round(coalesce(len(regexp_extract_all(c, '[一-鿿]')) / nullif(length(c), 0)::DOUBLE, 0), 6) AS ratio,
          coalesce(regexp_matches(c, '[一-鿿]') AND len(regexp_extract_all(c, '[一-鿿]')) / length(c)::DOUBLE >= 0.05, false) AS drop_it
        FROM (SELECT conv_id, list_last(list_filter(m, lambda x: x.role = 'assistant')).content AS c FROM {MARKED_CHATS})""",
)
def cjk(t):
    last = marked_turns(t).groupBy("conv_id").agg(F.max_by("text", F.expr("CASE WHEN role = 'assistant' THEN turn END")).alias("c"))
    return last.select(
        "conv_id",
        F.round(F.coalesce(L.cjk_ratio("c"), F.lit(0.0)), 6).alias("ratio"),
        F.coalesce(L.is_chinese("c", 0.05), F.lit(False)).alias("drop_it"),
    )


@query(
    "fl_cjk_last_two",
    f"""SELECT conv_id FROM (SELECT conv_id, m[-2:] AS tail FROM {MARKED_CHATS})
        WHERE len(list_filter(tail, lambda x: x.role IN ('user', 'assistant') AND regexp_matches(x.content, '[一-鿿]')
              AND len(regexp_extract_all(x.content, '[一-鿿]')) / length(x.content)::DOUBLE >= 0.05)) = 0""",
)
def cjk_two(t):
    return marked_chats(t).filter(~L.ends_chinese("messages", 0.05, user_turns=True)).select("conv_id")


@query(
    "fl_flags_retention",
    """SELECT count(*) AS total, count(*) FILTER (coalesce(toxic, 0) <> 1) AS toxic_kept,
         round(100.0::DOUBLE * count(*) FILTER (coalesce(toxic, 0) <> 1) / count(*), 2) AS toxic_pct,
         count(*) FILTER (lang = 'en') AS language_kept, round(100.0::DOUBLE * count(*) FILTER (lang = 'en') / count(*), 2) AS language_pct
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def flags(t):
    df = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return L.retention(df, {"toxic": F.col("toxic") == 1, "language": F.col("lang") != "en"})


@query(
    "fl_think_format",
    f"""SELECT conv_id, coalesce(regexp_matches(c, '(?s)\\A<think>.*?</think>.*\\z'), false) AS think,
               coalesce(regexp_matches(c, '(?s)\\A<think>.*?</think><answer>.*?</answer>\\z'), false) AS think_answer
        FROM (SELECT conv_id, list_last(m).content AS c FROM {MARKED_CHATS})""",
)
def think(t):
    return marked_chats(t).select(
        "conv_id",
        L.ends_with_format("messages", answer=False).alias("think"),
        L.ends_with_format("messages", answer=True).alias("think_answer"),
    )


@query(
    "fl_code_heavy",
    f"""WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM {MARKED_TURNS})
        SELECT conv_id, turn, sum(regexp_matches(line, '^\\s*(import|from|def|class|function|const|let|var)\\s+|^\\s*#include\\s*<|^\\s*public\\s+(class|static|void)')::INT
             + (length(line) > 10 AND length(regexp_replace(line, '[^{{}}\\[\\]();=<>]', '', 'g')) / nullif(length(line), 0)::DOUBLE > 0.15)::INT) / count(*)::DOUBLE > 0.3 AS heavy
        FROM l GROUP BY conv_id, turn""",
)
def code_heavy(t):
    return marked_turns(t).filter("text IS NOT NULL").select("conv_id", "turn", L.is_code_heavy("text").alias("heavy"))


@query(
    "fl_update_subsets",
    """SELECT source, count(*) AS n FROM (SELECT source FROM documents WHERE source NOT IN ('src1', 'src2')
       UNION ALL SELECT 'pages' FROM pages) GROUP BY source""",
)
def subsets(t):
    docs = t.documents.select(F.col("doc_id").alias("id"), "source", "n_chars")
    out = L.update_subsets(docs, ["src1", "src2"], {"pages": t.pages.select(F.col("page_id").alias("id"))}, ["n_chars"])
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("fl_varied_prompts", f"SELECT prompt FROM {SAMPLES_SQL} GROUP BY prompt HAVING count(DISTINCT score) > 1")
def varied(t):
    return L.varied_prompts(samples(t), "prompt", "score")


@query(
    "fl_pass_rate",
    f"""SELECT prompt, count(*) AS total, sum((score > 25)::INT)::DOUBLE AS correct, round(avg((score > 25)::INT), 6) AS rate
        FROM {SAMPLES_SQL} GROUP BY prompt HAVING avg((score > 25)::INT) BETWEEN 0.25 AND 0.75""",
)
def pass_rate(t):
    out = L.pass_rate_band(samples(t), "prompt", (F.col("score") > 25).cast("double"), 0.25, 0.75)
    return out.withColumn("rate", F.round("rate", 6))


TESTS = "transform(embedding, (x, i) -> concat('assert t', i))"


@query(
    "fl_passed_tests",
    """SELECT vec_id, len(list_filter(embedding, lambda x: x > -0.1)) AS n_passed,
         array_to_string([concat('assert t', i) FOR i IN generate_series(0, 63) IF embedding[i + 1] > -0.1], ',') AS passed
       FROM embeddings WHERE len(list_filter(embedding, lambda x: x > -0.1)) / len(embedding)::DOUBLE >= 0.8""",
)
def tests_passed(t):
    runs = t.embeddings.select(
        "vec_id", F.expr(TESTS).alias("tests"), F.expr("transform(embedding, x -> int(double(x) > -0.1))").alias("results")
    )
    keep, passed = L.passed_tests("tests", "results", 0.8)
    return runs.filter(keep).select("vec_id", F.size(passed).cast("long").alias("n_passed"), F.array_join(passed, ",").alias("passed"))


def _stages():
    return {
        "keywords": L.has_vendor_turn("messages"),
        "cutoff": F.size(L.all_cutoff_mentions("messages")) > 0,
        "empty": L.has_empty_turn("messages"),
    }


STAGE_FLAGS = f"""(SELECT conv_id, coalesce(bool_or(role = 'assistant' AND regexp_matches(lower(text), {sql_text(L.vendor_pattern())})), false) AS k,
   coalesce(bool_or(regexp_matches(text, {sql_text(L.CUTOFF_PATTERN)})), false) AS c,
   bool_or(text IS NULL OR trim(text, concat(' ', chr(9), chr(10))) = '') AS e FROM {MARKED_TURNS} GROUP BY conv_id)"""


@query(
    "fl_stage_retention",
    f"""SELECT count(*) AS input, count(*) FILTER (NOT k) AS after_keywords, count(*) FILTER (NOT k AND NOT c) AS after_cutoff,
               count(*) FILTER (NOT k AND NOT c AND NOT e) AS after_empty FROM {STAGE_FLAGS}""",
)
def stage_counts(t):
    return L.stage_retention(marked_chats(t), _stages())


@query("fl_stages", f"SELECT conv_id FROM {STAGE_FLAGS} WHERE NOT k AND NOT c AND NOT e")
def stages(t):
    return L.apply_stages(marked_chats(t), _stages()).select("conv_id")
