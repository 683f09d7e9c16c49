"""Queries: translated corpora."""

from pyspark.sql import functions as F

from chatloom.catalog.data import MARKED_TURNS, marked_turns
from chatloom.catalog.registry import query
from chatloom.functions.chat import flat
from chatloom.operators import translation as R

# The next document plays the translation of each one; numbers and links come from the page of the same number.
PAIRS = """(SELECT a.doc_id, a.source, a.lang, a.text AS original, CASE WHEN a.doc_id % 13 = 0 THEN ' ' ELSE b.text END AS translated, b.lang AS detected,
   CASE WHEN a.doc_id % 10 = 0 THEN 'system' ELSE 'user' END AS role FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"""


def pairs(t):
    d = t.documents
    b = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("t"), F.col("lang").alias("detected"))
    return d.join(b, "doc_id").select(
        "doc_id", "source", "lang", F.col("text").alias("original"), F.when(F.col("doc_id") % 13 == 0, " ").otherwise(F.col("t")).alias("translated"),
        "detected", F.when(F.col("doc_id") % 10 == 0, "system").otherwise("user").alias("role"),
    )


RATIO = "CASE WHEN coalesce(original, '') = '' OR coalesce(translated, '') = '' THEN 0 ELSE length(translated) / length(original)::DOUBLE END"


@query("tr_length_ratio", f"SELECT doc_id, round({RATIO}, 6) AS ratio, {RATIO} BETWEEN 0.3 AND 4 AS valid FROM {PAIRS}")
def length_ratio(t):
    return pairs(t).select(
        "doc_id", F.round(R.length_ratio("original", "translated"), 6).alias("ratio"), R.length_valid("original", "translated").alias("valid")
    )


NUM = r"'\b\d+(?:\.\d+)?\b'"


def kept_sql(a, b):
    return f"""len(list_filter(regexp_extract_all({a}, {NUM}), lambda x: NOT list_contains(regexp_extract_all({b}, {NUM}), x))) = 0 AS numbers,
      list_sort(list_distinct(regexp_extract_all({a}, 'https?://\\S+'))) = list_sort(list_distinct(regexp_extract_all({b}, 'https?://\\S+'))) AS urls"""


@query(
    "tr_entities",
    f"SELECT page_id, {kept_sql('a', 'b')} FROM (SELECT page_id, url || ' ' || page_id || ' 3.5 ' || html AS a, CASE WHEN page_id % 2 = 0 THEN url ELSE '' END || ' ' || page_id || CASE WHEN page_id % 3 = 0 THEN ' 3.5 ' ELSE ' ' END || replace(html, 'http', CASE WHEN page_id % 5 = 0 THEN 'https' ELSE 'http' END) AS b FROM pages)",
)
def entities(t):
    a = "concat(url, ' ', page_id, ' 3.5 ', html)"
    b = "concat(CASE WHEN page_id % 2 = 0 THEN url ELSE '' END, ' ', page_id, CASE WHEN page_id % 3 = 0 THEN ' 3.5 ' ELSE ' ' END, replace(html, 'http', CASE WHEN page_id % 5 = 0 THEN 'https' ELSE 'http' END))"
    d = t.pages.select("page_id", F.expr(a).alias("a"), F.expr(b).alias("b"))
    return d.select("page_id", R.numbers_kept("a", "b").alias("numbers"), R.urls_kept("a", "b").alias("urls"))


VERDICT = f"""WITH x AS (SELECT *, trim(translated, concat(' ', chr(9), chr(10))) = '' AS empty, {RATIO} AS r, {kept_sql('original', 'translated')} FROM {PAIRS} WHERE role <> 'system'),
  v AS (SELECT source, count(*) FILTER (empty) AS empty, count(*) FILTER (NOT empty AND r BETWEEN 0.3 AND 4) AS length_valid, count(*) FILTER (NOT empty AND r NOT BETWEEN 0.3 AND 4) AS length_invalid,
     avg(r) FILTER (NOT empty) AS ratio_mean, min(r) FILTER (NOT empty) AS ratio_min, max(r) FILTER (NOT empty) AS ratio_max, count(*) FILTER (NOT empty AND detected IS NULL) AS language_unknown,
     count(*) FILTER (NOT empty AND detected = 'en') AS language_right, count(*) FILTER (NOT empty AND detected <> 'en') AS language_wrong, count(*) FILTER (NOT empty) AS checked,
     count(*) FILTER (NOT empty AND numbers) AS numbers_kept, count(*) FILTER (NOT empty AND urls) AS urls_kept FROM x GROUP BY source),
  w AS (SELECT *, coalesce(language_right / nullif(language_right + language_wrong, 0)::DOUBLE, 1) > 0.8 AND coalesce(length_valid / nullif(length_valid + length_invalid, 0)::DOUBLE, 1) > 0.4 AS lenient,
     coalesce(language_right / nullif(language_right + language_wrong, 0)::DOUBLE, 1) > 0.8 AND coalesce(length_valid / nullif(length_valid + length_invalid, 0)::DOUBLE, 1) > 0.9 AS passed FROM v)
"""


def verdicts(t):
    return R.validate(pairs(t), "source", "role", "original", "translated", "detected", "en")


@query(
    "tr_validate",
    VERDICT + """SELECT source, empty, length_valid, length_invalid, round(ratio_mean, 6) AS ratio_mean, round(ratio_min, 6) AS ratio_min, round(ratio_max, 6) AS ratio_max,
      language_unknown, language_right, language_wrong, checked, numbers_kept, urls_kept, passed FROM w""",
)
def validate(t):
    v = verdicts(t)
    for c in ("ratio_mean", "ratio_min", "ratio_max"):
        v = v.withColumn(c, F.round(c, 6))
    return v


@query("tr_verdicts", VERDICT + "SELECT count(*) AS datasets, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed FROM w")
def verdict_summary(t):
    return R.verdict_summary(verdicts(t))


@query("tr_protect", f"SELECT conv_id, turn, md5(text) AS restored FROM {MARKED_TURNS} WHERE text IS NOT NULL")
def protect(t):
    d = marked_turns(t).filter("text IS NOT NULL").select("conv_id", "turn", R.protect("text").alias("p"))
    return d.select("conv_id", "turn", F.md5(R.restore("p.text", "p.kept")).alias("restored"))


@query("tr_protected_marks")
def marks(t):
    d = marked_turns(t).filter("text IS NOT NULL").select("conv_id", "turn", R.protect("text").alias("p"))
    return d.select("conv_id", "turn", F.explode("p.kept").alias("k")).select("conv_id", "turn", "k.*")


LANGS = "['en','de','fr','xx'][(conv_id % 4)::INT + 1]"
WORK = f"""w AS (SELECT conv_id, turn, role, text, CASE WHEN text IS NULL OR trim(text, concat(' ', chr(9), chr(10))) = '' THEN 'empty' WHEN length(trim(text)) < 20 THEN 'short'
    WHEN {LANGS} = 'xx' THEN 'unmapped' ELSE 'detected' END AS reason FROM {MARKED_TURNS}),
  v AS (SELECT *, CASE WHEN reason = 'detected' THEN {LANGS} ELSE 'en' END AS source FROM w),
  u AS (SELECT *, CASE WHEN role = 'system' THEN 'system' WHEN reason = 'empty' THEN 'empty' WHEN source = 'de' THEN 'same' ELSE 'todo' END AS status FROM v)"""


def work(t):
    langs = F.element_at(F.array(*[F.lit(x) for x in ("en", "de", "fr", "xx")]), (F.col("conv_id") % 4 + 1).cast("int"))
    return R.work_list(marked_turns(t).withColumn("lang", langs), ["conv_id", "turn"], "role", "text", "lang", "de", ["en", "de", "fr"])


@query(
    "tr_work_report",
    f"""WITH {WORK} SELECT CASE WHEN status = 'system' THEN 'system' ELSE source END AS source, count(*) AS turns, count(*) FILTER (reason = 'empty' AND status <> 'system') AS empty,
        count(*) FILTER (reason = 'short' AND status <> 'system') AS short, count(*) FILTER (status = 'same') AS skipped FROM u GROUP BY 1""",
)
def report(t):
    return R.translation_report(work(t))


@query(
    "tr_translated",
    f"""WITH {WORK}, z AS (SELECT conv_id, turn, role, CASE WHEN status = 'todo' AND text IN (SELECT text FROM w WHERE (conv_id + turn) % 3 <> 0 AND text IS NOT NULL) THEN '[de] ' || text ELSE text END AS text FROM u)
        SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM z GROUP BY conv_id""",
)
def translated(t):
    made = marked_turns(t).filter("(conv_id + turn) % 3 <> 0 AND text IS NOT NULL")
    table = made.select(F.sha2("text", 256).alias("hash"), F.concat(F.lit("[de] "), "text").alias("translated"))
    done = R.apply_translations(work(t), table, "text")
    return R.reassemble(done, "conv_id", "turn", "role", "result").select("conv_id", flat("messages").alias("chat"))
