"""Queries: contamination of ``documents`` by ``benchmark``."""

from pyspark.sql import functions as F

from chatloom.catalog.registry import query
from chatloom.functions.chat import chat_rows
from chatloom.operators import contamination as C
from chatloom.plans.decontaminate import language_report

TOKENS = "list_filter(regexp_split_to_array(lower(text), '[ ,.?!:;()\"\\-\\n\\\\]'), lambda x: x <> '')"
N = 8

PAIRS_SQL = f"""
WITH d AS (SELECT doc_id, {TOKENS} AS t FROM documents),
     b AS (SELECT item_id, {TOKENS} AS t FROM benchmark),
     dg AS (SELECT DISTINCT doc_id, array_to_string(t[i:i+{N - 1}], ' ') AS g
            FROM d, LATERAL (SELECT unnest(generate_series(1, len(t) - {N - 1})) AS i)),
     bg AS (SELECT item_id, len(t) AS n, i, array_to_string(t[i:i+{N - 1}], ' ') AS g
            FROM b, LATERAL (SELECT unnest(generate_series(1, len(t) - {N - 1})) AS i)),
     cov AS (SELECT DISTINCT doc_id, item_id, n, i + k AS idx
             FROM dg JOIN bg USING (g), generate_series(0, {N - 1}) s(k)),
     pairs AS (SELECT doc_id, item_id, count(*) / any_value(n)::DOUBLE AS score FROM cov GROUP BY doc_id, item_id)
"""


@query(
    "jn_query_messages",
    """SELECT conv_id, text FROM conversations WHERE role = 'user'""",
)
def query_messages(t):
    return C.query_messages(chat_rows(t.conversations), "conv_id")


@query(
    "jn_match_tokens",
    f"SELECT doc_id, len({TOKENS}) AS n_tokens, md5(array_to_string({TOKENS}, ' ')) AS digest FROM documents",
)
def match_tokens(t):
    toks = C.match_tokens("text")
    return t.documents.select("doc_id", F.size(toks).cast("long").alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("digest"))


def phrase():
    return F.array_join(C.match_tokens("text"), " ")


@query(
    "jn_exact",
    f"""WITH d AS (SELECT doc_id, ' ' || array_to_string({TOKENS}, ' ') || ' ' AS body FROM documents),
             b AS (SELECT item_id, ' ' || array_to_string({TOKENS}, ' ') || ' ' AS p FROM benchmark)
        SELECT item_id, count(doc_id) AS hits, (count(doc_id) > 0)::INT AS score
        FROM b LEFT JOIN d ON contains(body, p) GROUP BY item_id""",
)
def exact(t):
    items = t.benchmark.select("item_id", phrase().alias("phrase"))
    matches = C.exact_matches(t.documents, items, "doc_id", "text", "item_id", ["phrase"])
    return C.exact_scores(items, matches, "item_id", ["phrase"])


@query(
    "jn_exact_two_fields",
    f"""WITH d AS (SELECT doc_id, ' ' || array_to_string({TOKENS}, ' ') || ' ' AS body FROM documents),
             b AS (SELECT item_id, ' ' || array_to_string(({TOKENS})[1:3], ' ') || ' ' AS p,
                          ' ' || array_to_string(({TOKENS})[4:], ' ') || ' ' AS q FROM benchmark)
        SELECT doc_id, item_id FROM b JOIN d ON contains(body, p) AND contains(body, q)""",
)
def exact_two_fields(t):
    toks = C.match_tokens("text")
    items = t.benchmark.select(
        "item_id",
        F.array_join(F.slice(toks, 1, 3), " ").alias("question"),
        F.array_join(F.slice(toks, F.lit(4), F.size(toks)), " ").alias("answer"),
    )
    return C.exact_matches(t.documents, items, "doc_id", "text", "item_id", ["question", "answer"])


def _matches(t, threshold=None):
    return C.ngram_matches(t.documents, t.benchmark, "doc_id", "text", "item_id", ["text"], N, threshold)


@query("jn_ngram_pairs", PAIRS_SQL + "SELECT doc_id, item_id, round(score, 6) AS score FROM pairs")
def ngram_pairs(t):
    return C.all_pairs(_matches(t), "doc_id", "item_id").select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query(
    "jn_ngram_items",
    PAIRS_SQL + """SELECT item_id, round(coalesce(max(score), 0), 6) AS score
                   FROM benchmark LEFT JOIN pairs USING (item_id) GROUP BY item_id""",
)
def ngram_items(t):
    return C.item_scores(t.benchmark, _matches(t).scores, "item_id", ["text"]).select("item_id", F.round("score", 6).alias("score"))


@query("jn_ngram_rows", PAIRS_SQL + "SELECT doc_id, round(max(score), 6) AS score FROM pairs GROUP BY doc_id")
def ngram_rows(t):
    return C.row_scores(_matches(t), "doc_id").select("doc_id", F.round("score", 6).alias("score"))


@query(
    "jn_ngram_above",
    PAIRS_SQL + "SELECT doc_id, item_id, round(score, 6) AS score FROM pairs WHERE score > 0.5",
)
def ngram_above(t):
    pairs = C.ngram_pairs_above(t.documents, t.benchmark, "doc_id", "text", "item_id", ["text"], N, 0.5)
    return pairs.select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query(
    "jn_matrix",
    PAIRS_SQL + """, per AS (
        SELECT lang, item_id % 3 AS ev, item_id, max(coalesce(score, 0)) AS score
        FROM (SELECT DISTINCT lang FROM documents) l CROSS JOIN benchmark
        LEFT JOIN (SELECT d.lang, p.* FROM pairs p JOIN documents d USING (doc_id)) p USING (lang, item_id)
        GROUP BY ALL)
      SELECT lang, round(avg((score > 0.5)::INT) FILTER (ev = 0), 4) AS eval0,
             round(avg((score > 0.5)::INT) FILTER (ev = 1), 4) AS eval1,
             round(avg((score > 0.5)::INT) FILTER (ev = 2), 4) AS eval2
      FROM per GROUP BY lang""",
)
def matrix(t):
    # one training set per language; the set list times the item list is the report itself
    best = C.set_scores(_matches(t, 0.5), t.documents, "doc_id", "lang", "item_id")
    sets = t.documents.select("lang").distinct().agg(F.collect_set("lang").alias("langs"))
    langs = F.array(*[F.lit(x) for x in sorted(sets.first()["langs"])])
    cells = t.benchmark.select("item_id", F.explode(langs).alias("lang")).join(best, ["lang", "item_id"], "left")
    scores = cells.select(
        "lang", F.concat(F.lit("eval"), (F.col("item_id") % 3).cast("string")).alias("ev"), F.coalesce("best", F.lit(0.0)).alias("score")
    )
    return C.match_matrix(scores, "lang", "ev", 0.5, ["eval0", "eval1", "eval2"])


@query(
    "jn_decontaminate",
    PAIRS_SQL + """SELECT doc_id, lang, source FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM pairs WHERE score > 0.5)""",
)
def decontaminate(t):
    bad = C.contaminated(_matches(t, 0.5), "doc_id")
    return C.drop_contaminated(t.documents, bad, "doc_id").select("doc_id", "lang", "source")


@query(
    "jn_kept_report",
    PAIRS_SQL + """, bad AS (SELECT DISTINCT doc_id FROM pairs WHERE score > 0.5)
      SELECT count(*) AS total, count(bad.doc_id) AS removed,
             round(100.0::DOUBLE * (count(*) - count(bad.doc_id)) / count(*), 2) AS kept_pct
      FROM documents LEFT JOIN bad USING (doc_id)""",
)
def kept(t):
    bad = C.contaminated(_matches(t, 0.5), "doc_id")
    return C.kept_report(t.documents, bad, "doc_id")


@query(
    "flagship_decontaminated_languages",
    PAIRS_SQL + """, bad AS (SELECT DISTINCT doc_id FROM pairs WHERE score > 0.5),
      kept AS (SELECT lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM bad))
      SELECT lang AS language, count(*) AS n,
             round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM kept), 4) AS pct
      FROM kept GROUP BY lang""",
)
def flagship(t):
    return language_report(t.documents, t.benchmark, n=N, threshold=0.5)
