"""Queries: repetition inside texts."""

from pyspark.sql import functions as F

from chatloom.catalog.filters import sql_text
from chatloom.catalog.registry import query
from chatloom.operators import repetition as R

# Texts with the shapes the detector distinguishes, spread over all documents.
LOOPED = """CASE doc_id % 9
 WHEN 0 THEN concat(text, repeat(' Thrive goes on by day.', 12))
 WHEN 1 THEN concat(replace(text, chr(10), concat(chr(10), chr(10))), repeat(concat(chr(10), chr(10), 'Once more the very same lines, all of them'), 11))
 WHEN 2 THEN concat(text, repeat(' y = k + 3. Another line, plus more.', 9))
 WHEN 3 THEN concat('1. a', chr(10), '2. b', chr(10), text, repeat(concat(chr(10), chr(10), 'An item', chr(10), 'over two lines'), 14))
 WHEN 4 THEN concat(text, repeat('. maybe so', 5), repeat('. Mary sang', 3))
 ELSE text END"""
WS = "concat(' ', chr(9), chr(10), chr(13))"
BLOCKS = f"""
x AS (SELECT doc_id, {LOOPED} AS text FROM documents),
p0 AS (SELECT doc_id, 0 AS kind, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda s: trim(s, {WS})), lambda s: s <> '') AS a FROM x
  UNION ALL SELECT doc_id, 1, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(s, {WS})), lambda s: s <> '') FROM x),
b AS (SELECT doc_id, kind, unnest(a) AS block, unnest(generate_series(0, len(a) - 1)) AS pos FROM p0),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, kind, block ORDER BY pos) AS isl FROM b),
rl AS (SELECT doc_id, kind, block, isl, count(*) AS n, min(pos) AS p FROM runs GROUP BY ALL),
g AS (SELECT doc_id, kind, block, sum(n)::BIGINT AS total, max(n) AS longest, min(p) AS first,
             arg_min(n, p) FILTER (n > 1) AS run, min(p) FILTER (n > 1) AS start
      FROM rl GROUP BY doc_id, kind, block HAVING sum(n) > 1)
"""
STRUCTURED = f"""s AS (SELECT doc_id, len(l) >= 2 AND (len(list_filter(l, lambda z: regexp_matches(trim(z, {WS}), '^\\d+\\.\\s'))) >= 2
  OR len(list_filter(l, lambda z: regexp_matches(trim(z, {WS}), '^[\\-*•]\\s'))) >= 2) AS structured
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM x))"""


def _any(col, patterns, flags=""):
    return "(" + " OR ".join(f"regexp_matches({col}, {sql_text(flags + p)})" for p in patterns) + ")"


W = r"[\p{L}\p{N}_]"
UNI = lambda ps: [p.replace(r"\w", W) for p in ps]  # noqa: E731 - RE2 has an ASCII \w
SKIP = f"""((((regexp_matches(block, '[(\\[{{][^)\\]}}]*$') OR regexp_matches(block, '^[^(\\[{{]*[)\\]}}]'))
   AND NOT regexp_matches(block, '[(\\[{{][^(\\[{{)\\]}}]*[)\\]}}]')) OR {_any('block', UNI(R.CODE_STARTS), '(?i)')})
   OR {_any('block', UNI(R.MATH_PATTERNS))} OR lower(block) IN ('alternatively,', 'therefore,', 'however,'))"""
SHORT = "(" + " OR ".join(f"contains(lower(block), {sql_text(p)})" for p in R.SHORT_PHRASES) + f""" OR (
   regexp_matches(block, '^{W}+\\s*[<>]\\s*{W}+$') AND NOT ({" OR ".join(f"contains(lower(block), '{w}')" for w in R.CODE_WORDS)})))"""


def reasons_sql(p, n, r):
    return f"""WITH {BLOCKS}, {STRUCTURED},
v AS (SELECT doc_id, kind, block, total, longest, first, structured, regexp_matches(block, '[=+\\-*/^()\\[\\]{{}}<>|&~!@#$%\\\\]') AS math,
        {SKIP} AS skip, {SHORT} AS short FROM g JOIN s USING (doc_id) WHERE length(block) >= CASE kind WHEN 0 THEN 10 ELSE 5 END),
w AS (SELECT *, {p} * greatest(CASE WHEN structured THEN 3 ELSE 1 END, CASE WHEN contains(block, chr(10)) THEN 4 ELSE 1 END, CASE WHEN math THEN 2 ELSE 1 END) AS need,
        greatest(CASE WHEN structured THEN 3 ELSE 1 END, CASE WHEN math THEN 2 ELSE 1 END) AS f FROM v),
z AS (SELECT *, CASE WHEN kind = 0 THEN
   CASE WHEN NOT (longest = 1 AND length(block) < 20) AND NOT skip AND total >= CASE WHEN longest = 1 THEN least(need * 2, 30) ELSE need END
        THEN 'paragraph_repeated_' || total || 'x' END
  WHEN len(list_filter(regexp_split_to_array(block, '\\s+'), lambda q: q <> '')) <= 1 THEN NULL
  WHEN short THEN CASE WHEN longest >= {r} * 2 THEN 'line_repeated_' || total || 'x_consecutive_short_phrase' END
  WHEN skip THEN NULL
  WHEN longest >= {r} * f THEN 'line_repeated_' || total || 'x_consecutive'
  WHEN total >= {n} * f AND length(block) >= 10 THEN 'line_repeated_' || total || 'x' END AS reason FROM w)
SELECT doc_id, arg_min(reason, kind * 1000000 + first) AS reason, arg_min(total, kind * 1000000 + first) AS total,
       arg_min(longest, kind * 1000000 + first)::INT AS longest, arg_min(block, kind * 1000000 + first) AS block
FROM z WHERE reason IS NOT NULL GROUP BY doc_id"""


def looped(t):
    return t.documents.select("doc_id", F.expr(LOOPED).alias("text"))


def _reasons(t, p, n, r):
    return R.repetition_reasons(looped(t), "doc_id", "text", p, n, r)


@query("fl_repetition", reasons_sql(10, 40, 4))
def strict(t):
    return _reasons(t, 10, 40, 4)


@query("fl_repetition_loose", reasons_sql(3, 5, 2))
def loose(t):
    return _reasons(t, 3, 5, 2)


@query("fl_repetition_kept", f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({reasons_sql(25, 40, 20)}))")
def kept(t):
    return R.drop_repetitive(looped(t), "doc_id", "text", min_paragraph=25, min_line=40, min_run=20).select("doc_id")


@query(
    "fl_consecutive_runs",
    f"""WITH {BLOCKS} SELECT doc_id, kind, block, total, run::INT AS run, start::INT AS start,
        CASE WHEN run >= total THEN 'total_' ELSE 'consecutive_' END || CASE kind WHEN 0 THEN 'paragraph' ELSE 'line' END ||
        '_repeated_' || CASE WHEN run >= total THEN total ELSE run END || 'x' AS type
        FROM g WHERE longest > 1 AND length(block) >= CASE kind WHEN 0 THEN 20 ELSE 10 END""",
)
def runs(t):
    return R.consecutive_runs(looped(t), "doc_id", "text")


@query(
    "fl_ngram_repetitions",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda q: q <> '') AS a FROM documents),
       g AS (SELECT doc_id, array_to_string(a[i:i+2], ' ') AS ngram, i - 1 AS pos
             FROM w, LATERAL (SELECT unnest(generate_series(1, len(a) - 2)) AS i))
       SELECT doc_id, ngram, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS positions FROM g GROUP BY doc_id, ngram HAVING count(*) >= 2""",
)
def ngrams(t):
    return R.ngram_repetitions(t.documents, "doc_id", "text").withColumn("positions", F.array_join("positions", ","))
