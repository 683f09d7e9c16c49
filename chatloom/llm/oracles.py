"""SQL twins of the queries that SQL can say, for DuckDB."""

from __future__ import annotations

from chatloom.llm import licences, warc

WORD = r"[^\x20\x09-\x0D]+"
ANY_CASE = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
KEYWORDS = "|".join([*map(ANY_CASE, ("password", "passwd", "secret", "token")), ANY_CASE("api") + "_?" + ANY_CASE("key")])
ASSIGN = rf"(({KEYWORDS})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+))"


def _matches(kind: str, order: int, pattern: str, value: int, least: int) -> str:
    whole = rf"(?s)(.*?){pattern}"
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS ord, {least} AS least,
      unnest(regexp_extract_all(t, '{whole}', 1)) AS pre, unnest(regexp_extract_all(t, '{whole}', 2)) AS mat, unnest(regexp_extract_all(t, '{whole}', {value})) AS val,
      generate_subscripts(regexp_extract_all(t, '{whole}', 2), 1) AS i FROM d"""


# No table of ours holds a checksummed token, so all spans are base spans here; the checksums are tested on their own.
SECRETS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_matches("assign", 0, ASSIGN, 4, 6)} UNION ALL {_matches("access", 1, "(AKIA[A-Z0-9]+)", 2, 20)} UNION ALL {_matches("hex", 2, "([0-9a-f]{24,})", 2, 24)}),
p AS (SELECT doc_id, kind, ord, least, length(val) AS n, length(mat) AS w,
      sum(length(pre) + length(mat)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM m),
s AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
      string_agg(kind || ':' || (e - w)::BIGINT || ':' || e::BIGINT, ',' ORDER BY e - w, ord) AS spans FROM p WHERE n >= least GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (doc_id)"""


def _plain_text(html: str) -> str:
    each = lambda text, pattern, by: f"regexp_replace({text}, '{pattern}', {by}, 'g')"
    out = each(html, "(?s)<!--.*?-->", "''")
    for tag in warc.HIDDEN:
        out = each(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "''")
    out = each(out, r"[ \t\n\r\x0b\x0c]+", "' '")
    out = each(out, rf"(?i)</?(?:{warc.BLOCKS})\b[^>]*>", "chr(10)")
    out = each(out, r"<[a-zA-Z/!?][^>]*>", "''")
    for name, char in warc.NAMED:
        out = f"replace({out}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return out


_NUMBER = "regexp_extract(p, '^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});', 1)"
_VALUE = f"CASE WHEN {_NUMBER} SIMILAR TO '[xX].*' THEN ('0x' || substr({_NUMBER}, 2))::INT ELSE {_NUMBER}::INT END"
_CHAR = f"CASE WHEN ({_VALUE}) BETWEEN 1 AND 55295 OR ({_VALUE}) BETWEEN 57344 AND 1114111 THEN chr({_VALUE}) ELSE '�' END"
_DECODED = f"""t[1] || coalesce(list_aggregate(list_transform(t[2:], lambda p: CASE WHEN {_NUMBER} = '' THEN '&#' || p
  ELSE {_CHAR} || regexp_replace(p, '^[0-9a-zA-Z]+;', '') END), 'string_agg', ''), '')"""


def _uuid(text: str) -> str:
    pieces = " || '-' || ".join(f"substr(md5({text}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {pieces} || '>'"


WARC = f"""WITH r AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS body, 'sha256:' || sha256(coalesce(html, '')) AS source_digest,
    string_split({_plain_text("coalesce(html, '')")}, '&#') AS t FROM pages),
n AS (SELECT *, {_uuid("'response ' || page_id || ' ' || coalesce(target_uri, '') || ' ' || source_digest")} AS refers_to, chr(13) || chr(10) AS nl, {_DECODED} AS plain FROM r),
x AS (SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type, 'http-status-line: HTTP/1.1 200 OK' || nl || 'http-header-Content-Type: text/html; charset=utf-8' || nl
    || 'http-header-Content-Length: ' || strlen(body) || nl || 'source-record: ' || refers_to || nl || 'source-payload-digest: ' || source_digest || nl AS block FROM n
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8',
    regexp_replace(regexp_replace(replace(plain, '&amp;', '&'), ' *\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g') FROM n)
SELECT page_id, {_uuid("'derived ' || warc_type || ' ' || refers_to")} AS record_id, warc_type, target_uri, '2020-01-01T00:00:00Z' AS warc_date, content_type, refers_to,
  source_digest, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length, true AS digest_ok, block FROM x"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.c, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) c USING (doc_id)"""

EMBEDDINGS = """WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
z AS (SELECT vec_id, e, len(e) AS n FROM v WHERE list_dot_product(e, e) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM z a JOIN z b ON a.n = b.n AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, x.b FROM reach r JOIN e x ON r.b = x.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, least(vec_id, coalesce(c, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a) USING (vec_id) LEFT JOIN (SELECT a AS vec_id, min(b) AS c FROM reach GROUP BY a) USING (vec_id)"""

LINES = f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS ln FROM documents),
w AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS words FROM l),
u AS (SELECT doc_id, ln, line, unnest(range(1, 2 + least(2, words // 20))) AS k FROM w WHERE words > 0),
r AS (SELECT doc_id, row_number() OVER d AS pos, ln AS l0, lead(ln) OVER d AS l1, lead(ln, 2) OVER d AS l2, line AS s0, k AS k0,
  lead(line) OVER d AS s1, lead(k) OVER d AS k1, lead(line, 2) OVER d AS s2, lead(k, 2) OVER d AS k2 FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY ln, k)),
x AS (SELECT *, row_number() OVER (PARTITION BY s0, k0, s1, k1, s2, k2 ORDER BY doc_id, pos) AS nth FROM r WHERE l2 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([l0, l1, l2]) AS ln FROM x WHERE nth > 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY ln) AS t FROM l ANTI JOIN gone USING (doc_id, ln) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(kept.t, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines, coalesce(n.n, 0) AS n_removed
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_CLAUSES = ", ".join(
    f"({t}, '{c.label}', {len(c.words)}, {c.least}, {len(c.must)}, {c.base}, {i}, '{w}', {i in c.must})" for t, c in enumerate(licences.clauses()) for i, w in enumerate(c.words)
)
LICENCES = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
c(t, label, m, least, n_must, base, i, word, must) AS (VALUES {_CLAUSES}),
w AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
p AS (SELECT r, t, label, base, pos - i AS start, count(*) / any_value(m) AS share FROM w JOIN c USING (word) GROUP BY r, t, label, base, pos - i
  HAVING count(*) >= any_value(least) AND count_if(must) = any_value(n_must)),
s AS (SELECT r, count_if(base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, max(share) AS score FROM p GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN s USING (r)"""

# CRC-32 by its table, over strings of ASCII; then one row per turn and state pattern: the cheapest (cost, audit) that ends in each state.
_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"""
_BEFORE = {0: (), 1: ((0, "s"),), 2: ((0, "u"), (1, "u"), (3, "u")), 3: ((2, "a"),)}


def _state(q: int) -> str:
    """The cheapest way into state q: from each state before, with up to two new turns, by a turn that is deleted, kept or given another role."""
    new = lambda x, n: f"{{'c': {x}.c + {5 * n}, 'a': {x}.a || '{'I' * n}'}}"
    reach = {0: ["s.s0"], 1: ["s.s1"], 2: ["s.s2", *(new(f"s.s{p}", 1) for p in (0, 1, 3))], 3: ["s.s3", new("s.s2", 1), *(new(f"s.s{p}", 2) for p in (0, 1))]}
    step = lambda x, cost, edit: f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{edit}'}}"
    ways = [step(x, 2, "D") for x in reach[q]]
    for p, role in _BEFORE[q]:
        for x in reach[p]:
            ways.append(f"CASE WHEN NOT t.must AND t.i = '{role}' THEN {step(x, 't.extra', 'K')} END")
            if role != "s":
                ways.append(f"CASE WHEN NOT t.must THEN {step(x, '1 + t.extra', 'R')} END")
    return f"list_min([{', '.join(ways)}])"


_ENDS = "[s.s0, s.s3, {'c': s.s0.c + 10, 'a': s.s0.a || 'II'}, {'c': s.s1.c + 10, 'a': s.s1.a || 'II'}, {'c': s.s2.c + 5, 'a': s.s2.a || 'I'}]"
_FAR = "{'c': 1000000000::BIGINT, 'a': ''}"
REPAIR = f"""WITH RECURSIVE x AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k, {_TABLE} AS crc FROM conversations),
y AS (SELECT conv_id, turn, role, text, {_CRC} % 20 AS kind FROM x),
z AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM y),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(role, 1, 32), md5(length(role) || ':' || role || text)) AS n,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e FROM z),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM o),
t AS (SELECT *, CASE WHEN e = '' THEN 'b' WHEN again THEN 'd' WHEN e IN ('.', '!', '?') THEN '-' ELSE 't' END AS fault, e = '' OR again AS must, CASE WHEN NOT (e = '' OR again) AND e NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra FROM f),
s(conv_id, n, s0, s1, s2, s3) AS (SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': ''}}, {_FAR}, {_FAR}, {_FAR} FROM t
  UNION ALL SELECT s.conv_id, t.n, {", ".join(map(_state, range(4)))} FROM s JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.n + 1),
b AS (SELECT conv_id, list_min({_ENDS}) AS best FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
p AS (SELECT conv_id, best.a AS audit, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS j FROM b WHERE best.a <> ''),
q AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS n FROM p),
r AS (SELECT q.conv_id, j, edit, t.role, t.text, t.i, row_number() OVER (PARTITION BY q.conv_id ORDER BY j) AS m,
  first_value(edit = 'K' AND t.i = 's') OVER (PARTITION BY q.conv_id ORDER BY j) AS sys FROM q JOIN t ON t.conv_id IS NOT DISTINCT FROM q.conv_id AND t.n = greatest(q.n, 1) WHERE edit <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role ELSE CASE WHEN (m + CASE WHEN sys THEN 0 ELSE 1 END) % 2 = 0 THEN 'user' ELSE 'assistant' END END
  || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS repaired_sha256 FROM r GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
  count_if(before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM d.conv_id"""

_PRICE = lambda n, total: f"(1 + (1000000000 * ({n} + 1)::HUGEINT) // ({total} + v))"
DIVERGENCE = f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(t, 0)::HUGEINT AS t FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS t FROM c GROUP BY ALL) USING (lang, source)),
l AS (SELECT lang, term, sum(n)::HUGEINT AS n, (sum(sum(n)) OVER (PARTITION BY lang))::HUGEINT AS t FROM c GROUP BY lang, term),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_PRICE("coalesce(c.n, 0)", "g.t")} AS p FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, {_PRICE("n", "t")} AS q FROM l JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM e
QUALIFY part = 'pair' OR rank <= 200"""

ORACLES = {
    "op2_secret_scan": SECRETS, "op4_warc_derivatives": WARC, "op6_jaccard_join": JACCARD, "op8_product_quantisation": EMBEDDINGS, "op10_line_dedup": LINES,
    "op11_licence_scan": LICENCES, "op12_conversation_repair": REPAIR, "op13_divergence_audit": DIVERGENCE,
}
