"""Queries: preference construction and group-relative scores."""

from pyspark.sql import functions as F

from chatloom.catalog.data import SAMPLES_SQL, samples
from chatloom.catalog.registry import query
from chatloom.functions.chat import flat
from chatloom.operators import preferences as P


def best_sql(groups):
    g = "".join(f"{x}, " for x in groups)
    return f"""SELECT {g}prompt, arg_max(sample, score * 1e9::DOUBLE - sample / 1e3::DOUBLE) AS best, max(score) AS best_score,
      arg_min(sample, score * 1e9::DOUBLE + sample / 1e3::DOUBLE) AS worst, min(score) AS worst_score FROM {SAMPLES_SQL} GROUP BY {g}prompt"""


@query("pf_best_worst", best_sql([]))
def best(t):
    g = P.best_and_worst(samples(t), "prompt", "sample", "score", [])
    return g.select("prompt", F.col("best.sample").alias("best"), F.col("best.score").alias("best_score"), F.col("worst.sample").alias("worst"), F.col("worst.score").alias("worst_score"))


@query("pf_best_worst_judges", best_sql(["judge"]))
def best_judges(t):
    g = P.best_and_worst(samples(t), "prompt", "sample", "score", [], groups=["judge"])
    return g.select("judge", "prompt", F.col("best.sample").alias("best"), F.col("best.score").alias("best_score"), F.col("worst.sample").alias("worst"), F.col("worst.score").alias("worst_score"))


@query(
    "pf_best_worst_no_reference",
    f"SELECT prompt, max(score) AS best_score, min(score) AS worst_score FROM {SAMPLES_SQL} WHERE sample % 8 <> 1 GROUP BY prompt",
)
def best_no_reference(t):
    rows = samples(t).withColumn("ref", F.col("sample") % 8 == 1)
    g = P.best_and_worst(rows, "prompt", "sample", "score", [], reference="ref")
    return g.select("prompt", F.col("best.score").alias("best_score"), F.col("worst.score").alias("worst_score"))


VOTES = f"(SELECT prompt, judge, arg_max(model % 3, score * 1e9::DOUBLE - sample / 1e3::DOUBLE) AS choice FROM {SAMPLES_SQL} GROUP BY prompt, judge)"


@query(
    "pf_majority",
    f"""WITH v AS {VOTES}, c AS (SELECT prompt, choice, count(*) AS n, min(judge) AS f FROM v GROUP BY ALL),
      k AS (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY n DESC, f) AS a, row_number() OVER (PARTITION BY prompt ORDER BY md5('42:' || prompt || ':' || choice)) AS b,
              sum(n) OVER (PARTITION BY prompt) = count(*) OVER (PARTITION BY prompt) AS split FROM c)
      SELECT prompt, choice FROM k WHERE CASE WHEN split THEN b = 1 ELSE a = 1 END""",
)
def majority(t):
    votes = P.best_and_worst(samples(t), "prompt", "sample", "score", ["model"], groups=["judge"]).select(
        "prompt", "judge", (F.col("best.model") % 3).alias("choice")
    )
    return P.majority(votes, "prompt", "judge", "choice")


@query(
    "pf_preference_rows",
    f"""WITH b AS (SELECT prompt, judge, max(score) AS hi, min(score) AS lo FROM {SAMPLES_SQL} GROUP BY ALL)
      SELECT prompt, 'c' || prompt AS chosen, 'r' || prompt AS rejected, string_agg(judge || '=' || hi, ',' ORDER BY judge) AS chosen_scores,
        string_agg(judge || '=' || lo, ',' ORDER BY judge) AS rejected_scores FROM b GROUP BY prompt""",
)
def preference_rows(t):
    g = P.best_and_worst(samples(t), "prompt", "sample", "score", [], groups=["judge"])
    c = g.select("prompt", "judge", F.col("best.score").alias("s"), F.concat(F.lit("c"), "prompt").alias("text"))
    r = g.select("prompt", "judge", F.col("worst.score").alias("s"), F.concat(F.lit("r"), "prompt").alias("text"))
    rows = P.preference_rows(c, r, "prompt", "judge", "s", "text")
    show = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return rows.select("prompt", "chosen", "rejected", show("chosen_scores").alias("chosen_scores"), show("rejected_scores").alias("rejected_scores"))


ASPECTS = ["helpfulness", "correctness", "coherence", "complexity", "verbosity"]
RATED = """SELECT l_partkey AS prompt, l_orderkey * 8 + l_linenumber AS idx, 'r' || (l_orderkey * 8 + l_linenumber) AS response,
  (l_orderkey % 5)::DOUBLE AS helpfulness, (l_suppkey % 5)::DOUBLE AS correctness, (l_linenumber % 5)::DOUBLE AS coherence,
  floor(l_quantity % 5) AS complexity, floor(l_tax * 50) AS verbosity FROM lineitem"""


def rated(t):
    return t.lineitem.select(
        F.col("l_partkey").alias("prompt"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("idx"),
        F.concat(F.lit("r"), F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("response"),
        (F.col("l_orderkey") % 5).cast("double").alias("helpfulness"), (F.col("l_suppkey") % 5).cast("double").alias("correctness"),
        (F.col("l_linenumber") % 5).cast("double").alias("coherence"), F.floor(F.col("l_quantity") % 5).cast("double").alias("complexity"),
        F.floor(F.col("l_tax") * 50).cast("double").alias("verbosity"),
    )


def binarize_sql(score, where):
    return f"""WITH x AS ({RATED}), s AS (SELECT prompt, idx, response, {score} AS s FROM x),
      k AS (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY s DESC, idx) AS hi, row_number() OVER (PARTITION BY prompt ORDER BY s, idx DESC) AS lo, count(*) OVER (PARTITION BY prompt) AS n FROM s)
      SELECT c.prompt, c.response AS chosen, r.response AS rejected, round(c.s, 2) AS chosen_score, round(r.s, 2) AS rejected_score
      FROM k c JOIN k r ON c.prompt = r.prompt AND c.hi = 1 AND r.lo = 1 WHERE c.n >= 2 AND c.s <> r.s AND {where}"""


@query("pf_binarize", binarize_sql("(helpfulness + correctness + coherence + complexity) / 4", "c.s >= 2.5 AND c.s - r.s >= 1"))
def binarize(t):
    return P.binarize(rated(t), "prompt", "idx", "response", P.mean_score(ASPECTS, ["verbosity"]), 2.5, 1.0)


@query(
    "pf_binarize_weighted",
    binarize_sql("0.0::DOUBLE + helpfulness * 0.65::DOUBLE + correctness * 0.8::DOUBLE + coherence * 0.45::DOUBLE + complexity * 0.55::DOUBLE + verbosity * (-0.4::DOUBLE)", "c.s >= 2"),
)
def binarize_weighted(t):
    return P.binarize(rated(t), "prompt", "idx", "response", P.weighted_score(), 2.0)


@query(
    "pf_ranked_pick",
    """WITH a AS (SELECT l_partkey AS prompt, l_orderkey * 8 + l_linenumber AS id, l_quantity AS rank, CASE WHEN l_linenumber = 3 THEN 'x Human: ' ELSE '' END || 'a' || (l_orderkey * 8 + l_linenumber) AS text,
          md5('42:' || (l_orderkey * 8 + l_linenumber)) AS h FROM lineitem),
       v AS (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY rank, h) AS rn FROM a WHERE NOT regexp_matches(text, 'Human:|Assistant:')),
       c AS (SELECT prompt, arg_min(text, h) AS chosen, min(h) AS h FROM v WHERE rn <= 4 GROUP BY prompt)
       SELECT c.prompt, c.chosen, arg_max(v.text, v.h) AS rejected FROM v JOIN c ON v.prompt = c.prompt AND v.h <> c.h GROUP BY c.prompt, c.chosen""",
)
def ranked_pick(t):
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    text = F.concat(F.when(F.col("l_linenumber") == 3, "x Human: ").otherwise(""), F.lit("a"), key)
    rows = t.lineitem.select(F.col("l_partkey").alias("prompt"), key.alias("id"), F.col("l_quantity").alias("rank"), text.alias("text"))
    return P.pick_from_ranks(rows, "prompt", "rank", "text", "id")


@query(
    "pf_score_pair",
    """SELECT doc_id, abs((doc_id % 3) - (n_chars % 3))::DOUBLE AS margin,
         'assistant: ' || CASE WHEN doc_id % 3 > n_chars % 3 THEN source ELSE lang END AS chosen_answer, md5('user: q' || chr(10) || chr(10) || '1. ' || lang || chr(10) || chr(10) || '2. ' || source) AS ask
       FROM documents WHERE doc_id % 3 <> n_chars % 3""",
)
def score_pair(t):
    d = t.documents.select(
        "doc_id", F.lit("q").alias("question"), F.col("source").alias("a0"), F.col("lang").alias("a1"), F.array("lang", "source").alias("quotes"),
        (F.col("doc_id") % 3).cast("double").alias("s0"), (F.col("n_chars") % 3).cast("double").alias("s1"),
    )
    out = P.score_pair(d, "question", [("a0", "quotes", "s0"), ("a1", "quotes", "s1")])
    one = lambda i: flat(F.slice("chosen", i, 1))
    return out.select("doc_id", "margin", one(3).alias("chosen_answer"), F.md5(one(2)).alias("ask"))


@query(
    "pf_append_turns",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: hm' || chr(10) || 'assistant: ' || lang AS chosen,
         'user: ' || source || chr(10) || 'assistant: hm' || chr(10) || 'assistant: ' || text AS rejected FROM documents""",
)
def append_turns(t):
    from chatloom.operators.conversions import user_assistant

    c, r = P.append_turns(user_assistant("source", F.lit("hm")), "lang", F.col("text"))
    return t.documents.select("doc_id", flat(c).alias("chosen"), flat(r).alias("rejected"))


# Annotations: two aspects per document, three rated responses each, some unreadable, some N/A.
NOTE = """CASE WHEN code = 'ins' THEN concat('Rating: ', doc_id % 5, chr(10), 'Rationale: ok', chr(10), chr(10), 'Rating: N/A', chr(10), 'Rationale: none', chr(10), chr(10), 'nothing')
  ELSE concat('Type: 1', chr(10), 'Rationale: a', chr(10), 'Rating: ', n_chars % 5 + 1, chr(10), 'Rationale: b', chr(10), chr(10), 'Type: None', chr(10), 'Rationale: a', chr(10), 'Rating: 4 of 5', chr(10), 'Rationale: b', chr(10), chr(10), 'odd') END"""
RATINGS = """r AS (SELECT doc_id::VARCHAR AS id, 0 AS pos, (doc_id % 5 + n_chars % 5 + 1) / 2.0::DOUBLE AS rating FROM documents
  UNION ALL SELECT doc_id::VARCHAR, 1, 4 FROM documents UNION ALL SELECT doc_id::VARCHAR, 2, 1 FROM documents)"""


def notes(t):
    d = t.documents.select("doc_id", "n_chars", F.explode(F.array(F.lit("ins"), F.lit("hel"))).alias("code"))
    return d.select(F.concat_ws("_", "doc_id", "code").alias("custom_id"), F.expr(NOTE).alias("output"))


def rated_notes(t):
    key, aspect = P.decode_aspect("custom_id")
    return notes(t).select(key.alias("id"), P.parse_ratings("output", aspect).alias("ratings"))


@query("pf_mean_ratings", f"WITH {RATINGS} SELECT id, pos, rating FROM r")
def mean_ratings(t):
    return P.mean_ratings(rated_notes(t), "id", "ratings")


@query(
    "pf_binarize_ratings",
    f"""WITH {RATINGS}, b AS (SELECT id, arg_max(pos, rating * 10 - pos) AS c FROM r GROUP BY id),
      o AS (SELECT r.id, c, arg_min(pos, md5('42:' || r.id || ':' || pos)) AS x FROM r JOIN b USING (id) WHERE pos <> c GROUP BY r.id, c)
      SELECT o.id, ['t0', 't1', 't2'][c + 1] AS chosen, ['t0', 't1', 't2'][x + 1] AS rejected, ['m0', 'm1', 'm2'][c + 1] AS chosen_model, ['m0', 'm1', 'm2'][x + 1] AS rejected_model,
        a.rating AS chosen_rating, z.rating AS rejected_rating FROM o JOIN r a ON a.id = o.id AND a.pos = c JOIN r z ON z.id = o.id AND z.pos = x""",
)
def binarize_ratings(t):
    texts = F.array(F.lit("t0"), F.lit("t1"), F.lit("t2"))
    models = F.array(F.lit("m0"), F.lit("m1"), F.lit("m2"))
    done = t.documents.select(F.col("doc_id").cast("string").alias("id"), texts.alias("texts"), models.alias("models"))
    return P.binarize_ratings(P.mean_ratings(rated_notes(t), "id", "ratings"), done, "id", "models", "texts")


@query("pf_annotation_complete", "SELECT unnest(['aspect', 'id']) AS by, true AS even")
def complete(t):
    return P.annotation_completeness(notes(t), "custom_id")


@query(
    "pf_annotation_mix",
    """SELECT doc_id, source AS raw_text, a AS aspect, 'Rate ' || a || ' of ' || source || ':' || chr(10) || '<text 1> ' || lang || chr(10) || '<text 2> x' AS text
       FROM documents, (VALUES ('honesty'), ('helpfulness')) v(a)""",
)
def mix(t):
    prompts = {a: f"Rate {a} of {{instruction}}:\n{{completions}}" for a in ("honesty", "helpfulness")}
    d = t.documents.select("doc_id", "source", F.array(F.col("lang"), F.lit("x")).alias("completions"))
    return P.annotation_mix(d, "doc_id", "source", "completions", prompts).select("doc_id", "raw_text", "aspect", "text")


@query(
    "pf_judged_pair",
    """SELECT doc_id, CASE WHEN (doc_id % 2 = 0) <> (doc_id % 3 = 0) THEN 'A' ELSE 'B' END AS chosen, CASE WHEN (doc_id % 2 = 0) <> (doc_id % 3 = 0) THEN 'B' ELSE 'A' END AS rejected, 'fine ' || lang AS comparison
       FROM documents WHERE doc_id % 7 <> 0""",
)
def judged(t):
    verdict = "CASE WHEN doc_id % 7 = 0 THEN 'no idea' ELSE concat('Comparison: fine ', lang, ' Preferred: ', doc_id % 2) END"
    d = t.documents.select("doc_id", F.expr(verdict).alias("j"), (F.col("doc_id") % 3 == 0).alias("swapped"), F.lit("A").alias("a"), F.lit("B").alias("b"))
    c, r, why = P.judged_pair("j", "swapped", "a", "b")
    return d.select("doc_id", c.alias("chosen"), r.alias("rejected"), why.alias("comparison")).dropna()


@query(
    "pf_advantage",
    f"""SELECT prompt, sample, round((score - avg(score) OVER w) / (stddev_pop(score) OVER w + 1e-8::DOUBLE), 6) AS advantage, round(score - avg(score) OVER w, 6) AS centred
        FROM {SAMPLES_SQL} WINDOW w AS (PARTITION BY prompt)""",
)
def advantage(t):
    rows = P.advantages(samples(t), "prompt", "score").withColumnRenamed("advantage", "a")
    both = P.advantages(rows, "prompt", "score", normalise=False)
    return both.select("prompt", "sample", F.round("a", 6).alias("advantage"), F.round("advantage", 6).alias("centred"))


LEVELS = f"(SELECT prompt, sample, finish, CASE prompt % 6 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE score END::DOUBLE AS s FROM {SAMPLES_SQL})"


def levels(t):
    return samples(t).withColumn("s", F.expr("CASE prompt % 6 WHEN 0 THEN 0D WHEN 1 THEN 10D WHEN 2 THEN 5D ELSE score END"))


@query("pf_informative_groups", f"SELECT prompt, sample FROM {LEVELS} WHERE finish = 'O' AND prompt IN (SELECT prompt FROM {LEVELS} GROUP BY prompt HAVING min(s) < max(s))")
def informative(t):
    kept, _ = P.informative_groups(levels(t), "prompt", "s", 10.0)
    return P.finished(kept.withColumn("f", F.expr("CASE finish WHEN 'O' THEN 'stop' ELSE 'length' END")), "f").select("prompt", "sample")


@query(
    "pf_dropped_groups",
    f"""SELECT count(*) AS dropped, count(*) FILTER (lo = 0) AS zero, count(*) FILTER (lo = 10) AS solved, count(*) FILTER (lo NOT IN (0, 10)) AS other
        FROM (SELECT prompt, min(s) AS lo, max(s) AS hi FROM {LEVELS} GROUP BY prompt) WHERE lo = hi""",
)
def dropped(t):
    return P.informative_groups(levels(t), "prompt", "s", 10.0)[1]


@query("pf_solved_prompts", f"SELECT prompt FROM {LEVELS} GROUP BY prompt HAVING avg(s) / 50 >= 0.5")
def solved(t):
    return P.solved_prompts(levels(t), "prompt", "s", 50.0, 0.5)


# A trajectory is one embedding: its numbers are the values, its shifted numbers the rewards.
def gae_sql(cut):
    return f"""WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
      d AS (SELECT vec_id, i, v, v * 0.5 + 0.1::DOUBLE + 0.9 * coalesce(lead(v) OVER w, 0) * {cut} - v AS delta, 0.9 * 0.8 * {cut} AS c FROM x WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
      r AS (SELECT vec_id, i, v, sum(CASE WHEN c = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg, delta FROM d)
      SELECT a.vec_id, a.i - 1 AS t, round(sum(b.delta * power(0.72::DOUBLE, b.i - a.i)), 6) AS advantage, round(sum(b.delta * power(0.72::DOUBLE, b.i - a.i)) + any_value(a.v), 6) AS "return"
      FROM r a JOIN r b ON a.vec_id = b.vec_id AND b.i >= a.i AND coalesce(a.seg, 0) = coalesce(b.seg, 0) GROUP BY a.vec_id, a.i"""


def gae(t, dones):
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = t.embeddings.select(
        "vec_id", v.alias("v"), F.transform(v, lambda x: x * 0.5 + 0.1).alias("r"), F.transform("embedding", dones).alias("d"),
        F.transform("embedding", lambda x: F.lit(1)).alias("m"),
    )
    got = rows.select("vec_id", P.gae(0.9, 0.8)("v", "r", "d", "m").alias("g"))
    flat_rows = got.select("vec_id", F.posexplode(F.arrays_zip(F.col("g.advantages").alias("a"), F.col("g.returns").alias("r"))).alias("t", "x"))
    return flat_rows.select("vec_id", F.col("t").cast("long").alias("t"), F.round("x.a", 6).alias("advantage"), F.round("x.r", 6).alias("return"))


@query("pf_gae", gae_sql("1"))
def gae_plain(t):
    return gae(t, lambda x, i: F.lit(0))


@query("pf_gae_packed", gae_sql("(CASE WHEN i % 16 = 0 THEN 0 ELSE 1 END)"))
def gae_packed(t):
    return gae(t, lambda x, i: F.when(i % 16 == 15, 1).otherwise(0))


@query(
    "pf_masked_mean",
    """SELECT vec_id, round(list_sum([x::DOUBLE FOR x IN embedding IF x > 0]) / len([x FOR x IN embedding IF x > 0]), 6) AS mean,
         round(list_sum([x::DOUBLE FOR x IN embedding IF x > 0]) / 64, 6) AS fixed FROM embeddings""",
)
def masked_mean(t):
    mask = F.transform("embedding", lambda x: (x > 0).cast("double"))
    v = F.transform("embedding", lambda x: x.cast("double"))
    return t.embeddings.select("vec_id", F.round(P.masked_mean(v, mask), 6).alias("mean"), F.round(P.masked_mean(v, mask, 64.0), 6).alias("fixed"))


@query("pf_masked_mean_all", "SELECT round(avg(x), 6) AS mean FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings) WHERE x > 0")
def masked_mean_all(t):
    d = t.embeddings.select(F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.transform("embedding", lambda x: (x > 0).cast("double")).alias("m"))
    return P.masked_mean_all(d, "v", "m").select(F.round("mean", 6).alias("mean"))
