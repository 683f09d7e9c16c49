"""Queries: win rates, annotators, ratings and series."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatloom.catalog.registry import query
from chatloom.operators import evaluation as E
from chatloom.session import broadcast_if_small, stored

# A battle per event: the verdict follows the event type, a dataset is a tenth of the users.
PREF = "CASE event_type WHEN 'click' THEN 0.2 WHEN 'view' THEN 0.5 WHEN 'purchase' THEN 0.9 WHEN 'signup' THEN 0.4 END"
B = f"(SELECT event_id, user_id % 10 AS dataset, ({PREF})::DOUBLE AS p, event_id % 3 = 0 AS ours, 'm' || user_id % 4 AS model, ['en','de','fr'][event_id % 3 + 1] AS lang FROM events)"


def battles(t):
    return t.events.select(
        "event_id", (F.col("user_id") % 10).alias("dataset"), F.expr(f"CAST({PREF} AS DOUBLE)").alias("p"), (F.col("event_id") % 3 == 0).alias("ours"),
        F.concat(F.lit("m"), F.col("user_id") % 4).alias("model"), F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr")), (F.col("event_id") % 3 + 1).cast("int")).alias("lang"),
    )


RATES = f"""SELECT dataset, count(*) FILTER (p < 0.5) AS a_wins, count(*) FILTER (p > 0.5) AS b_wins, count(*) FILTER (p = 0.5) AS ties, count(*) AS total,
  (count(*) FILTER (p < 0.5) + 0.5 * count(*) FILTER (p = 0.5))::DOUBLE / count(*) AS a_rate FROM {B} GROUP BY dataset"""


def result_rows(t):
    # results of two models for one battle, as the judge log stores them; null preferences are kept
    return t.events.select((F.col("user_id") % 10).alias("dataset"), F.array(F.expr(f"CAST({PREF} AS DOUBLE)")).alias("preferences"))


@query("ev_win_rates", f"SELECT dataset, a_wins, b_wins, ties, total, round(a_rate, 6) AS a_rate, round(1 - a_rate, 6) AS b_rate FROM ({RATES})")
def win_rates(t):
    r = E.win_rates(E.explode_preferences(result_rows(t), "dataset", "preferences"), "dataset", "preference")
    return r.withColumn("a_rate", F.round("a_rate", 6)).withColumn("b_rate", F.round("b_rate", 6))


@query("ev_macro_average", f"SELECT round(avg(a_rate), 6) AS a_rate, round(avg(1 - a_rate), 6) AS b_rate FROM ({RATES})")
def macro(t):
    r = E.macro_average(E.win_rates(battles(t), "dataset", "p"))
    return r.select(F.round("a_rate", 6).alias("a_rate"), F.round("b_rate", 6).alias("b_rate"))


COUNTS = f"SELECT model, lang, count(*) FILTER (p < 0.5) AS wins, count(*) FILTER (p = 0.5) AS ties, count(*) FILTER (p > 0.5) AS losses FROM {B} GROUP BY ALL"


@query(
    "ev_rate_pivot",
    f"""WITH c AS ({COUNTS}), r AS (SELECT model, lang, 1 - (wins + 0.5 * ties)::DOUBLE / (wins + ties + losses) AS r FROM c),
      p AS (SELECT model, max(r) FILTER (lang = 'de') AS de, max(r) FILTER (lang = 'en') AS en, max(r) FILTER (lang = 'fr') AS fr FROM r GROUP BY model
            UNION ALL SELECT 'base', 0.5, 0.5, 0.5)
      SELECT model, round(de, 6) AS de, round(en, 6) AS en, round(fr, 6) AS fr, round((de + en + fr) / 3, 6) AS average FROM p""",
)
def pivot(t):
    c = battles(t).groupBy("model", "lang").agg(
        F.count_if(F.col("p") < 0.5).alias("wins"), F.count_if(F.col("p") == 0.5).alias("ties"), F.count_if(F.col("p") > 0.5).alias("losses")
    )
    r = E.rate_pivot(c, "model", "lang", ["de", "en", "fr"], "base")
    return r.select("model", *[F.round(x, 6).alias(x) for x in ("de", "en", "fr", "average")])


LANG = f"""SELECT model, lang, avg(CASE WHEN p IS NULL OR p = 0.5 THEN 0.5 WHEN (p < 0.5) = ours THEN 1 ELSE 0 END)::DOUBLE AS rate,
  avg(CASE WHEN p IS NULL OR p = 0.5 THEN 0 WHEN (p < 0.5) = ours THEN 1 ELSE 0 END)::DOUBLE AS strict_rate, count(*) AS n FROM {B} GROUP BY ALL"""


@query("ev_language_rates", f"SELECT model, lang, round(rate, 6) AS rate, round(strict_rate, 6) AS strict_rate, n FROM ({LANG})")
def language_rates(t):
    r = E.language_rates(battles(t), "model", "lang", "p", "ours")
    return r.withColumn("rate", F.round("rate", 6)).withColumn("strict_rate", F.round("strict_rate", 6))


@query(
    "ev_paired_differences",
    f"WITH r AS ({LANG}) SELECT lang, round(x.rate, 6) AS a, round(y.rate, 6) AS b, round(x.rate - y.rate, 6) AS difference FROM r x JOIN r y USING (lang) WHERE x.model = 'm0' AND y.model = 'm1'",
)
def paired(t):
    r = E.paired_differences(E.language_rates(battles(t), "model", "lang", "p", "ours"), "model", "lang", "m0", "m1")
    return r.select("lang", *[F.round(c, 6).alias(c) for c in ("a", "b", "difference")])


@query(
    "ev_suffix_languages",
    """WITH x AS (SELECT lang AS language, doc_id % 7 AS a, n_chars % 7 AS b FROM documents WHERE doc_id % 11 <> 0)
       SELECT language, round(avg(CASE WHEN b > a THEN 1 WHEN b = a THEN 0.5 ELSE 0 END)::DOUBLE, 4) AS value, count(*) AS n FROM x GROUP BY language""",
)
def suffix(t):
    text = "CASE WHEN doc_id % 11 = 0 THEN 'no verdict' ELSE concat('well. score_A: ', doc_id % 7, ' score_B:  ', n_chars % 7) END"
    rows = t.documents.select(F.concat_ws("-", F.md5("text"), "lang").alias("idx"), F.expr(text).alias("judge"))
    return E.suffix_language_rates(rows, "idx", "judge")


@query(
    "ev_rubric",
    """SELECT source, 'rubric_composite' AS metric, round(avg(n_chars) / 1000, 4) AS value, round(min(n_chars) / 1000.0::DOUBLE, 4) AS baseline_value FROM documents GROUP BY source
       UNION ALL SELECT source, 'rubric_style', round(max(n_chars) / 7.0::DOUBLE, 4), 0.0 FROM documents GROUP BY source""",
)
def rubric(t):
    d = t.documents.groupBy("source").agg(
        F.create_map(F.lit("composite_score"), F.min("n_chars") / 1000).alias("a"),
        F.create_map(F.lit("composite_score"), F.avg("n_chars") / 1000, F.lit("style_score"), F.max("n_chars") / 7.0).alias("b"),
    )
    return E.rubric_rows(d, ["source"], ["style"])


ANN = """(SELECT event_id // 3 AS instance, user_id % 3 AS evaluator, ts, CASE WHEN value > 10 THEN 'yes' ELSE 'no' END AS accept_a, CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS accept_b,
  CASE event_type WHEN 'click' THEN 'a-is-better' WHEN 'view' THEN 'a-is-slightly-better' WHEN 'error' THEN 'tie' WHEN 'signup' THEN 'b-is-better' ELSE 'b-is-slightly-better' END AS preference FROM events)"""


@query(
    "ev_annotators",
    f"""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instance, evaluator ORDER BY ts DESC) AS k FROM {ANN}) WHERE k = 1),
      o AS (SELECT *, row_number() OVER (PARTITION BY instance ORDER BY ts, evaluator) AS place, CASE WHEN preference LIKE 'a-%' THEN 'a' WHEN preference LIKE 'b-%' THEN 'b' ELSE 'tie' END AS side FROM l),
      p AS (SELECT instance, max(accept_a) FILTER (place = 1) AS a1, max(accept_a) FILTER (place = 2) AS a2, max(accept_b) FILTER (place = 1) AS b1, max(accept_b) FILTER (place = 2) AS b2,
              max(preference) FILTER (place = 1) AS p1, max(side) FILTER (place = 1) AS s1, max(side) FILTER (place = 2) AS s2 FROM o GROUP BY instance)
      SELECT count(*) AS instances, count(s2) AS twice, round(avg((a1 = 'yes')::INT), 6) AS a_accepted, round(avg((b1 = 'yes')::INT), 6) AS b_accepted,
        round(avg((p1 = 'a-is-better')::INT), 6) AS a_clearly, round(avg((p1 = 'a-is-slightly-better')::INT), 6) AS a_slightly, round(avg((p1 = 'b-is-better')::INT), 6) AS b_clearly,
        round(avg((p1 = 'b-is-slightly-better')::INT), 6) AS b_slightly, round(avg((p1 = 'tie')::INT), 6) AS tie, round(avg((s1 = 'a')::INT), 6) AS a_wins, round(avg((s1 = 'b')::INT), 6) AS b_wins,
        round((count(*) FILTER (a1 = a2) + count(*) FILTER (b1 = b2)) / (2.0::DOUBLE * count(s2)), 6) AS acceptance_agreement, round(count(*) FILTER (s1 = s2) / count(s2)::DOUBLE, 6) AS agreement,
        round((count(*) FILTER (s1 = s2) + 0.5::DOUBLE * count(*) FILTER (s1 <> s2 AND 'tie' IN (s1, s2))) / count(s2), 6) AS relaxed_agreement FROM p""",
)
def annotators(t):
    d = t.events.select(
        F.floor(F.col("event_id") / 3).alias("instance"), (F.col("user_id") % 3).alias("evaluator"), "ts",
        F.when(F.col("value") > 10, "yes").otherwise("no").alias("accept_a"), F.when(F.col("event_id") % 2 == 0, "yes").otherwise("no").alias("accept_b"),
        F.expr("CASE event_type WHEN 'click' THEN 'a-is-better' WHEN 'view' THEN 'a-is-slightly-better' WHEN 'error' THEN 'tie' WHEN 'signup' THEN 'b-is-better' ELSE 'b-is-slightly-better' END").alias("preference"),
    )
    m = E.annotator_metrics(E.ordered_annotations(d, "instance", "evaluator", "ts"), "instance")
    return m.select("instances", "twice", *[F.round(c, 6).alias(c) for c in m.columns if c not in ("instances", "twice")])


@query("ev_preference_histogram", f"SELECT least(floor(x * 20)::INT, 19) AS bin, count(*) AS n FROM (SELECT (event_id % 41)::DOUBLE / 40 AS x FROM events) GROUP BY 1")
def preference_histogram(t):
    rows = t.events.select(((F.col("event_id") % 41).cast("double") / 40).alias("x"))
    return E.preference_histogram(rows, "x")


@query(
    "ev_last_per_step",
    "SELECT user_id % 4 AS run, event_id // 2 AS step, arg_max(value, event_id) AS value FROM events GROUP BY ALL",
)
def last_per_step(t):
    return series(t).select("run", "step", "value")


def series(t):
    log = t.events.select((F.col("user_id") % 4).alias("run"), F.floor(F.col("event_id") / 2).alias("step"), "event_id", "value")
    return E.last_per_step(log, "run", "step", "event_id")


@query(
    "ev_rolling_band",
    """WITH s AS (SELECT user_id % 4 AS run, event_id // 2 AS step, arg_max(value, event_id) AS v FROM events GROUP BY ALL), f AS (SELECT * FROM s WHERE v >= 2)
       SELECT run, step, round(quantile_cont(v, 0.5) OVER w, 6) AS median, round(quantile_cont(v, 0.1) OVER w, 6) AS p10, round(quantile_cont(v, 0.9) OVER w, 6) AS p90
       FROM f WINDOW w AS (PARTITION BY run ORDER BY step ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING)""",
)
def rolling(t):
    band = E.rolling_band(series(t), "run", "step", "value", at_least=2.0, block=60)
    return band.select("run", "step", *[F.round(c, 6).alias(c) for c in ("median", "p10", "p90")])


def arena(t):
    # battles between the brands of neighbouring lines of an order; the winner follows the larger quantity
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(broadcast_if_small(part), "l_partkey")
    side = F.max_by(F.struct("brand", "l_quantity"), F.struct("l_quantity", "brand"))
    a = lines.groupBy("l_orderkey", "l_linenumber").agg(side.alias("a")).filter("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    # the line after: an order has few numbers, and no row is shuffled for the other side of a join
    follows = F.lead(F.struct("l_linenumber", "a")).over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
    both = a.withColumn("next", follows).filter("next.l_linenumber = l_linenumber + 1").withColumn("b", F.col("next.a"))
    d = F.col("a.l_quantity") - F.col("b.l_quantity")
    rows = both.filter("a.brand <> b.brand").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("battle"), F.col("a.brand").alias("model_a"), F.col("b.brand").alias("model_b"),
        F.when(F.abs(d) < 3, "tie").when(d > 0, "model_a").otherwise("model_b").alias("winner"),
    )
    return stored(rows, "battles")


def _poisson_steps():
    steps, total, prob, k = [], 0.0, 0.36787944117144233, 0
    while total + prob <= 1 - 2**-32:
        total, k = total + prob, k + 1
        steps.append(total)
        prob /= k
    return steps


ARENA = """l AS (SELECT l_orderkey AS o, l_linenumber AS n, p_brand AS brand, l_quantity AS q FROM lineitem JOIN part ON p_partkey = l_partkey
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, p_brand DESC) = 1),
  arena AS (SELECT a.o * 8 + a.n AS battle, a.brand AS a, b.brand AS b, CASE WHEN abs(a.q - b.q) < 3 THEN 0.5 WHEN a.q > b.q THEN 1 ELSE 0 END::DOUBLE AS won
    FROM l a JOIN l b ON a.o = b.o AND b.n = a.n + 1 WHERE a.brand <> b.brand),
  known AS (SELECT m FROM (SELECT unnest([a, b]) AS m FROM arena) GROUP BY m HAVING count(*) >= 5),
  human AS (SELECT * FROM arena WHERE a IN (FROM known) AND b IN (FROM known))"""
# The fit over ``battles`` (battle, a, b, won): every replicate's pairs, and a hundred rounds over them.
FITTED = f"""seen AS (SELECT m FROM (SELECT unnest([a, b]) AS m FROM battles) GROUP BY m HAVING count(*) >= 5 OR m = 'Brand#1'),
  kept AS (SELECT * FROM battles WHERE a IN (FROM seen) AND b IN (FROM seen)),
  drawn AS (SELECT rep, a, b, won, list_sum([(u >= s)::INT FOR s IN {_poisson_steps()}]) AS w
    FROM (SELECT *, ('0x' || substr(md5('42:' || battle || ':' || rep), 1, 8))::BIGINT / 4294967296::DOUBLE AS u FROM kept, range(10) t(rep))),
  sides AS (SELECT rep, a AS m, b AS o, w * won AS won, w * (1 - won) AS lost FROM drawn WHERE w > 0 UNION ALL SELECT rep, b, a, w * (1 - won), w * won FROM drawn WHERE w > 0),
  games AS (SELECT rep, m, o, sum(won + lost) AS n FROM sides GROUP BY ALL), wins AS (SELECT rep, m, sum(won) + 1e-9 AS w FROM sides GROUP BY ALL),
  fit(k, rep, m, s) AS (SELECT 0, rep, m, 1::DOUBLE FROM wins UNION ALL
    SELECT k + 1, rep, m, x / exp(avg(ln(x)) OVER (PARTITION BY rep)) FROM (
      SELECT any_value(f.k) AS k, f.rep, f.m, any_value(wins.w) / greatest(sum(games.n / (f.s + o.s)), 1e-12) AS x
      FROM fit f JOIN games ON games.rep = f.rep AND games.m = f.m JOIN fit o ON o.rep = f.rep AND o.m = games.o JOIN wins ON wins.rep = f.rep AND wins.m = f.m
      WHERE f.k < 100 GROUP BY f.rep, f.m))
  SELECT m AS model, CASE WHEN (SELECT count(*) FROM kept) >= 100 THEN round(avg(1000 + 400 * log10(s)), 3) END AS rating,
    CASE WHEN (SELECT count(*) FROM kept) >= 100 THEN round(1.96 * stddev_pop(400 * log10(s)), 3) END AS half_width FROM fit WHERE k = 100 GROUP BY m"""


def rated(fitted):
    return fitted.select("model", F.round("rating", 3).alias("rating"), F.round("half_width", 3).alias("half_width"))


@query("ev_ratings", f"WITH RECURSIVE {ARENA}, battles AS (FROM human), {FITTED}")
def ratings(t):
    return rated(E.bradley_terry(E.well_known(arena(t), 5), "Brand#1", at_least=5))


@query(
    "ev_category_ratings",
    f"""WITH RECURSIVE {ARENA}, battles AS (SELECT -battle - 1 AS battle, a, b, won FROM human UNION ALL
      SELECT battle, a, b, won FROM arena JOIN documents ON doc_id = battle % (SELECT max(doc_id) + 1 FROM documents) WHERE lang = 'en'), {FITTED}""",
)
def category_ratings(t):
    last = t.documents.agg(F.max("doc_id")).first()[0]
    fought = arena(t)
    judged = fought.withColumn("text", (F.col("battle") % (last + 1)).cast("string"))
    meta = t.documents.select(F.col("doc_id").cast("string").alias("text"), (F.col("lang") == "en").alias("is_en"))
    picked = E.category_battles(judged, meta, "is_en", "text").select("battle", "model_a", "model_b", "winner")
    human = E.well_known(fought, 5).withColumn("battle", -F.col("battle") - 1)
    return rated(E.bradley_terry(stored(picked.unionByName(human), "category-battles"), "Brand#1", at_least=5))
