"""Queries: mixtures and samples of ``documents`` by language and source."""

from pyspark.sql import functions as F

from chatloom.catalog.registry import query
from chatloom.functions.text import hash_key
from chatloom.operators import mixing as X
from chatloom.operators import sampling as S
from chatloom.plans.mixture import assemble

MIX = dict(english_ratio=0.5, explicit={"de": 0.2, "fr": 0.1}, others_ratio=0.2)
PRIORITY = [f"src{i}" for i in range(20)]
H = "md5('42:' || doc_id)"


def mix():
    return X.LanguageMix(**MIX)


def quota_sql(total):
    return "(VALUES " + ", ".join(f"('{k}', {v}::BIGINT)" for k, v in mix().quotas(total).items()) + ") q(language, quota)"


def total_of(t):
    return t.documents.count() // 2


# The mixture asks for half as many rows as there are; the same arithmetic in SQL.
QUOTAS = """(SELECT 'en' AS language, floor(n * 0.5::DOUBLE)::BIGINT AS quota FROM tt UNION ALL SELECT 'de', floor(n * 0.2::DOUBLE)::BIGINT FROM tt
  UNION ALL SELECT 'fr', floor(n * 0.1::DOUBLE)::BIGINT FROM tt
  UNION ALL SELECT unnest(['bg','cs','da','el','es','et','fi','ga','hr','hu','it','lt','lv','mt','nl','pl','pt','ro','sk','sl','sv']), floor(n * 0.2::DOUBLE / 21)::BIGINT FROM tt)"""
HEAD = f"""WITH tt AS (SELECT count(*) // 2 AS n FROM documents), q AS {QUOTAS},
  c AS (SELECT lang, source, count(*) AS n, replace(source, 'src', '')::INT AS pr FROM documents GROUP BY ALL),
  u AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY pr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM c),
  a AS (SELECT lang, source, n, least(n, greatest(quota - used, 0))::BIGINT AS take FROM u JOIN q ON q.language = lang),
  r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY {H}) AS rn FROM documents),
  f AS (SELECT r.* FROM r JOIN a USING (lang, source) WHERE rn <= take)
"""


@query("mx_quotas", HEAD + "SELECT language, quota FROM q")
def quotas(t):
    return X.quota_table(t.spark, mix().quotas(total_of(t)))


@query("mx_fill_plan", HEAD + "SELECT lang AS language, source, n AS available, take AS quota FROM a")
def fill_plan(t):
    q = X.quota_table(t.spark, mix().quotas(total_of(t)))
    return X.fill_quotas(t.documents, q, "lang", "source", PRIORITY)


@query("mx_priority_fill", HEAD + "SELECT doc_id, lang, source FROM f")
def fill(t):
    q = X.quota_table(t.spark, mix().quotas(total_of(t)))
    return X.priority_fill(t.documents, q, "doc_id", "lang", "source", PRIORITY).select("doc_id", "lang", "source")


@query(
    "mx_shortfall",
    HEAD + """SELECT language, quota, count(f.lang) AS actual, round(100.0::DOUBLE * count(f.lang) / quota, 2) AS pct
              FROM q LEFT JOIN f ON lang = language WHERE quota > 0 GROUP BY language, quota""",
)
def shortfall(t):
    return assemble(t.documents, mix(), total_of(t), "doc_id", "lang", "source", PRIORITY)[1]


@query("mx_assembled", HEAD + f"SELECT doc_id, lang, row_number() OVER (ORDER BY {H}) AS place FROM f")
def assembled(t):
    rows = assemble(t.documents, mix(), total_of(t), "doc_id", "lang", "source", PRIORITY)[0]
    from chatloom.operators.ordering import row_numbers

    return row_numbers(rows.select("doc_id", "lang"), hash_key("doc_id"), "place", start=1).select("doc_id", "lang", "place")


@query(
    "mx_language_caps",
    HEAD + f"""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {H}) AS rn FROM documents)
               JOIN q ON language = lang WHERE rn <= floor(quota * 0.1::DOUBLE)""",
)
def caps(t):
    q = X.quota_table(t.spark, mix().quotas(total_of(t)))
    return X.cap_per_language(t.documents, q, "doc_id", "lang", factor=0.1).select("doc_id", "lang")


def resized_sql(table, key, name, target):
    return f"""SELECT '{name}' AS dataset_source, {key} AS id, unnest(generate_series(0, times - 1)) AS copy FROM (
       SELECT {key}, {target} // n + (rn <= {target} % n)::INT AS times FROM (
         SELECT {key}, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42:' || {key})) AS rn FROM {table})) WHERE times > 0"""


@query(
    "mx_fraction_or_count",
    "SELECT dataset_source, id, copy::INT AS copy FROM (" + resized_sql("documents", "doc_id", "docs", "floor(n * 0.3::DOUBLE)::BIGINT") + " UNION ALL "
    + resized_sql("pages", "page_id", "pages", "floor(n * 2.5::DOUBLE)::BIGINT") + " UNION ALL " + resized_sql("benchmark", "item_id", "bench", "100") + ")",
)
def fraction_or_count(t):
    return X.mix(
        [
            ("docs", t.documents.select(F.col("doc_id").alias("id")), "0.3"),
            ("pages", t.pages.select(F.col("page_id").alias("id")), "2.5"),
            ("bench", t.benchmark.select(F.col("item_id").alias("id")), "100"),
        ],
        "id",
    ).select("dataset_source", "id", "copy")


@query(
    "mx_prefix_mix",
    """SELECT 'docs_' || doc_id AS id, text, lang FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id)) AS rn, count(*) OVER () AS n FROM documents) WHERE rn <= floor(n * 0.25::DOUBLE)
       UNION ALL SELECT 'bench_' || item_id, text, NULL FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || item_id)) AS rn, count(*) OVER () AS n FROM benchmark) WHERE rn <= floor(n * 0.5::DOUBLE)""",
)
def prefix(t):
    docs = t.documents.withColumnRenamed("doc_id", "key")
    bench = t.benchmark.withColumnRenamed("item_id", "key")
    return X.prefix_mix({"docs": (docs, 0.25), "bench": (bench, 0.5)}, "key", ["text", "lang"])


@query(
    "mx_resample",
    f"""SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {H}) AS rn FROM documents)
        WHERE (source = 'src1' AND rn <= 6) OR (source = 'src2' AND rn <= 14) OR (source = 'src3' AND rn <= 1000)""",
)
def resample(t):
    return X.resample_subsets(t.documents, {"src1": 0.03, "src2": 0.07, "src3": 5.0}, 200, "doc_id", "source").select("doc_id", "source")


@query(
    "mx_sample_fraction",
    f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {H}) AS rn, count(*) OVER () AS n FROM documents) WHERE rn <= greatest(1, floor(n * 0.15::DOUBLE))""",
)
def fraction(t):
    return S.take_fraction(t.documents, 0.15, "doc_id").select("doc_id")


@query(
    "mx_subset_caps",
    f"""SELECT doc_id, 100 + (('0x' || substr({H}, 1, 8))::BIGINT % 3996)::INT AS target_length, copy::INT AS copy
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {H}) AS rn FROM documents), generate_series(0, 1) g(copy)
        WHERE CASE source WHEN 'src1' THEN rn <= 3 WHEN 'src2' THEN rn <= 5 ELSE true END""",
)
def subset_caps(t):
    rows = X.repeat_rows(X.cap_subsets(t.documents, {"src1": 3, "src2": 5}, "doc_id", "source"), 2)
    return rows.select("doc_id", X.random_length("doc_id", 100, 4096).alias("target_length"), "copy")


@query("mx_train_test", f"SELECT doc_id, CASE WHEN ('0x' || substr({H}, 1, 8))::BIGINT % 100 < 10 THEN 'test' ELSE 'train' END AS split FROM documents")
def train_test(t):
    return S.train_test(t.documents, "doc_id").select("doc_id", "split")


ROWS_SQL = "(SELECT user_id, event_type, arg_min(round(value, 2)::VARCHAR, event_id) AS completion FROM events GROUP BY ALL)"


def model_rows(t):
    e = t.events.groupBy("user_id", "event_type").agg(F.min_by("value", "event_id").alias("v"))
    return e.select("user_id", "event_type", F.round("v", 2).cast("string").alias("completion"))


@query(
    "mx_sample_models",
    f"""SELECT user_id, string_agg(event_type || '=' || completion, ',' ORDER BY h) AS picked FROM (
         SELECT *, md5('42:' || user_id || ':' || event_type) AS h, row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || user_id || ':' || event_type)) AS rn FROM {ROWS_SQL})
        WHERE rn <= 4 GROUP BY user_id""",
)
def models(t):
    got = X.sample_models(model_rows(t), "user_id", "event_type", "completion")
    return got.select("user_id", F.array_join(F.transform(F.arrays_zip("models", "completions"), lambda z: F.concat(z["models"], F.lit("="), z["completions"])), ",").alias("picked"))


@query(
    "mx_against_one",
    f"""WITH r AS {ROWS_SQL}, o AS (SELECT user_id, arg_min(event_type, md5('42:' || user_id || ':' || event_type)) AS other, arg_min(completion, md5('42:' || user_id || ':' || event_type)) AS oc
          FROM r WHERE event_type <> 'click' GROUP BY user_id)
        SELECT user_id, CASE WHEN ('0x' || substr(md5('42:' || user_id), 1, 8))::BIGINT % 2 = 1 THEN other || '=' || oc || ',click=' || completion
               ELSE 'click=' || completion || ',' || other || '=' || oc END AS sides FROM r JOIN o USING (user_id) WHERE event_type = 'click'""",
)
def against(t):
    got = X.against_one(model_rows(t), "user_id", "event_type", "completion", "click")
    return got.select("user_id", F.array_join(F.transform(F.arrays_zip("models", "completions"), lambda z: F.concat(z["models"], F.lit("="), z["completions"])), ",").alias("sides"))


@query("mx_stratified_pick")
def stratified(t):
    cats = F.filter(F.array(*[F.when(F.col("doc_id") % d == 0, F.lit(f"c{d}")) for d in (2, 3, 5, 7)]), lambda x: x.isNotNull())
    df = t.documents.select("doc_id", "lang", cats.alias("cats"))
    return X.stratified_pick(df, "doc_id", "lang", "cats", ["c2", "c3", "c5", "c7"], per_label=6, at_least=25)
