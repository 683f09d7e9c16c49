"""Statistics over chat, token and language tables. Every report is one scan with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import col
from chatloom.functions.tokens import total_tokens, trainable

# The lengths above which conversations are counted.
LENGTH_LIMITS = (512, 768, 1024, 1536, 2048, 4096)


def describe(value: Column, name: str, digits: int = 6) -> list[Column]:
    """count, mean, sample std, min, quartiles and max of a column, named ``<name>_...``."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    r = lambda c: F.round(c, digits)
    return [
        F.count(value).alias(f"{name}_count"), r(F.avg(value)).alias(f"{name}_mean"), r(F.stddev_samp(value)).alias(f"{name}_std"),
        F.min(value).alias(f"{name}_min"), r(q[0]).alias(f"{name}_p25"), r(q[1]).alias(f"{name}_p50"), r(q[2]).alias(f"{name}_p75"),
        F.max(value).alias(f"{name}_max"),
    ]


def chat_lengths(chats: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, turns, user, assistant, total): turns and token sums per conversation, system turns left out."""
    m = F.filter(messages, lambda x: x["role"] != "system")
    return chats.select(
        key, F.size(m).alias("turns"), total_tokens(messages, "user").alias("user"),
        total_tokens(messages, "assistant").alias("assistant"), total_tokens(messages).alias("total"),
    )


def summary(df: DataFrame, measure: str, value: str) -> DataFrame:
    """One row per measure: describe() and the counts over each length limit. Values are token or turn counts."""
    over = [F.count_if(F.col(value) > n).alias(f"over_{n}") for n in LENGTH_LIMITS]
    return df.groupBy(measure).agg(*[c for c in describe(F.col(value), "value")], *over)


def chat_summary(turns: DataFrame, key: str, role: str, tokens: Column) -> DataFrame:
    """Summary from a turn table: user and assistant turns, turns per conversation, tokens per conversation."""
    t = turns.filter(F.col(role) != "system").select(key, F.col(role).alias("role"), tokens.cast("long").alias("n"))
    spoken = F.col("role").isin("user", "assistant")
    per_chat = t.groupBy(key).agg(F.count(F.lit(1)).alias("turns"), F.sum(F.when(spoken, F.col("n")).otherwise(0)).alias("total"))
    both = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("turns", "total")])
    rows = per_chat.select(F.explode(both).alias("x")).select("x.*").unionByName(
        t.filter(spoken).select(F.col("role").alias("measure"), F.col("n").alias("value"))
    )
    return summary(rows, "measure", "value")


def pair_summary(df: DataFrame, prompt: str, completion: str) -> DataFrame:
    """The same summary for prompt, completion and total token counts of a pair."""
    parts = {"prompt": F.col(prompt), "completion": F.col(completion), "total": F.col(prompt) + F.col(completion)}
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), c.alias("value")) for m, c in parts.items()])
    return summary(df.select(F.explode(rows).alias("x")).select("x.*"), "measure", "value")


def longest(df: DataFrame, key: str, length: Column, n: int = 100) -> DataFrame:
    return df.select(key, length.alias("length")).orderBy(F.desc("length"), key).limit(n)


def dataset_table(lengths: DataFrame, dataset: str) -> DataFrame:
    """One row per dataset: size, mean lengths, share over each limit."""
    n = F.count(F.lit(1))
    share = [F.round(100.0 * F.count_if(F.col("total") > k) / n, 2).alias(f"over_{k}_pct") for k in (512, 1024, 2048, 4096)]
    return lengths.groupBy(dataset).agg(
        n.alias("instances"), F.round(F.avg("total"), 2).alias("avg_total"), F.max("total").alias("max_total"),
        F.round(F.sum("user") / F.sum("user_turns"), 2).alias("avg_user"),
        F.round(F.sum("assistant") / F.sum("assistant_turns"), 2).alias("avg_assistant"),
        F.round(F.avg("turns"), 2).alias("avg_turns"), *share,
    )


# --- histograms ------------------------------------------------------------------------------

def bin_index(value: Column, edges: list[float]) -> Column:
    """Index of the half-open bin of a value, the last bin closed; null outside."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        inside = (value >= edges[i]) & ((value <= edges[i + 1]) if i == len(edges) - 2 else (value < edges[i + 1]))
        out = F.when(inside, F.lit(i)).otherwise(out)
    return out


def linear_edges(top: float, points: int = 25) -> list[float]:
    return [top * i / (points - 1) for i in range(points)]


def log_edges(low: float, top: float, points: int = 25) -> list[float]:
    import math

    a, b = math.log10(low), math.log10(top)
    return [low, *[10 ** (a + (b - a) * i / (points - 1)) for i in range(1, points - 1)], top]


def merge_rare(df: DataFrame, category: str, at_least: int) -> DataFrame:
    """Categories below ``at_least`` rows become Other; the counts are joined back as a small table."""
    common = df.groupBy(category).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least).select(category)
    flagged = df.join(common.withColumn("_ok", F.lit(True)), category, "left")
    return flagged.withColumn(category, F.when(F.col("_ok"), F.col(category)).otherwise("Other")).drop("_ok")


def short_category(c) -> Column:
    """The part after the slash; names without one are Other."""
    return F.when(col(c).contains("/"), F.split_part(col(c), F.lit("/"), F.lit(2))).otherwise("Other")


def histogram(df: DataFrame, category: str, value: Column, edges: list[float]) -> DataFrame:
    binned = df.select(category, bin_index(value, edges).alias("bin")).filter("bin IS NOT NULL")
    return binned.groupBy(category, "bin").agg(F.count(F.lit(1)).alias("n"))


def length_percentiles(df: DataFrame, value: Column, approximate: bool = False) -> DataFrame:
    """Percentiles 10 … 90, min, max, mean and median."""
    points = [i / 10 for i in range(1, 10)]
    fn = F.percentile_approx if approximate else F.percentile
    p = fn(F.col("v"), F.array(*[F.lit(x) for x in points]))
    d = df.select(value.alias("v"))
    stats = d.agg(p.alias("p"), F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.avg("v"), 6).alias("mean"))
    return stats.select(
        *[F.round(F.col("p")[i], 6).alias(f"p{10 * (i + 1)}") for i in range(9)], "min", "max", "mean", F.round(F.col("p")[4], 6).alias("median")
    )


# --- accounting ------------------------------------------------------------------------------

def pipeline_accounting(initial: DataFrame, final: DataFrame, source: str, ids: str, labels: str) -> DataFrame:
    """Per source and overall: initial, final, filtered, up-sampling factor, tokens, trainable tokens and shares."""
    start = initial.groupBy(source).agg(F.count(F.lit(1)).alias("initial"))
    done = final.select(source, F.size(ids).cast("long").alias("n"), trainable(labels).cast("long").alias("t")).groupBy(source).agg(
        F.count(F.lit(1)).alias("final"), F.sum("n").alias("tokens"), F.sum("t").alias("trainable")
    )
    both = start.join(done, source, "left").fillna(0, ["final", "tokens", "trainable"])
    rolled = both.groupingSets([[source], []], source).agg(
        F.grouping(source).alias("overall"), *[F.sum(c).alias(c) for c in ("initial", "final", "tokens", "trainable")]
    )
    whole = Window.partitionBy()  # over one row per source
    return rolled.select(
        F.when(F.col("overall") == 1, "overall").otherwise(F.col(source)).alias(source), "initial", "final",
        (F.col("initial") - F.col("final")).alias("filtered"), "tokens", "trainable",
        F.round(F.col("final") / F.col("initial"), 6).alias("factor"),
        F.round(F.try_divide("tokens", "final"), 6).alias("avg_tokens"),
        F.round(100 * F.try_divide(F.col("tokens"), F.max("tokens").over(whole)), 4).alias("token_pct"),
        F.round(100 * F.try_divide(F.col("final"), F.max("final").over(whole)), 4).alias("instance_pct"),
    )


# --- languages -------------------------------------------------------------------------------

def language_shares(df: DataFrame, language: str) -> DataFrame:
    """Rows and percentage (four decimals) per language; the total runs over the small result."""
    counts = df.groupBy(F.col(language).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def language_breakdown(df: DataFrame, language: str, source: str, domain: str) -> DataFrame:
    """Counts per language, per (source, language) and per (domain, language) in one pass."""
    sets = df.groupingSets([[language], [source, language], [domain, language]], language, source, domain)
    return sets.agg(
        F.when(F.grouping(source) == 0, "source").when(F.grouping(domain) == 0, "domain").otherwise("all").alias("level"),
        F.count(F.lit(1)).alias("n"),
    ).select("level", F.coalesce(source, domain).alias("part"), F.col(language).alias("language"), "n")


def exact_quantiles(df: DataFrame, value: str, points: list[float], cuts: int = 200) -> DataFrame:
    """(p, value): exact interpolated quantiles of any number of distinct values.

    Equal values are counted first; approximate quantiles only place the block borders, inside and before which
    the exact ranks are summed. No task sees more than a block of distinct values.
    """
    from chatloom.operators.ordering import running_total

    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    head = df.agg(F.count(value).alias("n"), F.percentile_approx(F.col(value).cast("double"), F.array(*[F.lit(i / cuts) for i in range(1, cuts)])).alias("e")).first()
    total, edges = head["n"], sorted(set(head["e"] or []))
    block = F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<double>"), lambda e: e < F.col("v")))
    placed = running_total(counts, F.col("v"), F.col("n"), "before", block)
    ranks = F.array(
        *[
            F.struct(F.lit(p).alias("p"), F.lit(int(r)).alias("rank"), F.lit(w).alias("w"))
            for p in points
            for r, w in ((p * (total - 1) // 1, 1 - p * (total - 1) % 1), (p * (total - 1) // 1 + 1, p * (total - 1) % 1))
            if w > 0
        ]
    )
    hit = placed.select("v", "before", "n", F.explode(ranks).alias("r")).filter(
        (F.col("r.rank") >= F.col("before")) & (F.col("r.rank") < F.col("before") + F.col("n"))
    )
    return hit.groupBy("r.p").agg(F.sum(F.col("v") * F.col("r.w")).alias("value"))


def _measures(row: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in names])
    return row.select(F.explode(pairs).alias("x")).select("x.*")


def confidence(df: DataFrame, score: str, text: str) -> DataFrame:
    """(measure, value): detection scores and text lengths with population deviation and exact medians."""
    s, n = F.col(score), F.length(text)
    stats = df.agg(
        F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"),
        F.count_if(s < 0.5).alias("low"), F.round(100.0 * F.count_if(s < 0.5) / F.count(F.lit(1)), 4).alias("low_pct"),
        F.avg(n).alias("length_mean"), F.median(n).alias("length_median"), F.stddev_pop(n).alias("length_std"),
    )
    names = ["mean", "std", "min", "max", "low", "low_pct", "length_mean", "length_median", "length_std"]
    median = exact_quantiles(df, score, [0.5]).select(F.lit("median").alias("measure"), "value")
    return _measures(stats, names).unionByName(median).withColumn("value", F.round("value", 6))


def low_confidence_languages(df: DataFrame, score: str, language: str) -> DataFrame:
    return df.filter(F.col(score) < 0.5).groupBy(F.col(language).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def merge_shards(shards: DataFrame, shard: str, language: str, score: str) -> DataFrame:
    """What shard-wise statistics would merge to, exact for every measure."""
    per = shards.groupBy(shard).agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("s"), F.min(score).alias("lo"), F.max(score).alias("hi"))
    return per.agg(
        F.count(F.lit(1)).alias("shards"), F.sum("n").alias("total"), F.round(F.sum("s") / F.sum("n"), 6).alias("mean"),
        F.min("lo").alias("min"), F.max("hi").alias("max"),
    )


def language_profile(df: DataFrame, language: str, toxic: Column, targets: list[str]) -> DataFrame:
    """Non-toxic rows per language, blanks as unknown, with the share and whether it is a target language."""
    name = F.when(F.trim(F.coalesce(language, F.lit(""))) == "", "unknown").otherwise(F.col(language))
    counted = language_shares(df.filter(~F.coalesce(toxic, F.lit(False))).select(name.alias("language")), "language")
    return counted.withColumn("target", F.col("language").isin(targets))


def feature_lengths(df: DataFrame, features: list[str]) -> DataFrame:
    """min, max and mean length per array column."""
    sizes = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.size(f).alias("n")) for f in features])).alias("x")
    return df.select(sizes).groupBy("x.feature").agg(
        F.min("x.n").alias("min"), F.max("x.n").alias("max"), F.round(F.avg("x.n"), 6).alias("mean")
    )


def combine_metrics(records: DataFrame, name: str, number: str, items: str, text: str, order: str) -> DataFrame:
    """Metric records by name: numbers are averaged, of texts the last one stays; lists are joined in record order.

    Lists are emitted element-wise as (name, order, place, item) rows by ``combined_items``: a metric's list can
    be as long as the run.
    """
    return records.groupBy(name).agg(F.round(F.avg(number), 6).alias("mean"), F.max_by(text, F.when(F.col(text).isNotNull(), F.col(order))).alias("last"))


def combined_items(records: DataFrame, name: str, items: str, order: str) -> DataFrame:
    return records.select(name, order, F.posexplode(items).alias("place", "item"))


def rollout_report(df: DataFrame, score: str, length: str, finish: str, solved: float) -> DataFrame:
    """Batch metrics of scored rollouts; the mean length of an empty class is 0."""
    s, n = F.col(score), F.col(length)
    all_solved = F.min(s) == solved
    r = lambda c: F.round(c, 6)
    return df.agg(
        r(F.avg(s)).alias("mean_score"), r(F.avg((F.col(finish) == "stop").cast("int"))).alias("stop_rate"),
        F.count_if(s != solved).alias("unsolved"), r(F.count_if(s != solved) / F.count(F.lit(1))).alias("unsolved_ratio"),
        r(F.avg(n)).alias("length_mean"), F.min(n).alias("length_min"), F.max(n).alias("length_max"),
        r(F.when(all_solved, 0.0).otherwise(F.coalesce(F.avg(F.when(s == 0, n)), F.lit(0.0)))).alias("length_unsolved"),
        r(F.coalesce(F.avg(F.when(s == solved, n)), F.lit(0.0))).alias("length_solved"),
    )
