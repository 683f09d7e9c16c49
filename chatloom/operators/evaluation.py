"""Win rates, battle outcomes, annotator agreement, ratings and training-log series."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import col, hash_key
from chatloom.operators.ordering import row_numbers
from chatloom.operators.statistics import bin_index, linear_edges
from chatloom.session import broadcast_if_small, cut_lineage


# --- win rates -------------------------------------------------------------------------------

def explode_preferences(results: DataFrame, dataset: str, preferences: str) -> DataFrame:
    """One row per battle; null preferences stay."""
    return results.select(dataset, F.explode_outer(preferences).alias("preference"))


def win_rates(battles: DataFrame, dataset: str, preference: str) -> DataFrame:
    """Wins, ties and both win rates per dataset; battles without a preference count in the total."""
    p, total = F.col(preference), F.count(F.lit(1))
    a = (F.count_if(p < 0.5) + 0.5 * F.count_if(p == 0.5)) / total
    return battles.groupBy(dataset).agg(
        F.count_if(p < 0.5).alias("a_wins"), F.count_if(p > 0.5).alias("b_wins"), F.count_if(p == 0.5).alias("ties"), total.alias("total"),
        a.alias("a_rate"), (1 - a).alias("b_rate"),
    )


def macro_average(rates: DataFrame) -> DataFrame:
    return rates.agg(F.avg("a_rate").alias("a_rate"), F.avg("b_rate").alias("b_rate"))


def rate_pivot(counts: DataFrame, model: str, dataset: str, datasets: list[str], baseline: str) -> DataFrame:
    """Model by dataset win rates of the second side from (wins, ties, losses) of the first, with the baseline at 0.5."""
    first = (F.col("wins") + 0.5 * F.col("ties")) / (F.col("wins") + F.col("ties") + F.col("losses"))
    rates = counts.withColumn("rate", first).groupBy(model).pivot(dataset, datasets).agg(F.avg("rate"))
    flipped = rates.select(model, *[(1 - F.col(d)).alias(d) for d in datasets])
    spark = counts.sparkSession
    base = spark.range(1).select(F.lit(baseline).alias(model), *[F.lit(0.5).alias(d) for d in datasets])
    filled = sum((F.coalesce(F.col(d), F.lit(0.0)) for d in datasets[1:]), F.coalesce(F.col(datasets[0]), F.lit(0.0)))
    n = sum((F.col(d).isNotNull().cast("int") for d in datasets[1:]), F.col(datasets[0]).isNotNull().cast("int"))
    return flipped.filter(F.col(model) != baseline).unionByName(base).withColumn("average", filled / n).orderBy("average", model)


def battle_outcome(preference, ours_first, tie_half: bool = True) -> Column:
    """Score of our model: 1 win, 0 loss, ties and unreadable verdicts 0.5 (or 0 where only wins count)."""
    p, tie = col(preference), F.lit(0.5 if tie_half else 0.0)
    return F.when(p.isNull() | (p == 0.5), tie).when((p < 0.5) == col(ours_first), 1.0).otherwise(0.0)


def language_rates(battles: DataFrame, model: str, language: str, preference: str, ours_first: str) -> DataFrame:
    return battles.groupBy(model, language).agg(
        F.avg(battle_outcome(preference, ours_first)).alias("rate"),
        F.avg(battle_outcome(preference, ours_first, tie_half=False)).alias("strict_rate"), F.count(F.lit(1)).alias("n"),
    )


def paired_differences(rates: DataFrame, model: str, language: str, first: str, second: str) -> DataFrame:
    side = lambda m, n: rates.filter(F.col(model) == m).select(language, F.col("rate").alias(n))
    return side(first, "a").join(side(second, "b"), language).select(language, "a", "b", (F.col("a") - F.col("b")).alias("difference"))


def judged_winner(text) -> Column:
    """A, B or tie from ``score_A: n`` / ``score_B: n``; null when either is missing."""
    score = lambda s: F.regexp_extract(col(text), rf"score_{s}:\s*(\d+)", 1)
    a, b = score("A"), score("B")
    readable = (a != "") & (b != "")
    na, nb = a.try_cast("long"), b.try_cast("long")
    return F.when(readable, F.when(nb > na, "B").when(na > nb, "A").otherwise("tie"))


def suffix_language_rates(battles: DataFrame, index: str, text: str) -> DataFrame:
    """Win rate of B per language, the language being the part of the question id after the last dash."""
    rows = battles.select(F.substring_index(index, "-", -1).alias("language"), judged_winner(text).alias("w")).filter("w IS NOT NULL")
    rate = (F.count_if(F.col("w") == "B") + 0.5 * F.count_if(F.col("w") == "tie")) / F.count(F.lit(1))
    return rows.groupBy("language").agg(F.round(rate, 4).alias("value"), F.count(F.lit(1)).alias("n"))


def rubric_rows(df: DataFrame, keys: list[str], criteria: list[str]) -> DataFrame:
    """Composite and one row per criterion with trained and baseline score, four decimals.

    Expects ``a`` and ``b`` maps from score names to scores.
    """
    entry = lambda m, n: F.round(F.coalesce(F.try_element_at(m, F.lit(n)), F.lit(0.0)), 4)
    names = [("rubric_composite", "composite_score"), *[(f"rubric_{c}", f"{c}_score") for c in criteria]]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), entry("b", k).alias("value"), entry("a", k).alias("baseline_value")) for m, k in names])
    return df.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*")


# --- annotators ------------------------------------------------------------------------------

def ordered_annotations(df: DataFrame, instance: str, evaluator: str, time: str) -> DataFrame:
    """Latest annotation per evaluator, then the first two per instance in time order."""
    rest = [c for c in df.columns if c not in (instance, evaluator)]
    latest = df.groupBy(instance, evaluator).agg(F.max_by(F.struct(*rest), F.col(time)).alias("r")).select(instance, evaluator, "r.*")
    w = Window.partitionBy(instance).orderBy(time, evaluator)
    return latest.withColumn("place", F.row_number().over(w)).filter("place <= 2")


def annotator_metrics(ordered: DataFrame, instance: str) -> DataFrame:
    """Acceptance by the first annotation, verdict rates, and agreement of the first two.

    Expects ``accept_a``, ``accept_b`` (yes/no) and ``preference`` (five-way). Relaxed agreement gives half a point
    when one of the two verdicts is a tie.
    """
    side = F.when(F.col("preference").startswith("a-"), "a").when(F.col("preference").startswith("b-"), "b").otherwise("tie")
    at = lambda c, i: F.max(F.when(F.col("place") == i, c))
    per = ordered.withColumn("side", side).groupBy(instance).agg(
        at(F.col("accept_a"), 1).alias("a1"), at(F.col("accept_a"), 2).alias("a2"), at(F.col("accept_b"), 1).alias("b1"),
        at(F.col("accept_b"), 2).alias("b2"), at(F.col("preference"), 1).alias("p1"), at(F.col("side"), 1).alias("s1"), at(F.col("side"), 2).alias("s2"),
    )
    n, two = F.count(F.lit(1)), F.count("s2")
    share = lambda c: F.count_if(c) / n
    both = lambda c: F.count_if(F.coalesce(c, F.lit(False))) / two
    same = F.col("s1") == F.col("s2")
    tie = F.col("s2").isNotNull() & ~same & ((F.col("s1") == "tie") | (F.col("s2") == "tie"))
    return per.agg(
        n.alias("instances"), two.alias("twice"), share(F.col("a1") == "yes").alias("a_accepted"), share(F.col("b1") == "yes").alias("b_accepted"),
        share(F.col("p1") == "a-is-better").alias("a_clearly"), share(F.col("p1") == "a-is-slightly-better").alias("a_slightly"),
        share(F.col("p1") == "b-is-better").alias("b_clearly"), share(F.col("p1") == "b-is-slightly-better").alias("b_slightly"),
        share(F.col("p1") == "tie").alias("tie"), share(F.col("s1") == "a").alias("a_wins"), share(F.col("s1") == "b").alias("b_wins"),
        ((both(F.col("a1") == F.col("a2")) + both(F.col("b1") == F.col("b2"))) / 2).alias("acceptance_agreement"),
        both(same).alias("agreement"), (both(same) + 0.5 * both(tie)).alias("relaxed_agreement"),
    )


def preference_histogram(battles: DataFrame, preference: str, bins: int = 20) -> DataFrame:
    edges = linear_edges(1.0, bins + 1)
    rows = battles.select(bin_index(F.col(preference), edges).alias("bin")).filter("bin IS NOT NULL")
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


# --- series ----------------------------------------------------------------------------------

def last_per_step(log: DataFrame, run: str, step: str, order: str) -> DataFrame:
    rest = [c for c in log.columns if c not in (run, step)]
    return log.groupBy(run, step).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(run, step, "r.*")


def rolling_band(series: DataFrame, run: str, step: str, value: str, at_least: float | None = None, window: int = 100, block: int = 5_000) -> DataFrame:
    """Centred rolling median, 10th and 90th percentile over ``window // 2`` rows to each side.

    Rows are numbered per run without one task per run; the moving frame then works on blocks of rows that carry
    copies of their neighbours' edges, so a very long run is spread over many tasks. Runs shorter than the window
    use a third of their length.
    """
    rows = series if at_least is None else series.filter(F.col(value) >= at_least)
    # blocks of equal step width; the order value is the step itself
    numbered = row_numbers(rows, F.col(step), "_n", F.floor(F.col(step) / F.lit(block * 10)), [run])
    sizes = cut_lineage(rows.groupBy(run).agg(F.count(F.lit(1)).alias("_size")))
    half = F.when(F.col("_size") < window, F.greatest(F.floor(F.col("_size") / 3), F.lit(1))).otherwise(window)
    sized = numbered.join(broadcast_if_small(sizes), run).withColumn("_half", F.floor(half / 2))
    home = F.floor(F.col("_n") / block)
    # every block a row's window reaches into gets a copy, also when a block is narrower than the window
    homes = F.sequence(F.floor((F.col("_n") - F.col("_half")) / block), F.floor((F.col("_n") + F.col("_half")) / block))
    spread = sized.withColumn("_home", home).withColumn("_block", F.explode(homes)).filter("_block >= 0")
    widest = window // 2
    near = Window.partitionBy(run, "_block").orderBy("_n").rowsBetween(-widest, widest)
    inside = F.collect_list(F.struct(F.col("_n").alias("n"), F.col(value).alias("v"))).over(near)
    framed = spread.withColumn("_f", inside).filter(F.col("_block") == F.col("_home"))
    v = F.array_sort(
        F.transform(F.filter("_f", lambda x: F.abs(x["n"] - F.col("_n")) <= F.col("_half")), lambda x: x["v"].cast("double"))
    )

    def at(p: float) -> Column:
        # linear interpolation between the two neighbours of rank p * (n - 1)
        r = F.lit(p) * (F.size("_v") - 1)
        low = F.get("_v", F.floor(r).cast("int"))
        high = F.coalesce(F.get("_v", F.floor(r).cast("int") + 1), low)
        return low + (high - low) * (r - F.floor(r))

    return framed.withColumn("_v", v).select(run, step, at(0.5).alias("median"), at(0.1).alias("p10"), at(0.9).alias("p90"))


# --- ratings ---------------------------------------------------------------------------------

def battles_of(battles: DataFrame) -> DataFrame:
    """(m, n): battles of each model. Battles are counted per pair before they become two rows."""
    pairs = battles.groupBy("model_a", "model_b").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select(F.explode(F.array("model_a", "model_b")).alias("m"), "n").groupBy("m").agg(F.sum("n").alias("n"))


def well_known(human: DataFrame, at_least: int = 500) -> DataFrame:
    """Human battles between models that have at least ``at_least`` of them."""
    names = broadcast_if_small(cut_lineage(battles_of(human).filter(F.col("n") >= at_least).select("m")))  # one row per model
    return human.join(names, F.col("model_a") == F.col("m"), "left_semi").join(names, F.col("model_b") == F.col("m"), "left_semi")


def category_battles(judged: DataFrame, meta: DataFrame, category: str | None, text: str) -> DataFrame:
    """Judge battles with the category flags of their instruction; the flags hold one row per text."""
    rows = judged.join(meta, text)
    return rows if category is None else rows.filter(F.col(category))


def bradley_terry(battles: DataFrame, target: str, at_least: int = 100, replicates: int = 10, rounds: int = 100, seed: int = 42) -> DataFrame:
    """(model, rating, half_width) on a 400·log10 scale around 1000; null ratings when there are too few battles.

    The battles are reduced to wins per ordered pair and bootstrap replicate in one aggregate, each battle weighing
    a Poisson(1) count drawn from its hash. What is fitted is only models × models numbers per replicate.
    They are read twice, so what is costly to compute should be stored first.
    """
    names = broadcast_if_small(cut_lineage(battles_of(battles).filter((F.col("n") >= at_least) | (F.col("m") == target)).select("m")))
    kept = battles.join(names, F.col("model_a") == F.col("m"), "left_semi").join(names, F.col("model_b") == F.col("m"), "left_semi")
    # the drawn number of each replicate leaves the explosion as a column, so that a hash is computed once
    draws = [F.substring(hash_key(F.concat_ws(":", "battle", F.lit(r)), seed), 1, 8) for r in range(replicates)]
    rows = kept.select("model_a", "model_b", "winner", F.posexplode(F.array(*draws)).alias("rep", "u"))
    # the distribution up to the last step that a number of 32 bits can reach
    steps, total, prob, k = [], 0.0, float(np.exp(-1.0)), 0
    while total + prob <= 1 - 2**-32:
        total, k = total + prob, k + 1
        steps.append(total)
        prob /= k
    # eight hexadecimal digits compare as the number of 32 bits that they write
    weight = F.lit(len(steps))
    for k, s in reversed(list(enumerate(steps))):
        weight = F.when(F.col("u") < f"{math.ceil(s * 2**32):08x}", k).otherwise(weight)
    win_a = F.when(F.col("winner") == "model_a", 1.0).when(F.col("winner") == "model_b", 0.0).otherwise(0.5)
    pairs = rows.withColumn("w", weight).groupBy("rep", "model_a", "model_b").agg(
        F.sum(F.col("w") * win_a).alias("wins"), F.sum(F.col("w") * (1 - win_a)).alias("losses"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")
    )
    pairs = cut_lineage(pairs)
    enough = (pairs.filter("rep = 0").agg(F.sum("n")).first()[0] or 0) >= 100
    pairs = pairs.filter("w > 0").select("rep", "model_a", "model_b", "wins", "losses")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        models = sorted(set(pdf["model_a"]) | set(pdf["model_b"]))
        at = {m: i for i, m in enumerate(models)}
        won = np.zeros((len(models), len(models)))
        a, b = pdf["model_a"].map(at).to_numpy(), pdf["model_b"].map(at).to_numpy()
        np.add.at(won, (a, b), pdf["wins"].to_numpy())
        np.add.at(won, (b, a), pdf["losses"].to_numpy())
        games, wins = won + won.T, won.sum(axis=1) + 1e-9
        strength = np.ones(len(models))
        for _ in range(rounds):
            strength = wins / np.maximum((games / (strength[:, None] + strength[None, :])).sum(axis=1), 1e-12)
            strength /= np.exp(np.log(strength).mean())
        return pd.DataFrame({"rep": pdf["rep"].iloc[0], "model": models, "rating": 1000 + 400 * np.log10(strength)})

    fitted = pairs.groupBy("rep").applyInPandas(fit, "rep int, model string, rating double")
    value = lambda c: c if enough else F.lit(None).cast("double")
    return fitted.groupBy("model").agg(value(F.avg("rating")).alias("rating"), value(1.96 * F.stddev_pop("rating")).alias("half_width"))
