"""Preference pairs, votes, advantages: work inside groups of completions of one prompt.

Groups are reduced by ``max_by`` / ``min_by`` and plain aggregates, which combine before the shuffle, so a prompt
with very many samples never has to fit into one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import message, user_assistant
from chatloom.functions.text import col, hash_key, strip
from chatloom.operators.sampling import first_k


# --- best and worst --------------------------------------------------------------------------

def best_and_worst(df: DataFrame, prompt: str, idx: str, score: str, values: list[str], groups: list[str] = (), reference: str | None = None) -> DataFrame:
    """argmax and argmin of the score per prompt (and judge), ties to the first index; reference rows can be left out."""
    rows = df if reference is None else df.filter(~F.col(reference))
    keep = F.struct(idx, score, *values)
    return (
        rows.groupBy(*groups, prompt)
        .agg(
            F.max_by(keep, F.struct(F.col(score), -F.col(idx))).alias("best"),
            F.min_by(keep, F.struct(F.col(score), F.col(idx))).alias("worst"),
        )
    )


def majority(votes: DataFrame, prompt: str, judge: str, choice: str, seed: int = 42) -> DataFrame:
    """The most frequent choice per prompt, ties to the one seen first; total disagreement is decided by hash."""
    counted = votes.groupBy(prompt, choice).agg(F.count(F.lit(1)).alias("n"), F.min(judge).alias("first"))
    h = hash_key(F.concat_ws(":", prompt, choice), seed)
    tops = counted.withColumn("h", h).groupBy(prompt).agg(
        F.sum("n").alias("judges"), F.count(F.lit(1)).alias("choices"),
        F.min_by(choice, F.struct(-F.col("n"), F.col("first"))).alias("common"), F.min_by(choice, F.col("h")).alias("drawn"),
    )
    return tops.select(prompt, F.when(F.col("judges") == F.col("choices"), F.col("drawn")).otherwise(F.col("common")).alias(choice))


def preference_rows(chosen: DataFrame, rejected: DataFrame, prompt: str, judge: str, score: str, text: str) -> DataFrame:
    """(prompt, chosen, rejected, chosen_scores, rejected_scores): judge scores as maps; both sides share the prompt."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(prompt).agg(
            F.max(text).alias(name), F.map_from_entries(F.sort_array(F.collect_list(F.struct(judge, score)))).alias(f"{name}_scores")
        )

    return side(chosen, "chosen").join(side(rejected, "rejected"), prompt)


# --- binarisation ----------------------------------------------------------------------------

# Weights of the five aspects, verbosity counts against an answer.
ASPECT_WEIGHTS = {"helpfulness": 0.65, "correctness": 0.8, "coherence": 0.45, "complexity": 0.55, "verbosity": -0.4}


def mean_score(aspects: list[str], ignore: list[str] = ()) -> Column:
    kept = [a for a in aspects if a not in ignore]
    return sum((F.col(a) for a in kept[1:]), F.col(kept[0])) / len(kept)


def weighted_score(weights: dict[str, float] = ASPECT_WEIGHTS) -> Column:
    return sum((F.col(a) * w for a, w in weights.items()), F.lit(0.0))


def binarize(df: DataFrame, prompt: str, idx: str, response: str, score: Column, min_score: float | None = None, margin: float | None = None) -> DataFrame:
    """Best against worst response of a prompt with at least two; ties, low and close scores are skipped.

    Responses of equal score keep their order: the first one wins, the last one loses.
    """
    rows = df.select(prompt, idx, response, score.alias("s"))
    g = rows.groupBy(prompt).agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct(response, "s"), F.struct(F.col("s"), -F.col(idx))).alias("c"),
        F.min_by(F.struct(response, "s"), F.struct(F.col("s"), -F.col(idx))).alias("r"),
    )
    g = g.filter((F.col("n") >= 2) & (F.col("c.s") != F.col("r.s")))
    if min_score is not None:
        g = g.filter(F.col("c.s") >= min_score)
    if margin is not None:
        g = g.filter(F.col("c.s") - F.col("r.s") >= margin)
    return g.select(
        prompt, F.col("c")[response].alias("chosen"), F.col("r")[response].alias("rejected"),
        F.round("c.s", 2).alias("chosen_score"), F.round("r.s", 2).alias("rejected_score"),
    )


def pick_from_ranks(answers: DataFrame, prompt: str, rank: str, text: str, key, top: int = 4, seed: int = 42) -> DataFrame:
    """Chosen by hash among the best ``top`` valid answers, rejected by hash among all the others.

    Answers with role marks are invalid; a prompt needs two valid ones.
    """
    valid = answers.filter(~F.col(text).rlike("Human:|Assistant:")).withColumn("_h", hash_key(key, seed))
    best = first_k(valid, [prompt], [rank, "_h"], top)
    chosen = best.groupBy(prompt).agg(F.min_by(F.struct(rank, text, "_h"), F.col("_h")).alias("c"))
    other = valid.join(chosen, prompt).filter(F.col("_h") != F.col("c._h"))
    return other.groupBy(prompt).agg(
        F.max(F.col("c")[text]).alias("chosen"), F.max_by(text, F.col("_h")).alias("rejected")
    )


# Fixed value: the system turn of questions with excerpts.
EXCERPT_SYSTEM = (
    "You are a helpful assistant answering questions. You will get a question with some excerpts from websites that "
    "could be useful to answer them."
)


def numbered(quotes) -> Column:
    return F.array_join(F.transform(col(quotes), lambda q, i: F.concat((i + 1).cast("string"), F.lit(". "), q)), "\n\n")


def score_pair(df: DataFrame, question: str, sides: list[tuple[str, str, str]]) -> DataFrame:
    """Two (answer, quotes, score) sides to chosen and rejected chats with their margin; ties are dropped."""

    def chat(answer: str, quotes: str) -> Column:
        ask = F.concat(F.col(question), F.lit("\n\n"), numbered(quotes))
        return F.concat(F.array(message("system", F.lit(EXCERPT_SYSTEM))), user_assistant(ask, answer))

    (a0, q0, s0), (a1, q1, s1) = sides
    first = F.col(s0) > F.col(s1)
    return df.filter(F.col(s0) != F.col(s1)).select(
        "*", F.when(first, chat(a0, q0)).otherwise(chat(a1, q1)).alias("chosen"),
        F.when(first, chat(a1, q1)).otherwise(chat(a0, q0)).alias("rejected"), F.abs(F.col(s0) - F.col(s1)).alias("margin"),
    )


def append_turns(trajectory, chosen, rejected) -> tuple[Column, Column]:
    """The trajectory followed by the chosen and by the rejected answer."""
    end = lambda c: F.concat(col(trajectory), F.array(message("assistant", c)))
    return end(chosen), end(rejected)


# --- aspect ratings --------------------------------------------------------------------------

# Aspect codes of the annotation ids, and the aspects that come with a type and two rationales.
ASPECT_CODES = {"hon": "honesty", "hel": "helpfulness", "ins": "instruction_following", "tru": "truthfulness"}
TYPED_ASPECTS = ["truthfulness", "helpfulness"]


def decode_aspect(custom_id) -> tuple[Column, Column]:
    """(id, aspect) of ``<id>_<code>``."""
    code = F.get(F.split(col(custom_id), "_"), F.lit(1))
    names = F.create_map(*[F.lit(x) for kv in ASPECT_CODES.items() for x in kv])
    return F.get(F.split(col(custom_id), "_"), F.lit(0)), F.try_element_at(names, code)


def annotation_completeness(df: DataFrame, custom_id: str) -> DataFrame:
    """Whether all aspects and all ids occur equally often (missing and duplicate annotations)."""
    key, aspect = decode_aspect(custom_id)
    rows = df.select(key.alias("id"), aspect.alias("aspect"))
    even = lambda c: rows.groupBy(c).count().agg((F.min("count") == F.max("count")).alias("even")).select(F.lit(c).alias("by"), "even")
    return even("aspect").unionByName(even("id"))


def parse_ratings(text, aspect) -> Column:
    """One rating per blank-line separated response; an unreadable response counts 1, ``N/A`` is null."""
    typed = col(aspect).isin(TYPED_ASPECTS)

    def number(raw: Column) -> Column:
        first = F.regexp_extract(raw, r"(?U)\b(\d+)\b", 1)
        return F.when(first == "", 1).otherwise(first.try_cast("int"))

    def plain(r: Column) -> Column:
        raw = F.regexp_extract(r, r"(?s)Rating: (.+?)\nRationale: (.+)", 1)
        return F.when(raw == "N/A", F.lit(None).cast("int")).when(raw == "", 1).otherwise(number(raw))

    def with_type(r: Column) -> Column:
        raw = F.regexp_extract(r, r"(?s)Type: (.+?)\nRationale: (.+?)\nRating: (.+?)\nRationale: (.+)", 3)
        return F.when(raw == "", 1).otherwise(number(raw))

    return F.transform(F.split(col(text), "\n\n"), lambda r: F.when(typed, with_type(r)).otherwise(plain(r)))


def mean_ratings(df: DataFrame, key: str, ratings: str) -> DataFrame:
    """Element-wise mean over the aspects of an id; lists may differ in length, missing values do not count."""
    exploded = df.select(key, F.posexplode(ratings).alias("pos", "r"))
    return exploded.groupBy(key, "pos").agg(F.avg("r").alias("rating"))


def binarize_ratings(ratings: DataFrame, completions: DataFrame, key: str, models: str, texts: str, seed: int = 42, top: int = 4) -> DataFrame:
    """Best mean rating is chosen, a random other completion is rejected; computed per id, so nothing can shift."""
    rows = ratings.filter(F.col("pos") < top)
    h = hash_key(F.concat_ws(":", key, "pos"), seed)
    best = rows.groupBy(key).agg(F.max_by(F.struct("pos", "rating"), F.struct(F.col("rating"), -F.col("pos"))).alias("c"))
    other = rows.join(best.select(key, "c"), key).filter(F.col("pos") != F.col("c.pos")).withColumn("h", h)
    pair = other.groupBy(key).agg(F.max("c").alias("c"), F.min_by(F.struct("pos", "rating"), F.col("h")).alias("r"))
    at = lambda c, side: F.get(F.col(c), F.col(f"{side}.pos"))
    return pair.join(completions, key).select(
        key, at(texts, "c").alias("chosen"), at(texts, "r").alias("rejected"), at(models, "c").alias("chosen_model"),
        at(models, "r").alias("rejected_model"), F.col("c.rating").alias("chosen_rating"), F.col("r.rating").alias("rejected_rating"),
    ).dropna()


def annotation_mix(df: DataFrame, key: str, text: str, completions: str, prompts: dict[str, str]) -> DataFrame:
    """One row per prompt and aspect with the rendered judge prompt; the aspects travel inside the row."""
    listed = F.array_join(F.transform(completions, lambda c, i: F.concat(F.lit("<text "), (i + 1).cast("string"), F.lit("> "), c)), "\n")

    def rendered(template: str) -> Column:
        return F.replace(F.replace(F.lit(template), F.lit("{instruction}"), F.col(text)), F.lit("{completions}"), listed)

    rows = F.array(*[F.struct(F.lit(a).alias("aspect"), rendered(p).alias("text")) for a, p in prompts.items()])
    return df.select(key, F.col(text).alias("raw_text"), F.explode(rows).alias("x")).select(key, "raw_text", "x.aspect", "x.text")


def judged_pair(judgement, swapped, first, second) -> tuple[Column, Column, Column]:
    """(chosen, rejected, comparison) of a ``Comparison: … Preferred: n`` verdict; null when it cannot be read.

    ``swapped`` says that the judge saw the second completion as number 0.
    """
    j = col(judgement)
    preferred = strip(F.regexp_extract(j, r"(?s)Preferred:(.*)", 1))
    comparison = strip(F.regexp_extract(j, r"(?s)Comparison:(.*?)(?:Preferred:|\z)", 1))
    readable = j.contains("Comparison:") & preferred.isin("0", "1")
    wins = (preferred == "0") != col(swapped)
    return (
        F.when(readable, F.when(wins, col(first)).otherwise(col(second))), F.when(readable, F.when(wins, col(second)).otherwise(col(first))),
        F.when(readable, comparison),
    )


# --- advantages ------------------------------------------------------------------------------

def group_stats(df: DataFrame, prompt: str, score: str) -> DataFrame:
    s = F.col(score)
    return df.groupBy(prompt).agg(
        F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("lo"), F.max(s).alias("hi"), F.count(F.lit(1)).alias("n")
    )


def advantages(df: DataFrame, prompt: str, score: str, normalise: bool = True) -> DataFrame:
    """(score - mean) / (population std + 1e-8), or centred only. Aggregate and join back, so a hot prompt can be split."""
    stats = group_stats(df, prompt, score).select(prompt, "mean", "std")
    centred = F.col(score) - F.col("mean")
    value = centred / (F.col("std") + 1e-8) if normalise else centred
    return df.join(stats, prompt).withColumn("advantage", value).drop("mean", "std")


def informative_groups(df: DataFrame, prompt: str, score: str, solved: float) -> tuple[DataFrame, DataFrame]:
    """(rows of groups whose scores differ, tally of the dropped groups: all zero, all solved, other)."""
    stats = group_stats(df, prompt, score)
    tally = stats.filter("lo = hi").agg(
        F.count(F.lit(1)).alias("dropped"), F.count_if(F.col("lo") == 0).alias("zero"), F.count_if(F.col("lo") == solved).alias("solved"),
        F.count_if((F.col("lo") != 0) & (F.col("lo") != solved)).alias("other"),
    )
    return df.join(stats.filter("lo < hi").select(prompt), prompt, "left_semi"), tally


def finished(df: DataFrame, finish: str) -> DataFrame:
    return df.filter(F.col(finish) == "stop")


def solved_prompts(df: DataFrame, prompt: str, score: str, max_score: float, rate: float) -> DataFrame:
    """Prompts that need no further sampling."""
    return group_stats(df, prompt, score).filter(F.col("mean") / max_score >= rate).select(prompt)


def gae(gamma: float, lam: float):
    """Kernel for advantages and returns of trajectory rows: ``gae(g, l)(values, rewards, dones, response_mask)``.

    The steps of all rows of an Arrow batch stand one after the other, and the backward recursion ``a[t] + c[t] * adv[t + 1]`` is put together over
    reaches of 1, 2, 4, ... steps; a reach ends where c is 0, at the end of a row, a done, or a query token. Memory follows the steps of a batch, not its longest row.
    Pass arrays of zeros as dones and of ones as mask to have no cut.
    """

    @F.pandas_udf("advantages array<double>, returns array<double>")
    def kernel(values: pd.Series, rewards: pd.Series, dones: pd.Series, response_mask: pd.Series) -> pd.DataFrame:
        size = values.map(len).to_numpy()
        flat = lambda rows: np.concatenate([np.zeros(0), *(np.asarray(x, dtype="float64") for x in rows)])
        v, r, d, m = (flat(x) for x in (values, rewards, dones, response_mask))
        ends = np.cumsum(size)
        passes = (1 - np.clip(d, 0, 1)) * np.clip(m, 0, 1)
        passes[ends[size > 0] - 1] = 0.0  # the last step of a row has no successor
        adv = r + gamma * np.append(v[1:], 0.0)[: len(v)] * passes - v
        reach, step = gamma * lam * passes, 1
        while step < len(v) and reach.any():
            # a product of two reaches of ``step`` steps is one of twice as many
            adv[:-step] = adv[:-step] + reach[:-step] * adv[step:]
            reach = np.append(reach[:-step] * reach[step:], np.zeros(step))
            step *= 2
        cuts = ends[:-1]
        return pd.DataFrame({"advantages": np.split(adv, cuts)[: len(size)], "returns": np.split(adv + v, cuts)[: len(size)]})

    return kernel


def masked_mean(values, mask, denominator: float | None = None) -> Column:
    """Mean of the unmasked values of a row."""
    total = F.aggregate(F.zip_with(col(values), col(mask), lambda x, m: (x * m).cast("double")), F.lit(0.0), lambda a, x: a + x)
    count = F.lit(denominator) if denominator is not None else F.aggregate(col(mask), F.lit(0.0), lambda a, m: a + m)
    return total / count


def masked_mean_all(df: DataFrame, values: str, mask: str) -> DataFrame:
    """One mean over all rows."""
    pairs = df.select(F.explode(F.arrays_zip(F.col(values).alias("v"), F.col(mask).alias("m"))).alias("x"))
    return pairs.agg((F.sum(F.col("x.v") * F.col("x.m")) / F.sum("x.m")).alias("mean"))
