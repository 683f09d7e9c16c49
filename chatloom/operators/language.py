"""Language detection with a character-trigram model learned from labelled text.

The model is a table (language, gram, log probability); scoring is a join and a sum, so it runs wherever the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import by_role
from chatloom.functions.text import col, find_all, strip
from chatloom.session import broadcast_if_small, cut_lineage

MIN_CHARS = 20


def user_text(messages) -> Column:
    """All user turns, joined by blanks."""
    return F.array_join(F.transform(by_role(messages, "user"), lambda m: m["content"]), " ")


def grams(text, n: int = 3) -> Column:
    """Overlapping character grams of the letters of a text, words set apart by blanks."""
    letters = F.regexp_replace(F.lower(col(text)), r"[^\p{L}]+", " ")
    # a look-ahead matches at every position without consuming it: one linear walk over the text
    return find_all(F.concat(F.lit(" "), F.trim(letters), F.lit(" ")), f"(?s)(?=(.{{{n}}}))", 1)


def train(df: DataFrame, language: str, text: str) -> DataFrame:
    """(language, gram, weight, floor) with add-one smoothing; ``floor`` is the weight of an unseen gram."""
    # the corpus is read once; the counts are kept as a table because sizes, totals and scoring all need them
    counts = cut_lineage(
        df.select(F.col(language).alias("language"), F.explode(grams(text)).alias("gram")).groupBy("language", "gram").agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    vocabulary = counts.select("gram").distinct().count()
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    return counts.join(broadcast_if_small(totals), "language").select(
        "language", "gram",
        F.log((F.col("n") + 1) / (F.col("total") + vocabulary)).alias("weight"),
        F.log(F.lit(1.0) / (F.col("total") + vocabulary)).alias("floor"),
    )


def detect(df: DataFrame, key: str, text: str, model: DataFrame) -> DataFrame:
    """(key, detected, reason): the language with the highest log likelihood; empty and short texts are told apart.

    The model has a row per gram with a column per language, what the gram gains over the language's floor; grams are looked up where the texts are read and
    summed there, so what is shuffled is a row per text.
    """
    clean = df.select(F.col(key), strip(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    long = clean.filter(F.length("t") >= MIN_CHARS)
    floors = {r["language"]: r["floor"] for r in model.groupBy("language").agg(F.max("floor").alias("floor")).collect()}  # one row per language
    gain = lambda name: F.coalesce(F.sum(F.when(F.col("language") == name, F.col("weight") - F.col("floor"))), F.lit(0.0))
    gains = model.groupBy("gram").agg(*[gain(name).alias(f"g{i}") for i, name in enumerate(floors)])
    known = long.select(key, F.explode(grams("t")).alias("gram")).join(broadcast_if_small(gains), "gram", "left")
    total = lambda i, floor: F.coalesce(F.sum(f"g{i}"), F.lit(0.0)) + F.count(F.lit(1)) * F.lit(floor)
    sums = known.groupBy(key).agg(*[total(i, floor).alias(f"s{i}") for i, floor in enumerate(floors.values())])
    if floors:
        ranked = F.array(*[F.struct(F.col(f"s{i}").alias("s"), F.lit(name).alias("l")) for i, name in enumerate(floors)])
        best = sums.select(key, F.array_max(ranked)["l"].alias("detected"))
    else:
        best = long.select(key, F.lit(None).cast("string").alias("detected")).distinct()
    reason = F.when(F.length("t") == 0, "empty").when(F.length("t") < MIN_CHARS, "short").otherwise("detected")
    return clean.join(best, key, "left").select(key, F.coalesce("detected", F.lit("unknown")).alias("detected"), reason.alias("reason"))
