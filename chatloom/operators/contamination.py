"""Benchmark contamination: phrase and n-gram matching as equi-joins, and removal of the matched rows.

A text's n-grams are numbers that a filter of the benchmark's grams is asked for inside the row; only the few that pass are exploded, as strings, and
joined. Texts that hold the same benchmark grams are one class, and scores are formed per class and item, so that a passage in a third of the corpus is
scored once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.grams import GramFilter, gram_of
from chatloom.functions.text import col, let
from chatloom.session import broadcast_if_small, cut_lineage

# Fixed value: the characters at which texts are cut for matching.
MATCH_SPLIT = r'[ ,.?!:;()"\-\n\\]'


def match_tokens(text) -> Column:
    """Lower-cased tokens used on both sides of every text match."""
    return F.filter(F.split(F.lower(col(text)), MATCH_SPLIT), lambda t: t != "")


def token_grams(tokens: Column, n: int) -> Column:
    """The n-grams of a token array in order; empty when there are fewer than n tokens."""

    def grams(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(t) - (n - 1))
        return F.when(F.size(t) >= n, F.transform(starts, lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))).otherwise(
            F.array().cast("array<string>")
        )

    return let(tokens, grams)


def query_messages(chats: DataFrame, key: str, role: str = "user", messages: str = "messages") -> DataFrame:
    """The texts of one role, one row per message, with the id of their row."""
    return chats.select(key, F.explode(messages).alias("m")).filter(F.col("m.role") == role).select(
        key, F.col("m.content").alias("text")
    )


def _fields(test: DataFrame, item: str, fields: list[str]) -> DataFrame:
    """(item, field, tokens) of the items whose fields are all present."""
    whole = test.dropna(subset=fields)
    parts = F.array(*[F.struct(F.lit(i).alias("field"), F.col(f).alias("text")) for i, f in enumerate(fields)])
    return whole.select(F.col(item).alias("item"), F.explode(parts).alias("p")).select(
        "item", "p.field", match_tokens("p.text").alias("tokens")
    )


def exact_matches(train: DataFrame, test: DataFrame, key: str, text: str, item: str, fields: list[str], anchor: int = 5) -> DataFrame:
    """(key, item) where every field of the item occurs in the text as a contiguous phrase.

    A first pass finds (text, phrase) candidates by the first ``anchor`` tokens of the phrases, inside the row but for those that a filter of
    the anchors lets pass; a second pass verifies them against the whole text. Only candidates are kept in between, and the corpus itself is
    shuffled only when the candidates are too many to be broadcast.
    """
    parts = _fields(test, item, fields)
    phrases = cut_lineage(
        parts.filter(F.size("tokens") > 0)
        .withColumn("phrase", F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" ")))
        .withColumn("pid", F.md5("phrase"))
        .withColumn("anchor_len", F.least(F.size("tokens"), F.lit(anchor)))
        .withColumn("gram", F.array_join(F.slice("tokens", F.lit(1), F.col("anchor_len")), " "))
    )
    lengths = sorted(r[0] for r in phrases.select("anchor_len").distinct().collect())  # at most ``anchor`` values
    by_length = [F.when(F.col("anchor_len") == n, gram_of(F.col("gram"), n)) for n in lengths]
    known = GramFilter(phrases.select(F.coalesce(*by_length, F.lit(0).cast("long")).alias("h")).distinct())
    texts = train.select(F.col(key).alias("key"), F.col(text).alias("_text"))
    scan = known.attach(texts).select("key", F.explode(known.surviving(match_tokens("_text"), lengths or [anchor])).alias("gram"))
    lookup = broadcast_if_small(phrases.select("gram", "pid").distinct())
    candidates = cut_lineage(scan.join(lookup, "gram").select("key", "pid").distinct())
    wanted = broadcast_if_small(candidates.join(broadcast_if_small(phrases.select("pid", "phrase").distinct()), "pid"))
    body = F.concat(F.lit(" "), F.array_join(match_tokens("_text"), " "), F.lit(" "))
    hits = texts.join(wanted, "key").filter(F.contains(body, "phrase")).select("key", "pid")
    found = hits.distinct().join(phrases.select("item", "field", "pid"), "pid")
    return (
        found.groupBy("key", "item")
        .agg(F.count_distinct("field").alias("n"))
        .filter(F.col("n") == len(fields))
        .select(F.col("key").alias(key), F.col("item").alias(item))
    )


def exact_scores(test: DataFrame, matches: DataFrame, item: str, fields: list[str]) -> DataFrame:
    """0/1 per item that has all its fields, with the number of rows it was found in."""
    hits = matches.groupBy(item).agg(F.count(F.lit(1)).alias("hits"))
    return (
        test.dropna(subset=fields)
        .select(item)
        .join(hits, item, "left")
        .select(item, F.coalesce("hits", F.lit(0)).alias("hits"), F.col("hits").isNotNull().cast("int").alias("score"))
    )


def item_grams(test: DataFrame, item: str, fields: list[str], n: int) -> DataFrame:
    """(item, gram, cover, weight): the token positions a gram covers and what each position adds to the score.

    Positions of different fields are kept apart by packing the field number into the high digits.
    """
    parts = _fields(test, item, fields)
    place = F.transform(
        token_grams(F.col("tokens"), n), lambda g, i: F.struct(g.alias("gram"), i.alias("at"))
    )
    return (
        parts.withColumn("size", F.size("tokens"))
        .select("item", "field", "size", F.explode(place).alias("g"))
        .groupBy("item", "field", "size", F.col("g.gram").alias("gram"))
        .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("g.at"), F.col("g.at") + (n - 1))))).alias("idx"))
        .select(
            "item",
            "gram",
            F.transform("idx", lambda i: F.col("field").cast("long") * 1_000_000_000 + i).alias("cover"),
            (F.lit(1.0) / F.col("size") / len(fields)).alias("weight"),
        )
    )


def gram_hits(train: DataFrame, key: str, text: str, grams: DataFrame, n: int) -> DataFrame:
    """(key, gid) for the benchmark grams (gram, gid) present in each text, each once. One pass over the corpus; its other grams never leave their row."""
    known = GramFilter(grams.select(gram_of(F.col("gram"), n).alias("h")))
    texts = train.select(F.col(key).alias("key"), F.col(text).alias("_text"))
    have = known.attach(texts).select("key", F.explode(known.surviving(match_tokens("_text"), [n])).alias("gram"))
    return have.join(broadcast_if_small(grams.select("gram", "gid")), "gram").select("key", "gid")


def _coverage(triples: DataFrame) -> DataFrame:
    """(cls, item, score) from (cls, item, cover, weight); a pair has at most as many rows as the item has grams."""
    by_field = triples.groupBy("cls", "item", "weight", (F.col("cover")[0] / 1_000_000_000).cast("int").alias("field")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("cover")))).alias("covered")
    )
    return by_field.groupBy("cls", "item").agg(F.sum(F.col("covered") * F.col("weight")).alias("score"))


class Matches(NamedTuple):
    """Matched texts: ``members`` (key, cls) with the class of their benchmark grams, and ``scores`` (cls, item, score)."""

    members: DataFrame
    scores: DataFrame


def ngram_matches(
    train: DataFrame, test: DataFrame, key: str, text: str, item: str, fields: list[str], n: int, threshold: float | None = None
) -> Matches:
    """Scores of every class and item that share a gram, or of those above ``threshold``, without forming the pairs that boilerplate grams would give.

    With a threshold, the most frequent grams of an item, as long as together they cannot lift a score above the threshold,
    create no candidates: a pair above it must share a rarer gram as well. Candidates are then scored on all grams.
    """
    places = cut_lineage(item_grams(test, item, fields, n))
    ids = cut_lineage(places.select("gram").distinct().withColumn("gid", F.monotonically_increasing_id()))
    places = cut_lineage(places.join(broadcast_if_small(ids), "gram").drop("gram"))
    held = gram_hits(train, key, text, ids, n).groupBy("key").agg(F.sort_array(F.collect_set("gid")).alias("gids"))
    held = cut_lineage(held.withColumn("cls", F.md5(F.concat_ws(",", F.transform("gids", lambda g: g.cast("string"))))))
    classes = cut_lineage(held.groupBy("cls").agg(F.first("gids").alias("gids")))
    hits = classes.select("cls", F.explode("gids").alias("gid"))
    members = held.select(F.col("key").alias(key), "cls")
    if threshold is None:
        return Matches(members, _item_named(_coverage(hits.join(broadcast_if_small(places), "gid")), item))
    frequency = hits.groupBy("gid").agg(F.count(F.lit(1)).alias("df"))
    by_item = Window.partitionBy("item").orderBy(F.desc("df"), "gid").rowsBetween(Window.unboundedPreceding, 0)
    rare = (
        places.join(frequency, "gid")
        .withColumn("reach", F.sum(F.size("cover") * F.col("weight")).over(by_item))
        .filter(F.col("reach") > threshold - 1e-9)
        .select("gid", "item")
    )
    candidates = hits.join(rare, "gid").select("cls", "item").distinct()
    scored = _coverage(candidates.join(broadcast_if_small(places), "item").join(hits, ["cls", "gid"], "left_semi"))
    return Matches(members, _item_named(scored.filter(F.col("score") > threshold), item))


def _item_named(scores: DataFrame, item: str) -> DataFrame:
    return scores.select("cls", F.col("item").alias(item), "score")


def ngram_pairs(train: DataFrame, test: DataFrame, key: str, text: str, item: str, fields: list[str], n: int) -> DataFrame:
    """(key, item, score) of every text and item that share a gram: the full match report."""
    return all_pairs(ngram_matches(train, test, key, text, item, fields, n), key, item)


def ngram_pairs_above(
    train: DataFrame, test: DataFrame, key: str, text: str, item: str, fields: list[str], n: int, threshold: float
) -> DataFrame:
    """The pairs with a score above ``threshold``."""
    return all_pairs(ngram_matches(train, test, key, text, item, fields, n, threshold), key, item)


def all_pairs(found: Matches, key: str, item: str) -> DataFrame:
    """The scores of every member of a class: the report itself."""
    return found.members.join(found.scores, "cls").select(key, item, "score")


def contaminated(found: Matches, key: str) -> DataFrame:
    """The texts of the classes that have a score, each once."""
    return found.members.join(found.scores.select("cls").distinct(), "cls", "left_semi").select(key)


def item_scores(test: DataFrame, scores: DataFrame, item: str, fields: list[str]) -> DataFrame:
    """Best score per item, 0 for items without any match; ``scores`` of pairs or of classes."""
    best = scores.groupBy(item).agg(F.max("score").alias("best"))
    return test.dropna(subset=fields).select(item).join(best, item, "left").select(
        item, F.coalesce("best", F.lit(0.0)).alias("score")
    )


def row_scores(found: Matches, key: str) -> DataFrame:
    """Best score per training row: one number a class."""
    best = found.scores.groupBy("cls").agg(F.max("score").alias("score"))
    return found.members.join(best, "cls").select(key, "score")


def set_scores(found: Matches, sets: DataFrame, key: str, train_set: str, item: str) -> DataFrame:
    """(train_set, item, best): best score of an item in each training set of ``sets`` (key, train_set); a class counts once a set."""
    present = found.members.join(sets.select(key, train_set), key).select("cls", train_set).distinct()
    return present.join(found.scores, "cls").groupBy(train_set, item).agg(F.max("score").alias("best"))


def match_matrix(scores: DataFrame, train_set: str, eval_set: str, threshold: float | None, eval_sets: list[str]) -> DataFrame:
    """Mean (thresholded) item score per training set and evaluation set, four decimals."""
    value = F.col("score") if threshold is None else (F.col("score") > threshold).cast("double")
    return scores.groupBy(train_set).pivot(eval_set, eval_sets).agg(F.round(F.avg(value), 4))


def drop_contaminated(train: DataFrame, contaminated: DataFrame, key: str) -> DataFrame:
    """The rows that match no evaluation set."""
    ids = cut_lineage(contaminated.select(key).distinct())
    return train.join(broadcast_if_small(ids), key, "left_anti")


def kept_report(train: DataFrame, contaminated: DataFrame, key: str) -> DataFrame:
    """Totals and kept percentage in one pass."""
    ids = cut_lineage(contaminated.select(key).distinct().withColumn("hit", F.lit(1)))
    flag = broadcast_if_small(ids)
    return train.select(key).join(flag, key, "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("hit").alias("removed"),
        F.round(100.0 * (F.count(F.lit(1)) - F.count("hit")) / F.count(F.lit(1)), 2).alias("kept_pct"),
    )
