"""Conversations out of message trees by pointer jumping: every round doubles how far a message sees, ids only; the texts are joined once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import cut_lineage


def _role(c: Column) -> Column:
    return F.when(c == "assistant", "assistant").otherwise("user")


def lines_of_descent(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(message_id, line): the ids from a start down to every message that edges (parent_id, message_id) connect to it, itself included.

    A message's line grows upwards: as many ids as the line of its topmost one has are put before it, so the rounds follow the logarithm of the depth. A parent
    without a line of its own (deleted, or not picked) ends a line, and it goes. A message has one parent.
    """
    tops = starts.select("message_id", F.array("message_id").alias("line"), F.lit(True).alias("done"))
    known = cut_lineage(tops.unionByName(edges.select("message_id", F.array("parent_id", "message_id").alias("line"), F.lit(False).alias("done"))))
    done, open_ = known.filter("done"), known.filter("NOT done")
    while not open_.isEmpty():
        upper = known.select(F.col("message_id").alias("top"), F.col("line").alias("above"), F.col("done").alias("ends"))
        grown = open_.withColumn("top", F.col("line")[0]).join(upper, "top")
        longer = grown.select("message_id", F.concat("above", F.slice("line", F.lit(2), F.size("line") - 1)).alias("line"), F.col("ends").alias("done"))
        # replies that go round in a circle have no root
        round_ = F.array_contains(F.slice("line", F.lit(1), F.size("line") - 1), F.col("message_id"))
        known = cut_lineage(longer.filter(~round_).unionByName(done))
        done, open_ = known.filter("done"), known.filter("NOT done")
    return done.select("message_id", "line")


def _spoken(lines: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, messages): the messages of a line in order, with the texts of ``nodes``."""
    parts = lines.select(*keys, F.posexplode("line").alias("at", "message_id"))
    bodies = nodes.select("message_id", "role", "text")
    told = parts.join(bodies, "message_id").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", _role(F.col("role")).alias("role"), F.col("text").alias("content")))).alias("m"))
    return told.select(*keys, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def best_paths(nodes: DataFrame) -> DataFrame:
    """(root, messages, language): from each prompter root follow the best child until a leaf.

    Best is the lowest rank (missing = 999), then more labels, then the smaller id: one min_by per parent, so a
    parent with very many replies is reduced before the shuffle.
    """
    order = F.struct(F.coalesce("rank", F.lit(999)), -F.coalesce(F.size("labels"), F.lit(0)), F.col("message_id"))
    best = cut_lineage(nodes.filter("parent_id IS NOT NULL").groupBy("parent_id").agg(F.min_by("message_id", order).alias("message_id")))
    roots = nodes.filter("parent_id IS NULL AND role = 'prompter'")
    lines = lines_of_descent(best, roots)
    ends = lines.join(best.select(F.col("parent_id").alias("message_id")), "message_id", "left_anti")
    paths = _spoken(ends.select(F.col("line")[0].alias("root"), "line"), nodes, ["root"])
    lang = roots.select(F.col("message_id").alias("root"), F.substring_index(F.coalesce("lang", F.lit("")), "-", 1).alias("language"))
    spoken = F.filter("messages", lambda m: F.coalesce(m["content"], F.lit("")) != "")
    return paths.withColumn("messages", spoken).filter(F.size("messages") >= 2).join(lang, "root").select("root", "messages", "language")


def reply_paths(nodes: DataFrame, top_k: int | None = None) -> DataFrame:
    """(root, tip, messages): every path from a root to an assistant leaf, deleted nodes pruned.

    With ``top_k`` only the best replies by quality are followed (WindowGroupLimit cuts them map-side).
    A node counts as a leaf when it has no reply at all, deleted ones included.
    """
    alive = nodes.filter("NOT deleted")
    edges = alive.filter("parent_id IS NOT NULL")
    if top_k is not None:
        w = Window.partitionBy("parent_id").orderBy(F.desc("quality"), "message_id")
        edges = edges.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top_k).drop("rn")
    lines = lines_of_descent(edges.select("parent_id", "message_id"), alive.filter("parent_id IS NULL"))
    parents = nodes.filter("parent_id IS NOT NULL").select(F.col("parent_id").alias("message_id")).distinct()
    leaves = alive.filter("role = 'assistant'").select("message_id").join(parents, "message_id", "left_anti")
    ends = lines.join(leaves, "message_id").select(F.col("line")[0].alias("root"), F.col("message_id").alias("tip"), "line")
    return _spoken(ends, alive, ["root", "tip"]).select("root", "tip", "messages")
