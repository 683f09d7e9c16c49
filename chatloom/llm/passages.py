"""Deduplication of repeated passages word by word, wherever in a line they begin and end, in DataFrame functions only.

A run of ``least`` words that stands earlier in the corpus is deleted word by word; earlier is by (id, text hash, position). Overlapping
runs merge into the whole repeated passage, so a passage of ``least`` words or more goes from its first word to its last one.

1. Winnowing: of the shingles in every ``least`` consecutive words the one of smallest hash is selected, so equal runs select the same shingle
   and one that occurs once proves that no run around it is repeated. The minimum of a window is taken by doubling its width.
2. Neighbouring runs that select the same shingle are a group, one row of a narrow table. A group that stands earlier as a whole is deleted and
   leaves the table: what it equals is still there. Shingles that are then left once are settled too.
3. Runs of the groups that are left, those around the ends of passages, are each compared with their first occurrence, and deleted if they are not the first.

Words are compared as strings (by 96 bits of hash per run), the white space between them is not. Where words go from the middle of a text, one space or,
if a line ended among them, one line end stays.

Edge cases: a null or empty text and one of fewer than ``least`` words come back as they are; null ids are before all others; a row that
repeats id and text of another counts as later than it as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import let, steps
from chatloom.llm.frames import WORD, cut, keeps_underscored, text_of
from chatloom.session import broadcast_if_small

LEAST = 51
SHINGLE = 16
DOC = ("_id", "_null", "_text")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def at_each(n: Column, body) -> Column:
    """``body`` of the numbers from 0 to n - 1; n must be positive."""
    return F.transform(F.sequence(F.lit(0), n - 1), body)


def selected(grams: Column, width: int) -> Column:
    """Position of the smallest hash, the last of equal ones, in each window of ``width`` grams."""
    # hash above, position below: the smallest number of a window says where it stands
    low = 2**31 - 1
    marked = F.transform(grams, lambda g, i: F.shiftleft(F.shiftright(g, 31), 31) + (F.lit(low) - i))
    have, rules = 1, []

    def widened(by: int):
        return lambda a: F.zip_with(F.slice(a, F.lit(1), F.size(a) - by), F.slice(a, F.lit(1 + by), F.size(a) - by), lambda x, y: F.least(x, y))

    while have < width:
        by = min(have, width - have)
        rules.append(widened(by))
        have += by
    return F.transform(steps(marked, *rules), lambda m: (F.lit(low) - m.bitwiseAND(F.lit(low))).cast("int"))


def small(df: DataFrame) -> DataFrame:
    """Broadcast within a bound that leaves a small driver room."""
    return broadcast_if_small(df, max_rows=200_000, max_bytes=16 * 1024 * 1024)


def run_groups(body: Column, least: int, shingle: int) -> Column:
    """Groups of a text: array of struct(print: the selected shingle, run and run2: hashes of the group's words, a, b: its first and last run)."""
    none = F.expr("array_repeat(struct(0L as print, 0L as run, 0 as run2, 0 as a, 0 as b), 0)")

    def groups(h: Column, g: Column, at: Column) -> Column:
        first = at_each(F.size(at), lambda j: F.when((j == 0) | (F.get(at, j) != F.get(at, j - 1)), j))

        def group(starts: Column) -> Column:
            def one(a: Column, i: Column) -> Column:
                b = F.coalesce(F.get(starts, i + 1), F.size(at)) - 1
                return let(F.slice(h, a + 1, b - a + least), lambda r: F.struct(
                    F.get(g, F.get(at, a)).alias("print"), F.xxhash64(r).alias("run"), F.hash(r).alias("run2"), a.alias("a"), b.alias("b")))

            return F.transform(starts, one)

        return let(F.array_compact(first), group)

    gram = lambda h: at_each(F.size(h) - (shingle - 1), lambda i: F.xxhash64(F.slice(h, i + 1, F.lit(shingle))))
    found = lambda h: let(gram(h), lambda g: let(selected(g, least - shingle + 1), lambda at: groups(h, g, at)))
    return let(hashes(body), lambda h: F.when(F.size(h) >= least, found(h)).otherwise(none))


def hashes(body: Column) -> Column:
    return F.transform(words_of(body), lambda w: F.xxhash64(w))


def repeated(rows: DataFrame, print_: list[str], at: str) -> DataFrame:
    """``rows`` with ``later``: whether equal ``print_`` stand at an earlier place."""
    place = F.struct(~F.col("_null"), F.col("_id"), F.col("_text"), F.col(at))
    first = cut(rows.groupBy(*print_).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return rows.join(small(first), print_, "left").withColumn("later", F.coalesce(place != F.col("first"), F.lit(False))).drop("first")


def repeated_words(rows: DataFrame, body: Column, least: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold a repeated run (_id, _null, _text), and the places of the later runs (.., _at array<struct(a, b)>) by text."""
    narrow = cut(rows.select(*DOC, F.inline(run_groups(body, least, shingle))))
    again = cut(narrow.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print"))
    hits = cut(narrow.join(small(again), "print", "left_semi"))
    judged = cut(repeated(hits, ["print", "run", "run2"], "a"))
    whole = judged.filter("later").select(*DOC, "a", "b")
    left = judged.filter("NOT later").drop("later", "run", "run2")
    unsettled = cut(left.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print"))
    left = cut(left.join(small(unsettled), "print", "left_semi").groupBy(*DOC).agg(F.collect_list(F.struct("a", "b")).alias("groups")))

    starts = F.flatten(F.transform("groups", lambda g: F.sequence(g["a"], g["b"])))
    run = lambda h: F.transform(starts, lambda i: let(F.slice(h, i + 1, F.lit(least)), lambda r: F.struct(
        F.xxhash64(r).alias("run"), F.hash(r).alias("run2"), i.alias("a"))))
    near = rows.select(*DOC, body.alias("body")).join(small(left), [*DOC])
    runs = cut(near.select(*DOC, F.inline(let(hashes(F.col("body")), run))))
    single = repeated(runs, ["run", "run2"], "a").filter("later").select(*DOC, "a", F.col("a").alias("b"))
    later = cut(whole.unionByName(single).groupBy(*DOC).agg(F.collect_set(F.struct("a", "b")).alias("_at")))
    return cut(hits.select(*DOC).distinct()), later


def without(body: Column, starts: Column, least: int) -> Column:
    """The text without the words of the runs that begin between a and b of ``starts``."""

    def joined(x: Column) -> Column:
        words, gaps, kept = x["words"], x["gaps"], x["kept"]

        def piece(i: Column, j: Column) -> Column:
            before = F.when(j == 0, F.lit(-1)).otherwise(F.get(kept, j - 1))
            gap = F.array_join(F.slice(gaps, before + 2, i - before), "")
            mended = F.when(j == 0, F.lit("")).when(F.contains(gap, F.lit("\n")), F.lit("\n")).otherwise(F.lit(" "))
            return F.concat(F.when(i == before + 1, gap).otherwise(mended), F.get(words, i))

        tail = F.when(F.get(kept, F.size(kept) - 1) == F.size(words) - 1, F.get(gaps, F.size(words))).otherwise(F.lit(""))
        return F.when(F.size(kept) > 0, F.concat(F.array_join(F.transform(kept, piece), ""), tail)).otherwise(F.lit(""))

    def gone(s: Column) -> Column:
        # each stretch of runs adds the words that the one before it does not hold
        first = lambda r, i: F.greatest(r["a"], F.when(i > 0, F.get(s, i - 1)["b"] + least).otherwise(r["a"]))
        return F.flatten(F.transform(s, lambda r, i: F.sequence(first(r, i), r["b"] + least - 1)))

    kept = lambda w: F.array_except(F.sequence(F.lit(0), F.size(w) - 1), let(F.array_sort(starts), gone))
    return let(words_of(body), lambda w: let(F.struct(w.alias("words"), F.split(body, WORD, -1).alias("gaps"), kept(w).alias("kept")), joined))


@keeps_underscored
def dedup_passages(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the later ones of repeated passages deleted from ``text``, and ``cut_words``, whether any were.

    ``docs`` is read four times.
    """
    body = text_of(text)
    rows = docs.drop("cut_words").withColumns({"_id": F.coalesce(F.col(key), F.lit(-(2**63))), "_null": F.col(key).isNull(), "_text": F.xxhash64(body)})
    suspects, later = repeated_words(rows, body, least, shingle)
    suspects = small(suspects)
    rest = rows.join(suspects, [*DOC], "left_anti").withColumn("cut_words", F.lit(False))
    held = rows.join(suspects, [*DOC], "left_semi").withColumn("_copy", F.row_number().over(Window.partitionBy(*DOC).orderBy("_text")))
    held = held.join(small(later), [*DOC], "left")
    again = F.col("_copy") > 1
    held = held.withColumn("cut_words", again | F.col("_at").isNotNull())
    held = held.withColumn(text, F.when(again, F.lit("")).when(F.col("_at").isNotNull(), without(F.col(text), F.col("_at"), least)).otherwise(F.col(text)))
    return rest.unionByName(held.select(rest.columns)).drop(*DOC)
