"""Line deduplication by winnowing over line hashes, in DataFrame functions only.

A line with a word is one unit, and one more for every ``unit_words`` words, up to ``window`` units; lines without a word have none. A
run of at least ``window`` units that stands earlier in the corpus is deleted, line by line; earlier is by (id, text hash, position).
So a line of 40 words is a run of its own at the defaults, shorter lines need equal neighbours, and a passage of more than 50 words that fills
its lines is always a run.

1. Winnowing: of every ``window`` consecutive units of a document the smallest hash is selected. Equal runs of that length
   select the same unit, so a fingerprint that occurs once proves that no run around it is repeated.
2. Positions of the fingerprints that occur again are joined back and extended both ways to the runs of ``window`` units around them.
3. Each such run is compared with its first occurrence; runs that are not the first are deleted, and overlapping runs merge into the whole repeated passage.

Edge cases: a null or empty text has no units and comes back as it is; lines without a word stay; a row that repeats id and text of another
counts as later than it; null ids are before all others; a text of fewer units than the window never loses a line. Lines are equal if they are equal as strings
(compared by 96 bits of hash per run). Only the columns named in the result are returned, besides the columns of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import let
from chatloom.llm.frames import cut, keeps_underscored, n_words, text_of

WINDOW = 3
UNIT_WORDS = 20


def unit_arrays(text: Column, window: int, unit_words: int) -> Column:
    """Units of a text in order: array of struct(u: hash of line and part, v: second hash, l: number of the line)."""
    no_units = F.expr("array_repeat(struct(0L as u, 0 as v, 0 as l), 0)")

    def parts(line, number):
        unit = lambda k: F.struct(F.xxhash64(line, k).alias("u"), F.hash(line, k).alias("v"), number.cast("int").alias("l"))
        count = lambda words: F.least(F.lit(window), 1 + F.floor(words / unit_words).cast("int"))
        return let(n_words(line), lambda words: F.when(words > 0, F.transform(F.sequence(F.lit(1), count(words)), unit)).otherwise(no_units))

    return F.flatten(F.transform(F.split(text, "\n", -1), parts))


def selected(units: Column, window: int) -> Column:
    """Winnowing: positions of the smallest hash, the last of equal ones, in each window of units."""
    least = lambda i: -F.array_min(
        F.transform(F.sequence(i, i + window - 1), lambda j: F.struct(F.get(units, j)["u"].alias("u"), (-j).alias("j")))
    )["j"]
    return F.when(
        F.size(units) >= window, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(units) - window), least))
    ).otherwise(F.expr("array_repeat(0, 0)"))


def repeated_lines(docs: DataFrame, text: str, key: str, window: int, unit_words: int) -> DataFrame:
    """Numbers of the lines to delete: (_id, _null, _text, _del array<int>), one row per distinct (id, text) that loses any."""
    base = docs.select(
        F.coalesce(F.col(key), F.lit(-(2**63))).alias("_id"), F.col(key).isNull().alias("_null"), F.xxhash64(text_of(text)).alias("_text"),
        unit_arrays(text_of(text), window, unit_words).alias("units"),
    )
    base = cut(base.filter(F.size("units") >= window))
    rows = base.withColumn("at", F.explode(selected(F.col("units"), window)))
    prints = rows.select("_id", "_null", "_text", "at", "units", F.get("units", F.col("at"))["u"].alias("print"))
    narrow = prints.drop("units")
    again = narrow.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print")
    hits = narrow.join(again, "print", "left_semi")
    # extend both ways: the starts of all runs that hold a repeated fingerprint; a document's positions come together by document
    starts = hits.groupBy("_id", "_null", "_text").agg(F.collect_set("at").alias("hits"))
    near = base.join(starts, ["_id", "_null", "_text"]).select(
        "_id", "_null", "_text", "units",
        F.array_distinct(F.flatten(F.transform("hits", lambda p: F.sequence(
            F.greatest(p - window + 1, F.lit(0)), F.least(p, F.size("units") - window))))).alias("starts"),
    )
    unit = lambda i, k: F.get(F.col("units"), i + k)
    run = lambda i: F.struct(
        F.xxhash64(*[unit(i, k)["u"] for k in range(window)]).alias("run"), F.hash(*[unit(i, k)["v"] for k in range(window)]).alias("run2"),
        i.alias("at"), F.array(*[unit(i, k)["l"] for k in range(window)]).alias("lines"),
    )
    runs = cut(near.select("_id", "_null", "_text", F.inline(F.transform("starts", run))))
    place = F.struct(~F.col("_null"), F.col("_id"), F.col("_text"), F.col("at"))
    first = runs.groupBy("run", "run2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = runs.join(first, ["run", "run2"]).filter(place != F.col("first"))
    return later.select("_id", "_null", "_text", F.explode("lines").alias("line")).groupBy("_id", "_null", "_text").agg(
        F.collect_set("line").alias("_del")
    )


@keeps_underscored
def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, unit_words: int = UNIT_WORDS) -> DataFrame:
    """``docs`` with the repeated lines deleted from ``text``, and ``n_lines`` and ``n_removed``.

    ``docs`` is read twice; its rows are shuffled once, by (id, hash of the text).
    """
    dropped = repeated_lines(docs, text, key, window, unit_words)
    body = text_of(text)
    rows = docs.drop("n_lines", "n_removed").withColumns(
        {"_id": F.coalesce(F.col(key), F.lit(-(2**63))), "_null": F.col(key).isNull(), "_text": F.xxhash64(body)}
    )
    joined = rows.join(dropped, ["_id", "_null", "_text"], "left")
    # a row that repeats another's id and text is later than it as a whole
    copy = F.row_number().over(Window.partitionBy("_id", "_null", "_text").orderBy("_text"))
    joined = joined.withColumn("_copy", copy)
    lines = F.split(body, "\n", -1)
    units = unit_arrays(body, window, unit_words)
    gone = F.when(F.col("_copy") > 1, let(units, lambda x: F.when(F.size(x) >= window, F.array_distinct(F.transform(x, lambda u: u["l"]))))).otherwise(F.col("_del"))
    gone = F.coalesce(gone, F.expr("array_repeat(0, 0)"))
    joined = joined.withColumn("_gone", gone).withColumn("_lines", lines)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")), lambda i: F.get(F.col("_lines"), i))
    out = joined.withColumns({
        "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size("_lines")).cast("long"), "n_removed": F.size("_gone").cast("long"),
        text: F.when(F.size("_gone") > 0, F.array_join(kept, "\n")).otherwise(F.col(text)),
    })
    return out.drop("_id", "_null", "_text", "_copy", "_del", "_gone", "_lines")
