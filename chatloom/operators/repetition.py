"""Repeated paragraphs, sentences and word n-grams inside one text.

Only texts that can reach a threshold at all are exploded: the check compares the number of blocks with the
number of distinct blocks inside the row, so nearly all of a corpus never enters the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import any_of, col, let, quote_regex, split_words, strip

# Phrases that make a sentence count as short, wherever they occur in it.
SHORT_PHRASES = [
    "not sure", "wait no", "i think", "maybe", "probably", "yes", "no",
    "ok", "okay", "right", "wrong", "correct", "incorrect", "true", "false",
    "good", "bad", "nice", "great", "awesome", "terrible", "wow", "oh",
    "hmm", "um", "uh", "well", "so", "now", "then", "here", "there",
    "this", "that", "these", "those", "it", "is", "are", "was", "were",
    "have", "has", "had", "do", "does", "did", "will", "would", "could",
    "should", "can", "cannot", "cant", "dont", "doesnt", "isnt", "arent",
    "second < b", "we can use:", "we can use", "first < a", "third < c", "fourth < d",
    "a < b", "b < c", "c < d", "d < e", "e < f", "f < g", "g < h",
    "x < y", "y < z", "i < j", "j < k", "k < l", "l < m", "m < n",
    "n < o", "o < p", "p < q", "q < r", "r < s", "s < t", "t < u",
    "u < v", "v < w", "w < x",
    "return none", "return true", "return false", "return 0", "return 1",
    "return -1", "return null", "return undefined",
]
# Words that turn a bare comparison into code.
CODE_WORDS = ["import", "from", "return", "def", "class", "if", "for", "while"]
# Blocks that are never counted.
TRANSITIONS = ["alternatively,", "therefore,", "however,"]
CODE_STARTS = [
    r"^import\s+", r"^from\s+\w+\s+import", r"^return\s+", r"^\w+\s*\+\s*=\s*\d+", r"^\w+\s*-\s*=\s*\d+",
    r"^\w+\s*\*\s*=\s*\d+", r"^\w+\s*/\s*=\s*\d+", r"^for\s+", r"^while\s+", r"^if\s+", r"^def\s+", r"^class\s+",
    r"^\w+\.\w+\(", r"^\w+\s*=\s*\w+\(",
]
MATH_PATTERNS = [
    r"math\.\w+\([^)]*\)", r"\w+\*\*[0-9]+", r"[0-9]+\s*[+\-*/]\s*[0-9]+", r"[a-zA-Z_]\w*\s*[+\-*/]\s*[a-zA-Z_]\w*",
    r"def\s+\w+\([^)]*\):", r"lambda\s+[^:]+:", r"\[[^\]]*for[^\]]*\]", r"\{[^}]*for[^}]*\}", r"\([^)]*for[^)]*\)",
]
MATH_SYMBOLS = r"[=+\-*/^()\[\]{}<>|&~!@#$%\\]"
PARAGRAPH, LINE = 0, 1


def paragraphs(text) -> Column:
    return F.filter(F.transform(F.split(col(text), "\n\n"), lambda p: strip(p)), lambda p: p != "")


def sentences(text) -> Column:
    return F.filter(F.transform(F.split(col(text), "[.!?]+"), lambda p: strip(p)), lambda p: p != "")


def is_structured_list(text) -> Column:
    def count(lines, pattern):
        return F.size(F.filter(lines, lambda x: strip(x).rlike(pattern)))

    return let(
        F.split(col(text), "\n"),
        lambda ls: (F.size(ls) >= 2) & ((count(ls, r"(?U)^\d+\.\s") >= 2) | (count(ls, r"(?U)^[\-*•]\s") >= 2)),
    )


def is_code_fragment(block: Column) -> Column:
    open_end = block.rlike(r"[(\[{][^)\]}]*$") | block.rlike(r"^[^(\[{]*[)\]}]")
    matched = block.rlike(r"[(\[{][^(\[{)\]}]*[)\]}]")
    return (open_end & ~matched) | any_of(block.rlike("(?iU)" + p) for p in CODE_STARTS)


def is_math_expression(block: Column) -> Column:
    return any_of(block.rlike("(?U)" + p) for p in MATH_PATTERNS)


def is_short_phrase(block: Column) -> Column:
    low = F.lower(block)
    bare = block.rlike(r"(?U)^\w+\s*[<>]\s*\w+$") & ~low.rlike("|".join(CODE_WORDS))
    return low.rlike("|".join(quote_regex(p) for p in SHORT_PHRASES)) | bare


def longest_run(positions: Column) -> Column:
    """Length of the longest stretch of consecutive numbers in a sorted array."""
    zero = F.struct(F.lit(-2).alias("prev"), F.lit(0).alias("cur"), F.lit(0).alias("best"))

    def step(acc, p):
        cur = F.when(p == acc["prev"] + 1, acc["cur"] + 1).otherwise(F.lit(1))
        return F.struct(p.alias("prev"), cur.alias("cur"), F.greatest(acc["best"], cur).alias("best"))

    return F.aggregate(positions, zero, step, lambda acc: acc["best"])


def _repeats(blocks: Column, at_least: int) -> Column:
    """Whether some block can occur ``at_least`` times."""
    return let(blocks, lambda b: F.size(b) - F.size(F.array_distinct(b)) + 1 >= at_least)


def _placed(blocks: Column, kind: int, min_len: int) -> Column:
    placed = F.transform(blocks, lambda b, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), b.alias("block")))
    return F.filter(placed, lambda x: F.length(x["block"]) >= min_len)


def repeated_blocks(df: DataFrame, key: str, text: str, at_least: tuple[int, int] = (2, 2), min_len: tuple[int, int] = (10, 5)) -> DataFrame:
    """(key, kind, block, structured, total, first, longest, positions) of blocks that occur at least twice."""
    # blocks are cut once, into columns of their own; what follows works on the arrays
    t = df.select(
        F.col(key), paragraphs(text).alias("_p"), sentences(text).alias("_s"), is_structured_list(text).alias("structured")
    )
    rows = t.filter(_repeats(F.col("_p"), at_least[0]) | _repeats(F.col("_s"), at_least[1])).select(
        key, "structured",
        F.explode(F.concat(_placed(F.col("_p"), PARAGRAPH, min_len[0]), _placed(F.col("_s"), LINE, min_len[1]))).alias("b"),
    )
    return (
        rows.groupBy(key, F.col("b.kind").alias("kind"), F.col("b.block").alias("block"))
        .agg(
            F.bool_or("structured").alias("structured"),
            F.count(F.lit(1)).alias("total"),
            F.sort_array(F.collect_list("b.pos")).alias("positions"),
        )
        .filter(F.col("total") > 1)
        .withColumn("first", F.col("positions")[0])
        .withColumn("longest", longest_run(F.col("positions")))
    )


def block_verdict(min_paragraph: int, min_line: int, min_run: int) -> Column:
    """The reason a repeated block condemns its text, or null."""
    block, total, run = F.col("block"), F.col("total"), F.col("longest")
    skip = is_code_fragment(block) | is_math_expression(block) | F.lower(block).isin(TRANSITIONS)
    structured = F.when(F.col("structured"), 3).otherwise(1)
    math = F.when(block.rlike(MATH_SYMBOLS), 2).otherwise(1)
    multi = F.when(block.contains("\n"), 4).otherwise(1)
    times = total.cast("string")

    need = F.lit(min_paragraph) * F.greatest(structured, multi, math)
    need = F.when(run == 1, F.least(need * 2, F.lit(30))).otherwise(need)
    paragraph = F.when(
        ~((run == 1) & (F.length(block) < 20)) & ~skip & (total >= need),
        F.concat(F.lit("paragraph_repeated_"), times, F.lit("x")),
    )
    factor = F.greatest(math, structured)
    line = (
        F.when(F.size(split_words(block)) <= 1, F.lit(None).cast("string"))
        .when(
            is_short_phrase(block),
            F.when(run >= min_run * 2, F.concat(F.lit("line_repeated_"), times, F.lit("x_consecutive_short_phrase"))),
        )
        .when(skip, F.lit(None).cast("string"))
        .when(run >= min_run * factor, F.concat(F.lit("line_repeated_"), times, F.lit("x_consecutive")))
        .when((total >= min_line * factor) & (F.length(block) >= 10), F.concat(F.lit("line_repeated_"), times, F.lit("x")))
    )
    return F.when(F.col("kind") == PARAGRAPH, paragraph).otherwise(line)


def repetition_reasons(df: DataFrame, key: str, text: str, min_paragraph: int = 10, min_line: int = 40, min_run: int = 4) -> DataFrame:
    """(key, reason, total, longest, block) of the texts to drop; the first condemned block gives the reason."""
    lowest = (min(min_paragraph, 30), min(min_line, min_run))
    blocks = repeated_blocks(df, key, text, lowest).withColumn("reason", block_verdict(min_paragraph, min_line, min_run))
    return (
        blocks.filter(F.col("reason").isNotNull())
        .groupBy(key)
        .agg(F.min_by(F.struct("reason", "total", "longest", "block"), F.struct("kind", "first")).alias("v"))
        .select(key, "v.*")
    )


def drop_repetitive(df: DataFrame, key: str, text: str, **thresholds) -> DataFrame:
    return df.join(repetition_reasons(df, key, text, **thresholds).select(key), key, "left_anti")


def consecutive_runs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, block, total, run, start, type): the first run of neighbours of each block that has one."""
    blocks = repeated_blocks(df, key, text, min_len=(20, 10))
    islands = F.transform("positions", lambda p, i: p - i)

    def first_island(d: Column) -> Column:
        # equal neighbours of (position - index) belong to one run
        return F.element_at(F.filter(d, lambda x, i: F.get(d, i + 1) == x), 1)

    run = let(islands, lambda d: let(first_island(d), lambda f: F.size(F.filter(d, lambda x: x == f))))
    start = let(
        islands, lambda d: let(first_island(d), lambda f: F.element_at(F.col("positions"), F.array_position(d, f).cast("int")))
    )
    label = F.when(F.col("kind") == PARAGRAPH, "paragraph").otherwise("line")
    return (
        blocks.filter(F.col("longest") > 1)
        .withColumn("run", run)
        .withColumn("start", start)
        .withColumn(
            "type",
            F.when(F.col("run") >= F.col("total"), F.concat(F.lit("total_"), label, F.lit("_repeated_"), F.col("total"), F.lit("x")))
            .otherwise(F.concat(F.lit("consecutive_"), label, F.lit("_repeated_"), F.col("run"), F.lit("x"))),
        )
        .select(key, "kind", "block", "total", "run", "start", "type")
    )


def ngram_repetitions(df: DataFrame, key: str, text: str, n: int = 3, at_least: int = 2) -> DataFrame:
    """(key, ngram, positions) of the word n-grams that occur at least ``at_least`` times in a text."""

    def grams(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (n - 1))
        return F.when(F.size(w) >= n, F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))).otherwise(
            F.array().cast("array<string>")
        )

    def islands(s: Column) -> Column:
        # sorted grams: each begins an island where it differs from the one before
        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["ngram"] != F.get(s, i - 1)["ngram"]))

        def island(f: Column) -> Column:
            def one(a: Column, k: Column) -> Column:
                n = F.coalesce(F.get(f, k + 1), F.size(s)) - a
                return F.struct(F.get(s, a)["ngram"].alias("ngram"), F.transform(F.slice(s, a + 1, n), lambda x: x["pos"]).alias("positions"))

            return F.filter(F.transform(f, one), lambda g: F.size(g["positions"]) >= at_least)

        return let(firsts, island)

    rows = df.select(key, let(split_words(F.lower(col(text))), grams).alias("grams")).filter(
        F.size("grams") - F.size(F.array_distinct("grams")) + 1 >= at_least
    )
    placed = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("ngram"), i.alias("pos"))))
    # all inside the row: nothing is shuffled
    return rows.filter(F.size("grams") > 0).select(key, F.inline(let(placed, islands)))
