"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of each text are native columns. From labelled statistics, cut at quantiles, one aggregate makes a table of counts
(cells by bin, label and half); its size is bounded by the number of cuts, not by the corpus. Sequential covering over that table grows one conjunction of
thresholds after the other on the growing part (by information gain), prunes each on the pruning part, keeps it if it is precise
enough there, and takes the rows that it covers out. The ordered list becomes one Spark conditional expression.

Edge cases: a null or empty text has no words and fails the base rules; labels that are null, or of documents that do not exist, teach
nothing; with no labels, or labels of one kind only, the list is empty and everything that passes the base rules stays; repeated rows are judged each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import let
from chatloom.llm.frames import SPACE, WORD, cut, text_of

SYMBOLS = "#*$%&|<>"
CUTS = 12  # thresholds per feature
MIN_PRECISION = 0.97  # of a rule, on the pruning part
MIN_COVER = 5  # rejected labelled rows that a rule must cover on the growing part
MAX_RULES, MAX_TERMS = 16, 3


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACE, " " * len(SPACE)), " +"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    The windows' 64-bit hashes are sorted with their places; equal neighbours are repeats. The places, sorted again, cover three words
    each, less where the next one begins earlier.
    """
    n = F.size(words)
    grams = lambda w: F.sort_array(F.transform(F.sequence(F.lit(0), n_of(w) - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))
    n_of = F.size
    repeats = lambda g: F.filter(g, lambda x, i: (F.get(g, i - 1)["h"] == x["h"]) | (F.get(g, i + 1)["h"] == x["h"]))
    safe = lambda g: repeats(g)
    places = lambda g: F.sort_array(F.transform(g, lambda x: x["p"]))
    covered = lambda p: F.when(F.size(p) > 0, F.aggregate(
        F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda a, b: a + b)).otherwise(0)
    return F.when(n >= 4, let(let(let(grams(words), safe), places), covered)).otherwise(0).cast("long")


def statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of a text column."""
    body = text_of(text)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    out = {
        "n_words": F.size(F.col("_words")), "word_chars": F.length(F.translate(body, SPACE, "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_lines": F.size(lines), "n_repeat_words": repeat_words(F.col("_words")),
    }
    return {k: v.cast("long") for k, v in out.items()}


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the statistics of every text."""
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_body"))
    rows = rows.withColumn("_words", words_of(text_of("_body")))
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *[v.alias(k) for k, v in statistics(F.col("_body")).items()])


def base_failed() -> Column:
    """At least 50 words, and not more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What the thresholds are on; each has an interpretable unit."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"), "mean_word_chars": F.col("word_chars") / words, "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"), "repeat_share": F.col("n_repeat_words") / words,
    }


def cells(labelled: DataFrame, label: str, key: str) -> tuple[list[str], list[list[float]], list[tuple]]:
    """Quantile cuts per feature, and counts by (bins, half, label): at most (CUTS + 2) ** 5 * 4 rows, whatever the corpus."""
    names = list(features())
    table = cut(labelled.select(
        *[c.alias(n) for n, c in features().items()], F.col(label).cast("int").alias("label"),
        (F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(3)) == 0).alias("prune"),
    ))
    shares = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    quantiles = lambda label: table.filter(F.col("label") == label).agg(
        *[F.percentile_approx(n, shares, 10_000).alias(n) for n in names], *[F.max(n).alias(f"max_{n}") for n in names]).first()
    # cuts from both labels: where one label ends, the other may begin
    found = [quantiles(0), quantiles(1)]
    cuts = [sorted({x for r in found for x in [*(r[n] or []), r[f"max_{n}"]] if x is not None}) for n in names]
    above = lambda n, c: F.size(F.filter(F.array(*[F.lit(x) for x in c]), lambda x: x < F.col(n)))
    binned = [above(n, c) if c else F.lit(0) for n, c in zip(names, cuts, strict=True)]
    rows = table.groupBy(*[b.alias(n) for n, b in zip(names, binned, strict=True)], "prune", "label").count().collect()
    return names, cuts, [(tuple(r[:len(names)]), r["prune"], r["label"], r["count"]) for r in rows]


def learn(names: list[str], cuts: list[list[float]], counts: list[tuple]) -> list[list[tuple[str, str, float]]]:
    """The ordered rules that reject; a term is (feature, "<=" or ">", threshold), and a bin b lies above the first b cuts."""
    covers = lambda rule, bins: all((bins[f] <= k) == (op == "<=") for f, op, k in rule)
    rules: list[list[tuple[int, str, int]]] = []
    left = [c for c in counts if c[2] in (0, 1)]

    def tally(rule, prune):
        bad = good = 0
        for bins, half, label, n in left:
            if half == prune and covers(rule, bins):
                bad, good = (bad + n, good) if label == 0 else (bad, good + n)
        return bad, good

    while len(rules) < MAX_RULES:
        rule: list[tuple[int, str, int]] = []
        bad, good = tally(rule, False)
        while good and bad and len(rule) < MAX_TERMS:
            inside = [c for c in left if not c[1] and covers(rule, c[0])]
            best = (0.0, None, 0, 0)
            for f in range(len(names)):
                by_bin: dict[int, list[int]] = {}
                for bins, _, label, n in inside:
                    by_bin.setdefault(bins[f], [0, 0])[label] += n
                low = [0, 0]
                for k in range(len(cuts[f])):
                    low = [a + b for a, b in zip(low, by_bin.get(k, (0, 0)), strict=True)]
                    for op, (b, g) in (("<=", low), (">", (bad - low[0], good - low[1]))):
                        gain = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good))) if b >= MIN_COVER else 0.0
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, op, k), b, g)
            if best[1] is None:
                break
            rule.append(best[1])
            bad, good = best[2], best[3]
        worth = lambda r: (lambda b, g: (b - g) / (b + g) if b + g else -1.0)(*tally(r, True))
        while len(rule) > 1 and (shorter := max((rule[:i] + rule[i + 1 :] for i in range(len(rule))), key=worth)) and worth(shorter) >= worth(rule):
            rule = shorter
        b, g = tally(rule, True) if rule else (0, 0)
        b2, g2 = tally(rule, False) if rule else (0, 0)
        if not rule or b == 0 or b < MIN_PRECISION * (b + g) or b2 < MIN_PRECISION * (b2 + g2):
            break
        rules.append(rule)
        left = [c for c in left if not covers(rule, c[0])]
    return [[(names[f], op, cuts[f][k]) for f, op, k in rule] for rule in rules]


def verdict(rules: list[list[tuple[str, str, float]]]) -> tuple[Column, Column]:
    """The decision list as conditional expressions: whether a row stays, and the number of the rule that rejects it (0: none)."""
    columns = features()
    keep, number = F.lit(True), F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        hit = F.lit(True)
        for name, op, x in rule:
            hit = hit & (columns[name] <= F.lit(x) if op == "<=" else columns[name] > F.lit(x))
        keep, number = F.when(hit, F.lit(False)).otherwise(keep), F.when(hit, F.lit(i)).otherwise(number)
    return keep, number


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(key, statistics, base_failed, rule, kept) of every row of ``docs``; ``labels`` is (key, label).

    The texts are read once; their statistics are a narrow table in the shared folder. Rules are learned from the rows that pass the base rules.
    """
    table = cut(measured(docs, text, (key,)))
    marks = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).filter("_label IS NOT NULL AND _key IS NOT NULL").distinct()
    known = table.filter(~base_failed()).join(marks, F.col(key) == F.col("_key"))
    rules = learn(*cells(known, "_label", key))
    keep, number = verdict(rules)
    return table.withColumns({"base_failed": base_failed()}).withColumns({
        "rule": F.when(F.col("base_failed"), F.lit(0)).otherwise(number), "kept": ~F.col("base_failed") & keep,
    })


__all__ = ["WORD", "judge", "learn", "measured", "verdict"]
