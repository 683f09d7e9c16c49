"""Quality of translated corpora and the work list of a translation run."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import col, find_all, is_blank, strip

NUMBER = r"(?U)\b\d+(?:\.\d+)?\b"
URL = r"https?://\S+"
# What must survive a translation unchanged, in this order.
PRESERVED = [r"```[\s\S]*?```", r"`[^`]+`", r"https?://\S+", r"\S+@\S+\.\S+"]


def length_ratio(original, translated) -> Column:
    o, t = col(original), col(translated)
    blank = o.isNull() | t.isNull() | (o == "") | (t == "")
    return F.when(blank, 0.0).otherwise(F.length(t) / F.length(o))


def length_valid(original, translated, low: float = 0.3, high: float = 4.0) -> Column:
    return length_ratio(original, translated).between(low, high)


def numbers_kept(original, translated) -> Column:
    return F.size(F.array_except(find_all(original, NUMBER), find_all(translated, NUMBER))) == 0


def urls_kept(original, translated) -> Column:
    a, b = find_all(original, URL), find_all(translated, URL)
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def validate(pairs: DataFrame, dataset: str, role: str, original: str, translated: str, detected: str, target: str) -> DataFrame:
    """Counts and verdict per dataset. System turns are skipped, empty translations counted and left out.

    A dataset passes with language accuracy above 0.8 (none detected counts as right) and valid lengths above 0.9.
    """
    empty = is_blank(translated)
    full = ~empty
    lang = F.col(detected)
    ok = length_valid(original, translated)
    count = lambda c: F.count_if(full & c)
    out = pairs.filter(F.col(role) != "system").groupBy(dataset).agg(
        F.count_if(empty).alias("empty"), count(ok).alias("length_valid"), count(~ok).alias("length_invalid"),
        F.avg(F.when(full, length_ratio(original, translated))).alias("ratio_mean"),
        F.min(F.when(full, length_ratio(original, translated))).alias("ratio_min"),
        F.max(F.when(full, length_ratio(original, translated))).alias("ratio_max"),
        count(lang.isNull()).alias("language_unknown"), count(lang == target).alias("language_right"), count(lang != target).alias("language_wrong"),
        count(F.lit(True)).alias("checked"), count(numbers_kept(original, translated)).alias("numbers_kept"),
        count(urls_kept(original, translated)).alias("urls_kept"),
    )
    accuracy = F.coalesce(F.try_divide("language_right", F.col("language_right") + F.col("language_wrong")), F.lit(1.0))
    lengths = F.coalesce(F.try_divide("length_valid", F.col("length_valid") + F.col("length_invalid")), F.lit(1.0))
    return out.withColumn("passed", (accuracy > 0.8) & (lengths > 0.9))


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.count(F.lit(1)).alias("datasets"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def protect(text) -> Column:
    """Struct (text, kept): code, links and addresses replaced by numbered marks, with what they stand for. One walk over the text per pattern."""
    patterns = list(PRESERVED)

    def mark_all(texts: pd.Series) -> pd.DataFrame:
        out, kept = [], []
        for text in texts:
            pairs, done = [], text
            if text is not None:
                for i, pattern in enumerate(patterns):
                    parts, end = [], 0
                    for j, found in enumerate(re.finditer(pattern, done)):
                        mark = f"__PRESERVE_{i}_{j}__"
                        parts += [done[end : found.start()], mark]
                        end = found.end()
                        pairs.append({"mark": mark, "original": found[0]})
                    done = "".join(parts) + done[end:]
            out.append(done)
            kept.append(pairs)
        return pd.DataFrame({"text": out, "kept": kept})

    return F.pandas_udf(mark_all, "text string, kept array<struct<mark:string,original:string>>")(text)


def restore(text, kept) -> Column:
    """The text with its marks replaced, the last ones first, because they may stand for text with earlier marks. One walk over the text:
    a text without marks that are left goes through unchanged."""

    def restored(texts: pd.Series, kept: pd.Series) -> pd.Series:
        out = []
        for text, pairs in zip(texts, kept):
            if text is not None and pairs is not None and len(pairs):
                whole = {p["mark"]: p["original"] for p in pairs}
                mark = re.compile("__PRESERVE_[0-9]+_[0-9]+__")
                for m in whole:  # originals of earlier patterns are whole before they are put into later ones
                    whole[m] = mark.sub(lambda x: whole.get(x[0], x[0]), whole[m])
                text = mark.sub(lambda x: whole.get(x[0], x[0]), text)
            out.append(text)
        return pd.Series(out, dtype="object")

    return F.pandas_udf(restored, "string")(text, kept)


def work_list(
    turns: DataFrame, keys: list[str], role: str, text: str, detected: str, target: str, known: list[str], default: str = "en", min_chars: int = 20
) -> DataFrame:
    """Every turn with source language, reason (empty, short, unmapped, detected) and status (system, empty, same, todo).

    Empty and short texts and languages outside ``known`` count as the default language.
    """
    t, lang = F.col(text), F.col(detected)
    reason = (
        F.when(is_blank(t), "empty").when(F.length(strip(t)) < min_chars, "short")
        .when(lang.isNull() | ~lang.isin(known), "unmapped").otherwise("detected")
    )
    source = F.when(reason == "detected", lang).otherwise(default)
    status = (
        F.when(F.col(role) == "system", "system").when(reason == "empty", "empty").when(source == target, "same").otherwise("todo")
    )
    return turns.select(*keys, role, text, source.alias("source"), reason.alias("reason"), status.alias("status"))


def apply_translations(work: DataFrame, translations: DataFrame, text: str) -> DataFrame:
    """Translations looked up by text hash; turns without one keep their text. One row per hash on the right side."""
    found = translations.select("hash", "translated").groupBy("hash").agg(F.min("translated").alias("translated"))
    todo = work.withColumn("hash", F.when(F.col("status") == "todo", F.sha2(F.col(text), 256)))
    joined = todo.join(found, "hash", "left")
    return joined.withColumn("result", F.coalesce("translated", F.col(text))).withColumn(
        "status", F.when((F.col("status") == "todo") & F.col("translated").isNull(), "failed").otherwise(F.col("status"))
    ).drop("hash", "translated")


def reassemble(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Translated turns back to ordered chat rows."""
    rows = F.sort_array(F.collect_list(F.struct(turn, role, text)))
    return turns.groupBy(key).agg(rows.alias("t")).select(
        key, F.transform("t", lambda x: F.struct(x[role].alias("role"), x[text].alias("content"))).alias("messages")
    )


def translation_report(work: DataFrame) -> DataFrame:
    """Turns per source language, with the empty, short and skipped ones; system turns are counted on their own."""
    label = F.when(F.col("status") == "system", "system").otherwise(F.col("source"))
    return work.groupBy(label.alias("source")).agg(
        F.count(F.lit(1)).alias("turns"), F.count_if((F.col("reason") == "empty") & (F.col("status") != "system")).alias("empty"),
        F.count_if((F.col("reason") == "short") & (F.col("status") != "system")).alias("short"), F.count_if(F.col("status") == "same").alias("skipped"),
    )
