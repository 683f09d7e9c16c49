"""Mixtures by language and source quotas, up-sampling mixers, random model choices."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.text import hash_key
from chatloom.operators import sampling as S
from chatloom.session import broadcast_if_small, cut_lineage

# The official languages of the European Union besides English.
EU_LANGUAGES = [
    "bg", "cs", "da", "de", "el", "es", "et", "fi", "fr", "ga", "hr", "hu", "it", "lt", "lv", "mt", "nl", "pl",
    "pt", "ro", "sk", "sl", "sv",
]


@dataclass
class LanguageMix:
    """Ratios of a mixture; checked on construction."""

    english_ratio: float
    explicit: dict[str, float] = field(default_factory=dict)
    others_ratio: float = 0.0
    eu_only: bool = True

    def __post_init__(self):
        ratios = {"en": self.english_ratio, "others": self.others_ratio, **self.explicit}
        negative = [k for k, r in ratios.items() if r < 0]
        if negative:
            raise ValueError(f"negative ratio for {negative}")
        if "en" in self.explicit:
            raise ValueError("English has its own ratio and cannot be an explicit language")
        unknown = [k for k in self.explicit if self.eu_only and k not in EU_LANGUAGES]
        if unknown:
            raise ValueError(f"not official EU languages: {unknown}")
        total = self.english_ratio + sum(self.explicit.values()) + self.others_ratio
        if abs(total - 1.0) > 1e-6:
            raise ValueError(f"ratios sum to {total:.6f}, not to 1")

    def quotas(self, total: int) -> dict[str, int]:
        """Rows per language; truncated, so the sum may stay below ``total``."""
        out = {"en": int(total * self.english_ratio)}
        out.update({lang: int(total * r) for lang, r in self.explicit.items()})
        others = [x for x in EU_LANGUAGES if x not in self.explicit]
        if self.others_ratio > 0 and others:
            out.update(dict.fromkeys(others, int(total * self.others_ratio / len(others))))
        return out


def quota_table(spark: SparkSession, quotas: dict[str, int], name: str = "language") -> DataFrame:
    return spark.createDataFrame(list(quotas.items()), f"{name} string, quota long")


def fill_quotas(df: DataFrame, quotas: DataFrame, language: str, source: str, priority: list[str]) -> DataFrame:
    """(language, source, available, quota): sources are used up in order until the language quota is met."""
    rank = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col(source))
    available = (
        df.groupBy(F.col(language).alias("language"), F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("available"), F.max(rank).alias("rank"))
        .filter("rank > 0")
    )
    before = Window.partitionBy("language").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    # this window runs over one row per source, not over the data
    used = F.coalesce(F.sum("available").over(before), F.lit(0))
    placed = available.withColumn("used", used).join(broadcast_if_small(quotas.withColumnRenamed("quota", "need")), "language")
    left = F.greatest(F.col("need") - F.col("used"), F.lit(0))
    return placed.select("language", "source", "available", F.least("available", left).alias("quota"))


def priority_fill(df: DataFrame, quotas: DataFrame, key: str, language: str, source: str, priority: list[str], seed: int = 42) -> DataFrame:
    cells = cut_lineage(fill_quotas(df, quotas, language, source, priority)).select(
        F.col("language").alias(language), F.col("source").alias(source), "quota"
    )
    return S.take(df, [language, source], cells, key, seed)


def shortfall(taken: DataFrame, quotas: DataFrame, language: str) -> DataFrame:
    """(language, quota, actual, pct) with the filled percentage of every language."""
    have = taken.groupBy(F.col(language).alias("language")).agg(F.count(F.lit(1)).alias("actual"))
    return quotas.filter("quota > 0").join(have, "language", "left").select(
        "language", "quota", F.coalesce("actual", F.lit(0)).alias("actual"),
        F.round(100.0 * F.coalesce("actual", F.lit(0)) / F.col("quota"), 2).alias("pct"),
    )


def cap_per_language(df: DataFrame, quotas: DataFrame, key: str, language: str, seed: int = 42, factor: float = 1.0) -> DataFrame:
    """At most the quota (times a test factor) of each language."""
    scaled = quotas.select(F.col("language").alias(language), F.floor(F.col("quota") * F.lit(factor)).cast("long").alias("quota"))
    return S.take(df, [language], scaled, key, seed)


def target_rows(amount: str, available: int) -> int:
    """"0.5" is a fraction of the rows, "500" a count."""
    return int(float(amount) * available) if "." in amount else int(amount)


def resize(df: DataFrame, target: int, key: str, seed: int = 42, total: int | None = None) -> DataFrame:
    """Exactly ``target`` rows: whole copies of the table plus a sample without replacement."""
    total = df.count() if total is None else total
    if total == 0:
        return df
    copies, extra = divmod(target, total)
    times = F.lit(copies)
    if extra:
        times = times + (hash_key(key, seed) <= S.cut_hash(df, extra, key, seed)).cast("int")
    numbered = df.withColumn("_times", times).filter("_times > 0")
    return numbered.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))).drop("_times")


def tag_source(df: DataFrame, name: str, column: str = "dataset_source") -> DataFrame:
    return df.withColumn(column, F.lit(name))


def mix(datasets: list[tuple[str, DataFrame, str]], key: str, seed: int = 42) -> DataFrame:
    """Resize each (name, table, amount), tag it with its name and put all together."""
    out = None
    for name, df, amount in datasets:
        total = df.count()
        part = tag_source(resize(df, target_rows(amount, total), key, seed, total), name)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def prefix_mix(datasets: dict[str, tuple[DataFrame, float]], key: str, columns: list[str], seed: int = 42) -> DataFrame:
    """Older mixer: all fractions or all counts; a shuffled prefix of each table, missing columns null, new ids."""
    values = [v for _, v in datasets.values()]
    if any(v < 0 for v in values):
        raise ValueError("fractions and counts must not be negative")
    if any(v <= 1 for v in values) and any(v > 1 for v in values):
        raise ValueError("either all fractions or all counts")
    out = None
    for name, (df, value) in datasets.items():
        n = int(value * df.count()) if value <= 1 else int(value)
        part = S.take_n(df, n, key, seed)
        full = part.select(
            F.concat(F.lit(f"{name}_"), F.col(key).cast("string")).alias("id"),
            *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns],
        )
        out = full if out is None else out.unionByName(full)
    return out


def resample_subsets(df: DataFrame, proportions: dict[str, float], total: int, key: str, subset: str, seed: int = 42) -> DataFrame:
    quotas = quota_table(df.sparkSession, {k: int(v * total) for k, v in proportions.items()}, subset)
    return S.take(df, [subset], quotas, key, seed)


def cap_subsets(df: DataFrame, caps: dict[str, int], key: str, subset: str, seed: int = 42) -> DataFrame:
    """Subsets above their cap are sampled down, the others stay whole."""
    capped = S.take(df.filter(F.col(subset).isin(list(caps))), [subset], quota_table(df.sparkSession, caps, subset), key, seed)
    return capped.unionByName(df.filter(~F.col(subset).isin(list(caps)) | F.col(subset).isNull()))


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def random_length(key, low: int, high: int, seed: int = 42):
    """A stable integer in [low, high) per row."""
    return F.lit(low) + S.bucket(key, high - low, seed)


def sample_models(rows: DataFrame, prompt: str, model: str, completion: str, k: int = 4, seed: int = 42) -> DataFrame:
    """k models per prompt in hash order, with their completions. A group holds one row per model."""
    drawn = rows.withColumn("_h", hash_key(F.concat_ws(":", prompt, model), seed))
    picked = S.first_k(drawn, [prompt], ["_h"], k)
    return picked.groupBy(prompt).agg(F.sort_array(F.collect_list(F.struct("_h", model, completion))).alias("s")).select(
        prompt, F.transform("s", lambda x: x[model]).alias("models"), F.transform("s", lambda x: x[completion]).alias("completions")
    )


def against_one(rows: DataFrame, prompt: str, model: str, completion: str, fixed: str, seed: int = 42) -> DataFrame:
    """The fixed model against one random other per prompt, sides by hash parity."""
    mine = rows.filter(F.col(model) == fixed).select(prompt, F.col(completion).alias("mine"))
    h = hash_key(F.concat_ws(":", prompt, model), seed)
    other = rows.filter(F.col(model) != fixed).groupBy(prompt).agg(F.min_by(F.struct(model, completion), h).alias("o"))
    swap = S.bucket(prompt, 2, seed) == 1
    m, o = F.lit(fixed), F.col("o")[model]
    return mine.join(other, prompt).select(
        prompt,
        F.when(swap, F.array(o, m)).otherwise(F.array(m, o)).alias("models"),
        F.when(swap, F.array(F.col("o")[completion], F.col("mine"))).otherwise(F.array(F.col("mine"), F.col("o")[completion])).alias("completions"),
    )


def stratified_pick(df: DataFrame, key: str, language: str, categories: str, labels: list[str], per_label: int = 50, at_least: int = 100, seed: int = 42) -> DataFrame:
    """Greedy multi-label pick per language.

    Labels are served in order; each takes unpicked rows in hash order until ``per_label`` rows carry it, co-labels
    counted. What the loop can reach is bounded, so the candidates are cut natively before any group is formed:
    the first ``per_label * len(labels)`` rows of each label and the first ``2 * at_least`` rows of each language.
    """
    h = hash_key(key, seed)
    base = df.select(F.col(key).alias("key"), F.col(language).alias("lang"), F.col(categories).alias("cats"), h.alias("h"))
    labelled = base.withColumn("label", F.explode("cats")).filter(F.col("label").isin(labels))
    by_label = S.first_by_hash(labelled, ["lang", "label"], "h", per_label * len(labels), "key", seed).drop("label")
    candidates = by_label.unionByName(S.first_by_hash(base, ["lang"], "h", 2 * at_least, "key", seed)).dropDuplicates(["lang", "key"])

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pool = pdf.sort_values("h").reset_index(drop=True)
        counts, picked = dict.fromkeys(labels, 0), set()
        for label in labels:
            for i, cats in enumerate(pool["cats"]):
                if counts[label] >= per_label:
                    break
                if i not in picked and label in cats:
                    picked.add(i)
                    for c in cats:
                        counts[c] = counts.get(c, 0) + 1
        for i in range(len(pool)):
            if len(picked) >= at_least:
                break
            picked.add(i)
        return pool.iloc[sorted(picked)][["key", "lang"]]

    key_type = df.schema[key].dataType.simpleString()
    return candidates.groupBy("lang").applyInPandas(pick, f"key {key_type}, lang string").select(
        F.col("key").alias(key), F.col("lang").alias(language)
    )
