"""Row filters. Every predicate is a Column, so it can be pushed, combined and streamed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import last_assistant, last_message
from chatloom.functions.text import any_of, col, count_matches, find_all, is_blank, let, occurrences

# Vendor names that disqualify an assistant turn.
VENDOR_NAMES = [
    "OpenAI", "Open AI", "ChatGPT", "Chat GPT", "GPT-3", "GPT3", "GPT 3", "GPT-4", "GPT4", "GPT 4",
    "GPT-3.5", "GPT3.5", "GPT 3.5", "BingChat", "Bing Chat", "LAION", "Open Assistant", "OpenAssistant",
]
# The longer, older list, matched as plain substrings of any turn.
VENDOR_NAMES_LEGACY = [
    "OpenAI", "Open AI", "ChatGPT", "Chat GPT", "GPT-3", "GPT3", "GPT 3", "GPT-4", "GPT4", "GPT 4",
    "GPT-3.5", "GPT3.5", "GPT 3.5", "BingChat", "Bing Chat", "BARD", "Palm", "Anthropic", "Claude",
    "LAION", "Open Assistant", "OpenAssistant",
]
# Model providers whose self-descriptions are dropped.
PROVIDERS = [
    "OpenAI", "Open AI", "Claude", "Gemini", "Qwen", "DeepSeek", "Anthropic", "Meta AI", "Meta's", "ChatGPT",
    "Cohere", "Mistral AI", "Mistral's", "xAI", "Perplexity",
]
# Patterns of self-identification, {P} is any provider.
IDENTITY_PATTERNS = [
    r"\bI'?m\s+({P}),?\s+an?\s+AI\s+(?:assistant|model)[^.!?]{0,100}(?:made|developed|created|trained)\s+by\s+({P})\b[^.!?]{0,100}[.!?]",
    r"\b({P})\s+is\s+an?\s+AI\s+(?:assistant|model)[^.!?]{0,100}(?:developed|created|made|trained)\s+by\s+({P})\b[^.!?]{0,100}[.!?]",
    r"\bas\s+an?\s+(?:language\s+model|AI\s+model|assistant|chatbot|model)[^.!?]{0,100}\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bas\s+an\s+AI\s+(?:developed|created|made|trained)\s+by\s+({P})\b[^.!?]{0,100}[.!?]",
    r"\bI\s+am\s+(?:a\s+)?(?:language\s+model|AI\s+model|assistant|chatbot|model)[^.!?]{0,100}\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bI\s+am\s+called\s+\b({P})\b[^.!?]{0,100}[.!?]",
    r"\b(?:I'?m|I\s+am)\s+\b({P})\b[^.!?]{0,100}[.!?]",
    r"\btrained\s+by\s+[^.!?]{0,100}?\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bdeveloped\s+by\s+[^.!?]{0,100}?\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bcreated\s+by\s+[^.!?]{0,100}?\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bmade\s+by\s+[^.!?]{0,100}?\b({P})\b[^.!?]{0,100}[.!?]",
    r"\bagainst\s+({P})(?:'s|'s)?\s+(?:use-case\s+)?(?:policy|policies|guidelines|terms)[^.!?]{0,100}[.!?]",
    r"\b({P})(?:'s|'s)\s+(?:policy|policies|guidelines|terms|use-case)[^.!?]{0,100}[.!?]",
    r"[^.!?]{0,250}?\bDeepSeek\b[^.!?]{0,100}[.!?]",
    r"[^.!?]{0,250}?\bQwen\b[^.!?]{0,100}[.!?]",
    r"[^.!?]{0,250}?\bAlibaba\s+Qwen\b[^.!?]{0,100}[.!?]",
    r"[^.!?]{0,250}?\bAlibaba\s+Cloud\b[^.!?]{0,100}[.!?]",
]
# Fixed value: mentions of a knowledge cutoff with a year.
CUTOFF_PATTERN = (
    r"(?i)(?:as\s+(?:of\s+)?(?:my\s+)?(?:last|latest)\s+(?:update|knowledge)(?:\s+was)?\s+in"
    r"|knowledge\s+cutoff|last\s+updated?\s+in)\s+"
    r"(?:(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+)?(\d{4})"
)
# What a line of program code looks like, and the characters that fill one.
CODE_LINE_PATTERNS = [
    r"^\s*(import|from|def|class|function|const|let|var)\s+",
    r"^\s*#include\s*<",
    r"^\s*public\s+(class|static|void)",
]
CODE_CHARS = "{}[]();=<>"
CJK = "[一-鿿]"


# --- text predicates -------------------------------------------------------------------------

def vendor_pattern(names=VENDOR_NAMES) -> str:
    # names stay unquoted: the dot of a version number matches any character
    return r"\b(" + "|".join(n.lower() for n in names) + r")\b"


def mentions_vendor(text) -> Column:
    return F.lower(col(text)).rlike("(?U)" + vendor_pattern())


def mentions_vendor_legacy(text) -> Column:
    low = F.lower(col(text))
    return any_of(low.contains(n.lower()) for n in VENDOR_NAMES_LEGACY)


def identity_patterns() -> list[str]:
    return [p.replace("{P}", "|".join(PROVIDERS)) for p in IDENTITY_PATTERNS]


def identifies_itself(text) -> Column:
    """Self-identification; the costly patterns only run where a provider name occurs at all."""
    names = "(?i)" + "|".join(PROVIDERS + ["Alibaba"])
    return col(text).rlike(names) & any_of(col(text).rlike("(?iU)" + p) for p in identity_patterns())


def cutoff_mentions(text) -> Column:
    return find_all(text, CUTOFF_PATTERN)


def cjk_ratio(text) -> Column:
    t = col(text)
    return F.when(F.length(t) > 0, count_matches(t, CJK) / F.length(t)).otherwise(F.lit(0.0))


def is_chinese(text, threshold: float | None = None) -> Column:
    has = col(text).rlike(CJK)
    return has if threshold is None else has & (cjk_ratio(text) >= threshold)


def is_think(text) -> Column:
    return F.coalesce(col(text).rlike(r"(?s)\A<think>.*?</think>.*\z"), F.lit(False))


def is_think_answer(text) -> Column:
    return F.coalesce(col(text).rlike(r"(?s)\A<think>.*?</think><answer>.*?</answer>\z"), F.lit(False))


def is_code_heavy(text, threshold: float = 0.3) -> Column:
    """Share of code-like lines above the threshold; a dense pattern line counts twice, as specified."""

    def points(line: Column) -> Column:
        dense = sum((occurrences(line, ch) for ch in CODE_CHARS), F.lit(0)) / F.length(line) > 0.15
        return any_of(line.rlike(p) for p in CODE_LINE_PATTERNS).cast("int") + ((F.length(line) > 10) & dense).cast("int")

    return let(
        F.split(col(text), "\n"),
        lambda lines: F.aggregate(lines, F.lit(0), lambda acc, line: acc + points(line)) / F.size(lines) > threshold,
    )


# --- chat row predicates ---------------------------------------------------------------------

def any_message(messages, predicate) -> Column:
    return F.coalesce(F.exists(col(messages), lambda m: F.coalesce(predicate(m), F.lit(False))), F.lit(False))


def has_vendor_turn(messages) -> Column:
    return any_message(messages, lambda m: (m["role"] == "assistant") & mentions_vendor(m["content"]))


def has_vendor_text(messages) -> Column:
    return any_message(messages, lambda m: mentions_vendor_legacy(m["content"]))


def has_empty_turn(messages) -> Column:
    return any_message(messages, lambda m: is_blank(m["content"]))


def has_identity_turn(messages, user_turns: bool = False) -> Column:
    """A null content in a checked turn drops the row as well."""
    roles = ["assistant", "user"] if user_turns else ["assistant"]
    return any_message(
        messages, lambda m: m["role"].isin(roles) & (m["content"].isNull() | identifies_itself(m["content"]))
    )


def all_cutoff_mentions(messages) -> Column:
    return F.flatten(
        F.transform(col(messages), lambda m: F.coalesce(cutoff_mentions(m["content"]), F.array().cast("array<string>")))
    )


def ends_chinese(messages, threshold: float | None = 0.05, user_turns: bool = False) -> Column:
    if user_turns:
        tail = F.slice(col(messages), F.greatest(F.size(messages) - 1, F.lit(1)), F.lit(2))
        return any_message(tail, lambda m: m["role"].isin("assistant", "user") & is_chinese(m["content"], threshold))
    return F.coalesce(is_chinese(last_assistant(messages)["content"], threshold), F.lit(False))


def ends_with_format(messages, answer: bool) -> Column:
    content = last_message(messages)["content"]
    return is_think_answer(content) if answer else is_think(content)


# --- tables ----------------------------------------------------------------------------------

def flag_conversations(turns: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Any-turn flags per conversation from a turn table: partial aggregation, nothing is collected."""
    return turns.groupBy(key).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()])


def retention(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows, kept rows and kept percentage of each filter flag (missing counts as false), in one pass."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total")]
    for name, dropped in flags.items():
        kept = F.count_if(~F.coalesce(dropped, F.lit(False)))
        aggs += [kept.alias(f"{name}_kept"), F.round(100.0 * kept / total, 2).alias(f"{name}_pct")]
    return df.agg(*aggs)


def stage_retention(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Filters applied in sequence, reported from a single scan: rows left after each stage."""
    alive, aggs = F.lit(True), [F.count(F.lit(1)).alias("input")]
    for name, dropped in stages.items():
        alive = alive & ~F.coalesce(dropped, F.lit(False))
        aggs.append(F.count_if(alive).alias(f"after_{name}"))
    return df.agg(*aggs)


def apply_stages(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    for dropped in stages.values():
        df = df.filter(~F.coalesce(dropped, F.lit(False)))
    return df


def drop_by_matches(df: DataFrame, key: str, matches: Column) -> DataFrame:
    """Rows without any match. The decision is per row id, so the rows never meet in a join."""
    return df.filter(F.size(matches) == 0)


def update_subsets(df: DataFrame, remove_sources: list[str], add: dict[str, DataFrame], drop_columns: list[str] = ()) -> DataFrame:
    """Drop sources, append datasets tagged with their name, drop columns where present."""
    out = df.filter(~F.col("source").isin(remove_sources) | F.col("source").isNull())
    for name, extra in add.items():
        out = out.unionByName(extra.withColumn("source", F.lit(name)), allowMissingColumns=True)
    return out.drop(*drop_columns)


def varied_prompts(samples: DataFrame, prompt: str, text: str) -> DataFrame:
    """Prompts whose sampled completions are not all identical (min and max differ; nothing to collect)."""
    return samples.groupBy(prompt).agg(F.min(text).alias("lo"), F.max(text).alias("hi")).filter(
        F.col("lo") != F.col("hi")
    ).select(prompt)


def pass_rate_band(scored: DataFrame, prompt: str, score, low: float, high: float, prompts: DataFrame | None = None) -> DataFrame:
    """Total, correct and rate per prompt inside the closed band; prompts without samples have rate 0."""
    rates = scored.groupBy(prompt).agg(
        F.count(F.lit(1)).alias("total"), F.sum(col(score)).alias("correct"), F.avg(col(score)).alias("rate")
    )
    if prompts is not None:
        rates = prompts.select(prompt).distinct().join(rates, prompt, "left").fillna(0, ["total"]).fillna(0.0, ["correct", "rate"])
    return rates.filter(F.col("rate").between(low, high))


def passed_tests(tests, results, min_rate: float = 0.8) -> tuple[Column, Column]:
    """(keep flag, passed tests) of a program from its tests and 0/1 results."""
    rate = F.aggregate(col(results), F.lit(0), lambda a, r: a + (r == 1).cast("int")) / F.size(results)
    passed = F.transform(
        F.filter(F.arrays_zip(col(tests).alias("t"), col(results).alias("r")), lambda z: z["r"] == 1), lambda z: z["t"]
    )
    return (F.size(results) > 0) & (rate >= min_rate), passed


