"""Tokenisation and loss masks over chat rows.

A tokenizer is a function from an ``array<string>`` column to an ``array<array<int>>`` column. The built-in one is a
JVM expression; a tokenizer file is applied in Arrow batches. Turns are tokenised on their own, so that the spans of
a mask are plain sums of lengths.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.templates import ChatTemplate, opening, segments
from chatloom.functions.text import col, let, token_id, word_tokens

MASKED = -100
Tokenizer = Callable[[Column], Column]


def word_ids(texts: Column, vocab: int = 50_000) -> Column:
    return F.transform(texts, lambda s: F.transform(word_tokens(s), lambda t: token_id(t, vocab)))


def file_tokenizer(path: str) -> Tokenizer:
    """Tokenizer of a ``tokenizer.json`` that every executor can read."""

    @F.pandas_udf("array<array<int>>")
    def encode(batch: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer as FileTokenizer

        tok = FileTokenizer.from_file(path)
        flat = [s if s is not None else "" for row in batch for s in row]
        ids = iter(tok.encode_batch(flat, add_special_tokens=False))
        return pd.Series([[next(ids).ids for _ in row] for row in batch])

    return encode


def token_count(text) -> Column:
    """Tokens of a text; null counts as empty."""
    return F.size(word_tokens(F.coalesce(col(text), F.lit(""))))


def message_tokens(messages, role: str | None = None) -> Column:
    """Token counts of the turns of one role, or of user and assistant turns."""
    wanted = [role] if role else ["user", "assistant"]
    turns = F.filter(col(messages), lambda m: m["role"].isin(wanted))
    return F.transform(turns, lambda m: token_count(m["content"]))


def total_tokens(messages, role: str | None = None) -> Column:
    return F.aggregate(message_tokens(messages, role), F.lit(0), lambda a, n: a + n)


def encode_chat(messages, template: ChatTemplate, tokenizer: Tokenizer = word_ids) -> Column:
    """The ids of the opening followed by the ids of every turn."""
    return tokenizer(F.concat(F.array(opening(messages, template)), segments(messages, template)))


def _generation_length(template: ChatTemplate, tokenizer: Tokenizer) -> Column:
    return F.size(F.element_at(tokenizer(F.array(F.lit(template.generation))), 1))


def masked_chat(
    messages, template: ChatTemplate, max_length: int, mask: str = "assistant", tokenizer: Tokenizer = word_ids
) -> Column:
    """Struct (input_ids, labels, attention_mask), cut to ``max_length``.

    ``mask`` is "assistant" (only assistant turns carry loss; the header an assistant turn shares with the generation
    prompt does not when it answers another role), "last" (only the final turn carries loss), "prompt" (everything
    before the final turn and the generation prompt is masked) or "none".
    """
    m = col(messages)

    def label(ids: Column, i: Column, header: Column) -> Column:
        # element 0 is the opening, element i + 1 the i-th turn
        turn, before = F.get(m, i - 1), F.get(m, i - 2)
        last = i == F.size(m)
        if mask == "none":
            return ids
        if mask == "assistant":
            open_turn = (i > 0) & (turn["role"] == "assistant")
            shared = F.when((i > 1) & (before["role"] != "assistant"), header).otherwise(0)
        else:
            single = (F.size(m) == 1) & F.lit(mask == "prompt")
            open_turn = last & (i > 0) & ~single
            shared = F.when(i > 1, header).otherwise(0) if mask == "last" else header
        keep = F.coalesce(open_turn, F.lit(False))
        hidden = F.when(keep, F.least(shared, F.size(ids))).otherwise(F.size(ids))
        # bound, or every token would look up its turn again
        return let(hidden, lambda h: F.transform(ids, lambda t, j: F.when(j < h, F.lit(MASKED)).otherwise(t)))

    def build(bound: Column) -> Column:
        parts, header = bound["parts"], bound["header"]
        ids = F.slice(F.flatten(parts), F.lit(1), F.lit(max_length))
        labels = F.slice(F.flatten(F.transform(parts, lambda p, i: label(p, i, header))), F.lit(1), F.lit(max_length))
        return F.struct(
            ids.alias("input_ids"), labels.alias("labels"), F.transform(ids, lambda t: F.lit(1)).alias("attention_mask")
        )

    header = _generation_length(template, tokenizer)
    return let(F.struct(encode_chat(m, template, tokenizer).alias("parts"), header.alias("header")), build)


def prompt_ids(messages, template: ChatTemplate, tokenizer: Tokenizer = word_ids) -> Column:
    """Ids of everything before a final answer, with the generation prompt."""
    m = col(messages)
    prompt = F.when(F.size(m) > 1, F.slice(m, F.lit(1), F.size(m) - 1)).otherwise(m)
    return F.flatten(tokenizer(segments_for_prompt(prompt, template)))


def segments_for_prompt(prompt, template: ChatTemplate) -> Column:
    """Opening, turns and generation prompt of a chat that waits for an answer."""
    p = col(prompt)
    return F.concat(F.array(opening(p, template)), segments(p, template, generate=True), F.array(F.lit(template.generation)))


def has_labels(labels) -> Column:
    return F.exists(col(labels), lambda x: x != MASKED)


def trainable(labels) -> Column:
    return F.aggregate(col(labels), F.lit(0), lambda a, x: a + (x != MASKED).cast("int"))


def length_filter(prompt_ids_col=None, ids=None, labels=None, max_prompt: int | None = None, max_total: int | None = None) -> Column:
    """Prompt and total length limits and at least one unmasked label, as far as given."""
    ok = F.lit(True)
    if max_prompt is not None:
        ok = ok & (F.size(prompt_ids_col) <= max_prompt)
    if max_total is not None:
        ok = ok & (F.size(ids) <= max_total)
    if labels is not None:
        ok = ok & has_labels(labels)
    return ok


# --- sentence chunks -------------------------------------------------------------------------

def split_for_chunks(text: Column) -> Column:
    """Sentences by end marks and blank lines; short texts stay whole."""
    paragraphs = F.filter(F.split(text, r"(?U)\n\s*\n"), lambda p: F.trim(p) != "")
    parts = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?U)(?<=[.!?])\s+")))
    clean = F.filter(F.transform(parts, lambda s: F.regexp_replace(s, r"(?U)\A\s+|\s+\z", "")), lambda s: s != "")
    return (
        F.when(F.length(text) == 0, F.array().cast("array<string>"))
        .when(F.length(text) < 50, F.array(text))
        .otherwise(let(clean, lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(text))))
    )


def _greedy(parts: Column, target: int, long_part) -> Column:
    """Join neighbours with blanks while they stay within ``target`` tokens."""
    texts = "array<string>"
    start = F.struct(F.lit("").alias("cur"), F.lit(0).alias("n"), F.array().cast(texts).alias("done"))

    def flush(acc: Column) -> Column:
        return F.when(acc["cur"] != "", F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])

    def step(acc: Column, s: Column) -> Column:
        def add(n: Column) -> Column:
            grown = F.when(acc["cur"] == "", s).otherwise(F.concat(acc["cur"], F.lit(" "), s))
            fresh = (acc["n"] + n > target) & (acc["cur"] != "")
            usual = F.struct(
                F.when(fresh, s).otherwise(grown).alias("cur"),
                F.when(fresh, n).otherwise(acc["n"] + n).alias("n"),
                F.when(fresh, flush(acc)).otherwise(acc["done"]).alias("done"),
            )
            if long_part is None:
                return usual
            alone = F.struct(F.lit("").alias("cur"), F.lit(0).alias("n"), F.concat(flush(acc), long_part(s, n)).alias("done"))
            return F.when(n > target, alone).otherwise(usual)

        return let(token_count(s), add)

    return F.aggregate(parts, start, step, flush)


def first_tokens(text: Column, n: int) -> Column:
    """The text up to the end of its n-th token."""
    return F.regexp_extract(text, r"(?s)\A((?:\s*(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])){0," + str(n) + "})", 1)


def sentence_chunks(text, max_tokens: int = 400, margin: int = 50) -> Column:
    """Chunks of whole sentences of at most ``max_tokens`` tokens; longer sentences are cut at words."""
    target = max_tokens - margin

    def cap(chunks: Column) -> Column:
        return F.transform(chunks, lambda c: F.when(token_count(c) <= max_tokens, c).otherwise(first_tokens(c, max_tokens)))

    def by_words(s: Column) -> Column:
        return _greedy(F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""), target, None)

    def long_sentence(s: Column, n: Column) -> Column:
        return F.when(n <= max_tokens, F.array(s)).otherwise(by_words(s))

    def chunk(t: Column) -> Column:
        def spread(sentences: Column) -> Column:
            return F.when(F.size(sentences) <= 1, by_words(t)).otherwise(_greedy(sentences, target, long_sentence))

        made = let(split_for_chunks(t), spread)
        whole = F.when(F.size(made) > 0, made).otherwise(F.array(t))
        return F.when(token_count(t) <= max_tokens, F.array(t)).otherwise(cap(whole))

    return let(col(text), chunk)


# --- context window --------------------------------------------------------------------------

# Fixed value: the reply format a judge prompt ends with.
JUDGE_FORMAT = 'Respond in JSON format. {"REASONING": "[...]", "SCORE": "<your-score>"}'


def fits_context(messages, completion: int, window: int = 8192, margin: int = 100) -> Column:
    used = F.aggregate(
        col(messages), F.lit(0), lambda a, m: a + token_count(m["content"]) + F.when(m["role"] == "system", 4).otherwise(3)
    )
    return used + completion + margin <= window


def truncate_to_context(messages, completion: int, window: int = 8192, margin: int = 100) -> Column:
    """System turns whole, the others in order while they fit, the first that does not is cut; the rest is dropped."""
    m = col(messages)
    ddl = "array<struct<role:string,content:string>>"
    system = F.filter(m, lambda x: x["role"] == "system")
    spent = F.aggregate(system, F.lit(0), lambda a, x: a + token_count(x["content"]) + 4)

    def fill(room: Column) -> Column:
        start = F.struct(room.alias("room"), F.lit(False).alias("full"), F.array().cast(ddl).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            n = token_count(x["content"]) + 3
            left = acc["room"] - 3
            cut = F.struct(x["role"].alias("role"), first_tokens_of(x["content"], left).alias("content"))
            taken = F.struct((acc["room"] - n).alias("room"), F.lit(False).alias("full"), F.concat(acc["out"], F.array(x)).alias("out"))
            last = F.struct(
                F.lit(0).alias("room"), F.lit(True).alias("full"),
                F.when(left > 0, F.concat(acc["out"], F.array(cut))).otherwise(acc["out"]).alias("out"),
            )
            return F.when(acc["full"], acc).when(n <= acc["room"], taken).otherwise(last)

        rest = F.filter(m, lambda x: x["role"] != "system")
        return F.when(room <= 0, system).otherwise(F.concat(system, F.aggregate(rest, start, step, lambda acc: acc["out"])))

    return let(F.lit(window - completion - margin) - spent, fill)


def first_tokens_of(text: Column, n: Column) -> Column:
    """``first_tokens`` for a limit that differs per row."""
    return let(F.regexp_extract_all(text, F.lit(r"\s*(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"), 0), lambda t: F.array_join(F.slice(t, F.lit(1), F.greatest(n, F.lit(0))), ""))


def with_judge_format(messages) -> Column:
    m = col(messages)
    tail = F.try_element_at(m, F.lit(-1))
    ask = (tail["role"] == "user") & ~tail["content"].endswith(JUDGE_FORMAT)
    new = F.struct(tail["role"].alias("role"), F.concat(tail["content"], F.lit("\n" + JUDGE_FORMAT)).alias("content"))
    return F.when(F.coalesce(ask, F.lit(False)), F.concat(F.slice(m, F.lit(1), F.size(m) - 1), F.array(new))).otherwise(m)
