"""Named steps over tables: every step is a function from DataFrame to DataFrame with its own arguments.

A run is a list of (name, arguments). Map steps may be told which columns to keep; the source tag always stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions import tokens as T
from chatloom.functions.templates import TEMPLATES
from chatloom.operators import conversions as C
from chatloom.operators import filters as L

SOURCE = "dataset_source"
STEPS: dict[str, tuple[Callable[..., DataFrame], str]] = {}


def step(name: str, kind: str):
    """Register a step of kind "map" or "filter"."""
    if kind not in ("map", "filter"):
        raise ValueError(f"unknown kind {kind}")

    def wrap(fn):
        STEPS[name] = (fn, kind)
        return fn

    return wrap


def run(df: DataFrame, steps: list[tuple[str, dict]], source: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Apply the steps in order as one lazy plan."""
    if source is not None:
        df = df.withColumn(SOURCE, F.lit(source))
    for name, kwargs in steps:
        fn, kind = STEPS[name]
        df = fn(df, **kwargs)
        if kind == "map" and keep is not None:
            df = df.select(*[c for c in df.columns if c in keep or c == SOURCE])
    return df


def _tokens(df: DataFrame, mask: str, max_length: int, template: str, messages: str, tokenizer) -> DataFrame:
    coded = df.withColumn("_t", T.masked_chat(messages, TEMPLATES[template], max_length, mask, tokenizer))
    return coded.select("*", "_t.*").drop("_t")


@step("tokenize", "map")
def tokenize(df, template="tagged", messages="messages", max_length=2**31 - 1, tokenizer=T.word_ids):
    out = _tokens(df, "none", max_length, template, messages, tokenizer)
    return out.withColumn("input_ids_prompt", T.prompt_ids(messages, TEMPLATES[template], tokenizer))


@step("tokenize_mask_prompt", "map")
def tokenize_mask_prompt(df, template="tagged", messages="messages", max_length=2**31 - 1, tokenizer=T.word_ids):
    out = _tokens(df, "prompt", max_length, template, messages, tokenizer)
    return out.withColumn("input_ids_prompt", T.prompt_ids(messages, TEMPLATES[template], tokenizer))


@step("tokenize_mask_assistant", "map")
def tokenize_mask_assistant(df, max_length, template="tagged", messages="messages", tokenizer=T.word_ids):
    return _tokens(df, "assistant", max_length, template, messages, tokenizer)


@step("tokenize_mask_last", "map")
def tokenize_mask_last(df, max_length, template="tagged", messages="messages", tokenizer=T.word_ids):
    return _tokens(df, "last", max_length, template, messages, tokenizer)


@step("tokenize_preference", "map")
def tokenize_preference(df, max_length, template="tagged", chosen="chosen", rejected="rejected", mask="last", tokenizer=T.word_ids):
    for side in (chosen, rejected):
        coded = T.masked_chat(side, TEMPLATES[template], max_length, mask, tokenizer)
        df = df.withColumn("_t", coded).select("*", *[F.col(f"_t.{c}").alias(f"{side}_{c}") for c in ("input_ids", "labels", "attention_mask")]).drop("_t")
    return df


@step("prompt_for_rewards", "map")
def prompt_for_rewards(df, template="tagged", messages="messages", truth="ground_truth", verifier="dataset", system=None, tokenizer=T.word_ids):
    """Prompt ids and raw prompt; ground truth and verifier names become lists."""
    as_list = lambda c: F.col(c) if df.schema[c].dataType.typeName() == "array" else F.array(c)
    prompt = C.prompt_messages(messages, system)
    return (
        df.withColumn("raw_prompt", C.raw_prompt(messages, system)).withColumn(truth, as_list(truth)).withColumn(verifier, as_list(verifier))
        .withColumn("_p", prompt).withColumn("input_ids_prompt", F.flatten(tokenizer(T.segments_for_prompt("_p", TEMPLATES[template])))).drop("_p")
    )


@step("length_filter", "filter")
def length_filter(df, max_prompt=None, max_total=None, need_labels=True):
    labels = F.col("labels") if need_labels else None
    prompt = F.col("input_ids_prompt") if "input_ids_prompt" in df.columns else None
    ids = F.col("input_ids") if "input_ids" in df.columns else None
    return df.filter(T.length_filter(prompt, ids, labels, max_prompt, max_total))


@step("preference_length_filter", "filter")
def preference_length_filter(df, max_total=None, need_labels=True):
    ok = F.lit(True)
    for side in ("chosen", "rejected"):
        labels = F.col(f"{side}_labels") if need_labels else None
        ok = ok & T.length_filter(None, F.col(f"{side}_input_ids"), labels, None, max_total)
    return df.filter(ok)


@step("drop_vendor_turns", "filter")
def drop_vendor_turns(df, messages="messages"):
    return df.filter(~L.has_vendor_turn(messages))


@step("drop_empty_turns", "filter")
def drop_empty_turns(df, messages="messages"):
    return df.filter(~L.has_empty_turn(messages))


@step("drop_identity_turns", "filter")
def drop_identity_turns(df, messages="messages", user_turns=False):
    return df.filter(~L.has_identity_turn(messages, user_turns))


@step("convert", "map")
def convert(df, spec):
    return C.convert_with_spec(df, spec)
