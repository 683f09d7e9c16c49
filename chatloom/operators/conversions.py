"""From heterogeneous dumps to one chat schema: every converter is a Column for the ``messages`` list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import (
    flat, last_message, merge_same_role, message, no_messages, replace_last, user_assistant,
)
from chatloom.functions.text import any_of, col, find_all, hash_key, is_blank, last_of, let, replace_all, split_words, steps, strip

# Senders of the exported conversation formats.
SENDER_ROLES = {
    "gpt": "assistant", "chatgpt": "assistant", "Assistant": "assistant", "assistant": "assistant",
    "user": "user", "User": "user", "human": "user",
}
# Language names of chat logs and their ISO 639-1 codes.
LANGUAGE_CODES = {
    "English": "en", "German": "de", "French": "fr", "Spanish": "es", "Italian": "it", "Portuguese": "pt",
    "Dutch": "nl", "Polish": "pl", "Czech": "cs", "Romanian": "ro", "Greek": "el", "Ukrainian": "uk",
    "Russian": "ru", "Chinese": "zh", "Japanese": "ja", "Korean": "ko", "Arabic": "ar", "Turkish": "tr",
    "Vietnamese": "vi", "Indonesian": "id", "Thai": "th", "Hindi": "hi", "Swedish": "sv", "Danish": "da",
    "Finnish": "fi", "Norwegian": "no", "Hungarian": "hu", "Bulgarian": "bg", "Croatian": "hr", "Slovak": "sk",
    "Slovenian": "sl", "Estonian": "et", "Latvian": "lv", "Lithuanian": "lt", "Serbian": "sr", "Hebrew": "he",
    "Persian": "fa", "Catalan": "ca", "Bangla": "bn", "Tamil": "ta", "Urdu": "ur", "Malay": "ms",
    "Tagalog": "tl", "Swahili": "sw", "Albanian": "sq", "Icelandic": "is", "Irish": "ga", "Maltese": "mt",
    "Welsh": "cy", "Basque": "eu", "Galician": "gl", "Afrikaans": "af", "Georgian": "ka", "Armenian": "hy",
    "Azerbaijani": "az", "Kazakh": "kk", "Belarusian": "be", "Macedonian": "mk", "Bosnian": "bs", "Latin": "la",
}
# Reasoning marks and what replaces them in plain text.
REASONING_MARKS = [("<think>", "\n"), ("</think>", ""), ("<answer>", "\n\n"), ("</answer>", "")]
RESERVED_MARKS = [("<|reserved_special_token_246|>", "<think>"), ("<|reserved_special_token_247|>", "</think><answer>")]
# Fixed value: the prompt around an instruction with input.
INSTRUCTION_PROMPT = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n### Instruction:\n", "\n\n### Input:\n", "\n\n### Response:",
)
CHOICE_PROMPT = (
    "Answer the following multiple choice question. The last line of your response should be of the following format: "
    "`<answer>LETTER</answer>` where LETTER is one of ABCD. Search the web by wrapping a query in query tags like so: "
    "<query></query>\nQueries should comprise of a few keywords that are relevant to the question. For example: "
    "<query>personalized dialogue generation, personalized language models, personalized dialogue</query>\nQuestion "
)


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Literal map lookup; null for unknown keys."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), c)


# --- roles and turns -------------------------------------------------------------------------

def from_senders(turns, sender: str = "from", value: str = "value", unknown: str = "error") -> Column:
    """Sender/value turns to messages. Unknown senders raise ("error") or keep their name ("keep")."""

    def role(s: Column) -> Column:
        other = F.raise_error(F.concat(F.lit("unknown sender "), s)).cast("string") if unknown == "error" else s
        return F.coalesce(lookup(s, SENDER_ROLES), other)

    return F.transform(col(turns), lambda x: F.struct(role(x[sender]).alias("role"), x[value].alias("content")))


def without_bot_system(turns, sender: str = "from") -> Column:
    """False where a system or bing sender makes the conversation unusable."""
    return ~F.exists(col(turns), lambda x: x[sender].isin("system", "bing"))


def positional_roles(texts) -> Column:
    """Even entries are user turns, odd ones assistant turns; an odd last entry is cut."""
    return let(
        col(texts),
        lambda a: F.transform(
            F.slice(a, F.lit(1), (F.floor(F.size(a) / 2) * 2).cast("int")),
            lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.alias("content")),
        ),
    )


def parse_transcript(text) -> Column:
    """``Human:`` / ``Assistant:`` transcripts to stripped messages with neighbours of one role merged."""
    pattern = r"(?s)(Human|Assistant):(.+?)(?=(?:Human|Assistant):|\z)"
    pairs = F.arrays_zip(find_all(text, pattern, 1).alias("r"), find_all(text, pattern, 2).alias("c"))
    turns = F.transform(
        pairs,
        lambda p: F.struct(F.when(p["r"] == "Human", "user").otherwise("assistant").alias("role"), strip(p["c"]).alias("content")),
    )
    return merge_same_role(turns)


def transcript_pairs(text) -> Column:
    """Pair the n-th human mark with the n-th assistant mark and cut the text at these offsets."""
    return let(col(text), _transcript_pairs)


def _transcript_pairs(t: Column) -> Column:
    human, assistant = "\n\nHuman: ", "\n\nAssistant: "

    def offsets(mark: str) -> Column:
        # running offset of each mark from the lengths of the pieces between the marks
        pieces = F.transform(F.split(t, mark), lambda x: F.length(x))
        lengths = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            lengths,
            start,
            lambda acc, n: F.struct(
                (acc["at"] + n + len(mark)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + n)).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def cut(h: Column, a: Column) -> Column:
        n = F.least(F.size(h), F.size(a))
        both = F.flatten(F.transform(F.slice(F.arrays_zip(h.alias("h"), a.alias("a")), F.lit(1), n), lambda p: F.array(p["h"], p["a"])))
        return let(F.concat(both, F.array(F.length(t))), pieces_of)

    def pieces_of(marks: Column) -> Column:
        index = F.when(F.size(marks) > 1, F.sequence(F.lit(0), F.size(marks) - 2)).otherwise(F.array().cast("array<int>"))

        def piece(i: Column) -> Column:
            skip = F.when(i % 2 == 0, len(human)).otherwise(len(assistant))
            at = F.get(marks, i) + skip
            length = F.greatest(F.get(marks, i + 1) - at, F.lit(0))
            return F.struct(
                F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), F.substring(t, at + 1, length).alias("content")
            )

        return F.transform(index, piece)

    return let(offsets(human), lambda h: let(offsets(assistant), lambda a: cut(h, a)))


def complete_chat(messages) -> Column:
    """No empty content and an assistant at the end."""
    return ~F.exists(col(messages), lambda m: m["content"] == "") & (last_message(messages)["role"] == "assistant")


def with_system(messages: Column, system, strip_it: bool = False) -> Column:
    """Prepend a system turn where the prompt is not empty."""
    text = strip(system) if strip_it else col(system)
    present = text.isNotNull() & (text != "")
    return F.when(present, F.concat(F.array(message("system", text)), messages)).otherwise(messages)


# --- column-set driven conversion ------------------------------------------------------------

def convert_by_columns(df: DataFrame) -> DataFrame:
    """Pick the converter from the columns present; the first matching set wins."""
    have = set(df.columns)
    if "messages" in have:
        return df
    if {"instruction", "output"} <= have:
        head, middle, tail = INSTRUCTION_PROMPT
        extra = F.col("input") if "input" in have else F.lit("")
        m = user_assistant(F.concat(F.lit(head), F.col("instruction"), F.lit(middle), extra, F.lit(tail)), "output")
    elif {"prompt", "completion"} <= have:
        m = user_assistant("prompt", "completion")
    elif "conversations" in have:
        m = from_senders("conversations")
    elif {"question", "response"} <= have:
        system = F.col("system_prompt") if "system_prompt" in have else F.lit("")
        m = F.concat(F.array(message("system", system)), user_assistant("question", "response"))
    elif {"query", "answer"} <= have:
        m = user_assistant("query", "answer")
    elif {"query", "response"} <= have:
        m = user_assistant("query", "response")
    elif {"chosen", "rejected", "reference_completion"} <= have:
        m = F.col("chosen")
    else:
        raise ValueError(f"no converter for columns {sorted(have)}")
    return df.withColumn("messages", m)


# --- choosing a side -------------------------------------------------------------------------

def chosen_answer(prefer_first: Column, prompt, first, second) -> Column:
    """User prompt with the preferred of two answers; a null condition prefers the second."""
    return user_assistant(prompt, F.when(prefer_first, col(first)).otherwise(col(second)))


def chosen_by_rank(prompt, answers) -> Column:
    """The answer of rank 1, else the first, after cutting the transcript marks off the prompt."""
    clean = F.regexp_replace(col(prompt), r"(?iU)\A\s*Human:\s*", "")
    clean = F.regexp_replace(clean, r"(?iU)\s*Assistant:\s*\z", "")
    best = F.coalesce(
        F.get(F.filter(col(answers), lambda a: a["rank"] == 1), F.lit(0))["answer"], F.get(col(answers), F.lit(0))["answer"], F.lit("")
    )
    return user_assistant(clean, best)


def chosen_conversation(keep: Column, conversation) -> Column:
    return F.when(F.coalesce(keep, F.lit(False)), col(conversation)).otherwise(no_messages())


def chosen_vote(tie, chosen_model, model_a, sides: dict[str, dict[str, str]]) -> Column:
    """Vote with quality veto. ``sides`` names the columns conversation, system, incorrect, useful of a and b."""
    winner = F.when(col(tie), col(model_a)).otherwise(col(chosen_model))

    def side(s: dict[str, str]) -> Column:
        vetoed = col(s["incorrect"]).eqNullSafe(F.lit(True)) | col(s["useful"]).eqNullSafe(F.lit(False))
        turns = F.filter(col(s["conversation"]), lambda m: m.isNotNull())
        filled = F.transform(
            turns, lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"))
        )
        merged = merge_same_role(with_system(filled, s["system"], strip_it=True))
        return F.when(~vetoed & (F.size(turns) > 0), merged).otherwise(no_messages())

    return F.when(winner.isNull(), no_messages()).when(winner == col(model_a), side(sides["a"])).otherwise(side(sides["b"]))


def safe_response(prompt, response, label) -> Column:
    keep = (col(prompt) != "REDACTED") & (col(label) == "safe")
    return F.when(F.coalesce(keep, F.lit(False)), user_assistant(prompt, response)).otherwise(no_messages())


# --- multilingual sources --------------------------------------------------------------------

def language_code(name) -> Column:
    n = col(name)
    return F.when(is_blank(n), "").otherwise(F.coalesce(lookup(n, LANGUAGE_CODES), F.substring(F.lower(n), 1, 2)))


def admit_chat(conversation, toxic=None, count_kept_only: bool = True, min_chars: int = 50) -> Column:
    """Messages of a non-toxic conversation with two turns and enough characters, else an empty list."""
    c = col(conversation)
    kept = F.transform(
        F.filter(c, lambda m: ~is_empty(m["role"]) & ~is_empty(m["content"])),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    measured = kept if count_kept_only else c
    chars = F.aggregate(measured, F.lit(0), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0)))
    ok = (F.size(c) >= 2) & (chars >= min_chars)
    if toxic is not None:
        ok = ok & ~F.coalesce(col(toxic), F.lit(False))
    return F.when(ok, kept).otherwise(no_messages())


def is_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def fusion_chat(prompt, fusion) -> Column:
    done = col(fusion)["completion"]
    return F.when(~is_empty(col(prompt)) & ~is_empty(done), user_assistant(prompt, done)).otherwise(no_messages())


def transform_source(df: DataFrame, messages: Column, renames: dict[str, str] | None = None, keep: list[str] = ()) -> DataFrame:
    """Rename, convert, keep columns, drop rows without messages."""
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    kept = [c for c in keep if c in df.columns and c != "messages"]
    return df.select(*kept, messages.alias("messages")).filter(F.size("messages") > 0)


# --- splitting, tags, rendering --------------------------------------------------------------

def split_by_budget(turns, budget: int, length, overhead: int = 6) -> Column:
    """Segments of whole (user, assistant) pairs within a token budget; longer pairs are skipped."""
    def pairs_of(a: Column) -> Column:
        index = F.when(F.size(a) >= 2, F.sequence(F.lit(0), F.floor(F.size(a) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            index,
            lambda i: F.struct(
                F.array(F.get(a, i * 2), F.get(a, i * 2 + 1)).alias("turns"),
                (length(F.get(a, i * 2)) + length(F.get(a, i * 2 + 1)) + 2 * overhead).alias("n"),
            ),
        )

    element = "array<struct<role:string,content:string>>"
    start = F.struct(
        F.array().cast(element).alias("cur"), F.lit(0).alias("n"), F.array().cast(f"array<{element}>").alias("done")
    )

    def step(acc, p):
        flushed = F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
        too_long, fits = p["n"] > budget, acc["n"] + p["n"] <= budget
        return F.struct(
            F.when(too_long, F.array().cast(element)).when(fits, F.concat(acc["cur"], p["turns"])).otherwise(p["turns"]).alias("cur"),
            F.when(too_long, F.lit(0)).when(fits, acc["n"] + p["n"]).otherwise(p["n"]).alias("n"),
            F.when(~too_long & fits, acc["done"]).otherwise(flushed).alias("done"),
        )

    return F.aggregate(
        let(col(turns), pairs_of),
        start,
        step,
        lambda acc: F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"]),
    )


def roles_alternate(messages, first: str = "user", second: str = "assistant") -> Column:
    return (F.size(messages) > 0) & F.forall(
        F.transform(col(messages), lambda m, i: m["role"] == F.when(i % 2 == 0, first).otherwise(second)), lambda ok: ok
    )


def fill_placeholders(messages, replacements: dict[str, str], system: str | None = None) -> Column:
    filled = F.transform(
        col(messages),
        lambda m: F.struct(m["role"].alias("role"), replace_all(m["content"], replacements.items()).alias("content")),
    )
    if not system:
        return filled
    has = F.exists(col(messages), lambda m: m["role"] == "system")
    text = system
    for old, new in replacements.items():
        text = text.replace(old, new)
    return F.when(has, filled).otherwise(F.concat(F.array(message("system", F.lit(text))), filled))


# The general filter tags. Tags that are names come with their spellings from the caller.
GENERAL_TAGS = ["date-cutoff", "no-tools", "english-only"]


def keep_by_tags(tags, filter_tags: list[str], spellings: dict[str, list[str]] | None = None) -> Column:
    """False where a row carries one of the filter tags, in any of its spellings; unknown filter tags match nothing."""
    known = {**{t: [t] for t in GENERAL_TAGS}, **(spellings or {})}
    bad = [s for t in filter_tags for s in known.get(t, [])]
    if not bad:
        return F.lit(True)
    return ~F.coalesce(F.arrays_overlap(col(tags), F.array(*[F.lit(b) for b in bad])), F.lit(False))


def strip_marks(text) -> Column:
    return replace_all(text, REASONING_MARKS)


def as_plain_text(messages) -> Column:
    """``User: …`` / ``Assistant: …`` paragraphs without reasoning marks and empty turns."""

    def label(role: Column) -> Column:
        low = F.lower(F.coalesce(role, F.lit("")))
        named = F.concat(F.upper(F.substring(low, 1, 1)), F.substr(low, F.lit(2)))
        return F.when(low.isin("user", "human"), "User").when(low.isin("assistant", "ai"), "Assistant").otherwise(named)

    full = F.filter(col(messages), lambda m: ~is_empty(m["content"]))
    return F.array_join(F.transform(full, lambda m: F.concat(label(m["role"]), F.lit(": "), strip_marks(m["content"]))), "\n\n")


def _newline_after_thought(c: Column) -> Column:
    return F.when(c.contains("</think>\n"), c).otherwise(F.replace(c, F.lit("</think>"), F.lit("</think>\n")))


def add_answer_tags(messages) -> Column:
    opened = lambda c: F.when(c.contains("<answer>"), c).otherwise(F.replace(c, F.lit("</think>"), F.lit("</think>\n<answer>")))
    closed = lambda c: F.when(c.endswith("</answer>"), c).otherwise(F.concat(c, F.lit("\n</answer>")))
    return replace_last(messages, steps(last_message(messages)["content"], _newline_after_thought, opened, closed))


def remove_answer_tags(messages) -> Column:
    bare = strip(replace_all(last_message(messages)["content"], [("<answer>", ""), ("</answer>", "")]))
    return replace_last(messages, steps(bare, _newline_after_thought))


def prompt_messages(messages, system_override: str | None = None) -> Column:
    """The prompt part: a final assistant turn is cut, an override replaces a leading system turn."""
    m = col(messages)
    cut = (F.size(m) > 1) & (last_message(m)["role"] == "assistant")
    p = F.when(cut, F.slice(m, F.lit(1), F.size(m) - 1)).otherwise(m)
    if system_override is None:
        return p
    rest = F.when(F.get(p, F.lit(0))["role"] == "system", F.slice(p, F.lit(2), F.size(p))).otherwise(p)
    return F.concat(F.array(message("system", F.lit(system_override))), rest)


def raw_prompt(messages, system_override: str | None = None) -> Column:
    return flat(prompt_messages(messages, system_override))


# --- answers ---------------------------------------------------------------------------------

def answer_after_hashes(text) -> Column:
    return strip(F.substring_index(col(text), "####", -1))


def last_boxed(text) -> Column:
    r"""Content of the last ``\boxed{…}`` with balanced braces, or of ``\boxed x`` up to a dollar sign; else null."""
    state = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def step(acc: Column, p: Column) -> Column:
        depth = acc["depth"] + F.when(p == "{", 1).when(p == "}", -1).otherwise(0)
        at = acc["at"] + F.length(p)
        closes = (p == "}") & (depth == 0) & (acc["end"] < 0)
        return F.struct(depth.alias("depth"), at.alias("at"), F.when(closes, at).otherwise(acc["end"]).alias("end"))

    def group(rest: Column) -> Column:
        # the brace group that opens the text after the mark, walked piece by piece
        inner = lambda end: F.when((end > 0) & rest.startswith("{"), F.substring(rest, F.lit(2), end - 2))
        return let(F.aggregate(find_all(rest, r"[^{}]+|[{}]"), state, step, lambda acc: acc["end"]), inner)

    def find(t: Column) -> Column:
        spaced = F.substring_index(F.substring_index(t, "\\boxed ", -1), "$", 1)
        braced = let(F.substring_index(t, "\\boxed", -1), group)
        return F.when(t.contains("\\boxed "), spaced).when(t.contains("\\boxed"), braced)

    return let(col(text), find)


def final_answer(text) -> Column:
    t = col(text)
    return (
        F.when(t.rlike("(?s)<answer>.*?</answer>"), strip(F.regexp_extract(t, "(?s)<answer>(.*?)</answer>", 1)))
        .when(t.contains("</think>"), strip(F.regexp_extract(t, "(?s)</think>(.*)", 1)))
        .when(t.contains("<|assistant|>"), strip(F.replace(t, F.lit("<|assistant|>"), F.lit(""))))
        .otherwise(t)
    )


def last_user_query(text) -> Column:
    """The last user turn of a templated transcript before the assistant starts to reason."""
    pattern = (
        r"(?s)(?:<\|user\|>\n(.*?)\n<\|assistant\|>\n<think>"
        r"|<\|im_start\|>user\n(.*?)(?:\n<functions>.*?</functions>)?<\|im_end\|>\n(?=[\s\S]*?<\|im_start\|>assistant\n<think>))"
    )
    simple, tagged = last_of(find_all(text, pattern, 1)), last_of(find_all(text, pattern, 2))
    return F.when(simple.isNull(), col(text)).otherwise(strip(F.when(simple != "", simple).otherwise(tagged)))


# --- instruction rendering -------------------------------------------------------------------

def instruction_example(instruction, input_text, output, eos: str = "") -> tuple[Column, Column]:
    extra = F.when(is_blank(input_text), "").otherwise(F.concat(strip(input_text), F.lit("\n\n")))
    return F.concat(strip(instruction), F.lit("\n\n"), extra), F.concat(strip(output), F.lit(eos))


def weighted_template(key, templates: list[tuple[str, float]], seed: int = 42) -> Column:
    """One of the templates by weight; the row's hash stands in for the random draw."""
    total = sum(w for _, w in templates)
    u = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32)) * total
    out, reached = F.lit(templates[-1][0]), total
    for name, weight in reversed(templates):
        reached -= weight
        out = F.when(u < reached + weight, F.lit(name)).otherwise(out)
    return out


def few_shot_prompt(instruction, examples, input_text) -> Column:
    shots = F.array_join(
        F.transform(
            col(examples),
            lambda e: F.concat(F.lit("Input:\n"), strip(e["input"]), F.lit("\nOutput:\n"), strip(e["output"]), F.lit("\n\n")),
        ),
        "",
    )
    return F.concat(strip(instruction), F.lit("\n\n"), shots, F.lit("Input:\n"), strip(input_text), F.lit("\nOutput:\n"))


def multiple_choice(question, correct, wrong: list) -> tuple[Column, Column]:
    """(prompt, letter): choices sorted without regard to case, the letter of the correct one."""
    c = col(correct)
    choices = F.transform(
        F.array_sort(F.transform(F.array(c, *[col(w) for w in wrong]), lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))),
        lambda s: s["v"],
    )
    listed = F.transform(choices, lambda x, i: F.concat(F.char(F.lit(65) + i), F.lit(": "), x))
    letter = F.char(F.lit(64) + F.array_position(choices, c).cast("int"))
    return F.concat(F.lit(CHOICE_PROMPT), col(question), F.lit("\nChoices: "), F.array_join(listed, ", ")), letter


def reasoning_marks(messages) -> Column:
    def fix(c: Column) -> Column:
        r = replace_all(c, RESERVED_MARKS)
        return F.when(r.contains("<answer>"), F.concat(r, F.lit("</answer>"))).otherwise(r)

    return F.transform(col(messages), lambda m: F.struct(m["role"].alias("role"), fix(m["content"]).alias("content")))


def reasoning_answer(messages) -> Column:
    c = F.substring_index(last_message(messages)["content"], "</think>", -1)
    return replace_all(c, [("<answer>", ""), ("</answer>", "")])


def reasoning_chat(question, reasoning, answer) -> Column:
    body = F.concat(F.lit("<think>"), col(reasoning), F.lit("</think><answer>"), col(answer), F.lit("</answer>"))
    ok = ~is_empty(col(question)) & ~is_empty(col(reasoning)) & ~is_empty(col(answer))
    return F.when(ok, user_assistant(question, body)).otherwise(no_messages())


def append_output(messages, output) -> Column:
    return F.concat(col(messages), F.array(message("assistant", output)))


def to_binary(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Preference rows to (messages, label) rows."""
    rest = [c for c in df.columns if c not in (chosen, rejected)]
    sides = F.array(
        F.struct(F.col(chosen).alias("messages"), F.lit(True).alias("label")),
        F.struct(F.col(rejected).alias("messages"), F.lit(False).alias("label")),
    )
    return df.select(*rest, F.explode(sides).alias("s")).select(*rest, "s.messages", "s.label")


def verified_to_chat(df: DataFrame, prompt: str, program: str, required: list[str]) -> DataFrame:
    return df.dropna(subset=required).withColumn("messages", user_assistant(prompt, program))


# --- table-driven specs ----------------------------------------------------------------------

# Prompt and answer columns of the two-column sources.
TWO_COLUMN_SPECS = {
    "inputs_targets": ("inputs", "targets"), "query_answer": ("query", "answer"), "instruction_response": ("instruction", "response"),
    "query_response": ("query", "response"), "prompt_completion": ("prompt", "completion"), "prompt_response": ("prompt", "response"),
    "problem_solution": ("problem", "generated_solution"), "question_answer": ("question", "answer"),
}


def convert_with_spec(df: DataFrame, spec: dict) -> DataFrame:
    """One converter for all table-driven sources.

    ``spec`` has a ``kind`` (two_column, senders, positional, identity, append, reasoning) with its columns, and
    optionally ``where`` (a predicate text), ``system``, ``rename`` and ``keep``.
    """
    if "where" in spec:
        df = df.filter(spec["where"])
    kind = spec["kind"]
    if kind == "two_column":
        m = user_assistant(*TWO_COLUMN_SPECS[spec["columns"]]) if isinstance(spec["columns"], str) else user_assistant(*spec["columns"])
    elif kind == "senders":
        m = from_senders(spec["column"], unknown=spec.get("unknown", "error"))
    elif kind == "positional":
        m = positional_roles(spec["column"])
    elif kind == "append":
        m = append_output(spec["column"], spec["output"])
    elif kind == "reasoning":
        m = reasoning_chat(*spec["columns"])
    elif kind == "identity":
        m = F.col(spec.get("column", "messages"))
    else:
        raise ValueError(f"unknown converter kind {kind}")
    if "system" in spec:
        m = with_system(m, spec["system"])
    return transform_source(df, m, spec.get("rename"), spec.get("keep", []))


def without_tools(tool_columns: list) -> Column:
    """False where one of the tool lists is not empty."""
    return ~any_of(F.coalesce(F.size(col(c)) > 0, F.lit(False)) for c in tool_columns)


def word_count(c) -> Column:
    return F.size(split_words(c))
