"""Declarative chat templates: how each turn of a conversation is written out before tokenisation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import col


@dataclass(frozen=True)
class ChatTemplate:
    """Text around the turns of a conversation.

    ``turns`` maps a role (or "*" for any role) to the text before and after its content, ``{Role}`` being the
    capitalised role; roles without an entry are left out. ``last`` replaces the text after the final turn, ``eos``
    is appended at the very end when no answer is to be generated, ``thinking`` says what remains of reasoning
    ("all", "cut" everywhere, or "cut_earlier" in all but the final turn). With ``tools`` a turn may offer functions or call them.
    """

    turns: dict[str, tuple[str, str]]
    generation: str = ""
    preamble: str = ""
    between: str = ""
    last: dict[str, str] = field(default_factory=dict)
    eos: str = ""
    system: str | None = None
    thinking: str = "all"
    tools: bool = False


# The texts of the named templates. EOS is the end-of-sequence token.
EOS = "<|endoftext|>"
REASONING_PREAMBLE = (
    "A conversation between User and Assistant. The user asks a question, and the Assistant solves it. The assistant "
    "first thinks about the reasoning process in the mind and then provides the user with the answer. The reasoning "
    "process and answer are enclosed within <think> </think> and <answer> </answer> tags, respectively, i.e., <think> "
    "reasoning process here </think> <answer> answer here </answer>.\n\n"
)
MATH_PREAMBLE = (
    "Solve the following problem step by step. The last line of your response should be the answer to the problem in "
    "form Answer: $Answer (without quotes) where $Answer is the answer to the problem.\n\n"
)
CODE_PREAMBLE = (
    "Solve the following code problem step by step. The last part of your response should be the solution to the "
    "problem in form ```\npython\nCODE\n``` where CODE is the solution for the problem.\n\n"
)
BOXED_REQUEST = (
    "You must put your answer inside <answer> </answer> tags, i.e., <answer> answer here </answer>. And your final "
    "answer will be extracted automatically by the \\boxed{} tag. This is the problem: "
)
TOOL_PREAMBLE = (
    "A conversation between User and Assistant. The User asks a question, and the Assistant solves it. The Assistant first thinks "
    "about the reasoning process in the mind and then provides the User with the answer. \n\n"
    "When given a question, the Assistant must conduct reasoning inside the <think> and </think> tags. During reasoning, the Assistant "
    "may write and execute python code using the <code> </code> tag, in order to solve the problem or verify the answer. Then the "
    "Assistant will get the stdout and stderr in the <output> and </output> tags. For example, the code could be\n"
    "<code>\nx, y = 1, 2\nresult = x + y\nprint(result)\n</code>\nor\n"
    "<code>\nimport sympy as sp\nfrom sympy import Symbol\nx = Symbol('x')\ny = Symbol('y')\n"
    "solution = sp.solve(x**2 + y**2 - 1, (x, y))\nprint(solution)\n</code>\n"
    "The Assistant will always `print` the result of the code execution in order to see it in the <output> tag. The Assistant may use "
    "the <code> </code> tag multiple times. When the Assistant is done reasoning, it should provide the answer inside the <answer> and "
    "</answer> tag.\n\n"
)
TAGGED = {"system": ("<|system|>\n", "\n"), "user": ("<|user|>\n", "\n"), "assistant": ("<|assistant|>\n", EOS + "\n")}
IM_NO_TOOLS = " You do not currently have access to any functions. <functions></functions><|im_end|>\n"
IM_TAGGED = {
    "system": ("<|im_start|>system\n", IM_NO_TOOLS), "user": ("<|im_start|>user\n", "<|im_end|>\n"),
    "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n"), "environment": ("<|im_start|>environment\n", "<|im_end|>\n"),
}
IM_SYSTEM = "<|im_start|>system\nYou are a helpful AI assistant.<|im_end|>\n"
IM_DATED_SYSTEM = "<|im_start|>system\nYou are a helpful AI assistant. Your date cutoff is December 2024.<|im_end|>\n"
IM_TOOL_SYSTEM = "<|im_start|>system\nYou are a helpful function-calling AI assistant." + IM_NO_TOOLS

TEMPLATES = {
    "concat_space": ChatTemplate({"*": ("", "")}, between=" ", eos=EOS),
    "concat_newline": ChatTemplate({"*": ("", "")}, between="\n", eos=EOS),
    "plain_chat": ChatTemplate({"*": ("{Role}: ", "")}, between="\n\n", eos=EOS),
    "assistant_only": ChatTemplate({"assistant": ("", "")}),
    "tagged_eos": ChatTemplate(
        {r: (f"<|{r}|>\n", EOS + "\n") for r in ("user", "system", "assistant")}, generation="<|assistant|>\n"
    ),
    "tagged": ChatTemplate(TAGGED, generation="<|assistant|>\n", last={"assistant": EOS}),
    "tagged_thinker": ChatTemplate(TAGGED, generation="<|assistant|>\n<think>", last={"assistant": EOS}),
    "tagged_thinker_cut": ChatTemplate(
        TAGGED, generation="<|assistant|>\n<think>", last={"assistant": EOS}, preamble=REASONING_PREAMBLE, thinking="cut"
    ),
    "im_tools": ChatTemplate(IM_TAGGED, generation="<|im_start|>assistant\n", last={"assistant": EOS}, system=IM_TOOL_SYSTEM, tools=True),
    "im": ChatTemplate(IM_TAGGED, generation="<|im_start|>assistant\n", last={"assistant": EOS}, system=IM_SYSTEM, tools=True),
    "im_sft": ChatTemplate(IM_TAGGED, generation="<|im_start|>assistant\n", last={"assistant": EOS}, system=IM_SYSTEM, tools=True),
    "im_dated": ChatTemplate(IM_TAGGED, generation="<|im_start|>assistant\n", last={"assistant": EOS}, system=IM_DATED_SYSTEM, tools=True),
    "im_thinker": ChatTemplate(IM_TAGGED, generation="<|im_start|>assistant\n<think>", last={"assistant": EOS}, system=IM_SYSTEM, tools=True),
    "im_thinker_cut_earlier": ChatTemplate(
        IM_TAGGED, generation="<|im_start|>assistant\n<think>", last={"assistant": EOS}, system=IM_SYSTEM, thinking="cut_earlier", tools=True
    ),
    "math_zero": ChatTemplate(
        {"*": ("", "\n")}, between="\n\n", preamble=MATH_PREAMBLE,
        generation='\nRemember to put your answer on its own line after "Answer:"',
    ),
    "code_zero": ChatTemplate(
        {"*": ("", "\n")}, between="\n\n", preamble=CODE_PREAMBLE,
        generation="\nRemember to put your solution inside the ```\npython\nCODE\n``` tags",
    ),
    "reasoning_chat": ChatTemplate({"*": ("{Role}: ", "\n")}, between="\n\n", preamble=REASONING_PREAMBLE, generation="Assistant:"),
    "reasoning_chat_think": ChatTemplate(
        {"*": ("{Role}: ", "\n")}, between="\n\n", preamble=REASONING_PREAMBLE, generation="Assistant: <think>"
    ),
    "reasoning_chat_tools": ChatTemplate(
        {"*": ("{Role}: " + BOXED_REQUEST, "\n")}, between="\n\n", preamble=TOOL_PREAMBLE, generation="Assistant: <think>"
    ),
    "reasoning_chat_boxed": ChatTemplate(
        {"*": ("{Role}: " + BOXED_REQUEST, "\n")}, between="\n\n", preamble=REASONING_PREAMBLE, generation="Assistant: <think>"
    ),
}


def _by_role(role: Column, values: dict[str, str], default: str | None) -> Column:
    out = F.lit(default).cast("string")
    for name, text in values.items():
        if name != "*":
            out = F.when(role == name, F.lit(text)).otherwise(out)
    return out


def segments(messages, template: ChatTemplate, generate: bool = False, tools: bool = False) -> Column:
    """The written form of each turn; null contents are empty. Joined, they are the conversation.

    Set ``tools`` for messages that have the fields functions and function_calls; only templates with tools write them.
    """
    m = col(messages)
    any_role = template.turns.get("*", (None, None))
    before = {r: b for r, (b, _) in template.turns.items()}
    after = {r: a for r, (_, a) in template.turns.items()}

    def content(x: Column, is_last: Column) -> Column:
        text = F.coalesce(x["content"], F.lit(""))
        if template.thinking == "all":
            return text
        rest = F.substring_index(text, "</think>", -1)
        if template.thinking == "cut":
            return F.when(x["role"] == "assistant", rest).otherwise(text)
        cut = ~is_last & text.contains("</think>") & text.contains("<think>") & (x["role"] == "assistant")
        return F.when(cut, F.ltrim(rest, F.lit("\n"))).otherwise(text)

    def write(x: Column, i: Column) -> Column:
        is_last = i == F.size(m) - 1
        head = _by_role(x["role"], before, any_role[0])
        if any("{Role}" in b for b in before.values()):
            role = F.concat(F.upper(F.substring(x["role"], 1, 1)), F.lower(F.substr(x["role"], F.lit(2))))
            head = F.replace(head, F.lit("{Role}"), role)
        tail = _by_role(x["role"], after, any_role[1])
        if template.last:
            tail = F.when(is_last, F.coalesce(_by_role(x["role"], template.last, None), tail)).otherwise(tail)
        text = content(x, is_last)
        if tools and template.tools:
            offered = F.concat(F.lit("<functions>"), x["functions"], F.lit("</functions><|im_end|>\n"))
            given = x["functions"].isNotNull()
            tail = F.when((x["role"] == "system") & given, F.concat(F.lit(" "), offered)).when((x["role"] == "user") & given, F.concat(F.lit("\n"), offered)).otherwise(tail)
            called = F.concat(F.lit("<function_calls>"), x["function_calls"], F.lit("</function_calls>"))
            text = F.concat(text, F.when(x["role"] == "assistant", F.coalesce(called, F.lit(""))).otherwise(F.lit("")))
        body = F.coalesce(F.concat(head, text, tail), F.lit(""))
        parts = [F.when((i > 0) & F.lit(bool(template.between)), F.lit(template.between)).otherwise(""), body]
        if template.eos and not generate:
            parts.append(F.when(is_last, F.lit(template.eos)).otherwise(""))
        return F.concat(*parts)

    return F.transform(m, write)


def opening(messages, template: ChatTemplate) -> Column:
    """Preamble and, without a system turn, the default system text."""
    if template.system is None:
        return F.lit(template.preamble)
    has = F.exists(col(messages), lambda x: x["role"] == "system")
    return F.when(has, F.lit(template.preamble)).otherwise(F.lit(template.preamble + template.system))


def render(messages, template: ChatTemplate, generate: bool = False, tools: bool = False) -> Column:
    text = F.concat(opening(messages, template), F.array_join(segments(messages, template, generate, tools), ""))
    return F.concat(text, F.lit(template.generation)) if generate else text
