"""Column expressions over ``messages ARRAY<STRUCT<role, content>>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import col, strip

MESSAGES_DDL = "array<struct<role:string,content:string>>"


def message(role, content) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), col(content).cast("string").alias("content"))


def user_assistant(prompt, answer) -> Column:
    return F.array(message("user", prompt), message("assistant", answer))


def no_messages() -> Column:
    return F.array().cast(MESSAGES_DDL)


def by_role(messages, role: str) -> Column:
    return F.filter(col(messages), lambda m: m["role"] == role)


def last_message(messages) -> Column:
    return F.try_element_at(col(messages), F.lit(-1))


def last_assistant(messages) -> Column:
    return F.try_element_at(by_role(messages, "assistant"), F.lit(-1))


def replace_last(messages, content: Column) -> Column:
    """The list with the content of its last message exchanged."""
    m = col(messages)
    return F.when(
        F.size(m) > 0,
        F.concat(
            F.slice(m, F.lit(1), F.size(m) - 1),
            F.array(F.struct(last_message(m)["role"].alias("role"), content.alias("content"))),
        ),
    ).otherwise(m)


def merge_same_role(messages, strip_content: bool = False) -> Column:
    """Join neighbours of equal role with a newline, inside the row: no shuffle, no window."""

    def step(acc, m):
        text = strip(m["content"]) if strip_content else m["content"]
        prev = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(prev["role"].alias("role"), F.concat(prev["content"], F.lit("\n"), text).alias("content"))
        own = F.struct(m["role"].alias("role"), text.alias("content"))
        return F.when(
            (F.size(acc) > 0) & prev["role"].eqNullSafe(m["role"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined)),
        ).otherwise(F.concat(acc, F.array(own)))

    return F.aggregate(col(messages), no_messages(), step)


def chat_rows(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turn table to chat rows. A conversation is one record, so its size is that of one row."""
    return (
        turns.groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(turn, role, text))).alias("t"))
        .select(
            key,
            F.transform("t", lambda x: F.struct(x[role].alias("role"), x[text].alias("content"))).alias("messages"),
        )
    )


def turn_rows(df: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """Chat rows to a turn table ``(key, turn, role, content)``."""
    return df.select(key, F.posexplode(messages).alias("turn", "m")).select(key, "turn", "m.role", "m.content")


def flat(messages) -> Column:
    """One string per conversation for reports and comparisons."""
    return F.array_join(F.transform(col(messages), lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
