"""Inputs derived from the given tables. One expression text serves both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.chat import chat_rows

# Turn texts with the phenomena the filters look for, spread over all rows by row number.
MARKED = """CASE (conv_id * 7 + turn * 3) % 29
 WHEN 0 THEN concat(text, ' I''m ChatGPT, an AI assistant made by OpenAI. Thanks.')
 WHEN 1 THEN concat(text, ' As of my last update in April 2023, it holds; knowledge cutoff 2021 too.')
 WHEN 2 THEN concat('答案是四十二 ', text)
 WHEN 3 THEN concat('<think>', text, '</think><answer>', text, '</answer>')
 WHEN 4 THEN concat('<think>', text, '</think> so ', text)
 WHEN 5 THEN concat(chr(10), '  ', chr(9))
 WHEN 6 THEN NULL
 WHEN 7 THEN concat('I am called Claude and that is it. ', text)
 WHEN 8 THEN concat(text, ' as a language model from the house of Anthropic I pause.')
 WHEN 9 THEN concat('import os', chr(10), 'def f(x): return (x[0]);', chr(10), text)
 WHEN 10 THEN concat('See https://example.org/', turn, ' or mail me@example.org, pay 12.50 or 1,300. ', text)
 WHEN 11 THEN concat('```python', chr(10), 'print(', conv_id, ')', chr(10), '``` then ', text)
 ELSE text END"""

MARKED_TURNS = f"(SELECT conv_id, turn, role, {MARKED} AS text FROM conversations)"
# A chat in the oracle: the ordered list of its turns.
MARKED_CHATS = f"(SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM {MARKED_TURNS} GROUP BY conv_id)"


def marked_turns(t):
    return t.conversations.select("conv_id", "turn", "role", F.expr(MARKED).alias("text"))


def marked_chats(t):
    return chat_rows(marked_turns(t))


# One prompt with several scored completions per model, out of the sales lines.
SAMPLES_SQL = """(SELECT l_partkey AS prompt, l_orderkey * 8 + l_linenumber AS sample, l_suppkey AS model,
                         l_quantity AS score, l_returnflag AS judge, l_linestatus AS finish FROM lineitem)"""


def samples(t):
    return t.lineitem.select(
        F.col("l_partkey").alias("prompt"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sample"),
        F.col("l_suppkey").alias("model"),
        F.col("l_quantity").alias("score"),
        F.col("l_returnflag").alias("judge"),
        F.col("l_linestatus").alias("finish"),
    )
