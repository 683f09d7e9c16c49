"""Queries: conversion of heterogeneous rows to chat rows."""

from pyspark.sql import functions as F

from chatloom.catalog.data import MARKED_CHATS, MARKED_TURNS, marked_chats, marked_turns
from chatloom.catalog.registry import query
from chatloom.functions.chat import chat_rows, flat, merge_same_role
from chatloom.operators import conversions as C
from chatloom.operators import trees

SENDERS = "CASE role WHEN 'user' THEN CASE WHEN turn % 3 = 0 THEN 'human' ELSE 'user' END WHEN 'assistant' THEN CASE WHEN turn % 2 = 1 THEN 'gpt' ELSE 'chatgpt' END ELSE role END"
# Roles that repeat, so that neighbours have to be merged.
BUNCHED = "CASE WHEN (conv_id + turn * turn) % 3 = 0 THEN 'user' ELSE 'assistant' END"
WS = "concat(' ', chr(9), chr(10), chr(13))"


def flat_sql(source, content="content", order="turn"):
    return f"SELECT conv_id, string_agg(role || ': ' || {content}, chr(10) ORDER BY {order}) AS chat FROM {source} GROUP BY conv_id"


def out(df, key="conv_id", messages="messages"):
    return df.select(key, flat(messages).alias("chat"))


def sent(t):
    turns = t.conversations.select("conv_id", "turn", F.expr(SENDERS).alias("from"), F.col("text").alias("value"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "from", "value"))).alias("conversations"))


@query(
    "cv_senders",
    "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM conversations GROUP BY conv_id",
)
def senders(t):
    return out(sent(t).select("conv_id", C.from_senders("conversations", unknown="keep").alias("messages")))


@query(
    "cv_senders_valid",
    """SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM conversations
       GROUP BY conv_id HAVING NOT bool_or(role IN ('system', 'bing'))""",
)
def senders_valid(t):
    rows = sent(t).filter(C.without_bot_system("conversations"))
    return out(rows.select("conv_id", C.from_senders("conversations").alias("messages")))


MERGE = f"""WITH r AS (SELECT conv_id, turn, {BUNCHED} AS role, {{c}} AS content FROM conversations),
  i AS (SELECT *, coalesce(lag(role) OVER w, '') <> role AS fresh FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  j AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM i),
  k AS (SELECT conv_id, island AS turn, any_value(role) AS role, string_agg(content, chr(10) ORDER BY turn) AS content FROM j GROUP BY conv_id, island)
  """ + flat_sql("k")


def bunched(t, content="text"):
    return chat_rows(t.conversations.select("conv_id", "turn", F.expr(BUNCHED).alias("role"), F.expr(content).alias("text")))


@query("cv_merge_turns", MERGE.format(c="text"))
def merge(t):
    return out(bunched(t).select("conv_id", merge_same_role("messages").alias("messages")))


@query("cv_merge_turns_stripped", MERGE.format(c=f"trim(concat('  ', text, chr(10)), {WS})"))
def merge_stripped(t):
    return out(bunched(t, "concat('  ', text, chr(10))").select("conv_id", merge_same_role("messages", True).alias("messages")))


TRANSCRIPT = "concat(chr(10), chr(10), CASE WHEN role = 'assistant' THEN 'Assistant: ' ELSE 'Human: ' END, text)"


def transcripts(t):
    # one transcript per conversation, put together in turn order
    rows = t.conversations.select("conv_id", "turn", F.expr(TRANSCRIPT).alias("s"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "s"))).alias("a")).select(
        "conv_id", F.array_join(F.transform("a", lambda x: x["s"]), "").alias("text")
    )


@query(
    "cv_transcript",
    f"""WITH r AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END AS role, trim(text, {WS}) AS content FROM conversations),
  i AS (SELECT *, coalesce(lag(role) OVER w, '') <> role AS fresh FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  j AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM i),
  k AS (SELECT conv_id, island AS turn, any_value(role) AS role, string_agg(content, chr(10) ORDER BY turn) AS content FROM j GROUP BY conv_id, island)
  """ + flat_sql("k"),
)
def transcript(t):
    return out(transcripts(t).select("conv_id", C.parse_transcript("text").alias("messages")))


@query(
    "cv_transcript_pairs",
    """SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM conversations
       WHERE conv_id IN (SELECT conv_id FROM (SELECT conv_id, CASE role WHEN 'assistant' THEN 'assistant' ELSE 'user' END AS r,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n, role FROM conversations)
          GROUP BY conv_id HAVING bool_and(role = CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END) AND any_value(n) % 2 = 0)
       GROUP BY conv_id""",
)
def transcript_pairs(t):
    alternating = chat_rows(t.conversations).filter(C.roles_alternate("messages") & (F.size("messages") % 2 == 0))
    texts = transcripts(t).join(alternating.select("conv_id"), "conv_id", "left_semi")
    cut = texts.select("conv_id", C.transcript_pairs("text").alias("messages"))
    return out(cut.filter(C.complete_chat("messages")))


@query("cv_by_columns", "SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || text AS chat FROM documents")
def by_columns(t):
    df = t.documents.select("doc_id", F.col("source").alias("prompt"), F.col("text").alias("completion"))
    return out(C.convert_by_columns(df), "doc_id")


@query(
    "cv_by_columns_instruction",
    """SELECT doc_id, 'user: Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.'
       || chr(10) || chr(10) || '### Instruction:' || chr(10) || source || chr(10) || chr(10) || '### Input:' || chr(10) || lang || chr(10) || chr(10) || '### Response:' || chr(10) || 'assistant: ' || text AS chat FROM documents""",
)
def by_columns_instruction(t):
    df = t.documents.select("doc_id", F.col("source").alias("instruction"), F.col("lang").alias("input"), F.col("text").alias("output"))
    return out(C.convert_by_columns(df), "doc_id")


@query(
    "cv_chosen_side",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || CASE WHEN doc_id % 3 = 1 THEN lang ELSE text END AS chat FROM documents""",
)
def chosen_side(t):
    df = t.documents.select("doc_id", "source", "lang", F.col("text").alias("b"), (F.col("doc_id") % 3).alias("label"))
    return out(df.select("doc_id", C.chosen_answer(F.col("label") == 1, "source", "lang", "b").alias("messages")), "doc_id")


@query(
    "cv_chosen_rank",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || CASE doc_id % 3 WHEN 1 THEN concat(text, ' ', lang) ELSE text END AS chat FROM documents""",
)
def chosen_rank(t):
    df = t.documents.select(
        "doc_id",
        F.concat(F.lit(" Human: "), "source", F.lit(" Assistant: ")).alias("prompt"),
        F.expr("array(struct(text AS answer, doc_id % 3 + 1 AS rank), struct(concat(text, ' ', lang) AS answer, doc_id % 3 AS rank))").alias("answers"),
    )
    return out(df.select("doc_id", C.chosen_by_rank("prompt", "answers").alias("messages")), "doc_id")


VOTE = {
    "both_equal": "conv_id % 5 = 0", "name": "CASE WHEN conv_id % 7 = 0 THEN NULL WHEN conv_id % 2 = 0 THEN 'm1' ELSE 'm2' END",
    "inc_a": "CASE conv_id % 4 WHEN 0 THEN true WHEN 1 THEN false END", "use_b": "CASE conv_id % 3 WHEN 0 THEN false WHEN 1 THEN true END",
}


@query(
    "cv_chosen_vote",
    f"""WITH c AS (SELECT conv_id, {VOTE['both_equal']} AS eq, {VOTE['name']} AS name, {VOTE['inc_a']} AS inc_a, {VOTE['use_b']} AS use_b FROM (SELECT DISTINCT conv_id FROM conversations)),
      s AS (SELECT conv_id, CASE WHEN eq THEN 'm1' ELSE name END AS w, inc_a, use_b FROM c),
      k AS (SELECT conv_id, w FROM s WHERE w IS NOT NULL AND NOT (w = 'm1' AND coalesce(inc_a, false)) AND NOT (w <> 'm1' AND NOT coalesce(use_b, true))),
      r AS (SELECT conv_id, turn, {BUNCHED} AS role, text AS content FROM conversations JOIN k USING (conv_id) WHERE w = 'm1'
            UNION ALL SELECT conv_id, -1, 'system', 'Be kind.' FROM k WHERE w = 'm1'
            UNION ALL SELECT conv_id, turn, role, text FROM conversations JOIN k USING (conv_id) WHERE w <> 'm1'),
      i AS (SELECT *, coalesce(lag(role) OVER w, '') <> role AS fresh FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
      j AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM i),
      m AS (SELECT conv_id, island AS turn, any_value(role) AS role, string_agg(content, chr(10) ORDER BY turn) AS content FROM j GROUP BY conv_id, island)
      """ + flat_sql("m"),
)
def chosen_vote(t):
    df = chat_rows(t.conversations).withColumnRenamed("messages", "conv_b").join(bunched(t).withColumnRenamed("messages", "conv_a"), "conv_id")
    df = df.select(
        "*", F.expr(VOTE["both_equal"]).alias("eq"), F.expr(VOTE["name"]).alias("name"), F.lit("m1").alias("model_a"),
        F.expr(VOTE["inc_a"]).alias("inc_a"), F.lit(None).cast("boolean").alias("none"), F.expr(VOTE["use_b"]).alias("use_b"),
        F.lit("  Be kind.\n").alias("sys_a"), F.lit("  ").alias("sys_b"),
    )
    sides = {
        "a": {"conversation": "conv_a", "system": "sys_a", "incorrect": "inc_a", "useful": "none"},
        "b": {"conversation": "conv_b", "system": "sys_b", "incorrect": "none", "useful": "use_b"},
    }
    got = df.select("conv_id", C.chosen_vote("eq", "name", "model_a", sides).alias("messages"))
    return out(got.filter(F.size("messages") > 0))


@query(
    "cv_safe",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || text AS chat FROM documents JOIN labels USING (doc_id)
       WHERE toxic = 0 AND source <> 'src3'""",
)
def safe(t):
    df = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "text", F.expr("CASE WHEN source = 'src3' THEN 'REDACTED' ELSE source END").alias("prompt"),
        F.expr("CASE toxic WHEN 0 THEN 'safe' ELSE 'unsafe' END").alias("label"),
    )
    got = df.select("doc_id", C.safe_response("prompt", "text", "label").alias("messages")).filter(F.size("messages") > 0)
    return out(got, "doc_id")


NAME = "CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE 'Xhosa' END"


@query(
    "cv_multilingual_chat",
    f"""SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'xh' ELSE '' END AS language,
          array_to_string([x.role || ': ' || x.content FOR x IN kept], chr(10)) AS chat
        FROM (SELECT conv_id, m, list_filter(m, lambda x: coalesce(x.content, '') <> '') AS kept FROM {MARKED_CHATS})
        WHERE conv_id % 11 <> 0 AND len(m) >= 2 AND list_sum([length(x.content) FOR x IN kept]) >= 50""",
)
def multilingual(t):
    df = marked_chats(t).select(
        "conv_id", "messages", (F.col("conv_id") % 11 == 0).alias("toxic"),
        F.expr("CASE conv_id % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'German' WHEN 2 THEN 'Xhosa' END").alias("name"),
    )
    got = df.select("conv_id", C.language_code("name").alias("language"), C.admit_chat("messages", "toxic").alias("messages"))
    return got.filter(F.size("messages") > 0).select("conv_id", "language", flat("messages").alias("chat"))


@query(
    "cv_fusion",
    """SELECT doc_id, lang AS language, 'user: ' || source || chr(10) || 'assistant: ' || text AS chat FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0""",
)
def fusion(t):
    df = t.documents.select(
        "doc_id", F.col("lang").alias("language_code"), F.expr("CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END").alias("prompt"),
        F.expr("named_struct('completion', CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END)").alias("Fusion"),
    )
    got = C.transform_source(df, C.fusion_chat("prompt", "Fusion"), {"language_code": "language"}, ["doc_id", "language"])
    return got.select("doc_id", "language", flat("messages").alias("chat"))


# A forest: every event answers the event with a third of its number; three roots in eight are kept.
NODES = """SELECT event_id AS message_id, CASE WHEN event_id < 40 THEN NULL ELSE event_id // 3 END AS parent_id,
   CASE WHEN event_id < 40 AND event_id % 4 = 3 THEN 'assistant' WHEN event_id < 40 THEN 'prompter'
        WHEN event_id % 2 = 0 THEN 'assistant' ELSE 'prompter' END AS role,
   event_type || ' ' || event_id AS text, CASE WHEN event_id % 2 = 0 THEN 'pt-BR' ELSE 'de' END AS lang,
   CASE WHEN event_id % 5 = 0 THEN NULL ELSE (event_id % 3)::INT END AS rank, round(value, 2) AS quality, event_id % 17 = 5 AS deleted FROM events"""


def nodes(t):
    sql = NODES.replace("//", "div").replace("(event_id % 3)::INT", "int(event_id % 3)").replace("FROM events", "")
    exprs = sql.replace("SELECT ", "", 1)
    df = t.events
    df.createOrReplaceTempView("chatloom_events")
    base = t.spark.sql(f"SELECT {exprs} FROM chatloom_events")
    return base.withColumn("labels", F.create_map(F.lit("q"), F.col("quality")))


@query(
    "cv_tree_best_path",
    f"""WITH RECURSIVE n AS ({NODES}),
      best AS (SELECT parent_id, arg_min(message_id, coalesce(rank, 999)::BIGINT * 100000000 + message_id) AS message_id FROM n WHERE parent_id IS NOT NULL GROUP BY parent_id),
      walk AS (SELECT message_id AS root, message_id AS tip, 1 AS depth FROM n WHERE parent_id IS NULL AND role = 'prompter'
               UNION ALL SELECT root, b.message_id, depth + 1 FROM walk JOIN best b ON b.parent_id = tip)
      SELECT root, split_part(any_value(r.lang), '-', 1) AS language,
        string_agg(CASE WHEN n.role = 'assistant' THEN 'assistant' ELSE 'user' END || ': ' || n.text, chr(10) ORDER BY depth) AS chat
      FROM walk JOIN n ON n.message_id = tip JOIN n r ON r.message_id = root GROUP BY root HAVING count(*) >= 2""",
)
def tree_best(t):
    return trees.best_paths(nodes(t)).select("root", "language", flat("messages").alias("chat"))


def paths_sql(top_k):
    cut = f"QUALIFY row_number() OVER (PARTITION BY parent_id ORDER BY quality DESC, message_id) <= {top_k}" if top_k else ""
    return f"""WITH RECURSIVE n AS ({NODES}), e AS (SELECT parent_id, message_id, role, text FROM n WHERE parent_id IS NOT NULL AND NOT deleted {cut}),
      walk AS (SELECT message_id AS root, message_id AS tip, role, CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END || ': ' || text AS chat FROM n WHERE parent_id IS NULL AND NOT deleted
               UNION ALL SELECT root, e.message_id, e.role, chat || chr(10) || CASE WHEN e.role = 'assistant' THEN 'assistant' ELSE 'user' END || ': ' || e.text FROM walk JOIN e ON e.parent_id = tip)
      SELECT root, tip, chat FROM walk WHERE role = 'assistant' AND tip NOT IN (SELECT parent_id FROM n WHERE parent_id IS NOT NULL)"""


@query("cv_tree_all_paths", paths_sql(None))
def tree_all(t):
    return trees.reply_paths(nodes(t)).select("root", "tip", flat("messages").alias("chat"))


@query("cv_tree_top_paths", paths_sql(2))
def tree_top(t):
    return trees.reply_paths(nodes(t), 2).select("root", "tip", flat("messages").alias("chat"))


@query("cv_split_budget")
def split_budget(t):
    chats = chat_rows(t.conversations.filter("role <> 'system'"))
    segments = C.split_by_budget("messages", 260, lambda m: C.word_count(m["content"]))
    rows = chats.select("conv_id", F.posexplode(segments).alias("segment", "messages"))
    return rows.filter(C.roles_alternate("messages")).select("conv_id", "segment", flat("messages").alias("chat"))


@query(
    "cv_placeholders",
    """SELECT conv_id, (CASE WHEN bool_or(role = 'system') THEN '' ELSE 'system: I am Loom.' || chr(10) END) ||
         string_agg(role || ': ' || replace(replace(text, 'the', 'Loom'), 'der', '2024'), chr(10) ORDER BY turn) AS chat
       FROM conversations GROUP BY conv_id""",
)
def placeholders(t):
    fill = C.fill_placeholders("messages", {"the": "Loom", "der": "2024"}, "I am the.")
    return out(chat_rows(t.conversations).select("conv_id", fill.alias("messages")))


@query(
    "cv_tags",
    "SELECT doc_id FROM documents WHERE source NOT IN ('src1', 'src2')",
)
def tags(t):
    df = t.documents.select(
        "doc_id", F.expr("CASE source WHEN 'src1' THEN array('x', 'LooM') WHEN 'src2' THEN array('no-tools') WHEN 'src3' THEN NULL ELSE array('other') END").alias("tags")
    )
    return df.filter(C.keep_by_tags("tags", ["loom", "no-tools"], {"loom": ["loom", "LooM"]})).select("doc_id")


@query(
    "cv_plain_text",
    f"""SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE 'System' END || ': ' ||
          replace(replace(replace(replace(text, '<think>', chr(10)), '</think>', ''), '<answer>', chr(10) || chr(10)), '</answer>', ''),
          chr(10) || chr(10) ORDER BY turn) AS text FROM {MARKED_TURNS} WHERE coalesce(text, '') <> '' GROUP BY conv_id""",
)
def plain_text(t):
    return marked_chats(t).select("conv_id", C.as_plain_text("messages").alias("text"))


A1 = "CASE WHEN contains(c, '</think>' || chr(10)) THEN c ELSE replace(c, '</think>', '</think>' || chr(10)) END"
LAST = f"(SELECT conv_id, list_last(m).content AS c FROM {MARKED_CHATS} WHERE list_last(m).content IS NOT NULL)"


@query(
    "cv_answer_tags",
    f"""WITH a AS (SELECT conv_id, c AS o, {A1} AS c FROM {LAST}),
        b AS (SELECT conv_id, o, CASE WHEN contains(c, '<answer>') THEN c ELSE replace(c, '</think>', '</think>' || chr(10) || '<answer>') END AS c FROM a),
        r AS (SELECT conv_id, trim(replace(replace(c, '<answer>', ''), '</answer>', ''), {WS}) AS c FROM {LAST})
        SELECT b.conv_id, CASE WHEN b.c LIKE '%</answer>' THEN b.c ELSE b.c || chr(10) || '</answer>' END AS added,
          CASE WHEN contains(r.c, '</think>' || chr(10)) THEN r.c ELSE replace(r.c, '</think>', '</think>' || chr(10)) END AS removed
        FROM b JOIN r USING (conv_id)""",
)
def answer_tags(t):
    chats = marked_chats(t)
    last = lambda m: F.element_at(m, -1)["content"]
    return chats.filter(F.element_at("messages", -1)["content"].isNotNull()).select(
        "conv_id", last(C.add_answer_tags("messages")).alias("added"), last(C.remove_answer_tags("messages")).alias("removed")
    )


@query(
    "cv_raw_prompt",
    """WITH c AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id),
       p AS (SELECT conv_id, CASE WHEN len(m) > 1 AND list_last(m).role = 'assistant' THEN m[:len(m) - 1] ELSE m END AS m FROM c)
       SELECT conv_id, array_to_string([x.role || ': ' || x.content FOR x IN m], chr(10)) AS prompt,
         'system: Be brief.' || coalesce(chr(10) || nullif(array_to_string([x.role || ': ' || x.content FOR x IN CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END], chr(10)), ''), '') AS overridden FROM p""",
)
def raw_prompt(t):
    return chat_rows(t.conversations).select(
        "conv_id", C.raw_prompt("messages").alias("prompt"), C.raw_prompt("messages", "Be brief.").alias("overridden")
    )


BOXED = """CASE doc_id % 4 WHEN 0 THEN concat(text, ' so \\boxed{', doc_id, '}') WHEN 1 THEN concat('\\boxed{1} and \\boxed{\\frac{', doc_id, '}{7}} end')
  WHEN 2 THEN concat('Sum #### ', doc_id, ' ') ELSE text END"""


@query(
    "cv_ground_truth",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN '\\frac{' || doc_id || '}{7}' END AS boxed,
         CASE doc_id % 4 WHEN 2 THEN doc_id::VARCHAR END AS hashed, to_json([lang, source]) AS labels FROM documents""",
)
def ground_truth(t):
    df = t.documents.select("doc_id", F.expr(BOXED.replace("\\", "\\\\")).alias("text"), "lang", "source")
    return df.select(
        "doc_id", C.last_boxed("text").alias("boxed"),
        F.when(F.col("text").contains("####"), C.answer_after_hashes("text")).alias("hashed"),
        F.to_json(F.array("lang", "source")).alias("labels"),
    )


@query(
    "cv_final_answer",
    f"""SELECT conv_id, turn, CASE WHEN regexp_matches(text, '(?s)<answer>.*?</answer>') THEN trim(regexp_extract(text, '(?s)<answer>(.*?)</answer>', 1), {WS})
          WHEN contains(text, '</think>') THEN trim(regexp_extract(text, '(?s)</think>(.*)', 1), {WS}) ELSE text END AS answer FROM {MARKED_TURNS}""",
)
def final_answer(t):
    return marked_turns(t).select("conv_id", "turn", C.final_answer("text").alias("answer"))


@query(
    "cv_last_user_query",
    f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN trim(text, {WS}) WHEN 1 THEN source ELSE text END AS query FROM documents""",
)
def user_query(t):
    text = """CASE doc_id % 3 WHEN 0 THEN concat('<|user|>\\nfirst\\n<|assistant|>\\n<think>a</think>\\n<|user|>\\n', text, '\\n<|assistant|>\\n<think>')
      WHEN 1 THEN concat('<|im_start|>user\\n', source, '\\n<functions>f</functions><|im_end|>\\n<|im_start|>assistant\\n<think>') ELSE text END"""
    return t.documents.select("doc_id", F.expr(text).alias("text")).select("doc_id", C.last_user_query("text").alias("query"))


@query(
    "cv_instruction",
    f"""SELECT doc_id, source || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN lang || chr(10) || chr(10) ELSE '' END AS prompt,
          trim(text, {WS}) || '</s>' AS completion,
          CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 4 < 1 THEN 'a' ELSE 'b' END AS template,
          source || chr(10) || chr(10) || 'Input:' || chr(10) || 'x' || chr(10) || 'Output:' || chr(10) || 'y' || chr(10) || chr(10) || 'Input:' || chr(10) || lang || chr(10) || 'Output:' || chr(10) AS few_shot
        FROM documents""",
)
def instruction(t):
    df = t.documents.withColumn("extra", F.expr("CASE WHEN doc_id % 2 = 0 THEN lang ELSE '  ' END"))
    prompt, completion = C.instruction_example("source", "extra", "text", "</s>")
    shots = F.array(F.struct(F.lit("x ").alias("input"), F.lit(" y").alias("output")))
    return df.select(
        "doc_id", prompt.alias("prompt"), completion.alias("completion"),
        C.weighted_template("doc_id", [("a", 1.0), ("b", 3.0)]).alias("template"),
        C.few_shot_prompt("source", shots, "lang").alias("few_shot"),
    )


@query(
    "cv_binary",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || lang AS chat, true AS label FROM documents
       UNION ALL SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || text, false FROM documents""",
)
def binary(t):
    pairs = t.documents.select(
        "doc_id", C.user_assistant("source", "lang").alias("chosen"), C.user_assistant("source", "text").alias("rejected")
    )
    return C.to_binary(pairs).select("doc_id", flat("messages").alias("chat"), "label")


@query(
    "cv_verified_to_chat",
    """SELECT doc_id, 'user: ' || source || chr(10) || 'assistant: ' || text AS chat FROM documents JOIN labels USING (doc_id) WHERE quality = 1""",
)
def verified(t):
    df = t.documents.join(t.labels, "doc_id").withColumn("truth", F.expr("CASE WHEN quality = 1 THEN lang END"))
    return out(C.verified_to_chat(df, "source", "text", ["source", "text", "truth"]), "doc_id")


@query(
    "cv_multiple_choice",
    """WITH c AS (SELECT page_id, list_sort([lower(url), 'b' || page_id, 'zz', 'h' || page_id]) AS l, 'b' || page_id AS good FROM pages)
       SELECT page_id, chr(64 + list_position(l, good)::INT) AS letter,
         'A: ' || l[1] || ', B: ' || l[2] || ', C: ' || l[3] || ', D: ' || l[4] AS choices FROM c""",
)
def choice(t):
    df = t.pages.select("page_id", F.lower("url").alias("u"), F.expr("concat('b', page_id)").alias("good"), F.lit("zz").alias("z"), F.expr("concat('h', page_id)").alias("h"))
    prompt, letter = C.multiple_choice(F.lit("Which?"), "good", ["u", "z", "h"])
    return df.select("page_id", letter.alias("letter"), F.substring_index(prompt, "Choices: ", -1).alias("choices"))


@query(
    "cv_specs",
    """SELECT 'positional' AS spec, conv_id AS id, string_agg(CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END || ': ' || text, chr(10) ORDER BY i) AS chat
       FROM (SELECT conv_id, text, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
       WHERE i <= n // 2 * 2 GROUP BY conv_id
       UNION ALL SELECT 'two_column', doc_id, 'system: ' || lang || chr(10) || 'user: ' || source || chr(10) || 'assistant: ' || text FROM documents WHERE source LIKE 'src1%'
       UNION ALL SELECT 'reasoning', doc_id, 'user: ' || source || chr(10) || 'assistant: <think>' || text || '</think><answer>' || lang || '</answer>' FROM documents
       UNION ALL SELECT 'append', conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) || chr(10) || 'assistant: done ' || conv_id FROM conversations GROUP BY conv_id""",
)
def specs(t):
    chats = chat_rows(t.conversations).withColumn("output", F.concat(F.lit("done "), "conv_id"))
    texts = chats.select(F.col("conv_id").alias("id"), F.transform("messages", lambda m: m["content"]).alias("data"))
    docs = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("question"), F.col("text").alias("answer"), "lang")
    runs = {
        "positional": (texts, {"kind": "positional", "column": "data", "keep": ["id"]}),
        "two_column": (docs, {"kind": "two_column", "columns": "question_answer", "system": "lang", "where": "question LIKE 'src1%'", "keep": ["id"]}),
        "reasoning": (docs, {"kind": "reasoning", "columns": ["question", "answer", "lang"], "keep": ["id"]}),
        "append": (chats.withColumnRenamed("conv_id", "id"), {"kind": "append", "column": "messages", "output": "output", "keep": ["id"]}),
    }
    parts = [C.convert_with_spec(df, spec).select(F.lit(name).alias("spec"), "id", flat("messages").alias("chat")) for name, (df, spec) in runs.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


@query(
    "cv_reasoning_marks",
    """SELECT doc_id, 'user: q' || chr(10) || 'assistant: <think>' || lang || '</think><answer>' || source || '</answer>' AS chat, source AS ground_truth FROM documents""",
)
def marks(t):
    body = F.concat(F.lit("<|reserved_special_token_246|>"), "lang", F.lit("<|reserved_special_token_247|>"), "source")
    df = t.documents.select("doc_id", C.reasoning_marks(C.user_assistant(F.lit("q"), body)).alias("m"))
    return df.select("doc_id", flat("m").alias("chat"), C.reasoning_answer("m").alias("ground_truth"))
