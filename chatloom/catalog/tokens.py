"""Queries: tokenisation, masks, packing."""

from pyspark.sql import functions as F

from chatloom.catalog.data import marked_chats
from chatloom.catalog.registry import query
from chatloom.functions import tokens as T
from chatloom.functions.chat import chat_rows, flat
from chatloom.functions.templates import TEMPLATES, render
from chatloom.functions.text import hash_key
from chatloom.operators import packing as P
from chatloom.operators.nextfit import chunk_boundaries

TOK = r"regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"


def toks(c):
    return TOK.format(c=c)


def ids(c):
    return f"list_transform({toks(c)}, lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT % 50000)::INT)"


def csv(c):
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


EOS = "<|endoftext|>"
RENDER = f"""CASE role WHEN 'assistant' THEN '<|assistant|>' || chr(10) || text || '{EOS}' || CASE WHEN last THEN '' ELSE chr(10) END
   ELSE '<|' || role || '|>' || chr(10) || text || chr(10) END"""
SEGS = f"""(SELECT conv_id, turn, role, last, prev, {RENDER} AS seg FROM (SELECT *, lag(role) OVER w AS prev, lead(turn) OVER w IS NULL AS last
   FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)))"""


@query(
    "tk_counts",
    f"""SELECT conv_id, sum(len({toks('text')})) FILTER (role = 'user')::BIGINT AS prompt, sum(len({toks('text')})) FILTER (role = 'assistant')::BIGINT AS completion
        FROM conversations GROUP BY conv_id""",
)
def counts(t):
    # counted turn by turn: the conversation never has to be put together
    n = T.token_count("text").cast("long")
    return t.conversations.groupBy("conv_id").agg(
        F.sum(F.when(F.col("role") == "user", n)).alias("prompt"), F.sum(F.when(F.col("role") == "assistant", n)).alias("completion")
    )


@query(
    "tk_render_tagged",
    f"""SELECT conv_id, string_agg(seg, '' ORDER BY turn) AS text,
        string_agg(seg, '' ORDER BY turn) || '<|assistant|>' || chr(10) AS prompt FROM {SEGS} GROUP BY conv_id""",
)
def render_tagged(t):
    chats = chat_rows(t.conversations)
    tagged = TEMPLATES["tagged"]
    return chats.select("conv_id", render("messages", tagged).alias("text"), render("messages", tagged, generate=True).alias("prompt"))


@query(
    "tk_render_others",
    f"""SELECT conv_id, string_agg(text, ' ' ORDER BY turn) || '{EOS}' AS concat_space,
          string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) || chr(10) ORDER BY turn) || '{EOS}' AS plain_chat,
          coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS assistant_only,
          string_agg('<|' || role || '|>' || chr(10) || text || '{EOS}' || chr(10), '' ORDER BY turn) AS tagged_eos
        FROM conversations GROUP BY conv_id""",
)
def render_others(t):
    names = ["concat_space", "plain_chat", "assistant_only", "tagged_eos"]
    return chat_rows(t.conversations).select("conv_id", *[render("messages", TEMPLATES[n]).alias(n) for n in names])


IM = "<|im_start|>"
OFFER = "CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN concat('f', conv_id, '(x)') END"
CALL = "CASE WHEN conv_id % 4 = 0 THEN concat('f', turn, '(1)') END"


@query(
    "tk_render_tools",
    f"""WITH t AS (SELECT *, {OFFER} AS functions, {CALL} AS calls, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS last FROM conversations),
      s AS (SELECT conv_id, turn, role, '{IM}' || role || chr(10) || text || CASE role
        WHEN 'system' THEN CASE WHEN functions IS NULL THEN ' You do not currently have access to any functions. <functions></functions>' ELSE ' <functions>' || functions || '</functions>' END
        WHEN 'user' THEN CASE WHEN functions IS NULL THEN '' ELSE chr(10) || '<functions>' || functions || '</functions>' END
        ELSE coalesce('<function_calls>' || calls || '</function_calls>', '') END || CASE WHEN last AND role = 'assistant' THEN '{EOS}' ELSE '<|im_end|>' || chr(10) END AS seg FROM t)
      SELECT conv_id, CASE WHEN bool_or(role = 'system') THEN '' ELSE '{IM}system' || chr(10) || 'You are a helpful AI assistant. Your date cutoff is December 2024.<|im_end|>' || chr(10) END
        || string_agg(seg, '' ORDER BY turn) AS text FROM s GROUP BY conv_id""",
)
def render_tools(t):
    turn = F.struct("turn", "role", F.col("text").alias("content"), F.expr(OFFER).alias("functions"), F.expr(CALL).alias("function_calls"))
    chats = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("messages"))
    return chats.select("conv_id", render("messages", TEMPLATES["im_dated"], tools=True).alias("text"))


@query("tk_render_all")
def render_all(t):
    chats = marked_chats(t)
    every = F.array(*[F.struct(F.lit(n).alias("template"), render("messages", tpl, generate=True).alias("text")) for n, tpl in TEMPLATES.items()])
    return chats.select("conv_id", F.explode(every).alias("x")).select("conv_id", "x.template", F.md5("x.text").alias("digest"))


def mask_sql(rule, limit):
    # tokens of '<|assistant|>' with the newline: five
    return f"""WITH s AS (SELECT conv_id, turn, {ids('seg')} AS i, {rule} AS hidden FROM {SEGS}),
      f AS (SELECT conv_id, flatten(list(i ORDER BY turn))[:{limit}] AS input_ids,
              flatten(list([CASE WHEN j <= hidden THEN -100 ELSE i[j] END FOR j IN generate_series(1, len(i))] ORDER BY turn))[:{limit}] AS labels FROM s GROUP BY conv_id)
      SELECT conv_id, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels FROM f"""


def masked(t, mask, limit):
    chats = chat_rows(t.conversations)
    coded = chats.select("conv_id", T.masked_chat("messages", TEMPLATES["tagged"], limit, mask).alias("x"))
    return coded.select("conv_id", csv("x.input_ids").alias("input_ids"), csv("x.labels").alias("labels"))


@query("tk_mask_assistant", mask_sql("CASE WHEN role <> 'assistant' THEN 100000 WHEN prev <> 'assistant' THEN 5 ELSE 0 END", 300))
def mask_assistant(t):
    return masked(t, "assistant", 300)


@query("tk_mask_last", mask_sql("CASE WHEN NOT last THEN 100000 WHEN prev IS NOT NULL THEN 5 ELSE 0 END", 400))
def mask_last(t):
    return masked(t, "last", 400)


@query("tk_mask_prompt", mask_sql("CASE WHEN NOT last OR prev IS NULL THEN 100000 ELSE 5 END", 100000))
def mask_prompt(t):
    return masked(t, "prompt", 100000)


@query("tk_no_mask", mask_sql("0", 100000))
def mask_none(t):
    return masked(t, "none", 100000)


@query(
    "tk_preferences",
    f"""SELECT doc_id, len({toks("'<|user|>' || source || '<|assistant|>' || text || '" + EOS + "'")}) AS n_chosen,
          len({toks("text || '" + EOS + "'")}) AS chosen_trainable, len({toks("lang || '" + EOS + "'")}) AS rejected_trainable FROM documents""",
)
def preferences(t):
    from chatloom.operators.conversions import user_assistant

    pairs = t.documents.select(
        "doc_id", user_assistant("source", "text").alias("chosen"), user_assistant("source", "lang").alias("rejected")
    )
    tagged = TEMPLATES["tagged"]
    coded = pairs.select("doc_id", T.masked_chat("chosen", tagged, 2**31 - 1, "last").alias("c"), T.masked_chat("rejected", tagged, 2**31 - 1, "last").alias("r"))
    kept = coded.filter(T.has_labels("c.labels") & T.has_labels("r.labels"))
    return kept.select(
        "doc_id", F.size("c.input_ids").cast("long").alias("n_chosen"), T.trainable("c.labels").cast("long").alias("chosen_trainable"),
        T.trainable("r.labels").cast("long").alias("rejected_trainable"),
    )


@query(
    "fl_token_limit",
    f"SELECT doc_id FROM documents WHERE len({toks('text')}) <= 200",
)
def token_limit(t):
    return t.documents.filter(T.token_count("text") <= 200).select("doc_id")


@query(
    "fl_length_and_labels",
    f"""WITH s AS (SELECT conv_id, turn, role, last, len({toks('seg')}) AS n, (role = 'assistant')::INT AS a FROM {SEGS}),
      c AS (SELECT conv_id, sum(n) AS total, count(*) AS turns, sum(CASE WHEN NOT last THEN n ELSE 0 END) AS head, sum(a) AS a FROM s GROUP BY conv_id)
      SELECT conv_id FROM c WHERE total <= 600 AND CASE WHEN turns = 1 THEN total ELSE head END + 5 <= 500 AND a > 0""",
)
def length_labels(t):
    tagged = TEMPLATES["tagged"]
    rows = chat_rows(t.conversations).select(
        "conv_id", T.prompt_ids("messages", tagged).alias("prompt"), T.masked_chat("messages", tagged, 100000).alias("x")
    )
    return rows.filter(T.length_filter(F.col("prompt"), F.col("x.input_ids"), F.col("x.labels"), 500, 600)).select("conv_id")


def doc_tokens(t):
    words = T.word_ids(F.array("text"))
    return t.documents.select("doc_id", F.flatten(words).alias("ids"))


SHARD = 20_000
OFFSETS = f"""WITH d AS (SELECT doc_id, {ids('text')} AS ids, md5('42:' || doc_id) AS h FROM documents),
  o AS (SELECT doc_id, ids, len(ids) AS n, coalesce(sum(len(ids)) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM d),
  p AS (SELECT doc_id, ids, s, s + n AS e, unnest(generate_series(s // {SHARD}, (s + n - 1) // {SHARD})) AS shard FROM o WHERE n > 0),
  b AS (SELECT doc_id, shard, greatest(s - shard * {SHARD}, 0)::BIGINT AS "from", least(e - shard * {SHARD}, {SHARD})::BIGINT AS "to", greatest(shard * {SHARD} - s, 0) AS skip, ids FROM p)
"""


@query("tk_offsets", OFFSETS + 'SELECT doc_id, s AS start, s + n AS "end" FROM o')
def offsets(t):
    sizes = t.documents.select("doc_id", T.token_count("text").alias("n"))
    return P.document_offsets(sizes, hash_key("doc_id"), F.col("n")).select("doc_id", "start", "end")


@query("tk_shard_boundaries", OFFSETS + 'SELECT doc_id, shard, "from", "to" FROM b')
def boundaries(t):
    sizes = t.documents.select("doc_id", T.token_count("text").alias("n"))
    o = P.document_offsets(sizes, hash_key("doc_id"), F.col("n"))
    return P.shard_boundaries(o, SHARD, ["doc_id"]).drop("skip")


@query(
    "io_token_shards",
    OFFSETS + """SELECT shard, count(*) AS pieces, sum("to" - "from")::BIGINT AS n_tokens, sum(list_sum(ids[skip + 1:skip + "to" - "from"]))::BIGINT AS checksum FROM b GROUP BY shard""",
)
def shards(t):
    from chatloom.sources.sinks import read_token_shards, write_token_shards
    from chatloom.session import work_path

    rows = doc_tokens(t).withColumn("mask", F.transform("ids", lambda x: F.lit(True)))
    o = P.document_offsets(rows, hash_key("doc_id"), F.size("ids"))
    path = work_path(t.spark, "shards")
    write_token_shards(P.shard_pieces(o, SHARD, "doc_id", "ids", "mask"), path)
    back = read_token_shards(t.spark, path)
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    return back.groupBy("shard").agg(
        F.count(F.lit(1)).alias("pieces"), F.sum(F.size("tokens")).alias("n_tokens"), F.sum(total).alias("checksum")
    ).withColumn("shard", F.col("shard").cast("long"))


# Next-fit over all rows in hash order, one step a row.
NEXT_FIT = lambda rows, cap: f"""WITH RECURSIVE r AS ({rows}),
  f(i, used, pack) AS (SELECT i, n, 0 FROM r WHERE i = 1 UNION ALL
    SELECT r.i, CASE WHEN used + n > {cap} THEN n ELSE used + n END, CASE WHEN used + n > {cap} THEN pack + 1 ELSE pack END FROM f JOIN r ON r.i = f.i + 1)"""  # noqa: E731


@query(
    "tk_chunk_boundaries",
    NEXT_FIT(
        f"""SELECT n, sum(n) OVER (ORDER BY h) AS e, row_number() OVER (ORDER BY h) AS i
            FROM (SELECT len({toks('text')}) AS n, md5('42:' || doc_id) AS h FROM documents) WHERE n > 0""", 5000)
    + """ SELECT pack::BIGINT AS chunk, min(e - n)::BIGINT AS start, max(e)::BIGINT AS "end" FROM f JOIN r USING (i) GROUP BY pack""",
)
def chunks(t):
    sized = t.documents.select("doc_id", T.token_count("text").alias("size"))
    return chunk_boundaries(sized, hash_key("doc_id"), F.col("size"), 5000)


def packable(t):
    """All turns of a chat: the last one answers those before it."""
    coded = chat_rows(t.conversations).select("conv_id", T.word_ids(F.transform("messages", lambda m: m["content"])).alias("x"))
    rows = coded.select("conv_id", F.flatten(F.slice("x", F.lit(1), F.size("x") - 1)).alias("query"), F.element_at("x", -1).alias("response"))
    return rows.withColumn("mask", F.transform("response", lambda x: F.lit(1))).withColumn("logprobs", F.transform("response", lambda x: (-x / 50000).cast("float")))


PACKS = NEXT_FIT(
    f"""SELECT *, q + a AS n, row_number() OVER (ORDER BY md5('42:' || conv_id)) AS i FROM (
          SELECT conv_id, sum(len(x)) - arg_max(len(x), turn) AS q, arg_max(len(x), turn) AS a, flatten(list(x ORDER BY turn)) AS ids
          FROM (SELECT conv_id, turn, {ids('text')} AS x FROM conversations) GROUP BY conv_id)""", 900)


@query(
    "tk_packs",
    PACKS + """, p AS (SELECT *, row_number() OVER (PARTITION BY pack ORDER BY i) AS s FROM f JOIN r USING (i))
      SELECT pack::BIGINT AS pack, sum(n)::INT AS size, string_agg(n::BIGINT::VARCHAR, ',' ORDER BY i) AS lengths, string_agg(a::VARCHAR, ',' ORDER BY i) AS actions,
        md5(coalesce(string_agg(nullif(array_to_string(list_resize([]::INT[], n::BIGINT, s::INT), ','), ''), ',' ORDER BY i), '')) AS attention,
        md5(coalesce(string_agg(nullif(array_to_string(ids, ','), ''), ',' ORDER BY i), '')) AS ids,
        md5(coalesce(string_agg(nullif(array_to_string(list_concat(list_resize([]::INT[], q::BIGINT, 0), list_resize([]::INT[], a, i::INT)), ','), ''), ',' ORDER BY i), '')) AS response_mask,
        md5(coalesce(string_agg(nullif(array_to_string(list_concat(list_resize([]::INT[], greatest(n - 1, 0)::BIGINT, 0), CASE WHEN n > 0 THEN [i::INT] ELSE [] END), ','), ''), ',' ORDER BY i), '')) AS dones
      FROM p GROUP BY pack""",
)
def packs(t):
    p = P.pack(packable(t), 900, -1, hash_key("conv_id"))
    return p.select("pack", F.size("ids").alias("size"), csv("lengths").alias("lengths"), csv("num_actions").alias("actions"), *[F.md5(csv(c)).alias(c) for c in ("attention", "ids", "response_mask", "dones")])


@query(
    "tk_pack_efficiency",
    PACKS + """ SELECT count(DISTINCT pack) AS packs, count(*)::BIGINT AS sequences, round(sum(n) / (count(DISTINCT pack) * 900), 6)::DOUBLE AS efficiency FROM f JOIN r USING (i)""",
)
def efficiency(t):
    return P.pack_efficiency(P.pack(packable(t), 900, -1, hash_key("conv_id")), 900)


@query(
    "tk_padded_preferences",
    f"""WITH p AS (SELECT doc_id, doc_id // 8 AS batch, {ids('source')} AS c, {ids('text')} AS r FROM documents),
      m AS (SELECT *, max(greatest(len(c), len(r))) OVER (PARTITION BY batch) AS n FROM p)
      SELECT doc_id, batch, array_to_string(list_resize(c, n, 0), ',') AS chosen, array_to_string(list_resize(r, n, 0), ',') AS rejected FROM m""",
)
def padded(t):
    x = T.word_ids(F.array("source", F.col("text")))
    rows = t.documents.select("doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), x.alias("x")).select(
        "doc_id", "batch", F.col("x")[0].alias("chosen"), F.col("x")[1].alias("rejected")
    )
    return P.pad_preferences(rows, "batch", "chosen", "rejected", 0).select("doc_id", "batch", csv("chosen").alias("chosen"), csv("rejected").alias("rejected"))


@query(
    "tk_flat_batches",
    f"""WITH p AS (SELECT doc_id // 8 AS batch, doc_id, {ids('text')} AS i FROM documents),
      q AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY doc_id) - 1 AS s, sum(len(i)) OVER (PARTITION BY batch ORDER BY doc_id)::BIGINT AS c FROM p)
      SELECT batch, array_to_string(flatten(list(i ORDER BY doc_id)), ',') AS input_ids,
        array_to_string(flatten(list(list_concat(CASE WHEN len(i) > 0 THEN [-100] ELSE [] END, i[2:]) ORDER BY doc_id)), ',') AS labels,
        '0,' || string_agg(c::VARCHAR, ',' ORDER BY doc_id) AS cu_seq_lens, max(len(i))::INT AS max_length,
        array_to_string(flatten(list([j - 1 FOR j IN generate_series(1, len(i))] ORDER BY doc_id)), ',') AS position_ids,
        array_to_string(flatten(list([s FOR j IN i] ORDER BY doc_id)), ',') AS seq_idx FROM q GROUP BY batch""",
)
def flat_batches(t):
    x = T.word_ids(F.array(F.col("text")))[0]
    rows = t.documents.select("doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), x.alias("ids"))
    out = P.flatten_batch(rows, "batch", "doc_id", "ids", "ids")
    return out.select("batch", "max_length", *[csv(c).alias(c) for c in ("input_ids", "labels", "cu_seq_lens", "position_ids", "seq_idx")])


@query("tk_sentence_chunks")
def sentence_chunks(t):
    return t.documents.select("doc_id", F.posexplode(T.sentence_chunks("text", 120, 20)).alias("chunk", "text"))


@query(
    "tk_fits_context",
    f"""SELECT conv_id, sum(len({toks('text')}) + CASE role WHEN 'system' THEN 4 ELSE 3 END) + 200 + 100 <= 800 AS fits FROM conversations GROUP BY conv_id""",
)
def fits(t):
    return chat_rows(t.conversations).select("conv_id", T.fits_context("messages", 200, 800, 100).alias("fits"))


@query("tk_truncate_context")
def truncate(t):
    cut = T.with_judge_format(T.truncate_to_context("messages", 200, 500, 100))
    return chat_rows(t.conversations).select("conv_id", flat(cut).alias("chat"))
