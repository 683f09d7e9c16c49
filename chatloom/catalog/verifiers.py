"""Queries: verifiers, reward combination, judge texts and constraint checks."""

import json

from pyspark.sql import functions as F

from chatloom.catalog.data import MARKED_TURNS, marked_turns
from chatloom.catalog.filters import sql_text
from chatloom.catalog.registry import ORACLES, query
from chatloom.catalog.statistics import detected
from chatloom.catalog.tokens import toks
from chatloom.functions import constraints as K
from chatloom.functions import verifiers as V

WS = "concat(' ', chr(9), chr(10), chr(13))"
PUNCT = sql_text(V.PUNCTUATION)


def normal(c):
    return f"list_filter(regexp_split_to_array(translate(lower({c}), {PUNCT}, ''), '\\s+'), lambda x: x NOT IN ('', 'a', 'an', 'the'))"


# --- rule verifiers --------------------------------------------------------------------------

# Predictions and labels derived from every document: numbers, tags and phrases around its text.
PRED = """CASE doc_id % 8
 WHEN 0 THEN concat('so 1,234 and then ', doc_id, ' or ', n_chars, '.5') WHEN 1 THEN concat(text, ' The answer is: The ', source, '!')
 WHEN 2 THEN concat('<think>', text, '</think><answer> ', lang, '</answer>') WHEN 3 THEN concat('<think>x</think>', text)
 WHEN 4 THEN concat('a <finish>', text, '</finish>') WHEN 5 THEN concat('a <FINISH> the ', source, ' </FINISH>')
 ELSE text END"""
LABEL = """CASE doc_id % 8 WHEN 0 THEN concat(n_chars, '.', CASE WHEN doc_id % 3 = 0 THEN 4 ELSE 5 END) WHEN 1 THEN source WHEN 2 THEN CASE WHEN doc_id % 3 = 0 THEN 'xx' ELSE upper(lang) END
 WHEN 3 THEN concat(source, ' ', substr(text, 10)) WHEN 4 THEN concat('["', lang, '", "', regexp_replace(text, '["\\n\\\\]', 'x'{g}), '"]') WHEN 5 THEN source ELSE concat(doc_id % 300, '') END"""
KIND = "CASE doc_id % 8 WHEN 0 THEN 'gsm8k' WHEN 1 THEN 'flan' WHEN 2 THEN 'string_matcher' WHEN 3 THEN CASE WHEN doc_id % 2 = 1 THEN 'string_f1' END WHEN 4 THEN 're_search_f1' WHEN 5 THEN 're_search' WHEN 6 THEN 'max_length' ELSE 'up_to_max_length' END"


def cases(t):
    return t.documents.select(
        "doc_id", F.expr(PRED).alias("prediction"), F.expr(LABEL.replace("{g}", "").replace("\\n\\\\", "\\\\n\\\\\\\\")).alias("label"), F.expr(KIND).alias("verifier")
    )


NUMBER = "list_last(regexp_extract_all(regexp_replace(p, '(\\d),(\\d)', '\\1\\2', 'g'), '[-+]?\\d*\\.\\d+|\\d+'))"
F1 = """CASE WHEN same = 0 THEN 0 ELSE 2 * (same / np::DOUBLE) * (same / ng::DOUBLE) / (same / np::DOUBLE + same / ng::DOUBLE) END"""


def overlap(p, g):
    counted = lambda tokens: f"(SELECT w, count(*) AS n FROM (SELECT unnest({tokens}) AS w) GROUP BY w)"
    return f"(SELECT sum(least(a.n, b.n)) FROM {counted(p)} a JOIN {counted(g)} b USING (w))"


def f1_sql(p, g):
    return f"(SELECT {F1} FROM (SELECT coalesce({overlap(p, g)}, 0) AS same, len({p}) AS np, len({g}) AS ng))"


@query(
    "vf_scores",
    f"""WITH c AS (SELECT doc_id, {PRED} AS p, {LABEL.replace('{g}', ", 'g'").replace("'[\"", "'[\"")} AS l, {KIND} AS v FROM documents),
      n AS (SELECT *, regexp_extract(p, '(?is)<finish>(.*?)</finish>', 1) AS fin FROM c)
      SELECT doc_id, v AS verifier, round(CASE v WHEN 'gsm8k' THEN (lower({NUMBER}) = lower(l))::INT
        WHEN 'flan' THEN ({normal("list_last(string_split(p, 'The answer is: '))")} = {normal('l')})::INT
        WHEN 'string_matcher' THEN ({normal("split_part(split_part(p, '<answer>', 2), '</answer>', 1)")} = {normal('l')})::INT
        WHEN 'string_f1' THEN {f1_sql(normal("split_part(p, '</think>', 2)"), normal('l'))}
        WHEN 're_search_f1' THEN greatest(0.1, {f1_sql(normal('fin'), normal("(CASE WHEN v = 're_search_f1' THEN l::JSON->>0 END)"))}, {f1_sql(normal('fin'), normal("(CASE WHEN v = 're_search_f1' THEN l::JSON->>1 END)"))})
        WHEN 're_search' THEN ({normal('fin')} = {normal('l')})::INT
        WHEN 'max_length' THEN 1 - abs(len({toks('p')}) - try_cast(l AS DOUBLE)) / 4096
        WHEN 'up_to_max_length' THEN CASE WHEN len({toks('p')}) < try_cast(l AS DOUBLE) THEN 1 ELSE 1 - (len({toks('p')}) - try_cast(l AS DOUBLE)) / 4096 END END::DOUBLE, 6) AS score
      FROM n WHERE v IS NOT NULL""",
)
def scores(t):
    c = cases(t).filter("verifier IS NOT NULL")
    return c.select("doc_id", "verifier", F.round(V.score("verifier", "prediction", "label", V.verifiers(instructions=False)), 6).alias("score"))


@query(
    "vf_thought_match",
    f"""SELECT doc_id, ({normal("CASE WHEN contains(p, '</think>') THEN replace(replace(split_part(p, '</think>', 2), '<answer>', ''), '</answer>', '') ELSE replace(replace(p, '<answer>', ''), '</answer>', '') END")} = {normal('lang')})::INT::DOUBLE AS score
        FROM (SELECT doc_id, lang, {PRED} AS p FROM documents)""",
)
def thought(t):
    d = t.documents.select("doc_id", "lang", F.expr(PRED).alias("p"))
    return d.select("doc_id", V.thought_answer_match("p", "lang").alias("score"))


@query(
    "vf_format",
    f"""SELECT conv_id, turn, regexp_matches(text, '(?s)\\A.*?</think>\\s*<answer>.*?</answer>')::INT::DOUBLE AS score,
          coalesce(trim(list_last(regexp_extract_all(text, '(?s)```(?:python)?(.*?)```', 1)), {WS}), text) AS code FROM {MARKED_TURNS} WHERE text IS NOT NULL""",
)
def fmt(t):
    return marked_turns(t).filter("text IS NOT NULL").select("conv_id", "turn", V.format_score("text").alias("score"), V.last_code_block("text").alias("code"))


# Each document becomes a small problem whose answer is its number, written in one of seven ways.
MATH = r"""CASE doc_id % 7 WHEN 0 THEN concat('so \boxed{', doc_id, '}') WHEN 1 THEN concat('We get $x$ and $', doc_id, '$ done') WHEN 2 THEN concat('Final Answer: The final answer is $', doc_id, '$. I hope it is correct.')
 WHEN 3 THEN concat('\boxed{\frac', doc_id % 9 + 1, '7}') WHEN 4 THEN concat('x = ', doc_id, ' meters') WHEN 5 THEN concat('\boxed{', doc_id % 9 + 1, '/7}') ELSE 'I cannot tell' END"""
MATH_LABEL = r"""CASE WHEN doc_id % 7 IN (3, 5) THEN concat('\dfrac{', doc_id % 9 + 1, '}{7}') ELSE concat(doc_id, '') END"""


@query(
    "vf_math",
    "SELECT doc_id, (doc_id % 7 <> 6)::INT::DOUBLE AS score, (doc_id % 7 IN (2, 3, 4, 5))::INT::DOUBLE AS strict FROM documents",
)
def math(t):
    d = t.documents.select("doc_id", F.expr(MATH.replace("\\", "\\\\")).alias("p"), F.expr(MATH_LABEL.replace("\\", "\\\\")).alias("l"))
    return d.select("doc_id", V.math_match("p", "l").alias("score"), V.strict_math_match("p", "l").alias("strict"))


JUDGE = """CASE doc_id % 8 WHEN 0 THEN concat('I give ', doc_id % 5, '/5') WHEN 1 THEN concat('about ', doc_id % 100, '.5% ok') WHEN 2 THEN concat('score ', doc_id % 10, '.25') WHEN 3 THEN 'Yes, it is'
  WHEN 4 THEN 'wrong' WHEN 5 THEN 'Final Decision: YES' WHEN 6 THEN concat('```json', chr(10), '{"REASONING": "a b", "SCORE": "', doc_id % 11, '"}', chr(10), '```') ELSE concat('broken "SCORE": ', doc_id % 7, '.5 end') END"""


@query(
    "vf_judge_texts",
    """SELECT doc_id, round(CASE doc_id % 8 WHEN 0 THEN (doc_id % 5) / 5.0::DOUBLE WHEN 1 THEN (doc_id % 100 + 0.5) / 100 WHEN 2 THEN doc_id % 10 + 0.25 WHEN 3 THEN 1 WHEN 4 THEN 0 WHEN 5 THEN 1 WHEN 6 THEN doc_id % 11 ELSE doc_id % 7 + 0.5 END::DOUBLE, 6) AS number,
         (doc_id % 8 = 5)::INT::DOUBLE AS decision, round(CASE doc_id % 8 WHEN 6 THEN (doc_id % 11) / 10.0::DOUBLE WHEN 7 THEN (doc_id % 7 + 0.5) / 10 ELSE 0 END::DOUBLE, 6) AS json FROM documents""",
)
def judge(t):
    d = t.documents.select("doc_id", F.expr(JUDGE).alias("j"))
    number = F.when(F.col("doc_id") % 8 == 5, V.judge_number(F.lit("yes"))).otherwise(V.judge_number("j"))
    return d.select("doc_id", F.round(number, 6).alias("number"), V.judge_decision("j").alias("decision"), F.round(V.judge_json("j", 10.0), 6).alias("json"))


def responses(t):
    return cases(t).filter("verifier IN ('gsm8k', 'flan', 'string_matcher')").select(
        "doc_id", "prediction", F.array("label", "label", "label").alias("labels"), F.array(F.col("verifier"), F.lit("gsm8k"), F.lit("unknown")).alias("datasets"),
        (F.col("doc_id") % 5 != 0).alias("good"), F.when(F.col("doc_id") % 4 == 0, "length").otherwise("stop").alias("finish"),
    )


REWARD = f"""WITH c AS (SELECT doc_id, {PRED} AS p, {LABEL.replace('{g}', ", 'g'")} AS l, {KIND} AS v FROM documents),
  s AS (SELECT doc_id, p, v, CASE v WHEN 'gsm8k' THEN (lower({NUMBER}) = lower(l))::INT WHEN 'flan' THEN ({normal("list_last(string_split(p, 'The answer is: '))")} = {normal('l')})::INT
     ELSE ({normal("split_part(split_part(p, '<answer>', 2), '</answer>', 1)")} = {normal('l')})::INT END AS s1, (lower(coalesce({NUMBER}, p)) = lower(l))::INT AS s2,
     regexp_matches(p, '(?s)\\A.*?</think>\\s*<answer>.*?</answer>') AS f FROM c WHERE v IN ('gsm8k', 'flan', 'string_matcher')),
  r AS (SELECT *, 10 * (CASE v WHEN 'gsm8k' THEN 2 ELSE 1 END * s1 + 2 * s2)::DOUBLE AS verified FROM s)
"""


@query(
    "vf_rewards",
    REWARD + "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN -10 WHEN doc_id % 5 <> 0 THEN verified + f::INT ELSE f::INT END::DOUBLE AS reward FROM r",
)
def rewards(t):
    out, _ = V.combine_rewards(responses(t), "doc_id", "prediction", "labels", "datasets", {"gsm8k": 2.0}, registry=V.verifiers(instructions=False), use_format=True, additive=True, good="good", finish="finish")
    return out.select("doc_id", "reward")


@query("vf_rewards_gated", REWARD + "SELECT doc_id, CASE WHEN f THEN verified ELSE 0 END::DOUBLE AS reward FROM r")
def rewards_gated(t):
    out, _ = V.combine_rewards(responses(t), "doc_id", "prediction", "labels", "datasets", {"gsm8k": 2.0}, registry=V.verifiers(instructions=False), use_format=True)
    return out.select("doc_id", "reward")


@query(
    "vf_reward_report",
    REWARD + """, u AS (SELECT doc_id, v AS verifier, 10 * CASE v WHEN 'gsm8k' THEN 2 ELSE 1 END * s1 AS x FROM r UNION ALL SELECT doc_id, 'gsm8k', 20 * s2 FROM r),
      w AS (SELECT doc_id, verifier, sum(x) AS x FROM u GROUP BY ALL)
      SELECT verifier, round(avg(x)::DOUBLE, 6) AS reward, round(avg((x > 0)::INT), 6) AS correct_rate FROM w GROUP BY verifier""",
)
def reward_report(t):
    _, report = V.combine_rewards(responses(t), "doc_id", "prediction", "labels", "datasets", {"gsm8k": 2.0}, registry=V.verifiers(instructions=False))
    return report.select("verifier", F.round("reward", 6).alias("reward"), F.round("correct_rate", 6).alias("correct_rate"))


@query(
    "vf_reward_metrics",
    REWARD + """SELECT round(avg(verified), 6) AS verifiable_reward, round(avg((verified > 0)::INT), 6) AS verifiable_correct_rate, round(avg(f::INT), 6) AS format_score,
        round(avg(CASE WHEN f THEN verified ELSE 0 END), 6) AS reward FROM r""",
)
def reward_metrics(t):
    out, _ = V.combine_rewards(responses(t), "doc_id", "prediction", "labels", "datasets", {"gsm8k": 2.0}, registry=V.verifiers(instructions=False), use_format=True)
    return V.reward_metrics(out).select(*[F.round(c, 6).alias(c) for c in ("verifiable_reward", "verifiable_correct_rate", "format_score", "reward")])


# --- constraints -----------------------------------------------------------------------------

WORDS = r"regexp_extract_all(lower(t), '[\p{L}\p{N}_]+')"
SPLIT = "list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')"
LINES = "string_split(t, chr(10))"
STRIPPED = f"trim(t, {WS})"
# (function, arguments, the same rule in SQL over the text t)
SIMPLE = [
    ("verify_keywords", {"keyword_list": ["THE", "on"]}, "contains(lower(t), 'the') AND contains(lower(t), 'on')"),
    ("verify_keyword_frequency", {"word": "The", "N": ["2"]}, f"len(list_filter({WORDS}, lambda x: x = 'the')) = 2"),
    ("validate_forbidden_words", {"forbidden_words": ["Und", "les"]}, "NOT contains(lower(t), 'und') AND NOT contains(lower(t), 'les')"),
    ("verify_letter_frequency", {"letter": "e", "N": ["12"]}, "length(t) - length(replace(t, 'e', '')) = 12"),
    ("verify_paragraph_count", {"N": ["1"]}, f"NOT contains(t, '* * *') AND {STRIPPED} <> ''"),
    ("validate_word_constraint", {"N": ["25"], "quantifier": "around"}, f"abs(len({SPLIT}) - 25) <= 2"),
    ("verify_sentence_constraint", {"N": ["1"], "quantifier": "at least"}, "true"),
    ("validate_paragraphs", {"N": ["1"], "first_word": "E", "i": ["1"]}, f"NOT contains(t, chr(10) || chr(10)) AND {STRIPPED} LIKE 'E%'"),
    ("verify_postscript", {"postscript_marker": "the"}, f"contains(t, 'the') AND length(trim(substr(t, instr(t, 'the')), {WS})) > 3"),
    ("validate_placeholders", {"N": ["1"]}, "len(regexp_extract_all(t, '\\[(.*?)\\]')) >= 1"),
    ("verify_bullet_points", {"N": ["0"]}, f"len(list_filter({LINES}, lambda x: trim(x, {WS})[1] IN ('*', '-'))) = 0"),
    ("validate_title", {}, "regexp_matches(t, '<<(.*?)>>')"),
    ("validate_choice", {"options": ["Yes.", "No."]}, "contains('Yes.', t) OR contains('No.', t)"),
    ("validate_choice_in_text", {"options": ["ing", "ung"]}, "contains(t, 'ing') OR contains(t, 'ung')"),
    ("validate_highlighted_sections", {"N": ["1"]}, "len(regexp_extract_all(t, '\\*(.*?)\\*')) >= 1"),
    ("validate_sections", {"N": ["3"], "section_splitter": ". "}, "len(string_split(t, '. ')) - (t LIKE '. %')::INT = 3"),
    ("validate_json_format", {}, "json_valid(t)"),
    ("validate_repeat_prompt", {"original_prompt": "See "}, "starts_with(t, 'See ')"),
    ("validate_two_responses", {}, "false"),
    ("validate_uppercase", {}, "t = upper(t)"),
    ("validate_lowercase", {}, "t = lower(t)"),
    ("validate_frequency_capital_words", {"N": ["1"], "quantifier": "at most"}, r"len(list_filter(regexp_extract_all(t, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Z]+'))) <= 1"),
    ("validate_end", {"end_phrase": "."}, "t LIKE '%.'"),
    ("validate_quotation", {}, "t LIKE '\"%\"'"),
    ("validate_no_commas", {}, "NOT contains(t, ',')"),
]
STARS = "list_transform(regexp_split_to_array(t, '\\s?\\*\\*\\*\\s?'), lambda x: trim(x, " + WS + "))"
TOKENS = toks("t")
KEYED = [
    ("keywords:existence", {"keywords": ["the", "o[nr]"]}, "regexp_matches(t, '(?i)the') AND regexp_matches(t, '(?i)o[nr]')"),
    ("keywords:frequency", {"keyword": "en", "frequency": ["6"], "relation": "less than"}, "len(regexp_extract_all(t, '(?i)en')) < 6"),
    ("keywords:letter_frequency", {"letter": "a", "let_frequency": ["9"], "let_relation": "at least"}, "length(t) - length(replace(lower(t), 'a', '')) >= 9"),
    ("length_constraints:number_paragraphs", {"num_paragraphs": ["1"]}, f"NOT contains(t, '***') AND {STRIPPED} <> ''"),
    ("length_constraints:number_words", {"num_words": ["40"], "relation": "at least"}, r"len(regexp_extract_all(t, '[\p{L}\p{N}_]+')) >= 40"),
    ("detectable_content:number_placeholders", {"num_placeholders": ["1"]}, "len(regexp_extract_all(t, '\\[.*?\\]')) >= 1"),
    ("detectable_format:number_bullet_lists", {"num_bullets": ["0"]}, "NOT regexp_matches(t, '(?m)^\\s*\\*[^\\*].*$') AND NOT regexp_matches(t, '(?m)^\\s*-.*$')"),
    ("detectable_format:constrained_response", {}, "contains(t, 'My answer is yes.') OR contains(t, 'My answer is no.') OR contains(t, 'My answer is maybe.')"),
    ("detectable_format:number_highlighted_sections", {"num_highlights": ["1"]}, "false"),
    ("detectable_format:multiple_sections", {"section_spliter": "last", "num_sections": ["1"]}, "regexp_matches(t, '\\s?last\\s?\\d+\\s?')"),
    ("detectable_format:json_format", {}, "json_valid(t)"),
    ("detectable_format:title", {}, "regexp_matches(t, '<<[^\\n]+>>')"),
    ("combination:two_responses", {}, "false"),
    ("combination:repeat_prompt", {"prompt_to_repeat": " SEE https"}, f"starts_with(lower({STRIPPED}), 'see https')"),
    ("startend:end_checker", {"end_phrase": " I PAUSE. "}, f"ends_with(lower({STRIPPED}), 'i pause.')"),
    ("change_case:capital_word_frequency", {"capital_frequency": ["2"], "capital_relation": "at least"}, f"len(list_filter({TOKENS}, lambda x: x = upper(x) AND x <> lower(x))) >= 2"),
    ("punctuation:no_comma", {}, "NOT contains(t, ',')"),
    ("startend:quotation", {}, "false"),
    ("copy:copy", {"prompt_to_repeat": "x"}, f"lower({STRIPPED}) = 'x'"),
    ("keywords:word_once", {"keyword": "https"}, "len(regexp_extract_all(t, '(?i)https')) = 1"),
    ("keywords:word_count_different_numbers", {"keyword": "on", "frequency": ["3"], "relation": "at least"}, "len(regexp_extract_all(t, '(?i)on')) >= 3"),
    ("keywords:exclude_word_harder", {"keyword": "the"}, "NOT contains(t, ' the ')"),
    ("keywords:no_adjacent_consecutive", {}, f"len([1 FOR i IN generate_series(1, len({SPLIT}) - 1) IF unicode(lower({SPLIT}[i + 1])) - unicode(lower({SPLIT}[i])) = 1]) = 0"),
    ("detectable_format:square_brackets", {}, f"len(list_filter({SPLIT}, lambda x: NOT (x LIKE '[%' AND x LIKE '%]'))) = 0"),
    ("paragraphs:paragraphs", {}, "false"),
    ("paragraphs:paragraphs2", {}, "false"),
    ("first_word:first_word_answer", {"first_word": "see"}, f"coalesce(lower({SPLIT}[1]) = 'see', false)"),
    ("last_word:last_word_answer", {"last_word": "thanks"}, f"coalesce(regexp_replace(lower({SPLIT}[-1]), '[^\\w\\s]', '', 'g') = 'thanks', false)"),
    ("detectable_format:bigram_wrapping", {}, f"len({SPLIT}) < 2"),
    ("copy:copying_multiple", {"prompt_to_repeat": "x", "N": ["2"]}, "false"),
    ("punctuation:punctuation_dot", {}, "NOT contains(t, '.')"),
    ("punctuation:punctuation_exclamation", {}, "NOT contains(t, '!')"),
    ("count:lowercase_counting", {"N": ["20"]}, r"len(list_filter(regexp_extract_all(t, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-z]+'))) <= 20"),
    ("letters:letter_counting", {"N": ["100"], "relation": "less than"}, "len(regexp_extract_all(t, '[a-zA-Z]')) < 100"),
    ("letters:letter_counting2", {"letter": "Z", "let_frequency": ["1"], "let_relation": "less than"}, "NOT contains(lower(t), 'z')"),
    ("count:count_unique", {}, f"len({TOKENS}) = len(list_distinct({TOKENS}))"),
    ("count:count_increment_word", {"keyword1": "https", "keyword2": "me"}, "len(regexp_extract_all(t, '(?i)https')) = 1 AND len(regexp_extract_all(t, '(?i)me')) = 2"),
    ("keywords:palindrome", {}, f"len(list_filter({SPLIT}, lambda x: x = reverse(x))) > 0"),
    ("keywords:start_end", {}, f"len({TOKENS}) >= 2 AND lower({TOKENS}[1]) = lower({TOKENS}[-1])"),
]
REST = [
    ("keywords:forbidden_words", {"forbidden_words": ["the", "openai"]}), ("language:response_language", {"language": "en"}),
    ("length_constraints:number_sentences", {"num_sentences": ["5"], "relation": "less than"}),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": ["1"], "nth_paragraph": ["1"], "first_word": "see"}),
    ("detectable_content:postscript", {"postscript_marker": "P.S."}), ("change_case:english_capital", {}), ("change_case:english_lowercase", {}),
    ("copy:repeat_phrase", {"phrase": "I am called Claude and", "small_n": ["1"]}), ("new:copy_span_idx", {"prompt_to_repeat": "abcdef", "n_start": ["1"], "n_end": ["3"]}),
    ("detectable_format:sentence_hyphens", {}), ("first_word:first_word_sent", {"first_word": "See"}), ("last_word:last_word_sent", {"last_word": "on"}),
    ("copy:copying_simple", {"prompt_to_repeat": "x"}), ("count:counting_composition", {"n_sent": ["1"], "n_words": ["2"]}),
    ("keywords:keyword_specific_position", {"keyword": "https", "n": ["1"], "m": ["2"]}),
]


def arguments(args):
    as_list = lambda v: v if isinstance(v, list) else [v]
    ddl = "map<string,array<string>>"
    if not args:
        return F.create_map().cast(ddl)
    return F.create_map(*[x for k, v in args.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in as_list(v)]))]).cast(ddl)


def checked(t, specs, family):
    turns = marked_turns(t).filter("role = 'assistant' AND text IS NOT NULL")
    table = F.array(*[F.struct(F.lit(s[0]).alias("kind"), arguments(s[1]).alias("args")) for s in specs])
    rows = turns.select("conv_id", "turn", "text", F.explode(table).alias("c"))
    return rows.select("conv_id", "turn", F.col("c.kind").alias("kind"), K.check("c.kind", "text", "c.args", family).alias("satisfied"))


def checked_sql(specs):
    parts = [f"SELECT conv_id, turn, '{s[0]}' AS kind, coalesce({s[2]}, false) AS satisfied FROM a" for s in specs]
    return f"WITH a AS (SELECT conv_id, turn, text AS t FROM {MARKED_TURNS} WHERE role = 'assistant' AND text IS NOT NULL) " + " UNION ALL ".join(parts)


@query("vf_simple_constraints", checked_sql(SIMPLE))
def simple(t):
    return checked(t, SIMPLE, K.simple_constraints())


@query("vf_keyed_constraints", checked_sql(KEYED))
def keyed(t):
    return checked(t, KEYED, K.keyed_constraints())


@query("vf_keyed_constraints_rest")
def keyed_rest(t):
    return checked(t, REST, K.keyed_constraints())


@query(
    "vf_constraint_score",
    f"SELECT conv_id, turn, round(avg(satisfied::INT), 6) AS score FROM ({checked_sql(KEYED)}) GROUP BY ALL",
)
def constraint_score(t):
    turns = marked_turns(t).filter("role = 'assistant' AND text IS NOT NULL")
    family = K.keyed_constraints()
    flags = F.array(*[K.check(F.lit(s[0]), "text", arguments(s[1]), {s[0]: family[s[0]]}) for s in KEYED])
    return turns.select("conv_id", "turn", F.round(K.constraint_score("text", flags), 6).alias("score"))


def constraint_labels():
    """Labels of three constraints each, all keys in turn, written as JSON, with single quotes, or as JSON text inside a list."""
    out = []
    for i in range(0, len(KEYED), 3):
        some = KEYED[i : i + 3]
        record = {"instruction_id": [s[0] for s in some], "kwargs": [{**s[1], "unused": None} if k else s[1] or None for k, s in enumerate(some)]}
        out.append([json.dumps([record]), repr([record]), json.dumps([json.dumps(record)])][i // 3 % 3])
    return out


GROUPS = len(KEYED) // 3


@query(
    "vf_instructions",
    f"""WITH p AS (SELECT conv_id, turn, text, (conv_id * 7 + turn) % {GROUPS + 1} AS g FROM {MARKED_TURNS} WHERE role = 'assistant' AND text IS NOT NULL),
      a AS (SELECT conv_id, turn, g, trim(replace(replace(list_last(string_split(text, '</think>')), '<answer>', ''), '</answer>', ''), {WS}) AS t FROM p),
      f AS ({" UNION ALL ".join(f"SELECT conv_id, turn, t, coalesce({s[2]}, false) AS kept FROM a WHERE g = {i // 3}" for i, s in enumerate(KEYED))})
      SELECT conv_id, turn, 'ifeval' AS verifier, round(avg(CASE WHEN t = '' THEN 0 ELSE kept::INT END), 6) AS score FROM f GROUP BY ALL
      UNION ALL SELECT conv_id, turn, 'flan', ({normal('t')} = {normal("'thanks'")})::INT FROM (SELECT *, list_last(string_split(text, 'The answer is: ')) AS t FROM p WHERE g = {GROUPS})""",
)
def instructions(t):
    group = F.expr(f"int((conv_id * 7 + turn) % {GROUPS + 1})")
    rows = marked_turns(t).filter("role = 'assistant' AND text IS NOT NULL").select(
        "conv_id", "turn", "text", F.when(group < GROUPS, "ifeval").otherwise("flan").alias("verifier"),
        F.coalesce(F.get(F.array(*[F.lit(x) for x in constraint_labels()]), group), F.lit("thanks")).alias("label"),
    )
    return rows.select("conv_id", "turn", "verifier", F.round(V.score("verifier", "text", "label"), 6).alias("score"))


@query("vf_language_constraint", f"SELECT doc_id, detected = 'en' AS satisfied FROM ({ORACLES['ag_detect_language']})")
def language_constraint(t):
    found = detected(t).select("doc_id", "detected")
    rows = found.select("doc_id", "detected", F.lit("x").alias("text"), F.lit("validate_response_language").alias("kind"), arguments({"language": "en"}).alias("args"))
    family = K.simple_constraints(F.col("detected"))
    rule = {"validate_response_language": family["validate_response_language"]}
    return rows.select("doc_id", K.check("kind", "text", "args", rule).alias("satisfied"))
