import pytest
from pyspark.sql import functions as F

from chatloom.catalog.verifiers import arguments
from chatloom.functions import constraints as K
from chatloom.functions import verifiers as V
from chatloom.functions.chat import flat
from chatloom.operators import conversions as C
from chatloom.operators import evaluation as E
from chatloom.operators import repetition as R
from chatloom.operators import translation as TR
from chatloom.operators import trees

MSG = "array<struct<role:string,content:string>>"


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


# (key, arguments, text, expected)
KEYED = [
    ("keywords:forbidden_words", {"forbidden_words": ["cat"]}, "A Cat sat", False),
    ("keywords:forbidden_words", {"forbidden_words": ["cat"]}, "concatenate", True),
    ("length_constraints:number_sentences", {"num_sentences": ["2"], "relation": "at least"}, "Dr. Who came at 3.5 pm. Then he left.", True),
    ("length_constraints:number_sentences", {"num_sentences": ["2"], "relation": "less than"}, "Mr. Smith has no time", True),
    ("length_constraints:number_paragraphs", {"num_paragraphs": ["2"]}, "a *** b", True),
    ("length_constraints:number_paragraphs", {"num_paragraphs": ["2"]}, "a *** *** b", False),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": ["2"], "nth_paragraph": ["2"], "first_word": "Well"}, "One.\n\n'Well, two.", True),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": ["2"], "nth_paragraph": ["3"], "first_word": "well"}, "One.\n\nwell", False),
    ("detectable_content:postscript", {"postscript_marker": "P.S."}, "text\nP.S. more", True),
    ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, "text\nP.S. more", False),
    ("detectable_format:number_bullet_lists", {"num_bullets": ["2"]}, "* a\n- b\n** c", True),
    ("detectable_format:number_highlighted_sections", {"num_highlights": ["2"]}, "*a* and *b c*", True),
    ("detectable_format:number_highlighted_sections", {"num_highlights": ["1"]}, "* *", False),
    ("detectable_format:multiple_sections", {"section_spliter": "Section", "num_sections": ["2"]}, "Section 1 x Section 2 y", True),
    ("detectable_format:json_format", {}, "```json\n{\"a\": [1]}\n```", True),
    ("detectable_format:json_format", {}, "{a: 1", False),
    ("detectable_format:title", {}, "<<joy>> text", True),
    ("detectable_format:title", {}, "<<  >>", False),
    ("combination:two_responses", {}, "a ****** b", True),
    ("combination:two_responses", {}, "a ****** a", False),
    ("startend:end_checker", {"end_phrase": "The End"}, ' all. the end" ', True),
    ("startend:quotation", {}, ' "x" ', True),
    ("change_case:english_capital", {}, "ALL CAPS 1", True),
    ("change_case:english_capital", {}, "123", False),
    ("change_case:english_lowercase", {}, "all low", True),
    ("copy:repeat_phrase", {"phrase": "go with me home", "small_n": ["2"]}, "go with me home, go with you home", True),
    ("copy:repeat_phrase", {"phrase": "go with me home", "small_n": ["2"]}, "go with me home, go by you home", False),
    ("copy:repeat_phrase", {"phrase": "go with me home", "small_n": ["1"]}, "go with me home", False),
    ("copy:copy", {"prompt_to_repeat": "Say It"}, " say it ", True),
    ("new:copy_span_idx", {"prompt_to_repeat": "abcdef", "n_start": ["1"], "n_end": ["4"]}, "BCD", True),
    ("detectable_format:sentence_hyphens", {}, "One here.-Two here.", True),
    ("detectable_format:sentence_hyphens", {}, "One here. - Two here.", False),
    ("keywords:no_adjacent_consecutive", {}, "alpha beta", False),
    ("keywords:no_adjacent_consecutive", {}, "alpha gamma", True),
    ("detectable_format:square_brackets", {}, "[a] [b]", True),
    ("paragraphs:paragraphs", {}, "a\n***\nb", True),
    ("paragraphs:paragraphs2", {}, "a\n\nb\n\n", True),
    ("first_word:first_word_sent", {"first_word": "We"}, "We go. We stay.", True),
    ("first_word:first_word_sent", {"first_word": "We"}, "We go. They stay.", False),
    ("last_word:last_word_sent", {"last_word": "end"}, "the end. An END!", True),
    ("last_word:last_word_answer", {"last_word": "fin"}, "that is Fin.", True),
    ("detectable_format:bigram_wrapping", {}, "<<a b>> <<c d>> e", True),
    ("detectable_format:bigram_wrapping", {}, "<<a b>> c d", False),
    ("copy:copying_multiple", {"prompt_to_repeat": "x y", "N": ["2"]}, "x y ****** X Y", True),
    ("count:lowercase_counting", {"N": ["2"]}, "two words ONLY", True),
    ("letters:letter_counting", {"N": ["3"], "relation": "at least"}, "a1b2c3", True),
    ("count:counting_composition", {"n_sent": ["1"], "n_words": ["3"]}, "a b. *** c d. *** e f.", True),
    ("count:counting_composition", {"n_sent": ["1"], "n_words": ["3"]}, "a b. *** c d.", False),
    ("count:count_unique", {}, "a b c", True),
    ("count:count_unique", {}, "a b a", False),
    ("count:count_increment_word", {"keyword1": "cat", "keyword2": "dog"}, "Cat dog dog", True),
    ("keywords:palindrome", {}, "my level best", True),
    ("keywords:palindrome", {}, "my best", False),
    ("keywords:keyword_specific_position", {"keyword": "red", "n": ["2"], "m": ["3"]}, "One. It is red.", True),
    ("keywords:keyword_specific_position", {"keyword": "red", "n": ["3"], "m": ["1"]}, "One. It is red.", False),
    ("keywords:start_end", {}, "go on and Go", True),
    ("language:response_language", {"language": "de"}, "x", True),
]


def test_keyed_constraints(spark):
    family = K.keyed_constraints()
    assert len(family) == 54
    rows = spark.createDataFrame([(i, k, t) for i, (k, _, t, _) in enumerate(KEYED)], "i int, kind string, t string")
    args = F.element_at(F.array(*[arguments(a) for _, a, _, _ in KEYED]), F.col("i") + 1)
    got = {r["i"]: r["x"] for r in rows.withColumn("args", args).select("i", K.check("kind", "t", "args", family).alias("x")).collect()}
    wrong = [(KEYED[i][0], KEYED[i][2], got[i]) for i in range(len(KEYED)) if got[i] != KEYED[i][3]]
    assert not wrong


def test_simple_constraints_are_complete():
    assert len(K.simple_constraints()) == 26  # 25 and the corrected choice


@pytest.mark.parametrize(
    "rule, prediction, label, score",
    [
        (V.number_match, "It is 1,234.", "1234", 1.0), (V.number_match, "no number", "no number", 1.0), (V.number_match, "-3.5 then 7", "7", 1.0),
        (V.stated_answer_match, "x The answer is: The Cat.", "cat", 1.0), (V.tagged_answer_match, "<answer>a b</answer>", "B", 0.0 + 0.0 + 1.0),
        (V.tagged_answer_match, "b", "b", 0.0), (V.f1, "a red big fox", "red fox fox", 2 * (2 / 3) * (2 / 3) / (4 / 3)), (V.f1, "", "x", 0.0),
        (V.math_match, "so \\boxed{\\frac{1}{2}}", "0.5", 1.0), (V.math_match, "\\boxed{x/y}", "x/y", 1.0), (V.math_match, "$a$ or $10,000$", "10000", 1.0),
        (V.math_match, "\\boxed{\\sqrt2}", "\\sqrt{2}", 1.0), (V.math_match, "\\boxed{3}", "4", 0.0),
        (V.strict_math_match, "Final Answer: The final answer is 5 units. I hope it is correct.", "5", 1.0),
    ],
)
def test_verifiers(spark, rule, prediction, label, score):
    df = spark.createDataFrame([(prediction, label)], "p string, l string")
    assert df.select(rule("p", "l").alias("x")).first()["x"] == pytest.approx(score)


@pytest.mark.parametrize("text, score", [("4/5", 0.8), ("85%", 0.85), ("score 7", 7.0), ("Yes", 1.0), ("nope", 0.0)])
def test_judge_number(spark, text, score):
    assert one(spark, V.judge_number("t"), text) == pytest.approx(score)


def test_battle_outcomes(spark):
    rows = [(0.1, True, 1.0), (0.1, False, 0.0), (0.9, True, 0.0), (0.9, False, 1.0), (0.5, True, 0.5), (None, False, 0.5)]
    df = spark.createDataFrame(rows, "p double, first boolean, want double")
    assert all(r["x"] == r["want"] for r in df.select(E.battle_outcome("p", "first").alias("x"), "want").collect())


def test_tree(spark):
    rows = [
        ("r", None, "prompter", "Q", "pt-BR", None, None), ("a", "r", "assistant", "worse", "pt", 1, {"x": 1}), ("b", "r", "assistant", "best", "pt", 0, None),
        ("s", None, "assistant", "no root", "en", None, None), ("t", "s", "prompter", "x", "en", 0, None),
    ]
    df = spark.createDataFrame(rows, "message_id string, parent_id string, role string, text string, lang string, rank int, labels map<string,int>")
    got = trees.best_paths(df).select("root", "language", flat("messages").alias("m")).collect()
    assert [tuple(r) for r in got] == [("r", "pt", "user: Q\nassistant: best")]


def test_multilingual_admission(spark):
    long = "x" * 60
    rows = [
        (0, [("user", long), ("assistant", "ok")], False, "German"), (1, [("user", long), ("assistant", "ok")], True, "English"),
        (2, [("user", long)], False, "English"), (3, [("user", "hi"), ("assistant", "ho")], False, "English"),
    ]
    df = spark.createDataFrame([(i, [dict(role=r, content=c) for r, c in m], t, n) for i, m, t, n in rows], f"i int, c {MSG}, toxic boolean, name string")
    got = df.select("i", F.size(C.admit_chat("c", "toxic")).alias("n"), C.language_code("name").alias("l")).collect()
    assert [(r["n"], r["l"]) for r in got] == [(2, "de"), (0, "en"), (0, "en"), (0, "en")]


def test_split_by_budget_keeps_the_tail(spark):
    chat = [("user", "a b"), ("assistant", "c d"), ("user", "e"), ("assistant", "f"), ("user", " ".join("g" * 30)), ("assistant", "h"), ("user", "i"), ("assistant", "j"), ("user", "odd")]
    df = spark.createDataFrame([([dict(role=r, content=c) for r, c in chat],)], f"m {MSG}")
    got = df.select(C.split_by_budget("m", 20, lambda x: C.word_count(x["content"])).alias("s")).first()["s"]
    assert [[t["content"] for t in s] for s in got] == [["a b", "c d"], ["e", "f"], ["i", "j"]]


def reasons(spark, text, **kw):
    rows = R.repetition_reasons(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t", **kw).collect()
    return rows[0]["reason"] if rows else None


def test_repetition_reasons(spark):
    assert reasons(spark, "Mary sang loudly. " * 5) == "line_repeated_5x_consecutive"
    assert reasons(spark, "Mary sang loudly. " * 3) is None
    assert reasons(spark, "maybe so. " * 8) == "line_repeated_8x_consecutive_short_phrase"
    assert reasons(spark, "maybe so. " * 7) is None
    assert reasons(spark, "from xyz import abc. " * 50) is None
    assert reasons(spark, "A long enough paragraph here\n\n" * 10) == "paragraph_repeated_10x"
    mixed = "".join(f"A long enough paragraph here\n\nfiller {chr(97 + i)} text\n\n" for i in range(12))
    assert reasons(spark, mixed) is None  # apart from each other twenty are needed
    assert reasons(spark, "word. " * 100) is None


def test_protection_round_trip(spark):
    text = "see `x` and ```\ncode\n``` at https://a.b/c or me@x.org, `x` again"
    row = spark.createDataFrame([(text,)], "t string").select(TR.protect("t").alias("p")).select("p", TR.restore("p.text", "p.kept").alias("r")).first()
    assert row["r"] == text and "https" not in row["p"]["text"] and "code" not in row["p"]["text"]


def test_last_user_query_and_answers(spark):
    assert one(spark, C.final_answer("t"), "<think>x</think> 5 ") == "5"
    assert one(spark, C.last_boxed("t"), "\\boxed{a{b}c} tail }") == "a{b}c"
    assert one(spark, C.last_boxed("t"), "none") is None
