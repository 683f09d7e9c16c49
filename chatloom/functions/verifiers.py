"""Rule-based scores of a prediction against a label, as Columns in [0, 1] unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.constraints import check, keyed_constraints
from chatloom.functions.text import PUNCTUATION, any_of, col, find_all, last_of, let, replace_all, split_words, steps, strip
from chatloom.functions.tokens import token_count
from chatloom.operators.conversions import last_boxed

Score = Column


def _score(condition: Column) -> Score:
    return F.coalesce(condition, F.lit(False)).cast("double")


def without_thinking(text) -> Column:
    """The answer after the reasoning, without answer tags."""
    t = F.substring_index(strip(F.replace(col(text), F.lit("<|assistant|>"), F.lit(""))), "</think>", -1)
    return strip(replace_all(t, [("<answer>", ""), ("</answer>", "")]))


# --- numbers and exact answers ---------------------------------------------------------------

def last_number(text) -> Column:
    """The last number after removing thousands commas, or the whole text."""
    plain = F.regexp_replace(col(text), r"(\d),(\d)", "$1$2")
    return F.coalesce(last_of(find_all(plain, r"[-+]?\d*\.\d+|\d+")), plain)


def number_match(prediction, label) -> Score:
    return _score(F.lower(last_number(prediction)) == F.lower(col(label)))


def normal_answer(text) -> Column:
    """Lower case, no punctuation, no articles, single blanks."""
    bare = F.translate(F.lower(col(text)), PUNCTUATION, "")
    return F.array_join(split_words(F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " ")), " ")


def same_answer(a, b) -> Score:
    return _score(normal_answer(a) == normal_answer(b))


def stated_answer_match(prediction, label) -> Score:
    return same_answer(F.substring_index(col(prediction), "The answer is: ", -1), label)


def tagged_answer_match(prediction, label) -> Score:
    p = col(prediction)
    inner = F.substring_index(F.substring_index(p, "<answer>", -1), "</answer>", 1)
    return F.when(p.contains("<answer>") & p.contains("</answer>"), same_answer(inner, label)).otherwise(0.0)


def thought_answer_match(prediction, label) -> Score:
    return same_answer(without_thinking(prediction), label)


# --- token overlap ---------------------------------------------------------------------------

def f1(prediction, label) -> Score:
    """F1 of the two token multisets: both sides sorted together and read once."""

    def score(t: Column) -> Column:
        return let(overlap(t), lambda n: ratio(t, n))

    def overlap(t: Column) -> Column:
        side = lambda tokens, p, g: F.transform(tokens, lambda x: F.struct(x.alias("t"), F.lit(p).alias("p"), F.lit(g).alias("g")))
        both = F.array_sort(F.concat(side(t["p"], 1, 0), side(t["g"], 0, 1)))
        start = F.struct(F.lit("").alias("t"), F.lit(0).alias("p"), F.lit(0).alias("g"), F.lit(0).alias("n"))

        def step(s: Column, x: Column) -> Column:
            same = F.struct(s["t"].alias("t"), (s["p"] + x["p"]).alias("p"), (s["g"] + x["g"]).alias("g"), s["n"].alias("n"))
            other = F.struct(x["t"].alias("t"), x["p"].alias("p"), x["g"].alias("g"), (s["n"] + F.least(s["p"], s["g"])).alias("n"))
            return F.when(s["t"] == x["t"], same).otherwise(other)

        return F.aggregate(both, start, step, lambda s: s["n"] + F.least(s["p"], s["g"]))

    def ratio(t: Column, n: Column) -> Column:
        return F.when(n == 0, 0.0).otherwise(2.0 * n / (F.size(t["p"]) + F.size(t["g"])))

    tokens = lambda c: F.filter(F.split(normal_answer(c), " "), lambda x: x != "")
    return let(F.struct(tokens(prediction).alias("p"), tokens(label).alias("g")), score)


def f1_without_thinking(prediction, label) -> Score:
    p = replace_all(F.substring_index(col(prediction), "</think>", -1), [("<answer>", ""), ("</answer>", "")])
    return f1(p, label)


def finish_f1(prediction, labels) -> Score:
    """Best F1 over the labels of the text between finish tags; a kept format is worth at least 0.1."""
    p = col(prediction)
    answer = F.substring_index(F.substring_index(p, "<finish>", -1), "</finish>", 1)
    kept = p.contains("<finish>") | p.contains("</finish>")

    def best(a: Column) -> Column:
        top = F.array_max(F.transform(col(labels), lambda x: f1(a, x)))
        return F.when(~kept | (a == ""), 0.0).otherwise(let(top, lambda s: F.when(s == 0, 0.1).otherwise(s)))

    return let(answer, best)


def finish_exact(prediction, labels) -> Score:
    answer = strip(F.regexp_extract(col(prediction), r"(?is)<finish>(.*?)</finish>", 1))
    return F.when(answer == "", 0.0).otherwise(_score(F.exists(col(labels), lambda x: normal_answer(x) == normal_answer(answer))))


# --- lengths and formats ---------------------------------------------------------------------

def length_score(prediction, label, longest: int) -> Score:
    """1 - |length - target| / longest; may be negative."""
    return 1 - F.abs(token_count(prediction) - col(label).cast("double")) / longest


def up_to_length_score(prediction, label, longest: int) -> Score:
    over = token_count(prediction) - col(label).cast("double")
    return F.when(over < 0, 1.0).otherwise(1 - over / longest)


def format_score(prediction, scale: float = 1.0) -> Score:
    return F.when(col(prediction).rlike(r"(?s)\A.*?</think>\s*<answer>.*?</answer>"), scale).otherwise(0.0)


def last_code_block(text) -> Column:
    return F.coalesce(strip(last_of(find_all(text, r"(?s)```(?:python)?(.*?)```", 1))), col(text))


# --- mathematics -----------------------------------------------------------------------------

# Literal replacements and expressions left out of a final answer.
SUBSTITUTIONS = [
    ("an ", ""), ("a ", ""), (".$", "$"), ("\\$", ""), (r"\ ", ""), (" ", ""), ("mbox", "text"), (",\\text{and}", ","),
    ("\\text{and}", ","), ("\\text{m}", "\\text{}"),
]
REMOVED = [
    "square", "ways", "integers", "dollars", "mph", "inches", "ft", "hours", "km", "units", "\\ldots", "sue", "points",
    "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students",
    "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", r"\mathrm{th}", r"^\circ", r"^{\circ}", r"\;", r",\!", "{,}", '"', "\\dots",
]
NORMAL_REPLACEMENTS = [
    ("\n", ""), ("\\!", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"), ("\\left", ""), ("\\right", ""),
    ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""),
]


def normal_final_answer(text) -> Column:
    """Short form of a quantitative answer: the last side of an equation without words, units and TeX wrappers."""
    t = replace_all(F.substring_index(col(text), "=", -1), SUBSTITUTIONS + [(x, "") for x in REMOVED])
    for pattern, new in [
        (r"(?d)(.*?)(\$)(.*?)(\$)(.*)", r"\$$3\$"), (r"(?d)(\\text\{)(.*?)(\})", "$2"), (r"(?d)(\\textbf\{)(.*?)(\})", "$2"),
        (r"(?d)(\\overline\{)(.*?)(\})", "$2"), (r"(?d)(\\boxed\{)(.*)(\})", "$2"), (r"(?d)(frac)([^{])(.)", "frac{$2}{$3}"),
        (r"(sqrt)([^{])", "sqrt{$2}"),
    ]:
        t = F.regexp_replace(t, F.lit(pattern), F.lit(new))
    t = F.replace(t, F.lit("$"), F.lit(""))
    no_comma = lambda x: F.replace(x, F.lit(","), F.lit(""))
    return let(t, lambda x: F.when(no_comma(x).rlike(r"\A\d+\z"), no_comma(x)).otherwise(x))


def math_form(text) -> Column:
    """Canonical string of an expression; null where the rules do not apply and only the raw text may be compared."""
    none = F.lit(None).cast("string")
    digits = r"\A[+-]?\d+\z"
    part = lambda t, mark, i: F.get(F.split(t, mark), F.lit(i))
    count = lambda t, mark: F.size(F.split(t, mark))
    sub = lambda pattern, new: lambda t: F.regexp_replace(t, F.lit(pattern), F.lit(new))

    def units(t: Column) -> Column:
        n = count(t, r"\\text\{ ")
        return F.when(n > 2, none).when(n == 2, F.substring_index(t, "\\text{ ", 1)).otherwise(t)

    def zero(t: Column) -> Column:
        return F.when(t.startswith("."), F.concat(F.lit("0"), t)).otherwise(t)

    def right_side(t: Column) -> Column:
        return F.when((count(t, "=") == 2) & (F.length(part(t, "=", 0)) <= 2), part(t, "=", 1)).otherwise(t)

    def bare_root(t: Column) -> Column:
        return F.when(t.rlike(r"\\sqrt\z"), none).otherwise(t)

    def slash(t: Column) -> Column:
        whole = part(t, "/", 0).rlike(digits) & part(t, "/", 1).rlike(digits)
        plain = t.rlike(r"\A-?(0|[1-9]\d*)/-?(0|[1-9]\d*)\z")
        fraction = F.concat(F.lit("\\frac{"), part(t, "/", 0), F.lit("}{"), part(t, "/", 1), F.lit("}"))
        return F.when(count(t, "/") != 2, t).when(~whole, none).when(plain, fraction).otherwise(t)

    return steps(
        replace_all(text, NORMAL_REPLACEMENTS), units, lambda t: replace_all(t, [("\\%", ""), (" .", " 0."), ("{.", "{0.")]),
        zero, right_side, bare_root, sub(r"(?s)\\sqrt([^{])", r"\\sqrt{$1}"), lambda t: F.replace(t, F.lit(" "), F.lit("")),
        sub(r"(?s)\\frac([^{])([^{])", r"\\frac{$1}{$2}"), sub(r"(?s)\\frac([^{])\{", r"\\frac{$1}{"),
        lambda t: F.when(t == "0.5", F.lit("\\frac{1}{2}")).otherwise(t), slash,
    )


def same_expression(a, b) -> Column:
    raw = col(a) == col(b)
    return let(
        F.struct(math_form(a).alias("a"), math_form(b).alias("b")),
        lambda f: F.when(f["a"].isNull() | f["b"].isNull(), raw).otherwise(f["a"] == f["b"]),
    )


def phrase_answer(text) -> Column:
    """The answer in the closing phrase, normalised; null without the phrase."""
    pattern = r"(?d)Final Answer: The final answer is(.*?). I hope it is correct."
    said = lambda t: F.when(t.rlike(pattern), normal_final_answer(strip(F.regexp_extract(t, pattern, 1))))
    return let(F.concat(col(text), F.lit("I hope it is correct.")), said)


def _between_last_dollars(text) -> Column:
    return let(F.split(col(text), r"\$"), lambda p: F.when(F.size(p) > 2, F.get(p, F.size(p) - 2)))


def math_candidates(text) -> Column:
    """Boxed and closing-phrase answers, else the last dollar pair, else the whole text normalised and raw."""

    def choose(t: Column) -> Column:
        dollars = let(_between_last_dollars(t), lambda d: F.when(d.isNotNull(), F.array(normal_final_answer(d))))
        whole = F.array(normal_final_answer(t), t)
        named = F.filter(F.array(last_boxed(t), phrase_answer(t)), lambda x: x.isNotNull())
        return let(named, lambda n: F.when(F.size(n) > 0, n).otherwise(F.coalesce(dollars, whole)))

    return let(col(text), choose)


def math_match(prediction, label) -> Score:
    return _score(F.exists(math_candidates(prediction), lambda c: same_expression(c, col(label))))


def strict_math_match(prediction, label) -> Score:
    answer = F.coalesce(phrase_answer(prediction), normal_final_answer(prediction))
    return _score(same_expression(answer, label))


# --- judge texts -----------------------------------------------------------------------------

# Words that stand for a full or no score.
GOOD_WORDS = ["yes", "correct", "good", "true", "pass"]


def judge_number(text) -> Score:
    """First ratio, percentage or number of a judge text, else yes/no words, else 0."""
    t, number = col(text), r"(\d+\.?\d*|\.\d+)"
    a, b = (F.regexp_extract(t, r"(\d+)/(\d+)", i).try_cast("double") for i in (1, 2))
    percent = F.regexp_extract(t, number + "%", 1).try_cast("double") / 100
    plain = F.regexp_extract(t, number, 1).try_cast("double")
    good = any_of(F.lower(t).contains(w) for w in GOOD_WORDS)
    return F.coalesce(F.try_divide(a, b), percent, plain, F.when(good, 1.0).otherwise(0.0))


def judge_decision(text) -> Score:
    return _score(F.lower(col(text)).contains("final decision: yes"))


def judge_json(text, top: float = 1.0) -> Score:
    """SCORE of a JSON reply, fenced or broken; 0 when there is none."""
    fences = (
        lambda t: F.when(t.startswith("```json"), F.substring(t, 8, 1 << 30)).when(t.startswith("```"), F.substring(t, 4, 1 << 30)).otherwise(t),
        lambda t: F.when(t.endswith("```"), F.substring(t, F.lit(1), F.length(t) - 3)).otherwise(t),
    )
    t = steps(strip(text), *fences)
    t = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit("\\n"))
    t = strip(F.regexp_replace(t, F.lit(r'\\(?!["\\/bfnrtu])'), F.lit(r"\\\\")))
    return let(t, _json_score) / top


def _json_score(t: Column) -> Column:
    outer = F.regexp_replace(F.regexp_replace(t, F.lit(r"\A(\s|\\n)+"), F.lit("")), F.lit(r"(\s|\\n)+\z"), F.lit(""))
    parsed = F.get_json_object(outer, "$.SCORE").try_cast("double")
    found = F.regexp_extract(t, r'"SCORE"\s*:\s*"?([0-9]+(?:\.[0-9]+)?)"?', 1).try_cast("double")
    return F.coalesce(parsed, found, F.lit(0.0))


def judged_content(text) -> Column:
    t = F.regexp_replace(col(text), F.lit(r"(?s)<think>\s*.*?\s*</think>\s*"), F.lit(""))
    return replace_all(t, [("<answer>", ""), ("</answer>", "")])


# --- instruction following -------------------------------------------------------------------

CONSTRAINTS = "array<struct<instruction_id: array<string>, kwargs: array<map<string,string>>>>"


def constraint_list(label) -> Column:
    """array<struct<kind, args map<string,array<string>>>> of a label: a list whose first element is a record of constraint ids and their arguments.

    The list may be JSON or written with single quotes, None and True; the record may be JSON text inside the list. Arguments that are null are absent.
    """
    bare = lambda t, old, new: F.regexp_replace(t, rf"(?<=[\[{{,:]\s?){old}(?=\s*[,\]}}])", new)
    text = steps(strip(label), lambda t: bare(t, "None", "null"), lambda t: bare(t, "True", "true"), lambda t: bare(t, "False", "false"))

    def record(t: Column) -> Column:
        inner = F.get(F.from_json(t, "array<string>"), F.lit(0))
        return F.get(F.from_json(F.concat(F.lit("["), F.coalesce(inner, F.lit("")), F.lit("]")), CONSTRAINTS), F.lit(0))

    def one(pair: Column) -> Column:
        present = F.map_filter(F.coalesce(pair["kwargs"], F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull())
        many = F.transform_values(present, lambda k, v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v)))
        return F.struct(F.lower(pair["instruction_id"]).alias("kind"), many.alias("args"))

    return let(let(text, record), lambda r: F.transform(F.arrays_zip(r["instruction_id"].alias("instruction_id"), r["kwargs"].alias("kwargs")), one))


def instruction_following(prediction, label) -> Score:
    """Share of a label's constraints that the answer, without its reasoning, keeps; 0 for an empty answer, null for a label that names none."""
    answer = without_thinking(prediction)
    family = keyed_constraints()
    keeps = lambda a: F.transform(constraint_list(label), lambda c: check(c["kind"], a, c["args"], family))

    def share(flags: Column) -> Column:
        return F.when(F.size(flags) > 0, F.size(F.filter(flags, lambda x: x)) / F.size(flags))

    return let(answer, lambda a: F.when((a == "") | (col(prediction) == ""), 0.0).otherwise(let(keeps(a), share)))


# --- one pass over mixed tables --------------------------------------------------------------

def verifiers(longest: int = 4096, instructions: bool = True) -> dict:
    """Name to ``f(prediction, label)``; the registry may be extended by the caller.

    Without ``instructions`` the plan is much smaller, because instruction following holds the rules of every constraint.
    """
    many = lambda f: lambda p, x: f(p, label_list(x))
    more = {"ifeval": instruction_following} if instructions else {}
    return more | {
        "gsm8k": number_match, "math": math_match, "strict_math": strict_math_match, "flan": stated_answer_match,
        "string_matcher": tagged_answer_match, "puzzle": thought_answer_match, "string_f1": f1_without_thinking,
        "re_search_f1": many(finish_f1), "re_search": many(finish_exact),
        "max_length": lambda p, x: length_score(p, x, longest), "up_to_max_length": lambda p, x: up_to_length_score(p, x, longest),
    }


def label_list(label) -> Column:
    """A label that is a JSON list, or the stripped label itself."""
    s = strip(label)
    return F.coalesce(F.when(s.startswith("["), F.from_json(s, "array<string>")), F.array(s))


def score(verifier, prediction, label, registry: dict | None = None) -> Score:
    """Score by the verifier named in a column; null for unknown names. Each row runs one branch only."""
    out = F.lit(None).cast("double")
    for name, rule in (registry or verifiers()).items():
        out = F.when(F.lower(col(verifier)) == name, rule(col(prediction), col(label))).otherwise(out)
    return out


def combine_rewards(
    responses: DataFrame, key: str, prediction: str, labels: str, datasets: str, weights: dict[str, float] | None = None,
    mult: float = 10.0, use_format: bool = False, additive: bool = False, format_scale: float = 1.0,
    good: str | None = None, finish: str | None = None, penalty: float = -10.0, registry: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(reward per response, mean and correct rate per verifier).

    ``labels`` and ``datasets`` are aligned arrays; unknown verifiers are skipped. The sum over the labels of a
    response is taken inside its row, so nothing is shuffled for the rewards themselves.
    """
    w = F.create_map(*[F.lit(x) for kv in (weights or {}).items() for x in kv]) if weights else None
    pairs = responses.select("*", F.posexplode(F.arrays_zip(F.col(labels).alias("label"), F.col(datasets).alias("dataset"))).alias("_i", "_p"))
    weight = F.coalesce(F.try_element_at(w, F.col("_p.dataset")), F.lit(1.0)) if w is not None else F.lit(1.0)
    scored = pairs.select(
        key, F.col("_p.dataset").alias("verifier"), (mult * weight * score("_p.dataset", prediction, "_p.label", registry)).alias("r")
    ).filter("r IS NOT NULL")
    sums = scored.groupBy(key).agg(F.sum("r").alias("_verified"))
    rows = responses.join(sums, key, "left")
    verified = F.coalesce("_verified", F.lit(0.0))
    fmt = format_score(prediction, format_scale)
    if use_format:
        full = verified + fmt if additive else F.when(fmt == 1, verified).otherwise(0.0)
    else:
        full = verified
    base = fmt if use_format else F.lit(0.0)
    value = full if good is None else F.when(F.col(good), full).otherwise(base)
    if finish is not None:
        value = F.when(F.col(finish) != "stop", penalty).otherwise(value)
    per_response = scored.groupBy("verifier", key).agg(F.sum("r").alias("r"))
    report = per_response.groupBy("verifier").agg(F.avg("r").alias("reward"), F.avg((F.col("r") > 0).cast("int")).alias("correct_rate"))
    return rows.withColumns({"reward": value, "verified": verified, "format": fmt}).drop("_verified"), report


def reward_metrics(rewards: DataFrame) -> DataFrame:
    """(verifiable_reward, verifiable_correct_rate, format_score, reward): means over all responses of ``combine_rewards``."""
    return rewards.agg(
        F.avg("verified").alias("verifiable_reward"), F.avg((F.col("verified") > 0).cast("int")).alias("verifiable_correct_rate"),
        F.avg("format").alias("format_score"), F.avg("reward").alias("reward"),
    )
