"""Instruction-following checks: every constraint is a boolean Column of a text and an argument map.

Arguments come as ``map<string, array<string>>`` (a scalar is an array of one), so that one table can hold every
kind of constraint and is checked in a single pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import any_of, col, find_all, let, replace_all, split_words, steps, strip, word_tokens

Check = Callable[[Column, "Args"], Column]


class Args:
    """Typed access to the argument map of a row."""

    def __init__(self, args):
        self.map = col(args)

    def many(self, name: str) -> Column:
        return F.coalesce(F.try_element_at(self.map, F.lit(name)), F.array().cast("array<string>"))

    def text(self, name: str) -> Column:
        return F.get(self.many(name), F.lit(0))

    def number(self, name: str) -> Column:
        return self.text(name).cast("int")


# --- shared pieces ---------------------------------------------------------------------------

def words_of(text: Column) -> Column:
    return find_all(text, r"(?U)\w+")


def pattern(c: Column, flags: str = "iU") -> Column:
    return F.concat(F.lit(f"(?{flags})"), c)


def hits(text: Column, regex: Column) -> Column:
    return F.regexp_count(text, regex)


def literal_split(text: Column, mark: Column) -> Column:
    """str.split on a literal mark that may differ per row."""
    return F.split(text, F.concat(F.lit(r"\Q"), mark, F.lit(r"\E")))


def literal_count(text: Column, mark: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, mark, F.lit("")))) / F.length(mark)


def relation(value: Column, kind: Column, bound: Column) -> Column:
    return F.when(kind == "less than", value < bound).when(kind == "at least", value >= bound).otherwise(F.lit(False))


def quantified(value: Column, kind: Column, bound: Column, tolerance: Column) -> Column:
    return (
        F.when(kind == "at least", value >= bound).when(kind == "at most", value <= bound)
        .when(kind == "around", F.abs(value - bound) <= tolerance).otherwise(F.lit(False))
    )


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def sections(text: Column, regex: str) -> Column:
    """(parts, blank inside, blank at the ends) of a split."""
    return F.transform(F.split(text, regex), lambda p: strip(p))


def part_count(text: Column, regex: str) -> Column:
    """Number of non-blank parts, blanks allowed only at both ends; null when a blank lies between."""

    def count(p: Column) -> Column:
        inner = F.exists(F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))), lambda x: x == "")
        blank = F.size(F.filter(p, lambda x: x == ""))
        return F.when(inner, F.lit(None).cast("int")).otherwise(F.size(p) - blank)

    return let(sections(text, regex), count)


# Abbreviations and openings of the sentence splitter.
PREFIXES = "(Mr|St|Mrs|Ms|Dr)[.]"
SUFFIXES = "(Inc|Ltd|Jr|Sr|Co)"
STARTERS = r"(Mr|Mrs|Ms|Dr|Prof|Capt|Cpt|Lt|He\s|She\s|It\s|They\s|Their\s|Our\s|We\s|But\s|However\s|That\s|This\s|Wherever)"
ACRONYMS = "([A-Z][.][A-Z][.](?:[A-Z][.])?)"
WEBSITES = "[.](com|net|org|io|gov|edu|me)"


def sentences(text: Column) -> Column:
    """Sentences with protected abbreviations, numbers, acronyms and dots in runs."""
    a = "([A-Za-z])"
    t = F.concat(F.lit(" "), F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("  "))
    rules = [
        (PREFIXES, "$1<prd>"), (WEBSITES, "<prd>$1"), ("([0-9])[.]([0-9])", "$1<prd>$2"), (r"(\.{2,})", "$1<stop>"),
        (r"\.(?=\.)|(?<=\.)\.", "<prd>"), (r"Ph\.D\.", "Ph<prd>D<prd>"), (r"\s" + a + "[.] ", " $1<prd> "),
        (ACRONYMS + " " + STARTERS, "$1<stop> $2"), (a + "[.]" + a + "[.]" + a + "[.]", "$1<prd>$2<prd>$3<prd>"),
        (a + "[.]" + a + "[.]", "$1<prd>$2<prd>"), (" " + SUFFIXES + "[.] " + STARTERS, " $1<stop> $2"),
        (" " + SUFFIXES + "[.]", " $1<prd>"), (" " + a + "[.]", " $1<prd>"),
    ]
    for regex, new in rules:
        t = F.regexp_replace(t, F.lit(regex), F.lit(new))
    marks = [(".”", "”."), ('."', '".'), ('!"', '"!'), ('?"', '"?'), (".", ".<stop>"), ("?", "?<stop>"), ("!", "!<stop>"), ("<prd>", ".")]
    parts = F.transform(F.split(replace_all(t, marks), "<stop>"), lambda s: strip(s))
    return let(parts, lambda p: F.when(F.try_element_at(p, F.lit(-1)) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def first_word(sentence: Column) -> Column:
    return F.get(split_words(sentence), F.lit(0))


def last_word(sentence: Column) -> Column:
    return F.regexp_replace(F.try_element_at(split_words(sentence), F.lit(-1)), F.lit(r"(?U)[^\w\s]"), F.lit(""))


def every_sentence(text: Column, check) -> Column:
    return F.forall(sentences(text), lambda s: F.when(s == "", F.lit(False)).otherwise(check(s)))


# --- first family: one function name per constraint ------------------------------------------

def _clean_lines(t: Column) -> Column:
    lines = F.split(t, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    return strip(F.array_join(F.transform(lines, lambda x: strip(x)), "\n"))


def _divided(t: Column, n: Column) -> Column:
    return let(F.split(_clean_lines(t), r"\* \* \*"), lambda p: ~F.exists(p, lambda x: strip(x) == "") & (F.size(p) == n))


def _two_answers(t: Column) -> Column:
    parts = F.split(t, r"\*\*\*\*\*\*")
    return (literal_count(t, F.lit("******")) == 1) & (strip(F.get(parts, F.lit(0))) != strip(F.get(parts, F.lit(1))))


def _postscript(t: Column, marker: Column) -> Column:
    rest = strip(F.substr(t, F.instr(t, marker)))
    return F.contains(t, marker) & (F.length(rest) > F.length(marker))


def _split_sections(t: Column, n: Column, mark: Column) -> Column:
    return let(literal_split(t, mark), lambda p: F.size(p) - F.when(F.get(p, F.lit(0)) == "", 1).otherwise(0) == n)


def simple_constraints(detected: Column | None = None) -> dict[str, Check]:
    """Function name to check. ``detected`` is the detected language of the text, needed by one of them."""
    lang = F.lit(None).cast("string") if detected is None else detected
    sentence_split = r"(?U)(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=\.|\?)\s"
    return {
        "verify_keywords": lambda t, a: F.forall(a.many("keyword_list"), lambda k: F.contains(F.lower(t), F.lower(k))),
        "verify_keyword_frequency": lambda t, a: F.size(
            F.filter(words_of(F.lower(t)), lambda w: w == F.lower(a.text("word")))
        ) == a.number("N"),
        "validate_forbidden_words": lambda t, a: ~F.exists(a.many("forbidden_words"), lambda k: F.contains(F.lower(t), F.lower(k))),
        "verify_letter_frequency": lambda t, a: literal_count(t, a.text("letter")) == a.number("N"),
        "validate_response_language": lambda t, a: lang == a.text("language"),
        "verify_paragraph_count": lambda t, a: _divided(t, a.number("N")),
        "validate_word_constraint": lambda t, a: quantified(
            F.size(split_words(t)), a.text("quantifier"), a.number("N"), F.greatest(F.bround(a.number("N") * 0.1, 0), F.lit(1))
        ),
        "verify_sentence_constraint": lambda t, a: quantified(
            F.size(F.split(t, sentence_split)), a.text("quantifier"), a.number("N"), F.lit(1)
        ),
        "validate_paragraphs": lambda t, a: let(
            F.split(t, "\n\n"),
            lambda p: (F.size(p) == a.number("N")) & F.startswith(strip(F.get(p, a.number("i") - 1)), a.text("first_word")),
        ),
        "verify_postscript": lambda t, a: _postscript(t, a.text("postscript_marker")),
        "validate_placeholders": lambda t, a: hits(t, F.lit(r"(?d)\[(.*?)\]")) >= a.number("N"),
        "verify_bullet_points": lambda t, a: F.size(
            F.filter(F.split(t, "\n"), lambda x: F.substring(strip(x), 1, 1).isin("*", "-"))
        ) == a.number("N"),
        "validate_title": lambda t, a: t.rlike(r"(?d)<<(.*?)>>"),
        # the text has to lie inside an option; the corrected rule follows under its own name
        "validate_choice": lambda t, a: F.exists(a.many("options"), lambda o: F.contains(o, t)),
        "validate_choice_in_text": lambda t, a: F.exists(a.many("options"), lambda o: F.contains(t, o)),
        "validate_highlighted_sections": lambda t, a: hits(t, F.lit(r"(?d)\*(.*?)\*")) >= a.number("N"),
        "validate_sections": lambda t, a: _split_sections(t, a.number("N"), a.text("section_splitter")),
        "validate_json_format": lambda t, a: is_json(t),
        "validate_repeat_prompt": lambda t, a: F.startswith(t, a.text("original_prompt")),
        "validate_two_responses": lambda t, a: _two_answers(t),
        "validate_uppercase": lambda t, a: t == F.upper(t),
        "validate_lowercase": lambda t, a: t == F.lower(t),
        "validate_frequency_capital_words": lambda t, a: quantified(
            hits(t, F.lit(r"(?U)\b[A-Z]+\b")), a.text("quantifier"), a.number("N"), F.lit(0)
        ),
        "validate_end": lambda t, a: F.endswith(t, a.text("end_phrase")),
        "validate_quotation": lambda t, a: t.startswith('"') & t.endswith('"'),
        "validate_no_commas": lambda t, a: ~t.contains(","),
    }


# --- second family: keyed checkers -----------------------------------------------------------

def _keyword_hits(t: Column, a: Args, name: str = "keyword") -> Column:
    return hits(t, pattern(strip(a.text(name))))


def _highlights(t: Column) -> Column:
    one = F.filter(find_all(t, r"\*[^\n\*]*\*"), lambda h: F.trim(F.trim(h, F.lit("*"))) != "")
    two = F.filter(find_all(t, r"\*\*[^\n\*]*\*\*"), lambda h: strip(F.substring(h, F.lit(3), F.length(h) - 4)) != "")
    return F.size(one) + F.size(two)


def _postscript_line(t: Column, marker: Column) -> Column:
    regex = (
        F.when(marker == "P.P.S", r"(?dmU)\s*p\.\s?p\.\s?s.*$").when(marker == "P.S.", r"(?dmU)\s*p\.\s?s\..*$")
        .otherwise(F.concat(F.lit(r"(?dmU)\s*"), F.lower(marker), F.lit(".*$")))
    )
    return F.regexp_like(F.lower(t), regex)


def _nth_first_word(t: Column, a: Args) -> Column:
    def check(p: Column) -> Column:
        n = F.size(F.filter(p, lambda x: strip(x) != ""))
        nth = strip(F.get(p, a.number("nth_paragraph") - 1))
        word = F.ltrim(F.ltrim(first_word(nth), F.lit("'")), F.lit('"'))
        head = F.lower(F.regexp_extract(word, r"""\A([^.,?!'"]*)""", 1))
        ok = (a.number("nth_paragraph") <= n) & (nth != "") & (n == a.number("num_paragraphs"))
        return ok & (head == F.lower(a.text("first_word")))

    return let(F.split(t, "\n\n"), check)


def _phrase_repeats(t: Column, a: Args) -> Column:
    """Near repeats of a phrase: the right number, equal length, at most one word changed, one in the last of them."""
    ref = split_words(a.text("phrase"))

    def check(r: Column) -> Column:
        regex = F.concat(F.lit("(?d)"), F.get(r, F.lit(0)), F.lit(" .*? "), F.try_element_at(r, F.lit(-1)))
        found = F.transform(F.regexp_extract_all(t, regex, F.lit(0)), lambda f: split_words(f))

        def differences(f: Column) -> Column:
            changed = F.zip_with(f, r, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
            return F.when(F.size(f) == F.size(r), F.aggregate(changed, F.lit(0), lambda s, x: s + x)).otherwise(99)

        counts = F.transform(found, differences)
        return let(
            counts,
            lambda c: (F.size(c) == a.number("small_n")) & F.forall(c, lambda d: d <= 1) & F.coalesce(F.try_element_at(c, F.lit(-1)) == 1, F.lit(False)),
        )

    return let(ref, check)


def _hyphened(t: Column) -> Column:
    gold = sentences(F.regexp_replace(t, "-", " "))
    parts = F.split(t, "-")
    pairs = F.filter(F.arrays_zip(parts.alias("s"), gold.alias("g")), lambda z: z["s"].isNotNull() & z["g"].isNotNull())
    return F.forall(pairs, lambda z: (strip(z["s"]) == z["s"]) & (z["s"] == z["g"]))


def _no_alphabet_neighbours(t: Column) -> Column:
    codes = F.transform(split_words(t), lambda w: F.ascii(F.lower(F.substring(w, 1, 1))))
    return let(codes, lambda c: ~F.exists(F.transform(c, lambda x, i: F.coalesce(F.get(c, i + 1) - x == 1, F.lit(False))), lambda b: b))


def _bigrams_wrapped(t: Column) -> Column:
    def check(w: Column) -> Column:
        flags = F.transform(
            w, lambda x, i: F.when((i % 2 == 0) & (i + 1 < F.size(w)), x.startswith("<<") & F.get(w, i + 1).endswith(">>")).otherwise(F.lit(True))
        )
        return F.forall(flags, lambda b: b)

    return let(split_words(t), check)


def _two_different(t: Column) -> Column:
    def check(p: Column) -> Column:
        inner = F.exists(F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))), lambda x: x == "")
        full = F.filter(p, lambda x: x != "")
        return ~inner & (F.size(full) == 2) & (F.get(full, F.lit(0)) != F.get(full, F.lit(1)))

    return let(sections(t, r"\*\*\*\*\*\*"), check)


def _composition(t: Column, a: Args) -> Column:
    regex = r"\s?\*\*\*\s?"

    def right(p: Column) -> Column:
        return let(
            sentences(p),
            lambda s: (F.size(s) == a.number("n_sent")) & F.forall(s, lambda x: F.size(word_tokens(x)) == a.number("n_words")),
        )

    return F.coalesce(part_count(t, regex) == 3, F.lit(False)) & F.forall(F.split(t, regex), right)


def _json_body(t: Column) -> Column:
    head = lambda mark: lambda s: F.when(s.startswith(mark), F.substring(s, len(mark) + 1, 1 << 30)).otherwise(s)
    tail = lambda s: F.when(s.endswith("```"), F.substring(s, F.lit(1), F.length(s) - 3)).otherwise(s)
    return strip(steps(strip(t), *[head(m) for m in ("```json", "```Json", "```JSON", "```")], tail))


# The answers of the constrained response.
CONSTRAINED_ANSWERS = ["My answer is yes.", "My answer is no.", "My answer is maybe."]
STARS = r"(?U)\s?\*\*\*\s?"


def _equal_text(a: Column, b: Column) -> Column:
    return F.lower(strip(a)) == F.lower(strip(b))


def keyed_constraints(detected: Column | None = None) -> dict[str, Check]:
    """Constraint key to check."""
    lang = F.lit(None).cast("string") if detected is None else detected
    bullets = [r"(?dmU)^\s*\*[^\*].*$", r"(?dmU)^\s*-.*$"]
    words = lambda t: word_tokens(t)
    copy = lambda t, a: _equal_text(t, a.text("prompt_to_repeat"))
    frequency = lambda t, a: relation(_keyword_hits(t, a), a.text("relation"), a.number("frequency"))
    letters = lambda t, a: F.when(
        a.text("let_relation") == "less than", literal_count(F.lower(t), F.lower(a.text("letter"))) < a.number("let_frequency")
    ).otherwise(literal_count(F.lower(t), F.lower(a.text("letter"))) >= a.number("let_frequency"))
    return {
        "keywords:existence": lambda t, a: F.forall(a.many("keywords"), lambda k: F.regexp_like(t, pattern(k))),
        "keywords:frequency": frequency,
        "keywords:forbidden_words": lambda t, a: ~F.exists(
            a.many("forbidden_words"), lambda w: F.regexp_like(t, F.concat(F.lit(r"(?iU)\b"), w, F.lit(r"\b")))
        ),
        "keywords:letter_frequency": letters,
        "language:response_language": lambda t, a: F.coalesce(lang == a.text("language"), F.lit(True)),
        "length_constraints:number_sentences": lambda t, a: relation(F.size(sentences(t)), a.text("relation"), a.number("num_sentences")),
        "length_constraints:number_paragraphs": lambda t, a: part_count(t, STARS) == a.number("num_paragraphs"),
        "length_constraints:number_words": lambda t, a: relation(F.size(words_of(t)), a.text("relation"), a.number("num_words")),
        "length_constraints:nth_paragraph_first_word": _nth_first_word,
        "detectable_content:number_placeholders": lambda t, a: hits(t, F.lit(r"(?d)\[.*?\]")) >= a.number("num_placeholders"),
        "detectable_content:postscript": lambda t, a: _postscript_line(t, a.text("postscript_marker")),
        "detectable_format:number_bullet_lists": lambda t, a: hits(t, F.lit(bullets[0])) + hits(t, F.lit(bullets[1])) == a.number("num_bullets"),
        "detectable_format:constrained_response": lambda t, a: any_of(strip(t).contains(x) for x in CONSTRAINED_ANSWERS),
        "detectable_format:number_highlighted_sections": lambda t, a: _highlights(t) >= a.number("num_highlights"),
        "detectable_format:multiple_sections": lambda t, a: hits(
            t, F.concat(F.lit(r"(?U)\s?"), a.text("section_spliter"), F.lit(r"\s?\d+\s?"))
        ) >= a.number("num_sections"),
        "detectable_format:json_format": lambda t, a: is_json(_json_body(t)),
        "detectable_format:title": lambda t, a: F.exists(
            find_all(t, r"<<[^\n]+>>"), lambda x: strip(F.rtrim(F.ltrim(x, F.lit("<")), F.lit(">"))) != ""
        ),
        "combination:two_responses": lambda t, a: _two_different(t),
        "combination:repeat_prompt": lambda t, a: F.startswith(F.lower(strip(t)), F.lower(strip(a.text("prompt_to_repeat")))),
        "startend:end_checker": lambda t, a: F.endswith(F.lower(F.trim(strip(t), F.lit('"'))), F.lower(strip(a.text("end_phrase")))),
        "change_case:capital_word_frequency": lambda t, a: let(
            F.size(F.filter(words(t), lambda w: (w == F.upper(w)) & (w != F.lower(w)))),
            lambda n: F.when(a.text("capital_relation") == "less than", n < a.number("capital_frequency")).otherwise(n >= a.number("capital_frequency")),
        ),
        "change_case:english_capital": lambda t, a: (t == F.upper(t)) & (t != F.lower(t)) & F.coalesce(lang == "en", F.lit(True)),
        "change_case:english_lowercase": lambda t, a: (t == F.lower(t)) & (t != F.upper(t)) & F.coalesce(lang == "en", F.lit(True)),
        "punctuation:no_comma": lambda t, a: ~t.contains(","),
        "startend:quotation": lambda t, a: (F.length(strip(t)) > 1) & strip(t).startswith('"') & strip(t).endswith('"'),
        "copy:repeat_phrase": _phrase_repeats,
        "copy:copy": copy,
        "new:copy_span_idx": lambda t, a: _equal_text(
            t, F.substring(a.text("prompt_to_repeat"), a.number("n_start") + 1, a.number("n_end") - a.number("n_start"))
        ),
        "detectable_format:sentence_hyphens": lambda t, a: _hyphened(t),
        "keywords:no_adjacent_consecutive": lambda t, a: _no_alphabet_neighbours(t),
        "detectable_format:square_brackets": lambda t, a: F.forall(split_words(t), lambda w: w.startswith("[") & w.endswith("]")),
        "keywords:word_once": lambda t, a: _keyword_hits(t, a) == 1,
        "keywords:word_count_different_numbers": frequency,
        "keywords:exclude_word_harder": lambda t, a: ~F.contains(t, F.concat(F.lit(" "), strip(a.text("keyword")), F.lit(" "))),
        "paragraphs:paragraphs": lambda t, a: part_count(t, STARS) == 2,
        "paragraphs:paragraphs2": lambda t, a: part_count(t, "\n\n") == 2,
        "first_word:first_word_sent": lambda t, a: every_sentence(t, lambda s: F.lower(first_word(s)) == F.lower(strip(a.text("first_word")))),
        "first_word:first_word_answer": lambda t, a: F.coalesce(F.lower(first_word(t)) == F.lower(strip(a.text("first_word"))), F.lit(False)),
        "last_word:last_word_sent": lambda t, a: every_sentence(t, lambda s: F.lower(last_word(s)) == F.lower(strip(a.text("last_word")))),
        "last_word:last_word_answer": lambda t, a: F.lower(last_word(t)) == F.lower(strip(a.text("last_word"))),
        "detectable_format:bigram_wrapping": lambda t, a: _bigrams_wrapped(t),
        "copy:copying_simple": copy,
        "copy:copying_multiple": lambda t, a: let(
            F.split(t, r"\*\*\*\*\*\*"),
            lambda p: (F.size(p) == a.number("N")) & F.forall(p, lambda x: _equal_text(x, a.text("prompt_to_repeat"))),
        ),
        "punctuation:punctuation_dot": lambda t, a: ~t.contains("."),
        "punctuation:punctuation_exclamation": lambda t, a: ~t.contains("!"),
        "count:lowercase_counting": lambda t, a: hits(t, F.lit(r"(?U)\b[a-z]+\b")) <= a.number("N"),
        "letters:letter_counting": lambda t, a: relation(hits(t, F.lit("[a-zA-Z]")), a.text("relation"), a.number("N")),
        "letters:letter_counting2": letters,
        "count:counting_composition": _composition,
        "count:count_unique": lambda t, a: let(words(t), lambda w: F.size(w) == F.size(F.array_distinct(w))),
        "count:count_increment_word": lambda t, a: (_keyword_hits(t, a, "keyword1") == 1) & (_keyword_hits(t, a, "keyword2") == 2),
        "keywords:palindrome": lambda t, a: F.exists(split_words(t), lambda w: w == F.reverse(w)),
        "keywords:keyword_specific_position": lambda t, a: F.coalesce(
            let(F.get(sentences(t), a.number("n") - 1), lambda s: F.get(words(s), a.number("m") - 1)) == strip(a.text("keyword")), F.lit(False)
        ),
        "keywords:start_end": lambda t, a: let(
            words(t), lambda w: (F.size(w) >= 2) & (F.lower(F.get(w, F.lit(0))) == F.lower(F.try_element_at(w, F.lit(-1))))
        ),
    }


def check(kind, text, args, family: dict[str, Check]) -> Column:
    """Boolean by the constraint named in a column; false for unknown names and null results."""
    a, t = Args(args), col(text)
    out = F.lit(False)
    for name, rule in family.items():
        out = F.when(col(kind) == name, F.coalesce(rule(t, a), F.lit(False))).otherwise(out)
    return out


def constraint_score(prediction, satisfied) -> Column:
    """Mean of the satisfied flags of one response; an empty prediction scores 0."""
    n = F.aggregate(col(satisfied), F.lit(0), lambda s, x: s + x.cast("int"))
    return F.when(F.length(col(prediction)) == 0, 0.0).otherwise(n / F.size(satisfied))


__all__ = ["Args", "simple_constraints", "keyed_constraints", "check", "constraint_score", "sentences"]
