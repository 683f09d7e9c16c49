"""Column expressions for text that follow Python's string rules inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS_CLASS = "[" + WHITESPACE + "]"
# String.punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# One word (letters, digits, underscore) or one other visible character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
# A word in the sense of \w+ on unicode text.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression named inside a lambda of a higher-order function is evaluated per element, because the
    optimizer inlines it there; binding it as a lambda variable keeps the work linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def steps(value: Column, *rules) -> Column:
    """Apply rules one after the other, each on the bound result of the one before.

    A rule that names its input several times would otherwise multiply the expression with every step.
    """
    out = value
    for rule in rules:
        out = let(out, rule)
    return out


def strip(c) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def is_blank(c) -> Column:
    """Null or only white space."""
    return col(c).isNull() | (strip(c) == "")


def split_words(c) -> Column:
    """str.split(): white-space separated words without empties."""
    return F.filter(F.split(col(c), WS_CLASS + "+"), lambda w: w != "")


def count_matches(c, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))


def find_all(c, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), group)


def last_of(arr: Column) -> Column:
    """Last element or null, also for empty arrays."""
    return F.try_element_at(arr, F.lit(-1))


def occurrences(c, needle: str) -> Column:
    """str.count of a literal that does not overlap itself."""
    s = col(c)
    return ((F.length(s) - F.length(F.replace(s, F.lit(needle)))) / len(needle)).cast("int")


def any_of(conditions) -> Column:
    out = F.lit(False)
    for cond in conditions:
        out = out | cond
    return out


def replace_all(c, pairs) -> Column:
    """Literal replacements applied one after the other."""
    out = col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def quote_regex(literal: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ch for ch in literal)


def word_tokens(c) -> Column:
    """The built-in tokenizer: words and single punctuation marks."""
    return find_all(c, TOKEN_PATTERN)


def token_id(tok: Column, vocab: int = 50_000) -> Column:
    """Stable id of a token in a hashed vocabulary."""
    return (F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("long") % vocab).cast("int")


def hash_key(key, seed: int = 42) -> Column:
    """Position of a row in the seeded order that stands in for every random draw."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))
