"""Secret scan: an Aho-Corasick pass finds keywords, anchored patterns run only at the hits, checksums decide on the formats that carry one.

A text is reduced to one byte per code point, so that places in it are places in the text: ASCII letters are lowered for the
keywords, and for bare hexadecimal keys every hexadecimal digit becomes one class character, whose run of 24 is a keyword like the others.
From a hit the kind's pattern is matched at that place; places inside an earlier match of the kind are passed over, which gives
the leftmost non-overlapping matches of a search over the whole text.

Base kinds, in order: assign, access, hex. Added kinds, with an embedded checksum that must agree: github (``gh?_`` tokens) and npm
(``npm_`` tokens), whose last six characters are the CRC-32 of the thirty before in base 62, and xprv (extended private
keys), which end in four bytes of a double SHA-256.

Edge cases: a null text is empty and has no spans; texts are scanned whole, whatever their length; repeated rows are scanned each; an empty table gives
an empty result. Only the named columns and the results are returned, so other columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keywords and patterns of the base kinds, then of the checksummed formats.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
GITHUB = r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"
NPM = r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"
XPRV = r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![0-9A-Za-z])"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "github", "npm", "xprv")


def crc62(match: re.Match) -> bool:
    value = 0
    for ch in match[2]:
        value = value * 62 + BASE62.index(ch)
    return value == zlib.crc32(match[1].encode("ascii"))


def base58check(match: re.Match) -> bool:
    value = 0
    for ch in match[0]:
        value = value * 58 + BASE58.index(ch)
    try:
        raw = value.to_bytes(82, "big")
    except OverflowError:
        return False
    return sha256(sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def scanner(made: list = []):  # noqa: B006
    """The automata and patterns, made once per task."""
    import ahocorasick

    if made:
        return made[0]

    words = ahocorasick.Automaton()
    for kind, keys in (("assign", NAMES), ("access", ("akia",)), ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")), ("npm", ("npm_",)), ("xprv", ("xprv",))):
        for key in keys:
            words.add_word(key, (kind, len(key)))
    words.make_automaton()
    runs = ahocorasick.Automaton()
    runs.add_word("0" * LEAST["hex"], LEAST["hex"])
    runs.make_automaton()
    digits = bytes(0x30 if chr(b) in "0123456789abcdef" else 0x2E for b in range(256))
    patterns = {k: re.compile(p, re.ASCII) for k, p in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("github", GITHUB), ("npm", NPM), ("xprv", XPRV))}
    made.append((words, runs, digits, patterns))
    return made[0]


def accepted(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= LEAST[kind]
    if kind in LEAST:
        return len(match[0]) >= LEAST[kind]
    return base58check(match) if kind == "xprv" else crc62(match)


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then by the order of the kinds."""
    if not text:
        return []
    words, runs, digits, patterns = scanner()
    flat = text.encode("latin-1", "replace")
    hits = [(end - n + 1, kind) for end, (kind, n) in words.iter(flat.lower().decode("latin-1"))]
    hits += [(end - n + 1, "hex") for end, n in runs.iter(flat.translate(digits).decode("latin-1"))]
    hits.sort()
    passed, found = dict.fromkeys(KINDS, 0), []
    for start, kind in hits:
        if start < passed[kind]:
            continue
        match = patterns[kind].match(text, start)
        if match:
            passed[kind] = match.end()
            if accepted(kind, match):
                found.append((start, match.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, secrets array<struct<kind, start, end, value>>): every secret of every text, in one pass without a shuffle."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [[{"kind": k, "start": s, "end": e, "value": t[s:e]} for s, e, k in spans_of(t)] for t in part["_text"]]
            yield pd.DataFrame({"_key": part["_key"], "secrets": found})

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {docs.schema[key].dataType.simpleString()}, secrets array<struct<kind string, start int, end int, value string>>"
    return rows.mapInPandas(batches, schema).withColumnRenamed("_key", key)


def listed(spans):
    """kind:start:end of the spans, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(docs: DataFrame, text: str = "text", key: str = "doc_id", mark: str = "[secret]") -> DataFrame:
    """(key, text) with every secret replaced by ``mark``; overlapping spans become one mark."""

    def clean(t: str | None) -> str | None:
        out, at = [], 0
        for s, e, _ in spans_of(t):
            if e <= at:
                continue
            out += [t[at:s], mark] if s >= at else []
            at = e
        return t if t is None else "".join(out) + t[at:]

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"_key": part["_key"], "_text": [clean(t) for t in part["_text"]]})

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(batches, rows.schema).withColumnsRenamed({"_key": key, "_text": text})
