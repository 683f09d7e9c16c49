"""Token ids with a tokenizer file: words are encoded once and remembered, which is exact for tokenizers that split at white space."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import released

REMEMBERED = 100_000  # words, and pieces of words, in each of the two generations of a worker's memory
LONG = 64  # longer words are not remembered
CHUNK = 256  # texts that are encoded together


# The normaliser and the pieces of the lower-case word tokenizer, and the characters on which they need no more than lower().
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
PLAIN = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+"


class Memory(dict):
    """Ids of strings, made when first asked for. Two generations bound it: what the younger lacks may come from the older."""

    def __init__(self, make: Callable[[str], bytes], old: dict[str, bytes] | None = None):
        self.make, self.old = make, old or {}

    def __missing__(self, s: str) -> bytes:
        ids = self.old.get(s)
        if ids is None:
            ids = self.make(s)
        if len(s) <= LONG:
            self[s] = ids
        return ids

    def turned(self) -> Memory:
        """This memory, or where it is full the next one."""
        if len(self) <= REMEMBERED:
            return self
        self.old = {}
        return Memory(self.make, self)


class Words:
    """Encodes texts of a tokenizer that drops white space and never joins across it. ``whole`` turns the memory off."""

    def __init__(self, path: str, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.whole = whole
        parts = [json.loads(x.__getstate__()) if x else None for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        known = parts[0] == LOWER_WORDS["normalizer"] and LOWER_WORDS["pattern"] in json.dumps(parts[1], ensure_ascii=False).replace("\\\\", "\\")
        self.plain_text = re.compile(f"[ \\t-\\r{PLAIN}]*+" if known else r"(?!)")
        self.cut = re.compile(PIECES).findall
        if known:  # texts of plain characters: their pieces are remembered, and new ones go to the merges directly
            from tokenizers.pre_tokenizers import ByteLevel

            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.merges = self.tokenizer.model
            self.shown = {c: level.pre_tokenize_str(chr(c))[0][0] for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]}
        self.words, self.pieces = Memory(self.word), Memory(self.piece)
        # separators that str.split() knows and the tokenizer does not
        self.odd = re.compile("[\x1c-\x1f]")

    def packed(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def piece(self, s: str) -> bytes:
        ids = [t.id for t in self.merges.tokenize(s if s.isascii() else s.translate(self.shown))]
        return pack(f"<{len(ids)}{'H' if self.kind.itemsize == 2 else 'I'}", *ids)

    def is_plain(self, text: str) -> bool:
        return self.plain_text.fullmatch(text) is not None and "<|" not in text

    def from_pieces(self, text: str) -> bytes:
        """Ids of a plain word or text."""
        return b"".join(map(self.pieces.__getitem__, self.cut(text.lower())))

    def word(self, w: str) -> bytes:
        return self.from_pieces(w) if self.is_plain(w) else self.packed([w])[0]

    def text(self, t: str) -> bytes:
        if self.is_plain(t):
            return self.from_pieces(t)
        return self.packed([t])[0] if self.odd.search(t) else b"".join(map(self.words.__getitem__, t.split()))

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.whole:
            return self.packed(texts)
        self.words, self.pieces = self.words.turned(), self.pieces.turned()
        return [self.text(t) for t in texts]


def shared_words(path: str, whole: bool) -> Words:
    """One memory per Python worker, kept from task to task."""
    state = sys.modules.setdefault("_text_worker_state", types.ModuleType("_text_worker_state")).__dict__
    if (path, whole) not in state:
        state[path, whole] = Words(path, whole)
    return state[path, whole]


def token_rows(docs: DataFrame, tokenizer: str, end_id: int | None = 1, text: str = "text", key: str = "doc_id", whole: bool = False) -> DataFrame:
    """(_key, _n, _ids): the ids of every whole text (null: empty) and ``end_id`` as little-endian numbers of two bytes, four for a large vocabulary.

    ``tokenizer`` is the path of a file that every executor has. Set ``whole`` for a tokenizer whose tokens cross white space.
    """

    def encoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = shared_words(tokenizer, whole)
        end = b"" if end_id is None else np.asarray([end_id], words.kind).tobytes()
        for part in parts:
            for a in range(0, len(part), CHUNK):
                few = part.iloc[a : a + CHUNK]
                ids = [x + end for x in words.encode([t or "" for t in few["_text"]])]
                yield pd.DataFrame({"_key": few["_key"], "_n": [len(x) // words.kind.itemsize for x in ids], "_ids": ids})

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(released(encoded), f"_key {docs.schema[key].dataType.simpleString()}, _n long, _ids binary")
