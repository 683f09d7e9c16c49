"""Licence scan: a positional index of licence clauses, entered by each file's rarest licence words.

The index holds, for every word of the clauses, its postings (clause, position). A first pass counts in how many texts each of these words occurs; that gives
its inverse document frequency over the whole corpus. In a text only the clauses' words are kept, with their positions. The highest-IDF licence words
a text has are looked up first: a clause is entered through the rarest of its mandatory words, which any place of the clause must hold, so no place is lost.
From there the postings are intersected by relative position, rarest first: ``start = place of the word - its position in the clause`` must agree for
all words of the mandatory key phrases. A start that survives is verified: at least ``SHARE`` percent of all words of the clause stand at their relative positions.
A clause of key words only (the base phrases) therefore has to stand whole. Frequencies decide the order of work, never the result.

Long licences are given as several clauses, so text between clauses does no harm; a label needs one clause. A text's score is the largest share of a clause
that an accepted place holds, 0 without one.

Edge cases: a null text is empty: no words, no places, score 0; texts are read whole, in blocks of bounded size, however long a text or a word is; repeated
rows are scanned each; rows without a key are kept; an empty table gives an empty result. Only the key and the results are returned, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, clause in lower-case words, and its mandatory key phrases.
CLAUSES = (
    ("gpl-2.0", "gnu general public license version 2", ("general public license version 2",)),
    ("gpl-3.0", "gnu general public license version 3", ("general public license version 3",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "redistribute it and or modify it")),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("apache-2.0", "apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "this software and associated documentation files")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "with or without modification")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("source code form", "mozilla public license")),
    ("epl", "eclipse public license", ("eclipse public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("express or implied warranty", "will the authors be held liable")),
    ("cc0", "creative commons zero", ("creative commons zero",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("cc-by", "creative commons attribution", ("creative commons attribution",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc-by-sa", "creative commons attribution sharealike", ("commons attribution sharealike",)),
    ("cc-by-nc", "cc by nc", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial", ("commons attribution noncommercial",)),
    ("cc-by-nd", "cc by nd", ("cc by nd",)),
    ("cc-by-nd", "creative commons attribution noderivatives", ("commons attribution noderivatives",)),
)

SHARE = 80  # percent of a clause's words that stand at their places
BLOCK = 4 << 20  # bytes of text that are read at once
REACH = 4096  # a block ends at a separator among so many bytes, else inside a word that is longer than any of the clauses


class Clause(NamedTuple):
    label: str
    words: tuple[str, ...]
    must: tuple[int, ...]  # positions of the words of the key phrases
    least: int  # words that have to stand
    base: bool


def clause(label: str, text: str, keys: tuple[str, ...], base: bool = False, share: int = SHARE) -> Clause:
    words, must = tuple(text.split()), set()
    for key in keys:
        part = tuple(key.split())
        at = [i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part]
        if not part or len(at) != 1:
            raise ValueError(f"{key!r} has to stand once in {text!r}")
        must.update(range(at[0], at[0] + len(part)))
    if not must:
        raise ValueError(f"{text!r} needs a key phrase")
    return Clause(label, words, tuple(sorted(must)), -(-share * len(words) // 100), base)


def clauses() -> list[Clause]:
    """The base phrases, which have to stand whole, and then the clauses."""
    return [clause(label, text, (text,), True) for text, label in BASE] + [clause(*x) for x in CLAUSES]


class Vocabulary:
    """Finds the words of the clauses in UTF-8 bytes. Words are at most 16 bytes, read as two numbers."""

    def __init__(self, words: list[str]):
        self.words = words
        raw = [w.encode() for w in words]
        if any(not 0 < len(r) <= 16 for r in raw):
            raise ValueError("words of clauses have 1 to 16 bytes")
        keys = np.frombuffer(b"".join(r.ljust(16, b"\0") for r in raw), "<u8").reshape(-1, 2)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        self.ids, self.keys = order.astype(np.int32), keys[order]
        self.mixed = self.mix(self.keys)
        by_mixed = np.argsort(self.mixed, kind="stable")
        self.ids, self.keys, self.mixed = self.ids[by_mixed], self.keys[by_mixed], self.mixed[by_mixed]
        # letters are lowered, separators are 0; only ASCII has separators
        low = np.arange(256, dtype=np.uint8)
        low[ord("A") : ord("Z") + 1] += 32
        for a, b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
            low[a : b + 1] = 0
        self.low = low
        self.begins = np.zeros((18, 256), bool)  # by length and first byte
        for r in raw:
            self.begins[len(r), r[0]] = True
        self.masks = np.array([[(1 << 8 * min(n, 8)) - 1, (1 << 8 * min(max(n - 8, 0), 8)) - 1] for n in range(18)], dtype="<u8")

    @staticmethod
    def mix(keys: np.ndarray) -> np.ndarray:
        return keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)

    def block(self, raw: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the words in a block, and (index of the word, id) of those that the clauses have. ``inside``: its first word goes on from before."""
        low = np.zeros(len(raw) + 16, np.uint8)
        low[: len(raw)] = self.low[np.frombuffer(raw, np.uint8)]
        is_word = low != 0
        edge = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
        if is_word[0]:
            edge = np.concatenate(([0], edge))
        starts, sizes = edge[0::2], edge[1::2] - edge[0::2]
        known = self.begins[np.minimum(sizes, 17), low[starts]]
        if inside and len(starts) and starts[0] == 0:
            known[0] = False
        at = np.flatnonzero(known)
        raw16 = low[starts[at][:, None] + np.arange(16)]
        keys = np.ascontiguousarray(raw16).view("<u8") & self.masks[sizes[at]]
        mixed = self.mix(keys)
        place = np.minimum(np.searchsorted(self.mixed, mixed), len(self.mixed) - 1)
        same = (self.keys[place] == keys).all(axis=1)
        return starts, at[same], self.ids[place[same]]

    def text(self, raw: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words of a text, and the indices and ids of the words that the clauses have."""
        n, at, ids, begin, inside = 0, [], [], 0, False
        while begin < len(raw):
            end = min(begin + BLOCK, len(raw))
            cuts = False
            if end < len(raw):
                gaps = np.flatnonzero(self.low[np.frombuffer(raw, np.uint8, min(REACH, end - begin), max(begin, end - REACH))] == 0)
                if len(gaps):
                    end = max(begin, end - REACH) + int(gaps[-1]) + 1
                else:
                    cuts = True
            starts, i, k = self.block(raw[begin:end], inside)
            goes_on = inside and len(starts) > 0 and starts[0] == 0
            at.append(i + (n - goes_on))
            ids.append(k)
            n += len(starts) - goes_on
            begin, inside = end, cuts
        none = np.zeros(0, np.int64)
        return int(n), np.concatenate([none, *at]), np.concatenate([none.astype(np.int32), *ids])

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``text`` of each; short texts are read together, as one block."""
        few, size = [], 0
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            if len(raw) + size + len(few) > BLOCK and few:
                yield from self.together(few)
                few, size = [], 0
            if len(raw) > BLOCK:
                yield self.text(raw)
            else:
                few.append(raw)
                size += len(raw)
        if few:
            yield from self.together(few)

    def together(self, few: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        starts, at, ids = self.block(b"\n".join(few) + b"\n", False)
        ends = np.cumsum([len(r) + 1 for r in few])
        words = np.concatenate(([0], np.searchsorted(starts, ends)))
        hits = np.searchsorted(at, words)
        for k in range(len(few)):
            yield int(words[k + 1] - words[k]), at[hits[k] : hits[k + 1]] - words[k], ids[hits[k] : hits[k + 1]]


class Index:
    """Positional postings of the clauses, with the rarest mandatory word of each as its entry."""

    def __init__(self, known: list[Clause], vocabulary: Vocabulary, seen: np.ndarray):
        """``seen``: texts that hold each word."""
        number = {w: i for i, w in enumerate(vocabulary.words)}
        self.known, self.entries, self.plan = known, {}, []
        self.rank = np.argsort(np.argsort(seen, kind="stable"), kind="stable")  # 0: the highest IDF
        for c, x in enumerate(known):
            postings = [(number[w], i) for i, w in enumerate(x.words)]
            must = sorted((postings[i] for i in x.must), key=lambda p: (self.rank[p[0]], p[1]))
            rest = [p for p in postings if p[1] not in x.must]
            self.plan.append((must, rest))
            self.entries.setdefault(must[0][0], []).append(c)

    def places(self, at: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, float]]:
        """(start, clause, share) of every accepted place of a text; a start may lie before the text."""
        if not len(ids):
            return []
        order = np.argsort(ids, kind="stable")
        found, first = np.unique(ids[order], return_index=True)
        where = dict(zip(found.tolist(), np.split(at[order], first[1:])))
        out = []
        for word in sorted(where.keys() & self.entries.keys(), key=self.rank.__getitem__):
            for c in self.entries[word]:
                must, rest = self.plan[c]
                if any(w not in where for w, _ in must):
                    continue
                starts = where[word] - must[0][1]
                for w, i in must[1:]:
                    starts = np.intersect1d(starts, where[w] - i, assume_unique=True)
                    if not len(starts):
                        break
                if not len(starts):
                    continue
                held = np.full(len(starts), len(must))
                for w, i in rest:
                    if w in where:
                        held += np.isin(starts + i, where[w], assume_unique=True)
                m = len(self.known[c].words)
                out += [(int(s), c, h / m) for s, h in zip(starts, held.tolist()) if h >= self.known[c].least]
        return sorted(out)


def seen_in(docs: DataFrame, words: list[str], text: str = "text") -> np.ndarray:
    """In how many texts each word occurs. The table that reaches the driver has a row per word of the clauses."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, n = Vocabulary(words), np.zeros(len(words), np.int64)
        for part in parts:
            for _, _, ids in vocabulary.texts(part.column("_text").to_pylist()):
                n[np.unique(ids)] += 1
        yield pa.RecordBatch.from_pydict({"_word": np.flatnonzero(n).astype(np.int32), "_n": n[n > 0]})

    counts = docs.select(F.col(text).alias("_text")).mapInArrow(batches, "_word int, _n long").groupBy("_word").agg(F.sum("_n").alias("_n"))
    seen = np.zeros(len(words), np.int64)
    for row in counts.collect():
        seen[row["_word"]] = row["_n"]
    return seen


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", known: list[Clause] | None = None) -> DataFrame:
    """(key, n_words, places array<struct<start, label, share, base>>): every accepted place of every clause, by start. Reads the texts twice, shuffles none."""
    known = clauses() if known is None else known
    words = sorted({w for c in known for w in c.words})
    seen = seen_in(docs, words, text)

    place = pa.struct([("start", pa.int64()), ("label", pa.string()), ("share", pa.float64()), ("base", pa.bool_())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(words)
        index = Index(known, vocabulary, seen)
        for part in parts:
            sizes, places = [], []
            for n, at, ids in vocabulary.texts(part.column("_text").to_pylist()):
                sizes.append(n)
                places.append([{"start": s, "label": known[c].label, "share": x, "base": known[c].base} for s, c, x in index.places(at, ids)])
            yield pa.RecordBatch.from_arrays([part.column("_key"), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(place))], ["_key", "n_words", "places"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {docs.schema[key].dataType.simpleString()}, n_words long, places array<struct<start: long, label: string, share: double, base: boolean>>"
    return rows.mapInArrow(batches, schema).withColumnRenamed("_key", key)


def listed(places: Column) -> Column:
    """The distinct labels of places, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
