"""The licence scan against a plain comparison at every place."""

import random
import re

import numpy as np
import pytest

from chatloom.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, known):
    """Number of words, and (start, clause, share) of every accepted place, by trying every clause at every start."""
    words = WORD.findall((text or "").translate(LOWER))
    out = []
    for start in range(-40, len(words)):
        for c, x in enumerate(known):
            same = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(x.words)]
            if sum(same) >= x.least and all(same[i] for i in x.must):
                out.append((start, c, sum(same) / len(same)))
    return len(words), out


def scanned(text, known, seen=None):
    words = sorted({w for c in known for w in c.words})
    vocabulary = licences.Vocabulary(words)
    index = licences.Index(known, vocabulary, np.zeros(len(words)) if seen is None else seen)
    (n, at, ids), = vocabulary.texts([text])
    return n, index.places(at, ids)


def test_places_equal_a_plain_comparison(monkeypatch):
    rng = random.Random(3)
    known = licences.clauses()
    vocabulary = sorted({w for c in known for w in c.words})
    for trial in range(300):
        parts = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(known).words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary + ["x", "é", "中"])
            parts += words[rng.randint(0, 1) :] + [rng.choice(vocabulary + ["ſ", "K", "ÀB"]) for _ in range(rng.randint(0, 2))]
        text = "".join((w.upper() if rng.random() < 0.3 else w) + rng.choice([" ", ", ", "\n", "-", "\x7f"]) for w in parts)
        monkeypatch.setattr(licences, "BLOCK", rng.choice([48, 100, 1 << 22]))
        monkeypatch.setattr(licences, "REACH", 40)
        seen = np.array([rng.randint(0, 9) for _ in vocabulary])
        assert scanned(text, known, seen) == plain(text, known), text


def test_words_at_the_ends_of_blocks(monkeypatch):
    monkeypatch.setattr(licences, "BLOCK", 64)
    monkeypatch.setattr(licences, "REACH", 32)
    known = licences.clauses()
    for text in ("é" * 500, "a" * 1000 + " mit license " + "b" * 64 + "mit license", "mit license " * 40, " " * 200 + "CC-BY", "\x00" * 300, "x" * 64 + "mit license"):
        assert scanned(text, known) == plain(text, known)


def test_labels_of_licences():
    known = licences.clauses()
    labels = lambda text: {known[c].label for _, c, _ in scanned(text, known)[1]}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by", "cc-by-nc"}
    assert labels("Apache License, Version 2.0") == {"apache", "apache-2.0"}
    assert labels("apache licence") == set()
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    assert labels(notice) == {"mit"}
    assert labels(notice.replace("obtaining", "who gets")) == set()  # the rest no longer stands at its relative positions
    assert labels(notice.replace("obtaining", "getting")) == {"mit"}
    assert labels(notice.replace("hereby granted", "hereby given")) == set()  # a key phrase is broken


def test_key_phrases_have_to_stand_once():
    with pytest.raises(ValueError):
        licences.clause("x", "a b a b", ("a b",))
    with pytest.raises(ValueError):
        licences.clause("x", "a b", ())


def test_scan_of_odd_rows(spark, odd_documents, no_documents):
    known = licences.clauses()
    extra = spark.createDataFrame([(2**60 + 1, "The MIT License. " * 9000, 1), (None, "mit license\nCC BY", 2)], "doc_id long, text string, places int")
    for docs in (odd_documents, extra):
        got = sorted((repr(r.doc_id), r.n_words, [(p.start, p.label, p.share, p.base) for p in r.places]) for r in licences.scan(docs).collect())
        want = []
        for r in docs.collect():
            n, places = plain(r.text, known)
            want.append((repr(r.doc_id), n, [(s, known[c].label, x, known[c].base) for s, c, x in places]))
        assert got == sorted(want)
    assert licences.scan(no_documents).collect() == []
