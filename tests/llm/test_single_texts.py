"""Secrets, rules, lines, extraction, records and the classifier against brute force."""

import collections
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import lines, quality, rules, secret_scan, template, warc

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def test_base_spans_equal_a_plain_search():
    rng = random.Random(1)
    parts = ["token", "PASSWORD", "api", "_", "key", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0", "0123abc", "deadbeef", "é", "😀", "passwd", "ſecret", "x", "İ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert secret_scan.spans_of(text) == base_spans(text), text


def checksummed(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secret_scan.BASE62[d] + digits
    return prefix + body + digits


def test_checksums_decide():
    good = checksummed("ghp_", "A" * 15 + "b7" * 7 + "c")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    npm = checksummed("npm_", "z" * 30)
    text = f"see {good} or {bad} and {npm}."
    assert [(text[s:e], k) for s, e, k in secret_scan.spans_of(text)] == [(good, "github"), (npm, "npm")]
    public = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    assert secret_scan.spans_of(f"({public})") == [(1, 1 + len(public), "xprv")]
    assert secret_scan.spans_of(f"({public[:-1]}j)") == []


def test_scan_and_redact(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        got = sorted((repr(r.doc_id), [(s.start, s.end, s.kind) for s in r.secrets]) for r in secret_scan.scan(docs).collect())
        assert got == sorted((repr(r.doc_id), base_spans(r.text or "")) for r in docs.collect())
    assert secret_scan.scan(no_documents).collect() == []
    assert all(r.text is None or not base_spans(r.text) for r in secret_scan.redacted(odd_documents).collect())


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    grams = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    rows = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(rows) - len(set(rows)), len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics(documents, odd_documents):
    for docs in (documents, odd_documents):
        got = collections.Counter((r.doc_id, *[r[n] for n in NAMES]) for r in rules.measured(docs).collect())
        assert got == collections.Counter((r.doc_id, *plain_statistics(r.text)) for r in docs.collect())


def test_repeats_of_few_words(spark):
    texts = ["a a a", "a a a a", "a b c a b c", "a b c d a b", "x " * 9, "a b a b a b a"]
    got = {r.text: r.n_repeat_words for r in rules.measured(spark.createDataFrame([(t,) for t in texts], "text string"), keep=("text",)).collect()}
    assert got == {t: plain_statistics(t)[4] for t in texts}


def test_judge(documents, labels, odd_documents, no_documents):
    judged = rules.judge(documents, labels)
    rows = judged.join(labels, "doc_id").collect()
    assert judged.count() == documents.count()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    passed = [r for r in rows if not r.base_failed]
    good = [r.kept for r in passed if r.quality == 1]
    assert sum(good) >= 0.97 * len(good)
    no_labels = labels.limit(0)
    assert all(r.kept != r.base_failed for r in rules.judge(odd_documents, no_labels).collect())
    assert rules.judge(odd_documents, labels).count() == odd_documents.count()
    assert rules.judge(no_documents, labels).collect() == []


def test_folded_weights_are_averaged_vectors_and_softmax():
    texts = [("good words here and there", 1), ("bad $$$ text", 0), ("more good words", 1), ("$$$ *** bad", 0), ("words and words", 1)]
    rows = []
    for t, y in texts:
        ids, counts = np.unique(quality.buckets(t.encode()), return_counts=True)
        rows.append((ids, counts.astype(np.float32), y))
    vectors, out, bias = quality.learned(rows, 7)
    model = quality.train(rows, 7)
    for t in [t for t, _ in texts] + ["", "something else", None]:
        logits = vectors[quality.buckets((t or "").encode())].mean(axis=0) @ out + bias
        p = np.exp(logits - logits.max())
        assert abs(model.score(t) - p[1] / p.sum()) < 1e-4


def test_junk_is_rejected_by_the_rules(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = rules.judge(docs, marks).join(marks, "doc_id").filter("NOT base_failed").collect()
    junk, good = [r for r in rows if r.quality == 0], [r for r in rows if r.quality == 1]
    assert len(junk) > 10 and sum(not r.kept for r in junk) >= 0.9 * len(junk) and sum(r.kept for r in good) >= 0.97 * len(good)


def test_rules_are_learned_in_order():
    # bins of two features: label 0 where the first is high, or the second is low
    counts = [((a, b), half, int(not (a == 2 or b == 0)), 20) for a in range(3) for b in range(3) for half in (False, True)]
    learned = rules.learn(["f", "g"], [[1.0, 2.0], [5.0, 6.0]], counts)
    assert sorted(learned) == [[("f", ">", 2.0)], [("g", "<=", 5.0)]]
    assert rules.learn(["f"], [[1.0]], [((0,), False, 1, 9), ((1,), True, 1, 9)]) == []


def plain_line_dedup(rows, window=3, unit_words=20):
    """Kept lines by comparing the runs of all documents in order of (id, text)."""
    seen, out = set(), []
    for key, text in rows:
        parts = (text or "").split("\n")
        units = []
        for i, line in enumerate(parts):
            n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
            units += [(line, k, i) for k in range(min(window, 1 + n // unit_words) if n else 0)]
        gone, fresh = set(), []
        for a in range(len(units) - window + 1):
            run = tuple(u[:2] for u in units[a : a + window])
            if run in seen:
                gone |= {u[2] for u in units[a : a + window]}
            else:
                fresh.append(run)
                seen.add(run)
        out.append((key, "\n".join(x for i, x in enumerate(parts) if i not in gone) if gone else text, len(gone)))
    return out


def test_line_dedup(documents):
    want = plain_line_dedup([(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()])
    got = [(r.doc_id, r.text, r.n_removed) for r in lines.dedup_lines(documents).orderBy("doc_id").collect()]
    assert got == want and sum(n for *_, n in got) > 0


def test_line_dedup_runs(spark):
    long = " ".join(f"w{i}" for i in range(51))
    rows = [
        (1, f"a b\nc d\ne f\n{long}"), (2, f"start\n{long}\nend"), (3, "c d\n\na b\nc d\ne f\nnew"), (4, "a b\nc d"), (5, "e f\ne f\ne f\ne f"), (6, None), (7, ""), (8, long),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_x", F.lit(1)).drop("_x")
    got = [(r.doc_id, r.text, r.n_removed) for r in lines.dedup_lines(docs).orderBy("doc_id").collect()]
    assert got == plain_line_dedup(rows)
    assert got[1] == (2, "start\nend", 1) and got[7] == (8, "", 1) and got[3][2] == 0


def test_line_dedup_odd(spark, odd_documents, no_documents):
    out = lines.dedup_lines(odd_documents)
    assert set(out.columns) == {*odd_documents.columns, "n_lines", "n_removed"}
    assert out.count() == odd_documents.count() and all(r.n_lines == 0 for r in out.filter("text IS NULL").collect())
    assert lines.dedup_lines(no_documents).collect() == []
    text = " ".join(f"u{i}" for i in range(60))
    twice = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    assert sorted(r.text for r in lines.dedup_lines(twice).collect()) == ["", "", "", text]  # one stays, whatever repeats


def plain_article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_extraction(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in template.extract(pages).collect()}
    assert got == {r.page_id: (plain_article(r.html), len(plain_article(r.html))) for r in pages.collect()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_extraction_without_article(spark, broadcast, monkeypatch):
    monkeypatch.setattr(template, "is_small", lambda df: broadcast)
    page = (
        '<html><body><div class="top-menu"><a href=1>Home</a></div><div id=main-{0}><h2>Head {0}</h2><p>Body <i>of</i>\n page {0} &amp; more &#233;</p>'
        '<ul><li>one<li>two</ul><form><input><p>mail</form><div class="comments"><p>I agree</div><script>var x="<p>";</script></div><div class="footer">f</div>'
    )
    rows = [(i, f"http://h{i % 2}.org/{i}", page.format(i)) for i in range(6)] + [(7, None, None), (8, "nonsense", "plain text only"), (8, "nonsense", "plain text only"), (9, "http://x", "")]
    got = collections.Counter((r.page_id, r.text) for r in template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = [(i, f"Head {i}\nBody of page {i} & more é\none\ntwo") for i in range(6)] + [(7, ""), (8, "plain text only"), (8, "plain text only"), (9, "")]
    assert got == collections.Counter(want)


def test_extraction_of_copies_keeps_the_article(spark):
    page = "<body><nav>menu</nav><article><p>Same text.</p></article><aside>x</aside>"
    rows = [(i, "http://one.org/a", page) for i in range(5)]
    assert {r.text for r in template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"Same text."}
    assert template.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def extracted(spark, pages):
    rows = [(i, f"http://one.org/{i}", p) for i, p in enumerate(pages)]
    return {r.page_id: r.text for r in template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


@pytest.mark.parametrize(
    "page",
    [
        '<body class="has-sidebar"><article>{}</article><div class="sidebar">s</div>', '<main class="content with-sidebar">{}</main>', '<article class="post comments-open">{}<div class="comment-list">c</div></article>',
        '<article><div id="notice-period">{}</div></article>', '<article>{}</article><div class=related>r</div>', '<div class="sidebar-layout"><nav>n</nav><article>{}</article></div>',
    ],
)
def test_words_do_not_reject_the_page(spark, page):
    body = "<p>The text of the page is here.</p><section class='related-work'>Earlier work.</section><p>x <math><mi>y</mi></math> z"
    for html_ in (page.format(body), "<html>" + page.format(body)):
        assert extracted(spark, [html_]) == {0: "The text of the page is here.\nEarlier work.\nx y z"}


def test_template_slots_go_and_others_stay(spark):
    page = '<nav>n</nav><article><p>Story {0} is told at some length here.</p><div class="zq1">Buy our soap now!</div><p>And ends so {0}.</p></article><div class=k{0}>x</div>'
    assert extracted(spark, [page.format(i) for i in range(6)]) == {i: f"Story {i} is told at some length here.\nAnd ends so {i}." for i in range(6)}
    page = '<div class=content><div class=lead>Lead {0} in short.</div><div class=body>Body {0} which is a good deal longer than its lead, and goes on and on.</div></div><div class=q><a href=1>one</a> <a href=2>two</a></div><div class=z>The same everywhere.</div>'
    want = {i: f"Lead {i} in short.\nBody {i} which is a good deal longer than its lead, and goes on and on." for i in range(6)}
    assert extracted(spark, [page.format(i) for i in range(6)]) == want
    # the same line in two pages of six is no template, nor is what pages repeat that are copies
    some = [page.format(i) for i in range(6)]
    some[1] = some[0]
    assert extracted(spark, some) == {**want, 1: want[0]}


def test_records(spark, tmp_path):
    page = "<html><head><title>T</title></head><body><p>a &lt;b&gt; &#233;&#x1F600;</p><!-- c --><script>1</script><p>two</p></body></html>"
    pages = spark.createDataFrame([(1, "http://a/", page), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    source = warc.responses(pages)
    got = warc.derivatives(source).collect()
    assert len(got) == 6 and all(r.digest_ok for r in got)
    ids = {(r.page_id, r.record_id) for r in source.collect()}
    assert {(r.page_id, r.refers_to) for r in got} == ids
    text = {r.page_id: r.block for r in got if r.warc_type == "conversion"}
    assert text == {1: "a <b> é😀\ntwo", 2: ""}
    meta = next(r.block for r in got if r.warc_type == "metadata" and r.page_id == 1)
    assert "http-header-Content-Type: text/html; charset=utf-8\r\n" in meta and "http-status-line: HTTP/1.1 200 OK" in meta
    # files: what is written is read back, and a block may hold the line ends that part records
    whole = source.drop("page_id", "source_digest").unionByName(warc.derivatives(source).select(*[c for c in source.columns if c not in ("page_id", "payload_digest", "source_digest")]), allowMissingColumns=True)
    warc.write_warc(whole, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w" / "*.txt"))
    columns = sorted(back.columns)
    key = lambda r: tuple(str(r[c]) for c in columns)
    assert sorted(map(key, back.collect())) == sorted(key(r) for r in whole.select(*columns).collect())
    changed = source.withColumn("payload_digest", F.lit("sha256:0"))
    assert {(r.digest_ok, r.source_digest) for r in warc.derivatives(changed).collect()} == {(False, "sha256:0")}
    assert warc.derivatives(source.limit(0)).collect() == []


def test_classifier(spark, documents, labels, odd_documents, no_documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(quality.training_rows(docs, marks))
    rows = quality.score(docs, model).withColumn("held", quality.held_out()).join(marks, "doc_id").filter("held").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    again = quality.fit(quality.training_rows(docs.repartition(7), marks))
    assert abs(model.weights - again.weights).max() == 0  # reruns agree
    assert quality.score(odd_documents, model).count() == odd_documents.count()
    assert quality.score(no_documents, model).collect() == []
    assert quality.kept(docs, model).count() == quality.score(docs, model).filter("predicted = 1").count()
    assert quality.fit(quality.training_rows(docs, marks.limit(0))).score("any") == pytest.approx(0.5)


def test_word_features_do_not_depend_on_place():
    a, b = (collections.Counter(quality.buckets(t.encode()).tolist()) for t in ("one two three", "one two  three"))
    words = collections.Counter(quality.buckets(b"three").tolist())
    assert len(words - a) == 0 and sum((a - b).values()) <= 6
    assert quality.buckets(b"").tolist()[0] == 0
