"""Source divergence audit: an index of terms built in one pass in memory, spilled as sorted runs and merged shard by shard into frequencies.

1. A task builds postings in memory: for each term of a language, in how many texts of each source it stands and how often. When the memory holds
   ``MOST`` postings, half of them different, it is spilled as one run, sorted by (language, term), and begun anew; so a term is sent once a run.
2. Runs are dealt over shards by a hash of (language, term). In a shard they are merged in sorted order (the sort of a shuffle partition is a heap merge of
   runs on disk) and read as a stream that adds up neighbouring postings: the frequencies of a term in all sources. Terms of fewer than ``least`` texts go.
3. Sums over the frequencies give the sizes; the price of a term in a source is ``1 + floor(10**9 * (count + 1) / (N + V))``, in whole numbers throughout.
4. A pair's value is a sum over all V kept terms of the language. Most terms stand in neither source and add the same; so the sum is V times that, plus
   corrections: for the terms of one source by their count (a histogram of counts), and for terms of both. The latter are streamed from the merged
   frequencies: a task adds up the corrections of the pairs of a term's postings in memory and hands on one row a pair, or a part of it when it holds ``MOST`` pairs.

Terms of a group are ranked by value, then by UTF-8, to ``top`` ranks; the row limit works before the shuffle too.

Edge cases: null text, language and source are empty; a language or group without kept terms has N = V = 0, pairs of value 0, and no terms; texts are read whole, in
blocks of bounded size; repeated rows count each; a language with one source has no pairs; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.frames import cut, small

UNIT = 10**9
MOST = 1_000_000  # postings, or pairs, that a task holds
ROWS = 20_000  # rows that are handed on at once
BLOCK = 1 << 20  # bytes of a text whose terms are listed at once
CELLS = 1 << 20  # pairs of postings that are priced at once
FIND = re.compile(rb"[a-z\x80-\xff]+").findall


def blocks(raw: bytes) -> Iterator[bytes]:
    """A text in blocks that end between terms; a block is longer than ``BLOCK`` only if a term is."""
    gap, begin = re.compile(rb"[^a-z\x80-\xff]"), 0
    while len(raw) - begin > BLOCK:
        found = gap.search(raw, begin + BLOCK)
        end = found.end() if found else len(raw)
        yield raw[begin:end]
        begin = end
    yield raw[begin:]


class Block:
    """Postings in memory. A term has a number; postings are numbers of (term, group), with the texts and places that hold them, added up now and then."""

    GROUPS = 1 << 20  # groups of language and source that a block tells apart

    def __init__(self):
        self.begin()

    def begin(self) -> None:
        self.terms = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.groups, self.new, self.size, self.held = {}, [], 0, None

    def add(self, lang: str, source: str, text: str) -> Iterator[pa.RecordBatch]:
        """Count a text, and spill whenever the memory is full; a term counts a text once, however many blocks the text has."""
        found, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for raw in blocks(text.encode("utf-8", "surrogatepass").lower()):
            terms = FIND(raw)
            more, m = np.unique(np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms)), return_counts=True)
            found, _, n = (more, m, m) if not len(found) else summed(np.concatenate([found, more]), np.concatenate([n, m]), np.concatenate([n, m]))
        group = self.groups.setdefault((lang, source), len(self.groups))
        self.new.append((found * self.GROUPS + group, np.ones(len(found), np.int64), n))
        self.size += len(found)
        if self.size >= MOST or len(self.groups) == self.GROUPS:
            self.settle()
            if len(self.held[0]) >= MOST // 2 or len(self.groups) == self.GROUPS:
                yield from self.spilled()

    def settle(self) -> None:
        """Add up equal postings."""
        parts = self.new + ([self.held] if self.held else [])
        self.held = summed(*(np.concatenate([p[i] for p in parts]) for i in range(3))) if parts else None
        self.new, self.size = [], 0

    def spilled(self) -> Iterator[pa.RecordBatch]:
        """The run: a row (lang, term) with the postings of its sources, sorted."""
        self.settle()
        if self.held is None:
            return
        keys, texts, places = self.held
        order = sorted(self.terms)
        rank = np.empty(len(order), np.int64)
        rank[np.fromiter(map(self.terms.__getitem__, order), np.int64, len(order))] = np.arange(len(order))
        langs, sources = (sorted({g[i] for g in self.groups}) for i in range(2))
        lang_of, source_of = (np.array([bisect_left(names, g[i]) for g in self.groups], np.int64) for i, names in enumerate((langs, sources)))
        term, group = rank[keys // self.GROUPS], keys % self.GROUPS
        row = lang_of[group] * len(order) + term
        by = np.lexsort((source_of[group], row))
        row = row[by]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(row))
        names, words = pa.array(langs, pa.string()), pa.array(order, pa.binary())
        source, texts, places = pa.array(sources, pa.string()).take(pa.array(source_of[group[by]])), texts[by], places[by]
        for a in range(0, len(first), ROWS):
            f, e = first[a : a + ROWS], ends[a : a + ROWS]
            offsets = pa.array(np.append(f, e[-1]) - f[0], pa.int32())
            part = slice(f[0], e[-1])
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (source[part], pa.array(texts[part]), pa.array(places[part]))]
            at = row[f]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at // len(order))), words.take(pa.array(at % len(order))).cast(pa.string()), *lists], RUN)
        self.begin()


RUN = ["lang", "term", "sources", "texts", "places"]
RUN_SQL = "lang string, term string, sources array<string>, texts array<long>, places array<long>"


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal keys once, in order, with the sums of their values."""
    if not len(keys):
        return (keys, *values)
    by = np.argsort(keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[first], *(np.add.reduceat(v[by], first) for v in values))


def runs(docs: DataFrame) -> DataFrame:
    """The sorted runs of every task: a row for a term of a language, with its postings (source, texts, places)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for part in parts:
            for lang, source, text in zip(*(part.column(n).to_pylist() for n in ("lang", "source", "text"))):
                yield from block.add(lang, source, text)
        yield from block.spilled()

    return docs.select("lang", "source", "text").mapInArrow(batches, RUN_SQL)


def changes(*columns: pa.Array) -> np.ndarray:
    """Places at which a row differs from the one before it in any of the columns; the first always does."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (lang, term), regrouped so that a term's rows come together; only a last, open term is carried along."""
    rest = []
    for part in parts:
        if not part.num_rows:
            continue
        rest.append(part)
        if part.num_rows > 1 and (part.column("lang")[0], part.column("term")[0]) != (part.column("lang")[-1], part.column("term")[-1]):
            table = pa.Table.from_batches(rest).combine_chunks()
            last = int(changes(*(table.column(c).combine_chunks() for c in ("lang", "term")))[-1])
            yield table.slice(0, last)
            rest = table.slice(last).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def column(table: pa.Table, name: str) -> pa.Array:
    x = table.column(name).combine_chunks()
    return pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x


def frequencies(found: DataFrame, least: int) -> DataFrame:
    """(lang, term, source, n) of the terms that stand in ``least`` texts of their language: the runs of a shard, merged in sorted order."""

    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_terms(parts):
            lang, term, lists = column(table, "lang"), column(table, "term"), column(table, "sources")
            first = changes(lang, term)
            number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(lang))))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            of = np.repeat(number, sizes)
            sources = lists.flatten().dictionary_encode()
            texts, places = (column(table, c).flatten().to_numpy(zero_copy_only=False) for c in ("texts", "places"))
            seen = np.zeros(len(first), np.int64)
            np.add.at(seen, of, texts)
            names = len(sources.dictionary)
            keys, n = summed(of * names + sources.indices.to_numpy(zero_copy_only=False), places)
            kept = seen[keys // names] >= least
            keys, n = keys[kept], n[kept]
            at = pa.array(first[keys // names])
            for a in range(0, len(keys), ROWS):
                cut = slice(a, a + ROWS)
                yield pa.RecordBatch.from_arrays([lang.take(at[cut]), term.take(at[cut]), sources.dictionary.take(pa.array(keys[cut] % names)), pa.array(n[cut])], ["lang", "term", "source", "n"])

    shards = found.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return shards.mapInArrow(merged, "lang string, term string, source string, n long")


def price(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + terms)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = F.lit(UNIT).cast("decimal(10,0)") * wide(n + 1)
    return F.when(total + terms > 0, F.lit(1).cast("long") + whole_quotient(over, wide(total + terms))).otherwise(F.lit(0).cast("long"))


def whole_quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b).cast("long")


def value(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); prices are at most 10**9 + 1, so squares fit."""
    return whole_quotient((p - q) * (p - q), q)


def both(postings: DataFrame) -> DataFrame:
    """(lang, source, item, value): corrections of the terms that two sources share, added up inside each task.

    ``postings`` has the price p of a term in a source and p0, the price of a term that the source lacks. With f the value of two prices, a shared term corrects
    what its source's histogram and the other's have put in for it, f(p, q0) + f(p0, q) - f(p0, q0), to f(p, q).
    """

    names = ["lang", "source", "item", "value"]

    def flushed(sums: dict) -> pa.RecordBatch:
        keys = list(sums)
        return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)), pa.array(list(sums.values()), pa.int64())], names)

    def corrections(who: np.ndarray, p: np.ndarray, p0: np.ndarray, names: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs and their corrections; terms (rows) of as many postings each (columns)."""
        f = lambda x, y: (x - y) * (x - y) // y
        k = who.shape[1]
        step = max(1, CELLS // len(who))
        for i in range(k):
            for a in range(0, k, step):
                js = np.array([j for j in range(a, min(k, a + step)) if j != i], np.int64)
                mine, mine0, other, other0 = p[:, i, None], p0[:, i, None], p[:, js], p0[:, js]
                more = f(mine, other) - f(mine, other0) - f(mine0, other) + f(mine0, other0)
                yield summed((who[:, i, None] * names + who[:, js]).ravel(), more.ravel())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for table in whole_terms(parts):
            lang, sources = column(table, "lang").dictionary_encode(), column(table, "source").dictionary_encode()
            p, p0 = (column(table, c).to_numpy(zero_copy_only=False) for c in ("p", "p0"))
            code, langs, items = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang.dictionary.to_pylist(), sources.dictionary.to_pylist()
            first = changes(column(table, "lang"), column(table, "term"))
            sizes, own = np.diff(np.append(first, len(code))), lang.indices.to_numpy(zero_copy_only=False)[first]
            for k in np.unique(sizes[sizes > 1]).tolist():
                for of in np.unique(own[sizes == k]).tolist():
                    starts = first[(sizes == k) & (own == of)]
                    for a in range(0, len(starts), ROWS):
                        at = starts[a : a + ROWS, None] + np.arange(k)
                        for pairs, more in corrections(code[at], p[at], p0[at], len(items)):
                            for c, x in zip(pairs.tolist(), more.tolist()):
                                key = (langs[of], items[c // len(items)], items[c % len(items)])
                                sums[key] = sums.get(key, 0) + x
                            if len(sums) >= MOST:
                                yield flushed(sums)
                                sums = {}
        if sums:
            yield flushed(sums)

    shards = postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(batches, "lang string, source string, item string, value long")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language stands from its others (part ``pair``, all of them), and the terms it
    has more of than the language (part ``term``, to ``top`` ranks). Runs jobs when called."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(own(lang).alias("lang"), own(source).alias("source"), own(text).alias("text"))
    freq = cut(frequencies(runs(docs), least))
    sizes = freq.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("total"))
    groups = cut(groups)
    langs = freq.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    langs = small(cut(langs))
    groups = cut(groups.join(langs, "lang", "left").na.fill(0, ["terms", "lang_total"]).withColumn("p0", price(F.lit(0), F.col("total"), F.col("terms"))))
    postings = freq.join(small(groups), ["lang", "source"]).withColumn("p", price(F.col("n"), F.col("total"), F.col("terms")))

    whole = freq.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(langs, "lang").select("lang", "term", price(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q"))
    above = postings.select("lang", "source", "term", "p").join(whole, ["lang", "term"]).filter("p > q").withColumn("value", value(F.col("p"), F.col("q")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    # the histogram of a source's counts against every other source of its language
    counts = postings.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times")).join(small(groups.select("lang", "source", "p0")), ["lang", "source"])
    others = small(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")))
    faced = counts.join(others, "lang").filter("source <> item")
    exact = lambda c: F.sum(c.cast("decimal(20,0)") * F.col("times").cast("decimal(18,0)"))
    here = value(F.col("p"), F.col("q0")) - value(F.col("p0"), F.col("q0"))
    there = value(F.col("q0"), F.col("p")) - value(F.col("q0"), F.col("p0"))
    one = faced.groupBy("lang", "source", "item").agg(exact(here).alias("here"), exact(there).alias("there"))
    mine = one.select("lang", "source", "item", F.col("here").cast("decimal(38,0)").alias("more"))
    yours = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("there").cast("decimal(38,0)").alias("more"))
    shared = both(postings).select("lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("more"))
    more = mine.unionByName(yours).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    pairs = groups.select("lang", "source", "terms", "p0").join(others, "lang").filter("source <> item").join(more, ["lang", "source", "item"], "left")
    none = F.when(F.col("terms") > 0, F.col("terms").cast("decimal(20,0)") * value(F.col("p0"), F.col("q0"))).otherwise(F.lit(0))
    total = (none.cast("decimal(38,0)") + F.coalesce("more", F.lit(0).cast("decimal(38,0)"))).cast("long")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", total.alias("value")).withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(above)
