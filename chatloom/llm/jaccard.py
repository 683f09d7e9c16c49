"""N-gram Jaccard join in the metric space of shingle sets: pivots, Voronoi regions, triangle-inequality windows, exact recursion.

The Jaccard distance is a metric, and two documents link at a distance of at most ``1 - similarity``. Equal sets are one class. The result is
each document's component, so the join has to decide every pair of classes in different components that may link, not to list the pairs inside one.

1. Leaders. Near copies mostly share the smallest or the largest of their shingles. The sets that share one are a group, each is compared exactly with the
   group's leader, and the links found give components. A set in its leader's component carries the group's shingle as a label: sets of one label are
   known to be in one component, so that a text with many near copies does not pair all of them in every region.
2. First regions. A one-shingle set is a pivot too, and most documents are at distance 1 from most pivots. In a fixed order of the shingles, two sets that
   link share a shingle among the first ``n - ceil(similarity * n) + 1`` of each; a class enters the region of each of these shingles. Shingles that a
   scan finds frequent come last in the order, which any fixed order allows; so boilerplate makes no region unless a text is little else.
3. Small regions are joined directly: sizes, places and the counts of shingles by leading bits bound each pair from above, what is left is counted exactly.
   A pair that has a label in common is not made; so a large region that leaves few pairs is joined directly too.
4. Large regions that overlap in most of their members are merged into one. Their members take documents as pivots. Every member's exact distance to the
   pivots gives links (members near a pivot need no pairs among them: they are in its component) and a region: the nearest pivot within ``NEAR``, or the
   outer region. By the triangle inequality a member can only link into a pivot's region if it is within the region's radius plus the linking
   distance of it, and into the outer region if it is farther than ``NEAR`` less that distance from every pivot; boundary members are replicated by these
   windows. Regions in one component are done; regions that the windows divide recurse with new pivots; small ones, and those whose members are all about as
   far from each other, are decided in blocks: the sets of two blocks meet in one group, which counts all intersections and gives back a spanning forest.

No pair of two components is left out: every window follows from the metric or from counts, and a label from links. Which sets carry one is asked of a
Bloom filter of those that do not, which errs to a label less. Sets are held as 64-bit hashes; a class's name has 128 bits and a collision of
its first half is looked for and answered with another seed. A text goes once to the pairs it is in, by the hash of the text, and from there, once a
pair, to the side that has more pairs; where pairs or blocks would move more than all texts once, they are decided in waves that do not. Nothing but frequent shingles (a bounded number of them, which only move in the order) and
counts reaches the driver.

Edge cases: a null, empty or blank text has no shingles and is a component of its own; a null id links but never names a component,
which is null if it has no other id; repeated rows are equal sets; a text of fewer words than a shingle is one shingle;
an empty table gives an empty result. Only the named columns and the results are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.grams import GramFilter
from chatloom.llm import shingles as S
from chatloom.llm.components import components, forest
from chatloom.llm.frames import cut, released, shuffles_dropped

FREQUENT = 48  # repeats in the scan that make a shingle frequent
MOST_FREQUENT = 1 << 20  # frequent shingles that reach the driver; beyond it the limit above is doubled
BITS = 24  # of the table of frequent shingles: 2 MB
BUCKET = 250_000  # entries of first regions that one group holds
SMALL = 64  # members of a region that are paired directly
PIVOTS = 4
NEAR = 0.6
DEPTH = 4  # recursions before a region that is still large is decided in blocks
BLOCK, BLOCK_SHINGLES = 1024, 150_000  # members and shingles of a block
FEW = 2  # pairs to a member of a large region that is paired directly
FACTOR = 0x1E3779B97F4A7C15  # of a label in a number for two
TOGETHER = 256  # pairs of a class that are counted in one group


def need(a, b, percent: int):
    """The least intersection of linked sets of sizes a and b: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def scan(docs: DataFrame, words: int, seed: int, text: str, key: str) -> DataFrame:
    """One pass over the texts: their sets' sizes and names (kind 0), the shingles that repeat within a chunk of texts (kind 1), and a sketch per task and
    class (kind 2), with the set's smallest and largest shingle."""

    def scanned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met = set()
        for part in parts:
            sizes, a, b, held, seen, sketches = [], [], [], [], set(), {}
            for s in S.sets(part["_text"].tolist(), words, seed):
                x, y = S.name(s) if len(s) else (0, 0)
                sizes.append(len(s))
                a.append(x)
                b.append(y)
                if x not in seen and len(s):
                    seen.add(x)
                    held.append(s)
                    if x not in met:
                        met.add(x)
                        sketches[x] = len(s), S.sketch(s), *s[[0, -1]].view(np.int64).tolist()
            yield pd.DataFrame({"kind": 0, "_key": part["_key"], "n": sizes, "a": a, "b": b, "h": part["_hash"], "raw": None})
            found, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            more = times > 1
            yield pd.DataFrame({"kind": 1, "_key": None, "n": times[more], "a": found[more].view(np.int64), "b": 0, "h": 0, "raw": None}).astype({"_key": "object"})
            of = pd.DataFrame([*sketches.values()], columns=["n", "raw", "b", "h"]).astype({"n": int, "b": int, "h": int})
            yield of.assign(kind=2, _key=None, a=list(sketches)).astype({"_key": "object", "a": int})[["kind", "_key", "n", "a", "b", "h", "raw"]]

    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    return cut(rows.mapInPandas(released(scanned), "kind int, _key long, n long, a long, b long, h long, raw binary"))


def frequent(spark: SparkSession, found: DataFrame):
    """A bit per group of hashes, set for frequent shingles: a broadcast of fixed size."""
    counts = cut(found.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT))
    most = FREQUENT
    sizes = counts.agg(*[F.count_if(F.col("n") >= FREQUENT << i).alias(str(i)) for i in range(40)]).first()
    while sizes[str((most // FREQUENT).bit_length() - 1)] > MOST_FREQUENT:
        most *= 2
    hot = counts.filter(F.col("n") >= most).select("a").toArrow()["a"].to_numpy().astype(np.int64).view(np.uint64)
    bits = np.zeros(1 << BITS, bool)
    bits[(hot >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return spark.sparkContext.broadcast(np.packbits(bits))


def alike(sketches: DataFrame, rows: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, words: int, seed: int, text: str):
    """Links (u, v) of classes with the leaders of their groups; the components (u, v) that they give; and a filter of hashes of texts, with a number:
    0 for texts of a class in one of the components, 1 or 2 for texts that are not in the component of the leader by their smallest or largest shingle.
    The filter is None where there are no links."""
    key = lambda of, c: F.struct(F.lit(of).alias("of"), F.col(c).alias("key"))
    members = sketches.select("cls", "n", F.inline(F.array(key(1, "first"), key(2, "last"))))
    groups = members.groupBy("of", "key").agg(F.min(F.struct("cls", "n")).alias("lead"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    groups = groups.select("of", "key", F.col("lead.cls").alias("lead"), F.col("lead.n").alias("size"))
    led = cut(members.join(groups, ["of", "key"]).filter("cls <> lead").select("of", "cls", "lead", "n", "size"))
    pairs = led.filter(100 * F.least("n", "size") >= percent * F.greatest("n", "size")).select(F.col("lead").alias("x"), F.col("cls").alias("y"))
    links = linked(decided(bounded(pairs, sketches, percent), docs, classes, percent, words, seed, text), percent)
    of = components(links)
    if of.limit(1).count() == 0:
        return links, of, None
    of = of.select("u", F.col("v").alias("c"))
    named = lambda c: of.select(F.col("u").alias(c), F.col("c").alias(f"c_{c}"))
    other = led.join(named("cls"), "cls", "left").join(named("lead"), "lead", "left").filter(F.coalesce("c_cls", "cls") != F.coalesce("c_lead", "lead"))
    flagged = of.select(F.explode(F.array("u", "c")).alias("cls"), F.lit(0).alias("of")).union(other.select("cls", "of")).distinct()
    texts = rows.filter("cls IS NOT NULL").select("cls", "h").distinct()
    return links, of.withColumnRenamed("c", "v"), GramFilter(cut(flagged.join(texts, "cls").select(F.xxhash64("h", "of").alias("h"))))


def first_regions(docs: DataFrame, bits, buckets: int, words: int, seed: int, percent: int, text: str, sure: GramFilter | None = None) -> DataFrame:
    """Second pass: per task and bucket, the packed entries (shingle, class, size and place) of the sets' first shingles, with two labels if ``sure`` (of
    ``alike``) may hold them. They are much of the input, so they are not kept beside what the shuffle to their buckets writes."""

    def entered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot_bits, seen = np.unpackbits(bits.value).astype(bool), set()
        for part in parts:
            made: dict[int, list] = {3: [], 5: []}
            for s, has in zip(S.sets(part["_text"].tolist(), words, seed), part["_labels"].tolist(), strict=True):
                n = len(s)
                if not n or (cls := S.name(s)[0]) in seen:
                    continue
                seen.add(cls)
                hot = hot_bits[(s >> np.uint64(64 - BITS)).astype(np.int64)]
                first = n - -(-percent * n // 100) + 1
                chosen = np.concatenate([s[~hot][:first], s[hot][: max(0, first - int((~hot).sum()))]])
                rows = np.empty((first, 5 if has else 3), np.int64)
                rows[:, 0], rows[:, 1], rows[:, 2] = chosen.view(np.int64), cls, (n << 32) | np.arange(first)
                if has:  # the class stands for a label that it does not carry
                    ends = s[[0, -1]].view(np.int64)
                    rows[:, 3], rows[:, 4] = ends[0] if has & 1 else cls, ends[1] if has & 2 else cls
                made[rows.shape[1]].append(rows)
            for width, entries in made.items():
                if entries:
                    rows = np.concatenate(entries)
                    to = (S.mixed(rows[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(to, kind="stable")
                    rows, to = rows[order], to[order]
                    at = np.flatnonzero(np.diff(to, prepend=-1))
                    yield pd.DataFrame({"bucket": to[at], "width": width, "raw": [x.tobytes() for x in np.split(rows, at[1:])]})

    texts = docs.select(F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    if sure is None:
        texts = texts.select("_text", F.lit(0).alias("_labels"))
    else:
        held = lambda of: sure.may_hold(F.xxhash64("_hash", F.lit(of)))
        labels = F.when(held(1), 0).otherwise(1) + F.when(held(2), 0).otherwise(2)
        texts = sure.attach(texts).select("_text", F.when(held(0), labels).otherwise(0).alias("_labels"))
    return texts.mapInPandas(released(entered), "bucket long, width int, raw binary")


def paired(i: np.ndarray, j: np.ndarray, cls: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) of members of one region whose sizes and places allow a link."""
    a, b = size[i], size[j]
    ok = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (cls[i] != cls[j])
    ok &= 1 + np.minimum(a - place[i], b - place[j]) - 1 >= need(a, b, percent)
    return i[ok], j[ok]


def apart(labels: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The pairs (i, j) of members that have neither label in common, or None where they are too many."""
    k, outside = len(labels), []
    same = []
    for c in (labels[:, 0], labels[:, 1], labels[:, 0] * np.int64(FACTOR) + labels[:, 1]):
        names, times = np.unique(c, return_counts=True)
        same.append(int((times * (times - 1) // 2).sum()))
        outside.append(np.flatnonzero(c != names[times.argmax()]))
    if k * (k - 1) // 2 - same[0] - same[1] + same[2] > most:
        return None
    # one of the two is outside the largest group by the first label, and one by the second
    one, two = outside[:2]
    both = np.intersect1d(one, two, assume_unique=True)
    if len(one) * len(two) + len(both) * k > 16 * most:
        return None
    i = np.concatenate([np.repeat(one, len(two)), np.repeat(both, k)])
    j = np.concatenate([np.tile(two, len(one)), np.tile(np.arange(k), len(both))])
    ok = (labels[i] != labels[j]).all(1)
    pairs = np.unique(np.sort(np.stack([i[ok], j[ok]], 1), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def join_first(entries: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(region, x, y): pairs of small regions (region null, x < y), and members of large ones (x class, y size)."""

    def met(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[np.ndarray]] = {}
        for part in parts:
            for bucket, width, raw in zip(part["bucket"], part["width"], part["raw"], strict=True):
                rows = np.frombuffer(raw, np.int64).reshape(-1, width)
                held.setdefault(bucket, []).append(rows if width == 5 else rows[:, [0, 1, 2, 1, 1]])
        while held:
            rows = np.concatenate(held.popitem()[1])
            rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            again = np.append(False, (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1]))
            rows = rows[~again]  # a set that several tasks met
            at = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] - 1) != 0)
            end = np.append(at[1:], len(rows))
            many = end - at > 1
            pairs, large, done = [], [], set()
            for a, b in zip(at[many].tolist(), end[many].tolist(), strict=True):
                key, cls, size, place, labels = rows[a, 0], rows[a:b, 1], rows[a:b, 2] >> 32, rows[a:b, 2] & 0xFFFFFFFF, rows[a:b, 3:]
                if b - a <= SMALL:
                    i, j = np.triu_indices(b - a, 1)
                    if (labels != cls[:, None]).any():
                        new = (labels[i] != labels[j]).all(1)
                        i, j = i[new], j[new]
                    found = i, j
                else:
                    found = apart(labels, FEW * (b - a))
                if found is not None:
                    i, j = paired(*found, cls, size, place, percent)
                    if len(i):
                        pairs.append(np.stack([cls[i], cls[j]], 1))
                elif (same := cls.tobytes()) not in done:  # shingles of the same classes are one region
                    done.add(same)
                    large.append(pd.DataFrame({"region": key, "x": cls, "y": size}))
            if pairs:
                both = np.unique(np.concatenate(pairs), axis=0)
                yield pd.DataFrame({"region": None, "x": both[:, 0], "y": both[:, 1]}).astype({"region": "object"})
            yield from large

    dealt = entries.repartition(buckets, "bucket")
    return cut(dealt.mapInPandas(released(met), "region long, x long, y long"))


def bounded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny, most) of distinct pairs, with the sketches' bound of the intersection."""

    def limits(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            most = [
                min(a, b, S.most_common(S.counts_of(r, a), S.counts_of(q, b)))
                for a, b, r, q in zip(part["nx"], part["ny"], part["rx"], part["ry"], strict=True)
            ]
            yield part[["x", "y", "nx", "ny"]].assign(most=most)

    named = lambda c: sketches.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("raw").alias(f"r{c}"))
    both = pairs.select("x", "y").distinct().join(named("x"), "x").join(named("y"), "y")
    return both.mapInPandas(released(limits), "x long, y long, nx long, ny long, most long")


def waves(rows: DataFrame, key: list[str], load, classes: DataFrame) -> list[DataFrame]:
    """``rows`` in parts, rows of one key together, of at most about as much ``load`` as the classes have shingles: one part on most tables."""
    most, loads = classes.agg(F.sum("n")).first()[0], rows.agg(load).first()[0] or 0
    n = max(1, -(-int(loads) // most))
    return [rows] if n == 1 else [rows.filter(F.pmod(F.xxhash64(F.lit(n), *key), F.lit(n)) == i) for i in range(n)]


def linked(known: DataFrame, percent: int) -> DataFrame:
    """(u, v): the links among decided pairs."""
    return known.filter(100 * F.col("common") >= percent * (F.col("nx") + F.col("ny") - F.col("common"))).select(F.col("x").alias("u"), F.col("y").alias("v"))


def decided(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, words: int, seed: int, text: str) -> DataFrame:
    """(x, y, nx, ny, most, common): the exact intersection where the bound allows a link, else null."""
    limits = cut(pairs)
    close = limits.filter(100 * F.col("most") >= percent * (F.col("nx") + F.col("ny") - F.col("most")))
    degree = cut(close.select(F.explode(F.array("x", "y")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("pairs")).join(classes.select("cls", "h"), "cls"))

    # a pair goes with the text of one side to the side of more pairs, whose own text is there once for so many of them
    of = lambda c: degree.select(F.col("cls").alias(c), F.struct("pairs", F.col("cls").alias("c"), "h").alias(f"of_{c}"))
    met = close.join(of("x"), "x").join(of("y"), "y").withColumns({"center": F.greatest("of_x", "of_y"), "other": F.least("of_x", "of_y")})
    salt = F.pmod(F.xxhash64("other.c"), F.ceil(F.col("center.pairs") / TOGETHER)).cast("int").alias("salt")
    load = F.when(F.col("other.c") == F.col("x"), F.col("nx")).otherwise(F.col("ny")).alias("load")
    met = cut(met.select("x", "y", "nx", "ny", "most", F.col("center.c").alias("center"), salt, F.col("center.h").alias("of"), F.col("other.h").alias("h"), load))

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = None, None
        for part in parts:
            common = []
            for center, t, raw in zip(part["center"], part["_own"], S.sets(part["_text"].tolist(), words, seed), strict=True):
                if center != last:
                    held, last = next(S.sets([t], words, seed)), center
                common.append(len(np.intersect1d(held, raw, assume_unique=True)))
            yield part[["x", "y", "nx", "ny", "most"]].assign(common=common)

    def exact(met: DataFrame, hashes: DataFrame) -> DataFrame:
        texts = texts_by_hash(hashes, docs, text)
        own = met.select("center", "salt", F.col("of").alias("h")).distinct().join(texts, "h").select("center", "salt", F.col("_text").alias("_own"))
        both = met.drop("of", "load").join(texts, "h").join(own.hint("merge"), ["center", "salt"])
        return both.mapInPandas(released(counted), "x long, y long, nx long, ny long, most long, common long")

    far = limits.filter(100 * F.col("most") < percent * (F.col("nx") + F.col("ny") - F.col("most"))).withColumn("common", F.lit(None).cast("long"))
    parts = waves(met, ["center", "salt"], F.sum("load"), classes)
    if len(parts) == 1:
        return cut(exact(met, degree.select("h")).unionByName(far))
    for part in parts:
        far = far.unionByName(cut(exact(part, part.select(F.explode(F.array("of", "h")).alias("h")).distinct())))
    return far


def ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def stars(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots of each region, and the pairs of its members with them."""
    draws = [F.min(F.struct(F.xxhash64(F.lit(i), "x").alias("k"), F.col("x").alias("p"))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = members.groupBy("region").agg(*draws).select("region", F.array_distinct(F.array(*[F.col(f"p{i}.p") for i in range(PIVOTS)])).alias("pivots"))
    pivots = cut(pivots)
    pairs = members.join(pivots, "region").select("x", F.explode("pivots").alias("p")).filter("x <> p").select(*ordered("x", "p"))
    return pivots, pairs


def merged(members: DataFrame) -> DataFrame:
    """Members (region, x, y) with regions that share members made one, where that is at most twice the largest of them."""
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("first"))
    sized = cut(members.join(sizes, "region"))
    of = components(sized.select("x", "first")).select(F.col("u").alias("first"), F.col("v").alias("of"))
    sized = sized.join(of, "first", "left").withColumn("of", F.coalesce("of", "first"))
    one = sized.groupBy("of", "x").agg(F.max("y").alias("y"))
    small = one.groupBy("of").agg(F.count(F.lit(1)).alias("n")).join(sized.groupBy("of").agg(F.max("m").alias("largest")), "of").filter("n <= 2 * largest").select("of")
    small = cut(small)
    apart = sized.join(small, "of", "left_anti").select("region", "x", "y")
    return cut(one.join(small, "of").select(F.xxhash64(F.lit("merged"), "of").alias("region"), "x", "y").union(apart))


def split_regions(members: DataFrame, pivots: DataFrame, known: DataFrame, limit: float) -> DataFrame:
    """Members (parent, region, x, y, home) of the next regions: each at its nearest pivot or outside, and wherever a window may hold a partner."""
    union = F.col("nx") + F.col("ny")
    far = known.select("x", "y", (1 - F.coalesce("common", "most") / (union - F.coalesce("common", "most"))).alias("d"), F.col("common").isNotNull().alias("exact"))
    far = far.withColumnsRenamed({"x": "u", "y": "v"})
    to = members.join(pivots, "region").select("region", "x", "y", F.explode("pivots").alias("p"))
    to = to.withColumns({"u": F.least("x", "p"), "v": F.greatest("x", "p")}).join(far, ["u", "v"], "left")
    at = to.groupBy("region", "x", "y").agg(
        F.min(F.when(F.col("exact") & (F.col("d") <= NEAR), F.struct("d", "p"))).alias("near"), F.max(F.col("x") == F.col("p")).alias("pivot"),
        F.min("d").alias("least"), F.collect_list(F.struct("p", "d")).alias("all"),
    ).filter("NOT pivot")
    at = cut(at.select("region", "x", "y", "least", "all", F.col("near.d").alias("d"), F.col("near.p").alias("own")))
    radius = at.filter("own IS NOT NULL").groupBy("region", F.col("own").alias("p")).agg(F.max("d").alias("radius"))
    visits = at.select("region", "x", "y", "own", F.inline("all"))
    visits = visits.join(radius, ["region", "p"]).filter((F.col("d") <= F.col("radius") + limit) | F.col("own").eqNullSafe(F.col("p")))
    parent = F.col("region").alias("parent")
    inside = visits.select(parent, F.xxhash64("region", "p").alias("region"), "x", "y", F.col("own").eqNullSafe(F.col("p")).alias("home"))
    outside = at.filter((F.col("own").isNull()) | (F.col("least") > NEAR - limit)).select(
        parent, F.xxhash64("region", F.lit("outer")).alias("region"), "x", "y", F.col("own").isNull().alias("home"))
    return inside.union(outside)


def open_regions(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with ``c``, their component, and ``m``, the members of their region, of regions that hold more than one component and someone at home."""
    named = members.join(components(links).select(F.col("u").alias("x"), F.col("v").alias("c")), "x", "left").withColumn("c", F.coalesce("c", "x"))
    mixed = named.groupBy("region").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("home").alias("any"), F.count(F.lit(1)).alias("m"))
    return cut(named.join(mixed.filter("lo <> hi AND any"), "region").drop("lo", "hi", "any"))


def texts_by_hash(hashes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(h, _text): texts by their hashes. Those that a filter of the hashes rules out go where they are read; the others are shuffled once."""
    known = GramFilter(hashes.select("h"))
    texts = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("_text"))
    return known.attach(texts).filter(known.may_hold(F.col("h"))).groupBy("h").agg(F.first("_text").alias("_text"))


def texts_of(classes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(cls, _text) of ``classes`` (cls, h: hash of the text of one of its documents)."""
    return classes.select("cls", "h").join(texts_by_hash(classes, docs, text), "h").select("cls", "_text")


def block_links(members: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, words: int, seed: int, text: str) -> DataFrame:
    """(u, v): a spanning forest per group of the links between components, from groups of two blocks of the region's sets.

    Blocks of the region's largest component need not meet each other, so its members go to the blocks of the others only.
    """
    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"x": part["cls"], "raw": [s.tobytes() for s in S.sets(part["_text"].tolist(), words, seed)]})

    blocks = lambda k, s: F.greatest(F.ceil(k / BLOCK), F.ceil(s / BLOCK_SHINGLES), F.lit(1)).cast("int")
    by_component = members.groupBy("region", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("y").alias("s"))
    sizes = by_component.groupBy("region").agg(F.max_by(F.struct("c", "k", "s"), F.struct("k", "c")).alias("g"), F.sum("k").alias("k"), F.sum("s").alias("s"))
    sizes = sizes.select(
        "region", F.col("g.c").alias("main"), (blocks(F.col("k"), F.col("s")) > 1).alias("split"), blocks(F.col("g.k"), F.col("g.s")).alias("mains"),
        blocks(F.col("k") - F.col("g.k"), F.col("s") - F.col("g.s")).alias("others"),
    )
    # a region of one block meets itself
    sizes = sizes.withColumns({"mains": F.when(F.col("split"), F.col("mains")).otherwise(F.lit(0)), "others": F.when(F.col("split"), F.col("others")).otherwise(F.lit(1))})
    draw, main = F.xxhash64(F.lit(9), "x"), F.col("split") & (F.col("c") == F.col("main"))
    rows = members.join(sizes, "region").withColumn("b", F.when(main, F.pmod(draw, F.col("mains"))).otherwise(F.col("mains") + F.pmod(draw, F.col("others"))).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.when(main, F.col("mains")).otherwise(F.lit(0)), F.col("mains") + F.col("others") - 1)))
    rows = cut(rows.withColumns({"lo": F.least("b", "with"), "hi": F.greatest("b", "with")}).select("region", "lo", "hi", "b", "x", "y", "c", "home"))

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        first, second = pdf[pdf["b"] == lo], pdf[pdf["b"] == hi]
        sets = [np.frombuffer(r, np.uint64) for r in [*first["raw"], *second["raw"]]]
        if not len(first) or not len(second):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        found, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1
        column, kept = (np.cumsum(shared) - 1)[place], shared[place]
        owner, column = owner[kept], column[kept]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(first), len(second)), np.float32)
        step = max(64, 4_000_000 // len(sets))
        for a in range(0, int(shared.sum()), step):
            i, j = np.searchsorted(column, [a, a + step])
            table = np.zeros((len(sets), step), np.float32)
            table[owner[i:j], column[i:j] - a] = 1
            common += table[: len(first)] @ table[len(first) :].T
        n, m = first["y"].to_numpy()[:, None], second["y"].to_numpy()[None]
        ok = 100 * common >= percent * (n + m - common)
        ok &= first["c"].to_numpy()[:, None] != second["c"].to_numpy()[None]
        ok &= first["home"].to_numpy()[:, None] | second["home"].to_numpy()[None]
        i, j = np.nonzero(ok)
        pairs = np.stack([first["x"].to_numpy()[i], second["x"].to_numpy()[j]], 1)
        return pd.DataFrame(forest(pairs), columns=["u", "v"], dtype="int64")

    def of_part(rows: DataFrame) -> DataFrame:
        used = cut(rows.select(F.col("x").alias("cls")).distinct().join(classes.select("cls", "h"), "cls"))
        held = texts_of(used, docs, text).mapInPandas(released(hashed), "x long, raw binary")
        return cut(rows.join(held, "x").groupBy("region", "lo", "hi").applyInPandas(met, "u long, v long"))

    # a set has twice the bytes of its text
    return reduce(DataFrame.union, map(of_part, waves(rows, ["region", "lo", "hi"], 2 * F.sum("y"), classes)))


def join(docs: DataFrame, percent: int = 80, words: int = 5, text: str = "text", key: str = "doc_id", seed: int = 0) -> DataFrame:
    """(key, n_shingles, component_id) of every row. The texts are read twice, and once more for those that have a close candidate."""
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        rows, classes, links = linked_classes(docs, percent, words, text, key, seed)
        if rows is None:
            return join(docs, percent, words, text, key, seed + 1)
        joined = spark.createDataFrame([], "u long, v long") if links is None else components(links)
    named = classes.select("cls", "least").join(joined.select(F.col("u").alias("cls"), "v"), "cls", "left").withColumn("root", F.coalesce("v", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("cls", "component")
    out = rows.join(named, "cls", "left")
    return out.select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("_key")).otherwise(F.col("component")).alias("component_id"))


def linked_classes(docs: DataFrame, percent: int, words: int, text: str, key: str, seed: int):
    """The rows with their classes, the classes, and links (u, v) that join the classes of each component. No rows where two classes have one name, no links
    where there is no class."""
    spark, limit = docs.sparkSession, 1 - percent / 100
    found = scan(docs, words, seed, text, key)
    rows = found.filter("kind = 0").select("_key", "n", F.when(F.col("n") > 0, F.col("a")).alias("cls"), "b", "h")
    classes = cut(rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("_key").alias("least"), F.min("h").alias("h"), F.max("n").alias("n"), F.min("b").alias("b0"), F.max("b").alias("b1")))
    totals = classes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"), F.count_if(F.col("b0") != F.col("b1")).alias("bad")).first()
    if totals["bad"]:
        return None, None, None
    if not totals["c"]:
        return rows, classes, None
    sketches = found.filter("kind = 2").groupBy(F.col("a").alias("cls"))
    sketches = cut(sketches.agg(F.first("n").alias("n"), F.first("raw").alias("raw"), F.first("b").alias("first"), F.first("h").alias("last")))
    links, of, sure = alike(sketches, rows, docs, classes, percent, words, seed, text)
    buckets = max(211, (totals["n"] * (100 - percent) // 100 + totals["c"]) // BUCKET)
    regions = join_first(first_regions(docs, frequent(spark, found), buckets, words, seed, percent, text, sure), buckets, percent)
    pairs, members = regions.filter("region IS NULL").select("x", "y"), regions.filter("region IS NOT NULL")
    if sure is not None:
        named = lambda c: of.select(F.col("u").alias(c), F.col("v").alias(f"c{c}"))
        pairs = pairs.distinct().join(named("x"), "x", "left").join(named("y"), "y", "left").filter(F.coalesce("cx", "x") != F.coalesce("cy", "y")).select("x", "y")
    if members.limit(1).count():
        members = merged(members).withColumn("home", F.lit(True))
    depth = 0
    while True:
        left = members.limit(1).count() > 0
        if left:
            pivots, to_pivots = stars(members)
            pairs = pairs.union(to_pivots)
        known = decided(bounded(pairs, sketches, percent), docs, classes, percent, words, seed, text)
        links = links.union(linked(known, percent))
        if not left:
            return rows, classes, links
        members = open_regions(members, links)
        parts = open_regions(split_regions(members, pivots, known, limit), links)
        work = parts.groupBy("parent", "region").agg(F.max("m").alias("m")).groupBy("parent").agg(F.sum(F.col("m") * F.col("m")).alias("work"))
        work = members.groupBy("region").agg(F.max("m").alias("m")).join(work.withColumnRenamed("parent", "region"), "region", "left")
        stuck = cut(work.filter((2 * F.coalesce("work", F.lit(0)) > F.col("m") * F.col("m")) | F.lit(depth >= DEPTH)).select("region"))
        parts = parts.join(stuck.withColumnRenamed("region", "parent"), "parent", "left_anti").drop("parent")
        ready = members.join(stuck, "region", "left_semi").unionByName(parts.filter(F.col("m") <= SMALL))
        links = links.union(block_links(ready, docs, classes, percent, words, seed, text))
        members, pairs, depth = cut(parts.filter(F.col("m") > SMALL).select("region", "x", "y", "home")), pairs.limit(0), depth + 1
