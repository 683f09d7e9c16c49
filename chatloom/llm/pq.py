"""Embedding near-duplicates with product quantisation: inverted lists, residual codes, table-lookup distances, exact cosine.

Vectors are scaled to length one, where cosine >= c means a distance of at most r = sqrt(2 - 2c). A k-means on a bounded sample gives the lists; the residual
to the list's centroid is coded in ``PARTS`` subspaces of up to 256 words each, and the coding error of every vector is kept.

Sufficient probes: let x lie in list a and y in list b. Both are at least as far apart as the sum of their distances to the plane between the two
centroids, so one of them is within r/2 of it. Every vector therefore visits the lists whose plane is within r/2, and no link is
missed; a pair that both sides reach is counted at the smaller list only. In a list, the distance from the visitor to the coded vector comes
from lookup tables, and a pair is a candidate if it is at most r plus the coding error, which no link exceeds. Candidates are decided
by their cosine in double precision. So recall does not depend on the sample; only the amount of work does.

Equal vectors are one class with a count; lists and their visitors are dealt over blocks of bounded size, known from counts, so a list with
most vectors is split. A block gives back, per vector, how many links it has and a spanning forest of them, not the pairs.

Edge cases: vectors that are null, zero, empty or hold null or non-finite components link with nothing and are components of their own; vectors of
different length never link; a null id counts as a vector but is never a component's name, which is null if it has no other; repeated
rows are equal vectors; an empty table gives an empty result. Only the named columns and the results are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components, forest
from chatloom.llm.frames import cut

SAMPLE = 65_536  # most vectors that the lists and codes are fitted on
LISTS = 4096  # most lists; their number is the square root of the number of distinct vectors up to this
PARTS, WORDS = 8, 256
LIST_BLOCK, QUERY_BLOCK = 1024, 4096  # rows of a list, and of its visitors, that meet in one group


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, step: int = 4096) -> np.ndarray:
    norms = (centres**2).sum(1)
    return np.concatenate([(norms - 2 * x[i : i + step] @ centres.T).argmin(1) for i in range(0, len(x), step)] or [np.zeros(0, int)])


class Index:
    """Centroids of the lists and the words of each subspace; of fixed size whatever the table."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 11):
        self.centres = kmeans(sample, lists, 8, seed)
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        rest = sample - self.centres[nearest(sample, self.centres)]
        few = rest[:8192]
        self.words = [kmeans(few[:, c], WORDS, 6, seed + i) for i, c in enumerate(self.cuts)]

    def place(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
        """The list of each vector, and the other lists whose plane is within ``reach``."""
        gap = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(2), 0)) if len(self.centres) <= 256 else None
        d = (self.centres**2).sum(1) - 2 * x @ self.centres.T
        home = d.argmin(1)
        visits = []
        for i, h in enumerate(home):
            between = gap[h] if gap is not None else np.sqrt(((self.centres - self.centres[h]) ** 2).sum(1))
            close = d[i] - d[i, h] <= 2 * reach * between
            close[h] = False
            visits.append(np.flatnonzero(close & (between > 0) | (between == 0) & (np.arange(len(between)) != h)))
        return home, visits

    def code(self, x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = x - centre
        codes = np.stack([nearest(rest[:, c], w) for c, w in zip(self.cuts, self.words, strict=True)], 1)
        error = sum(((rest[:, c] - w[codes[:, i]]) ** 2).sum(1) for i, (c, w) in enumerate(zip(self.cuts, self.words, strict=True)))
        return codes, np.sqrt(error)

    def distances(self, x: np.ndarray, centre: np.ndarray, codes: np.ndarray, step: int = 128) -> np.ndarray:
        """Asymmetric distances, squared, a row per coded vector: exact vectors against coded ones, a table lookup per subspace. The tables of
        ``step`` exact vectors are made together, word by vector, so that a lookup reads one run of memory and the sums stay in cache."""
        out, columns = np.empty((len(codes), len(x))), np.ascontiguousarray(codes.T)
        for a in range(0, len(x), step):
            rest = x[a : a + step] - centre
            part, found = np.zeros((2, len(codes), len(rest)))
            for c, w, words in zip(self.cuts, self.words, columns, strict=True):
                few = rest[:, c]
                table = (w**2).sum(1)[:, None] - 2 * w @ few.T + (few**2).sum(1)
                part += np.take(table, words, axis=0, out=found, mode="clip")
            out[:, a : a + step] = part
        return out


def matrix(raw) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in raw])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links(classes: DataFrame, count: int, cosine: float) -> DataFrame:
    """(u, v, n) of classes of one vector length: links of class u to n vectors (v null), and forest edges u, v (n null)."""
    sample = classes.orderBy(F.xxhash64(F.lit(1), "cls")).limit(min(SAMPLE, 16 * math.isqrt(count) + 256)).select("cls", "vec").collect()
    sample.sort(key=lambda r: r["cls"])
    index = Index(unit(matrix([r["vec"] for r in sample])), max(1, min(LISTS, math.isqrt(count))))
    r = math.sqrt(2 - 2 * cosine)
    slack = 1e-6

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                home, visits = index.place(unit(matrix(part["vec"])), r / 2 + slack)
                yield part.assign(home=home.astype("int32"), visits=[v.astype("int32") for v in visits])

    rows = cut(classes.select("cls", "n", "vec").mapInPandas(placed, "cls long, n long, vec array<float>, home int, visits array<int>"))
    homes = {x["home"]: x["n"] for x in rows.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    guests = {x["c"]: x["n"] for x in rows.select(F.explode("visits").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.array(*[F.lit(max(1, -(-homes.get(c, 0) // LIST_BLOCK))) for c in range(len(index.centres))])
    queries = F.array(*[F.lit(max(1, -(-(homes.get(c, 0) + guests.get(c, 0)) // QUERY_BLOCK))) for c in range(len(index.centres))])
    dealt = lambda salt, of: F.pmod(F.xxhash64(F.lit(salt), "cls"), of).cast("int")
    members = rows.select("*", F.get(blocks, F.col("home")).alias("nb"), F.get(queries, F.col("home")).alias("nq")).withColumn("block", dealt(2, F.col("nb")))
    columns = ["cls", "n", "vec", "home"]
    listed = members.select(*columns, F.col("home").alias("cell"), "block", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("query"), F.lit(0).alias("kind"))
    # members meet the blocks from their own on, visitors meet all blocks of the lists they reach
    inside = members.select(*columns, F.col("home").alias("cell"), F.explode(F.sequence(F.col("block"), F.col("nb") - 1)).alias("block"),
                            dealt(3, F.col("nq")).alias("query"), F.when(F.lit(True), F.lit(1)).alias("kind"), F.col("block").alias("own"))
    inside = inside.withColumn("kind", F.when(F.col("block") == F.col("own"), 2).otherwise(1)).drop("own")
    visiting = rows.select(*columns, F.explode("visits").alias("cell")).select("*", F.get(blocks, F.col("cell")).alias("nb"), F.get(queries, F.col("cell")).alias("nq"))
    visiting = visiting.select(*columns, "cell", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"), dealt(3, F.col("nq")).alias("query"), F.lit(3).alias("kind"))

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        own = (pdf["kind"] == 0).to_numpy()
        if not own.any() or own.all():
            return pd.DataFrame({"u": [], "v": [], "n": []})
        lists, asks = pdf[own], pdf[~own]
        cell = int(lists["cell"].iloc[0])
        x, y = unit(matrix(asks["vec"])), unit(matrix(lists["vec"]))
        codes, error = index.code(y, index.centres[cell])
        j, i = np.nonzero(index.distances(x, index.centres[cell], codes) <= ((r + slack + error) ** 2)[:, None])
        sure = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
        i, j = i[sure], j[sure]
        ids, other = asks["cls"].to_numpy(), lists["cls"].to_numpy()
        kind, home = asks["kind"].to_numpy()[i], asks["home"].to_numpy()[i]
        keep = (kind != 2) | (ids[i] < other[j])  # a block meets itself
        far = np.flatnonzero(kind == 3)
        if len(far):  # where the member would visit as well, the smaller list has the pair
            a, b = index.centres[home[far]], index.centres[cell]
            back = ((y[j[far]] - a) ** 2).sum(1) - ((y[j[far]] - b) ** 2).sum(1) <= 2 * (r / 2 + slack) * np.linalg.norm(a - b, axis=1)
            keep[far] = ~back | (cell < home[far])
        i, j = i[keep], j[keep]
        seen = pd.concat([
            pd.DataFrame({"u": ids[i], "n": lists["n"].to_numpy()[j]}), pd.DataFrame({"u": other[j], "n": asks["n"].to_numpy()[i]}),
        ]).groupby("u", as_index=False)["n"].sum().assign(v=None)
        tree = forest(np.stack([ids[i], other[j]], 1)) if len(i) else []
        return pd.concat([seen[["u", "v", "n"]], pd.DataFrame(tree, columns=["u", "v"]).assign(n=None)])

    both = listed.unionByName(inside).unionByName(visiting)
    return cut(both.groupBy("cell", "block", "query").applyInPandas(met, "u long, v long, n long"))


def near_duplicates(table: DataFrame, cosine: float = 0.95, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``table``."""
    rows = table.select(F.col(key).alias("_key"), F.col(vector).cast("array<float>").alias("vec"))
    good = F.size("vec") > 0
    good = good & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("cls", F.when(F.col("vec").isNotNull() & good, F.xxhash64(F.transform("vec", lambda x: x + F.lit(0.0).cast("float")))))
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("least"), F.first("vec").alias("vec"))
    classes = cut(classes)
    found = None
    for size in classes.groupBy(F.size("vec").alias("size")).count().collect():
        part = links(classes.filter(F.size("vec") == size["size"]), size["count"], cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("_key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"), F.lit(True).alias("kept"))
    joined = components(found.filter("v IS NOT NULL").select("u", "v"))
    degree = found.filter("v IS NULL").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("far"))
    named = classes.select("cls", "n", "least").join(joined.select(F.col("u").alias("cls"), "v"), "cls", "left").withColumn("root", F.coalesce("v", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").join(degree, "cls", "left").select("cls", "component_id", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
    out = rows.select("_key", "cls").join(named, "cls", "left")
    return out.select(
        F.col("_key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("_key")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
