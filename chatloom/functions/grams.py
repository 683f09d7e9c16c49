"""Token n-grams as 64-bit numbers, and a Bloom filter of them that is asked inside the row, before anything is exploded.

The filter only spares work: what passes it is compared as a string. Its size follows the number of grams up to ``MOST_BITS``; with more grams it lets
more pass, and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import let

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
BITS = "_bits"


def hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def gram(h: Column, i, n: int) -> Column:
    """Number of the n-gram that begins at place ``i`` of token hashes."""
    return F.xxhash64(*[F.get(h, i + k) for k in range(n)])


def gram_of(text: Column, n: int) -> Column:
    """Number of an n-gram given as tokens joined by spaces."""
    return let(hashes(F.split(text, " ")), lambda h: gram(h, F.lit(0), n))


def _probes(h: Column, bits: int) -> list[Column]:
    return [x.bitwiseAND(F.lit(bits - 1)) for x in (h, F.shiftrightunsigned(h, 32))]


class GramFilter:
    """A Bloom filter over column ``h`` of ``numbers``: an array of 64-bit words that reaches the executors as the result of a one-row subquery."""

    def __init__(self, numbers: DataFrame):
        self.bits = LEAST_BITS
        wanted = 16 * numbers.count()
        while self.bits < min(wanted, MOST_BITS):
            self.bits *= 2
        place = F.explode(F.array(*_probes(F.col("h"), self.bits)))
        bit = F.expr("shiftleft(1L, cast(p & 63 AS int))")
        words = numbers.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("v"))
        dense = numbers.sparkSession.range(self.bits // 64).withColumnRenamed("id", "w").join(words, "w", "left")
        whole = F.array_sort(F.collect_list(F.struct("w", F.coalesce("v", F.lit(0).cast("long")).alias("v"))))
        self.words = dense.agg(F.transform(whole, lambda x: x["v"]).alias(BITS))

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the filter as column ``_bits``, for ``surviving`` in the next projection; subqueries cannot stand inside lambdas themselves."""
        return df.withColumn(BITS, self.words.scalar())

    def may_hold(self, h: Column) -> Column:
        one = lambda p: F.getbit(F.get(F.col(BITS), F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        a, b = _probes(h, self.bits)
        return one(a) & one(b)

    def surviving(self, tokens: Column, lengths: list[int]) -> Column:
        """Distinct n-grams, as strings, of a token array that the filter may hold, for each n of ``lengths``."""

        def of_length(t: Column, h: Column, n: int) -> Column:
            starts = F.sequence(F.lit(0), F.size(t) - n)
            passed = F.filter(starts, lambda i: let(gram(h, i, n), self.may_hold))
            found = F.transform(passed, lambda i: F.array_join(F.slice(t, i + 1, F.lit(n)), " "))
            return F.when(F.size(t) >= n, found).otherwise(F.array().cast("array<string>"))

        return let(tokens, lambda t: let(hashes(t), lambda h: F.array_distinct(F.concat(*[of_length(t, h, n) for n in lengths]))))
