"""A bounded filter of many keys, in place of a join that moves every row.

Where few rows of a large frame have a key of a set, and the set is too large to
broadcast, a join moves all rows to find them. Here the set becomes one array of
bits of a bounded size that every task holds: a row whose key is in the set always
passes, and few others do (a Bloom filter of two bits a key). What passes is then
looked at exactly, the rest stays where it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import cut_lineage

BITS = 16                  # of each key, while the words are below the most
LEAST_WORDS = 1 << 10
MOST_WORDS = 1 << 20       # 8 MB; more keys let more rows pass, none less


def _places(digest: Column, words: int) -> list[Column]:
    """The two bits of a digest."""
    last = F.lit(words * 64 - 1).cast("long")
    return [digest.bitwiseAND(last), F.shiftrightunsigned(digest, 32).bitwiseAND(last)]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def maybe_among(digests: DataFrame) -> Callable[[Column], Column]:
    """``digests``: a stored frame of one column, 64-bit digests of keys. Returns
    the test of a digest: true for all of these, and for few others."""
    words = LEAST_WORDS
    wanted = digests.count() * BITS // 64
    while words < min(wanted, MOST_WORDS):
        words *= 2
    return _test(cut_lineage(_words(digests, words), "key_filter"), words)


def maybe_among_lazy(digests: DataFrame, words: int) -> Callable[[Column], Column]:
    """The same as part of the query that asks, with a fixed number of words (a
    power of two): nothing runs before."""
    return _test(_words(digests, words), words)


def _words(digests: DataFrame, words: int) -> DataFrame:
    """One row: the array of words."""
    spark, (name,) = digests.sparkSession, digests.columns
    set_bits = (digests.where(F.col(name).isNotNull()).select(F.explode(F.array(*_places(F.col(name), words))).alias("p"))
                .groupBy(_word(F.col("p")).alias("w")).agg(F.bit_or(_bit(F.col("p"))).alias("bits")))
    every = spark.range(words).select(F.col("id").cast("int").alias("w")).join(set_bits, "w", "left")
    return every.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda x: x["bits"]).alias("words"))


def _test(one_row: DataFrame, words: int) -> Callable[[Column], Column]:
    held = one_row.scalar()

    def passes(digest: Column) -> Column:
        a, b = (F.get(held, _word(p)).bitwiseAND(_bit(p)) != 0 for p in _places(digest, words))
        return a & b
    return passes
