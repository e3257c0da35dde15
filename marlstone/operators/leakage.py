"""Values of the test part that the train part holds as well, compared as normalized text.

Only digests are compared, SHA-256 of the normalized values. Those of the test part first go through a Bloom filter of the train part's, which is a
table of 64-bit words of bounded size, and only what passes meets the train digests in an exact join. A filter that is too small for the train part lets
more pass; the answer is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.joins import join_split

#: Bits of a filter per train value, and the most bits as a power of two (2**21 words, 32 MB as a table).
BITS_PER_VALUE, MOST_BITS = 16, 27
HASHES = 2


def normalized(values: Sequence[str]) -> Column:
    """Lower case, white space as single blanks, none at the ends; several columns with a separator. Null where all are null."""

    def plain(name: str) -> Column:
        return F.trim(F.regexp_replace(F.lower(F.col(name).cast("string")), r"[\x20\x09-\x0D]+", " "))

    if len(values) == 1:
        return plain(values[0])
    together = F.concat_ws("\x1f", *[F.coalesce(plain(v), F.lit("\x1e")) for v in values])
    return F.when(F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull(), together)


def _digests(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """``_digest`` and its rows ``n``, combined in the map tasks; rows without a value have none."""
    digest = F.sha2(normalized(values), 256).alias("_digest")
    return df.select(digest).where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))


def _places(bits: int) -> list[Column]:
    """The bits of a digest, from its first hexadecimal digits on."""
    return [F.conv(F.substring("_digest", 1 + 7 * i, 7), 16, 10).cast("bigint").bitwiseAND((1 << bits) - 1) for i in range(HASHES)]


def bloom_words(digests: DataFrame, bits: int) -> DataFrame:
    """The filter as rows ``word, held``: at most ``2 ** (bits - 6)``, whatever the number of digests."""
    place = digests.select(F.explode(F.array(*_places(bits))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    return place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("held"))


def may_hold(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """The rows whose ``_digest`` has all its bits set."""
    columns = rows.columns
    for place in _places(bits):
        looked_up = rows.withColumn("_place", place).withColumn("word", F.shiftright("_place", 6))
        found = looked_up.join(F.broadcast(words), "word")
        rows = found.where(F.expr("shiftright(held, cast(_place & 63 as int)) & 1") == 1).select(*columns)
    return rows


def shared_digests(train: DataFrame, test: DataFrame, values: Sequence[str], bits: int | None = None) -> DataFrame:
    """``_digest, n``: the values of the test part that train has too, and in how many test rows they are."""
    theirs = _digests(train, values).select("_digest")
    if bits is None:
        # Rows bound the values from above; counting them reads no text.
        bits = min(max(ceil(log2(max(train.count(), 1) * BITS_PER_VALUE)), 10), MOST_BITS)
    passed = may_hold(_digests(test, values), bloom_words(theirs, bits), bits)
    return passed.join(theirs, "_digest", "left_semi")


def leakage_report(train: DataFrame, test: DataFrame, values: Sequence[str], bits: int | None = None) -> DataFrame:
    """One row: test rows and different values that are not null, and how many of them train holds too."""
    shared = shared_digests(train, test, values, bits)
    every = _digests(test, values).withColumn("seen", F.lit(False)).unionByName(shared.withColumn("seen", F.lit(True)))
    return every.agg(
        F.coalesce(F.sum(F.when(~F.col("seen"), F.col("n"))), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum(F.when(F.col("seen"), F.col("n"))), F.lit(0)).alias("test_rows_seen"),
        F.count(F.when(~F.col("seen"), 1)).alias("test_values"),
        F.count(F.when(F.col("seen"), 1)).alias("test_values_seen"),
    )


def leaked_rows(train: DataFrame, test: DataFrame, values: Sequence[str], bits: int | None = None) -> DataFrame:
    """The test rows whose value train holds too, with all their columns.

    A value that fills a large part of the test rows is joined where they lie.
    """
    shared = shared_digests(train, test, values, bits)
    marked = test.withColumn("_digest", F.sha2(normalized(values), 256))
    return join_split(marked, shared.select("_digest"), "_digest").select(*test.columns)
