"""Running values per key over rows of which one key may hold very many.

A scan along a key in one window is one task per key. Here places (whole numbers, at most one row per key and place) are cut into blocks of
``FAN`` places, windows run per (key, block), and what enters a block is found by the same scan over one row per block: a carry
of carries. With ``LEVELS`` levels a window holds at most ``FAN`` rows for ``FAN ** LEVELS`` places, and the last level's one per key
holds a row for each of the largest blocks. Sums of whole numbers are exact; those of doubles may differ from one long window in the last digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

FAN = 1_024
LEVELS = 3
EARLIER = (Window.unboundedPreceding, -1)


def block_of(place: str, width: int) -> Column:
    """Number of the block a place falls into, rounded down for places below zero too; never null for places that are not.

    Saying so keeps null checks out of one side of the block join, so that both sides can share their shuffle.
    """
    return F.coalesce(F.expr(f"({place} - pmod({place}, {width}L)) div {width}L"), F.lit(0))


def _blocked(df: DataFrame, key: Sequence[str], place: str, fan: int, level: int) -> tuple[DataFrame, list[str], WindowSpec]:
    """``df`` with its entity and block, their names, and the window over a block's earlier rows."""
    # As a struct the key is never null, so windows, summaries and joins meet on one partitioning.
    names = [f"_entity{level}", f"_block{level}"]
    cut = df.withColumn(names[0], F.struct(*key)).withColumn(names[1], block_of(place, fan))
    return cut, names, Window.partitionBy(*names).orderBy(place).rowsBetween(*EARLIER)


def carry_last(df: DataFrame, key: Sequence[str], place: str, value: str, out: str, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Add ``out``: the ``value`` of the nearest earlier row of the key that has one."""
    nearest = F.last(value, ignorenulls=True)
    if levels <= 1:
        return df.withColumn(out, nearest.over(Window.partitionBy(*key).orderBy(place).rowsBetween(*EARLIER)))
    cut, block, inside = _blocked(df, key, place, fan, levels)
    local = cut.withColumn("_near", nearest.over(inside))
    # Blocks without a value have a row as well, to take what reaches them.
    blocks = cut.groupBy(*block).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(place))).alias("_last"))
    carried = carry_last(blocks, block[:1], block[1], "_last", "_far", fan, levels - 1).select(*block, "_far")
    return local.join(carried, block).select(*df.columns, F.coalesce("_near", "_far").alias(out))


def carry_sum(df: DataFrame, key: Sequence[str], place: str, value: str, out: str, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the key, 0 for the first."""
    if levels <= 1:
        whole = Window.partitionBy(*key).orderBy(place).rowsBetween(*EARLIER)
        return df.withColumn(out, F.coalesce(F.sum(value).over(whole), F.lit(0)))
    cut, block, inside = _blocked(df, key, place, fan, levels)
    local = cut.withColumn("_near", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    blocks = cut.groupBy(*block).agg(F.sum(value).alias("_sum"))
    carried = carry_sum(blocks, block[:1], block[1], "_sum", "_far", fan, levels - 1).select(*block, "_far")
    return local.join(carried, block).select(*df.columns, (F.col("_near") + F.col("_far")).alias(out))
