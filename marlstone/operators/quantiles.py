"""Exact interpolated quantiles without holding a column's distinct values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import join_on, nan_as_null
from marlstone.operators.blocks import add_blocks, block_edges

BROADCAST_ROWS = 100_000


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Rows (by, column, share, value): the linearly interpolated quantile of each column.

    Nulls and NaN are left out. Block counts tell which blocks hold the wanted ranks, and only the
    distinct values of those blocks are shuffled and sorted, each block in its own partition. Tables of any size take this
    way, and the values are those of Spark's ``percentile`` to the last bit.
    """
    data = df.select(*by, *[nan_as_null(c).alias(c) for c in columns])
    return _by_blocks(data, columns, shares, by, blocks)


def quantile_values(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], **options
) -> dict[tuple[str, float], float]:
    """The same for whole columns as a driver-side dict of columns times shares numbers."""
    rows = quantiles(df, columns, shares, **options).collect()
    return {(r["column"], r["share"]): r["value"] for r in rows}


def _by_blocks(data, columns, shares, by, blocks):
    edges = block_edges(data, columns, blocks)
    marks = [f"_block_{i}" for i in range(len(columns))]
    wide = add_blocks(data, columns, edges, marks)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("x"), F.col(m).alias("block"))
            for c, m in zip(columns, marks)
        ]
    )
    long = wide.select(*by, F.explode(cells).alias("c")).select(*by, "c.*").where(F.col("x").isNotNull())

    keys = [*by, "column"]
    per_block = long.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"))
    rising = Window.partitionBy(*keys).orderBy("block")
    placed = per_block.select(
        *keys,
        "block",
        (F.sum("n").over(rising) - F.col("n")).alias("start"),
        F.sum("n").over(rising).alias("end"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    wanted = (
        placed.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("place", F.col("share") * (F.col("total") - 1))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))))
        .where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end")))
        .select(*keys, "block", "share", "place", "rank", "start")
        .persist()
    )
    # Two ranks per group, column and share. Where those are few, the rows are filtered where they were read;
    # with very many groups they are shuffled instead.
    held = wanted.select(*keys, "block").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        held, wanted = F.broadcast(held), F.broadcast(wanted)
    inside = Window.partitionBy(*keys, "block").orderBy("x")
    sorted_values = (
        join_on(long, held, [*keys, "block"], "left_semi")
        .groupBy(*keys, "block", "x")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "block", "x", "n", F.sum("n").over(inside).alias("upto"))
    )
    in_block = F.col("rank") - F.col("start")
    picked = join_on(sorted_values, wanted, [*keys, "block"]).where(
        (in_block >= F.col("upto") - F.col("n")) & (in_block < F.col("upto"))
    )
    low = F.max(F.when(F.col("rank") == F.floor("place"), F.col("x")))
    high = F.max(F.when(F.col("rank") == F.ceil("place"), F.col("x")))
    ends = picked.groupBy(*keys, "share").agg(low.alias("low"), high.alias("high"), F.max("place").alias("place"))
    between = (F.ceil("place") - F.col("place")) * F.col("low") + (F.col("place") - F.floor("place")) * F.col("high")
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between)
    return ends.select(*keys, "share", value.alias("value"))
