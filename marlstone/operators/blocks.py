"""Running totals and ranks over data that is too large for one sorted partition.

Values are cut into blocks by approximate quantile edges. Sums inside a block come from a
window over that block, and what lies before the block comes from a window over the block
totals, of which there are at most as many as blocks. The edges decide only how even the
blocks are; the totals are exact for any edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import nan_as_null, present

FEWEST_BLOCKS, MOST_BLOCKS = 64, 8_192


def block_edges(df: DataFrame, columns: Sequence[str], blocks: int | None = None) -> list[list[float]]:
    """Split points per column, strictly increasing and open at both ends.

    One pass over the raw columns with a mergeable sketch; the result has at most ``blocks``
    numbers per column. Unless given, there are two blocks per shuffle partition.
    """
    if blocks is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = min(max(2 * partitions, FEWEST_BLOCKS), MOST_BLOCKS)
    numbers = df.select([nan_as_null(c).alias(c) for c in columns])
    shares = [i / blocks for i in range(1, blocks)]
    found = numbers.approxQuantile(list(columns), shares, 1 / (2 * blocks))
    inner = [sorted({e for e in edges if e not in (float("inf"), float("-inf"))}) for edges in found]
    return [[float("-inf"), *(edges or [0.0]), float("inf")] for edges in inner]


def add_blocks(df: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]], names: Sequence[str]) -> DataFrame:
    """Add the block number of each column by binary search in its edges; a missing value gets -1.

    The number is never null: otherwise Spark would push null checks, and the search with them, down to the raw
    rows on one side of the block join only, and could no longer share the shuffle below it.
    """
    marked = Bucketizer(
        splitsArray=[list(e) for e in edges],
        inputCols=list(columns),
        outputCols=list(names),
        handleInvalid="keep",
    ).transform(df)
    return marked.withColumns({name: F.coalesce(F.col(name).cast("int"), F.lit(-1)) for name in names})


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Sequence[str],
    block: str,
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<total>_before``, the sum over all earlier rows, and ``<total>_all``, per ``by`` group.

    ``df`` holds one row per (by, order) and an integer ``block`` column that rises with the first order
    column. ``descending`` turns the first order column round; the others always rise.
    """
    turn = F.desc if descending else F.asc
    earlier = (Window.unboundedPreceding, -1)
    # As a struct the group is one key that is never null, so the window, the block sums and the join can
    # all work on the same shuffle.
    grouped = df.withColumn("_group", F.struct(*by)) if by else df
    group = ["_group"] if by else []
    sums = grouped.groupBy(*group, block).agg(*[F.sum(t).alias(f"_in_{t}") for t in totals])
    across = Window.partitionBy(*group).orderBy(turn(block)).rowsBetween(*earlier)
    whole = Window.partitionBy(*group)
    offsets = sums.select(
        *group,
        block,
        *[F.coalesce(F.sum(f"_in_{t}").over(across), F.lit(0)).alias(f"_to_{t}") for t in totals],
        *[F.sum(f"_in_{t}").over(whole).alias(f"{t}_all") for t in totals],
    )
    inside = Window.partitionBy(*group, block).orderBy(turn(order[0]), *order[1:]).rowsBetween(*earlier)
    local = grouped.select(
        "*", *[F.coalesce(F.sum(t).over(inside), F.lit(0)).alias(f"_at_{t}") for t in totals]
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most MOST_BLOCKS rows
    return local.join(offsets, [*group, block]).select(
        *df.columns,
        *[(F.col(f"_at_{t}") + F.col(f"_to_{t}")).alias(f"{t}_before") for t in totals],
        *[f"{t}_all" for t in totals],
    )


def value_totals(
    df: DataFrame,
    value: str,
    totals: dict,
    by: Sequence[str] = (),
    descending: bool = False,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """One row per distinct value with its own totals, the totals before it and those of the group.

    ``totals`` maps names to aggregate columns. Rows whose value is null or NaN have no place in
    the order and are left out. The data is combined per value in the map tasks, so a value that
    fills much of the table travels as one row per task.
    """
    ranked = df.where(present(F.col(value).cast("double")))
    if edges is None:
        edges = block_edges(ranked, [value])[0]
    per_value = ranked.groupBy(*by, value).agg(*[agg.alias(name) for name, agg in totals.items()])
    blocked = add_blocks(per_value, [value], [edges], ["_block"])
    return running_totals(blocked, [value], list(totals), "_block", by, descending).drop("_block")


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Each distinct value with its rank from 1; tied rows share the mean of their places."""
    counted = value_totals(df, value, {"n": F.count(F.lit(1))}, by)
    return counted.select(*by, value, (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"))
