"""Joins that stay even where one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_split(rows: DataFrame, table: DataFrame, key: str, sizes: DataFrame | None = None) -> DataFrame:
    """Inner join of rows with a table that has one row per key, split at the keys that are too heavy for one task.

    A key is heavy if it holds more than one shuffle partition's share of all rows, so there are fewer heavy keys than partitions: their rows
    of the table are sent to every task, and the rows stay where they are. All others are joined in the usual way. The counts are part of
    the same plan. ``sizes`` (``key, n``: rows per key) saves counting where that is known.
    """
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sizes.agg(F.sum("n")).scalar()
    heavy = F.broadcast(sizes.where(F.col("n") * partitions > total).select(key))
    often = rows.join(F.broadcast(table.join(heavy, key, "left_semi")), key)
    seldom = rows.join(heavy, key, "left_anti").join(table.join(heavy, key, "left_anti"), key)
    return often.unionByName(seldom)
