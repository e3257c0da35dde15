"""Bounded samples for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import SMALL_TABLE_ROWS
from marlstone.llm.storage import keep


def id_part(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def bounded_sample(df: DataFrame, per_group: int, group: str, *marks: str) -> DataFrame:
    """At most ``per_group`` rows of each group, those with the smallest hash of ``marks``.

    Groups are counted first, and their counts go to every task where they are few, so that only rows with a small enough hash move: about half as
    many again as the sample. Rows that agree in all marks are one row.
    """
    place = F.xxhash64(*marks) / F.lit(2.0**64) + 0.5
    counts = keep(df.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n")), "sample-groups")
    likely = F.least(F.lit(1.0), (F.lit(1.5) * per_group + 50) / F.col("_n"))
    told = F.broadcast(counts) if counts.count() <= SMALL_TABLE_ROWS else counts
    rows = df.withColumn("_place", place).join(told, F.col(group) == F.col("_group")).where(F.col("_place") <= likely)
    # Copies fall on one place together; they meet in the map tasks, so that a text of which there are very many is one row per task.
    rows = rows.dropDuplicates([group, *marks])
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy("_place", *marks)))
    return ranked.where(F.col("_rank") <= per_group).drop("_place", "_group", "_n", "_rank")
