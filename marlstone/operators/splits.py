"""Splitting tables into parts, and checks that the parts do not share entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import KEY_NUMBER_BITS, key_number


def hash_split(df: DataFrame, key: str, parts: dict[str, int], out: str = "part") -> DataFrame:
    """Add the part of each row; ``parts`` maps names to tenths and sums to ten.

    The same key gets the same part on every run and in every table.
    """
    if sum(parts.values()) != 10 or any(share < 0 for share in parts.values()):
        raise ValueError("the parts must be non-negative tenths that sum to 10")
    tenth = key_number(key) % 10
    upper, part = 0, None
    for name, share in parts.items():
        upper += share
        part = F.when(tenth < upper, name) if part is None else part.when(tenth < upper, name)
    return df.withColumn(out, part)


def kfold(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    """Add a fold number from 0 to k - 1 that depends on the key only."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return df.withColumn(out, (key_number(key) % k).cast("int"))


def time_split(df: DataFrame, ts: str, cutoff: str | Column, out: str = "part") -> DataFrame:
    """Add 'train' before the cutoff and 'test' from it on; a row without a time gets null."""
    limit = F.lit(cutoff).cast("timestamp_ntz") if isinstance(cutoff, str) else cutoff
    return df.withColumn(out, F.when(F.col(ts) < limit, "train").when(F.col(ts) >= limit, "test"))


def before(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """The rows that ``time_split`` calls train, as a plain comparison that reaches the scan."""
    return df.where(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz"))


def shared_entities(df: DataFrame, entity: Sequence[str], part: str = "part") -> DataFrame:
    """How far the test rows' entities are also seen in train.

    One row: test rows and entities, and how many of them also occur in train. Rows are counted per
    entity and part before anything is compared, so no entity's rows meet in one task.
    """
    in_train = F.sum(F.when(F.col(part) == "train", 1).otherwise(0))
    in_test = F.sum(F.when(F.col(part) == "test", 1).otherwise(0))
    per_entity = df.groupBy(*entity).agg(in_train.alias("n_train"), in_test.alias("n_test")).where(F.col("n_test") > 0)
    seen = F.col("n_train") > 0
    return per_entity.agg(
        F.coalesce(F.sum("n_test"), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum(F.when(seen, F.col("n_test"))), F.lit(0)).alias("test_rows_seen"),
        F.count(F.lit(1)).alias("test_entities"),
        F.count(F.when(seen, 1)).alias("test_entities_seen"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class its rows and the weight n / (classes * n_class); rows without a label are left out."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).persist()
    whole = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    row = whole.first()
    return counts.withColumn("weight", F.lit(float(row["rows"] or 0)) / (F.lit(row["classes"]) * F.col("n")))


def downsample(df: DataFrame, key: str, label: str, shares: dict) -> DataFrame:
    """Keep, per class, the rows whose key number falls below the class's share of the range.

    A sampling operator: classes not named in ``shares`` are kept whole. A row's fate depends on its
    key and class only; a null key has the number 0, so it stays wherever a class keeps anything.
    """
    limit = F.lit(float(2**KEY_NUMBER_BITS))
    for value, share in shares.items():
        limit = F.when(F.col(label) == value, F.lit(share * 2**KEY_NUMBER_BITS)).otherwise(limit)
    return df.where(F.coalesce(key_number(key), F.lit(0)) < limit)

