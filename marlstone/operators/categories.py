"""Turning categories into numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import as_column, divide, join_on, join_small, nan_as_null

MAX_ONE_HOT = 10_000


def fit_index(train: DataFrame, column: str) -> DataFrame:
    """Category table (column, n, idx): the most frequent first, ties in alphabetical order.

    The index is a dense position, so the table is meant for columns whose categories make sense as
    positions; more than ``MAX_ONE_HOT`` raise an error, and ``hash_features`` takes any number.
    """
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.persist()
    size = counts.count()
    if size > MAX_ONE_HOT:
        counts.unpersist()
        raise ValueError(f"{column} has {size} categories; use hash_features for that many")
    position = F.row_number().over(Window.orderBy(F.desc("n"), column)) - 1
    return counts.select(column, "n", position.alias("idx"))


def apply_index(df: DataFrame, index: DataFrame, column: str, one_hot: bool = True) -> DataFrame:
    """Add ``<column>_idx`` and, as an array of 0.0 and 1.0, ``<column>_onehot``.

    A category that is not in the table gets a null index and all zeros.
    """
    table = index.select(column, F.col("idx").alias(f"{column}_idx"))
    joined = join_on(df, F.broadcast(table), [column], "left")  # at most MAX_ONE_HOT rows, see fit_index
    if not one_hot:
        return joined
    size = index.count()
    if size == 0:
        return joined.withColumn(f"{column}_onehot", F.array().cast("array<double>"))
    position = F.coalesce(F.col(f"{column}_idx"), F.lit(-1))
    hot = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == position, 1.0).otherwise(0.0))
    return joined.withColumn(f"{column}_onehot", hot)


def fit_target_encode(train: DataFrame, column: str, y: str, fold: str, smoothing: float) -> DataFrame:
    """Encodings per (category, fold), each from the rows of the other folds.

    (sum + m * prior) / (count + m), where the prior is the mean of y over the other folds; the prior itself where
    that divides by zero. A NaN target counts as missing. Only category counts are compared, never the rows of a category.
    """
    target = nan_as_null(y)
    folds = train.groupBy(column, fold).agg(F.sum(target).alias("s"), F.count(target).alias("n")).persist()
    whole = folds.groupBy(column).agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    per_fold = folds.groupBy(fold).agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    rows = {r[fold]: (r["s"] or 0.0, r["n"]) for r in per_fold}  # as many as folds
    all_s, all_n = sum(s for s, _ in rows.values()), sum(n for _, n in rows.values())
    prior = F.lit(None).cast("double")
    for number, (s, n) in rows.items():
        if all_n > n:
            prior = F.when(F.col(fold) == number, F.lit((all_s - s) / (all_n - n))).otherwise(prior)
    m = F.lit(float(smoothing))
    others = join_on(folds, whole, [column])
    return others.select(
        column,
        fold,
        divide(
            F.coalesce("all_s", F.lit(0.0)) - F.coalesce("s", F.lit(0.0)) + m * prior, F.col("all_n") - F.col("n") + m, prior
        ).alias(f"{column}_encoded"),
    )


def apply_target_encode(df: DataFrame, encodings: DataFrame, column: str, fold: str) -> DataFrame:
    """Add ``<column>_encoded`` to rows that carry their fold."""
    return join_small(df, encodings, [column, fold])


def hash_features(df: DataFrame, columns: Sequence[str], dims: int, out: str = "hashed") -> DataFrame:
    """Signed hashing of ``name=value`` pairs into a sparse array of (idx, value), rising by idx.

    Index and sign come from different hex digits of the pair's MD5 digest. Nulls add nothing; pairs
    that meet in one index are added up.
    """

    def cell(name):
        digest = F.md5(F.concat(F.lit(f"{name}="), as_column(name).cast("string")))
        idx = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % dims
        odd = F.conv(F.substring(digest, 8, 1), 16, 10).cast("int") % 2
        return F.struct(idx.cast("int").alias("idx"), F.when(odd == 1, -1.0).otherwise(1.0).alias("value"))

    cells = F.filter(F.array(*[cell(c) for c in columns]), lambda c: c["idx"].isNotNull())

    def merged(found):
        def summed(idx):
            same = F.filter(found, lambda c: c["idx"] == idx)
            total = F.aggregate(same, F.lit(0.0), lambda value, c: value + c["value"])
            return F.struct(idx.alias("idx"), total.alias("value"))

        places = F.array_sort(F.array_distinct(F.transform(found, lambda c: c["idx"])))
        return F.transform(places, summed)

    # Through a one-element array the pairs are hashed once per row and not once per use.
    return df.withColumn(out, F.transform(F.array(cells), merged)[0])
