"""Scaling and binning of number columns. Fitted state is a few numbers per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import nan_as_null
from marlstone.operators.quantiles import quantile_values

Centre = tuple[float, float]


def fit_scale(train: DataFrame, columns: Sequence[str], method: str) -> dict[str, Centre]:
    """Centre and spread per column.

    'standard' is mean and sample deviation, 'minmax' minimum and range, 'robust' median and
    interquartile range.
    """
    if method == "robust":
        found = quantile_values(train, columns, [0.25, 0.5, 0.75])
        return {c: (found[c, 0.5], found[c, 0.75] - found[c, 0.25]) for c in columns if found.get((c, 0.5)) is not None}
    if method == "standard":
        pairs = lambda x: (F.avg(x), F.stddev_samp(x))
    elif method == "minmax":
        pairs = lambda x: (F.min(x), F.max(x) - F.min(x))
    else:
        raise ValueError(f"unknown method {method!r}")
    row = train.agg(*[F.struct(*pairs(nan_as_null(c))).alias(c) for c in columns]).first()
    return {c: (row[c][0], row[c][1] or 0.0) for c in columns if row[c][0] is not None}


def apply_scale(df: DataFrame, state: dict[str, Centre], suffix: str = "_scaled") -> DataFrame:
    """(value - centre) / spread; a column without spread gives 0.0, a missing value null."""
    scaled = {}
    for c, (centre, spread) in state.items():
        shifted = nan_as_null(c) - F.lit(centre)
        scaled[f"{c}{suffix}"] = shifted / F.lit(spread) if spread else shifted * 0.0
    return df.withColumns(scaled)


def fit_bins(train: DataFrame, column: str, n: int, method: str) -> list[float]:
    """Rising edges of at most ``n`` bins: equal 'width', or equal 'quantile' shares."""
    if n < 2:
        raise ValueError("n must be at least 2")
    if method == "quantile":
        shares = [i / n for i in range(n + 1)]
        found = quantile_values(train, [column], shares)
        edges = [found[column, s] for s in shares if found.get((column, s)) is not None]
    elif method == "width":
        x = nan_as_null(column)
        low, high = train.agg(F.min(x), F.max(x)).first()
        edges = [] if low is None else [low + (high - low) * i / n for i in range(n)] + [high]
    else:
        raise ValueError(f"unknown method {method!r}")
    return sorted(set(edges))


def apply_bins(df: DataFrame, column: str, edges: Sequence[float], out: str = "bin") -> DataFrame:
    """Add the bin number from 0: bins are closed on the left, and the end bins take what lies outside.

    Missing values get null.
    """
    splits = [float("-inf"), *edges[1:-1], float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.when(nan_as_null(column).isNotNull(), F.lit(0)))
    clean = df.withColumn("_bin_value", nan_as_null(column))
    marked = Bucketizer(splits=splits, inputCol="_bin_value", outputCol="_bin_place", handleInvalid="keep").transform(clean)
    return marked.withColumn(out, F.col("_bin_place").cast("int")).drop("_bin_value", "_bin_place")
