"""Filling gaps and limiting outliers, with limits learned from training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import nan_as_null
from marlstone.operators.quantiles import quantile_values


def fit_impute(train: DataFrame, rules: dict[str, object]) -> dict[str, object]:
    """Fill values per column. A rule is 'mean', 'median', 'mode' or ('constant', value).

    NaN counts as missing in double columns; ties for the mode go to the smallest value. All means share
    one pass.
    """
    kinds = dict(train.dtypes)
    fills: dict[str, object] = {c: rule[1] for c, rule in rules.items() if isinstance(rule, tuple)}
    means = [c for c, rule in rules.items() if rule == "mean"]
    if means:
        row = train.agg(*[F.avg(nan_as_null(c)).alias(c) for c in means]).first()
        fills.update({c: row[c] for c in means})
    medians = [c for c, rule in rules.items() if rule == "median"]
    if medians:
        found = quantile_values(train, medians, [0.5])
        fills.update({c: found.get((c, 0.5)) for c in medians})
    for c in (c for c, rule in rules.items() if rule == "mode"):
        value = nan_as_null(c) if kinds[c] in ("double", "float") else F.col(c)
        counts = train.select(value.alias("x")).where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("x")).first()
        fills[c] = row["x"]
    unknown = set(rules) - set(fills)
    if unknown:
        raise ValueError(f"unknown rule for {sorted(unknown)}")
    return fills


def apply_impute(df: DataFrame, fills: dict[str, object], flag: bool = False) -> DataFrame:
    """Fill missing values; with ``flag``, add ``<column>_was_null``."""
    kinds = dict(df.dtypes)
    columns = []
    for name in df.columns:
        if name not in fills:
            columns.append(F.col(name))
            continue
        floating = kinds[name] in ("double", "float")
        value = nan_as_null(name) if floating else F.col(name)
        # A mean or median need not be a whole number, so a filled integer column becomes double.
        fill = F.lit(fills[name])
        if kinds[name] in ("tinyint", "smallint", "int", "bigint") and isinstance(fills[name], float):
            value = value.cast("double")
        columns.append(F.coalesce(value, fill).alias(name))
        if flag:
            columns.append(value.isNull().alias(f"{name}_was_null"))
    return df.select(*columns)


def fit_clip(train: DataFrame, columns: Sequence[str], low: float, high: float) -> dict[str, tuple[float, float]]:
    """Limits per column at two interpolated quantiles."""
    found = quantile_values(train, columns, [low, high])
    return {c: (found[c, low], found[c, high]) for c in columns if (c, low) in found}


def apply_clip(df: DataFrame, limits: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """Move values outside the limits to the nearer limit; null stays null and NaN becomes null."""
    clipped = {
        f"{c}{suffix}": F.when(nan_as_null(c).isNotNull(), F.greatest(F.least(nan_as_null(c), F.lit(hi)), F.lit(lo)))
        for c, (lo, hi) in limits.items()
        if lo is not None
    }
    return df.withColumns(clipped) if clipped else df
