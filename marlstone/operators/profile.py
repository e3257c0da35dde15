"""Column profiles, correlation, association and drift."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import divide, nan_as_null, present
from marlstone.operators.blocks import average_ranks
from marlstone.operators.quantiles import quantiles
from marlstone.operators.scale import apply_bins, fit_bins

SHARE_FLOOR = 1e-6


def profile(df: DataFrame, columns: Sequence[str], exact_distinct: bool = False) -> DataFrame:
    """One row per number column: rows, nulls, distinct, min, max, mean, deviation, skewness, kurtosis, quartiles.

    The moments come from one aggregate. Distinct counts are sketches in the same pass unless ``exact_distinct``
    asks for exact ones: those shuffle each column's distinct values, apart from the moments, so that no sums are
    carried along per value. NaN counts as null.
    """
    data = df.select([nan_as_null(c).alias(c) for c in columns])
    stats = data.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                (F.count(F.lit(1)) - F.count(c)).alias("n_null"),
                (F.lit(None).cast("bigint") if exact_distinct else F.approx_count_distinct(c)).alias("n_distinct"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.skewness(c).alias("skewness"),
                F.kurtosis(c).alias("kurtosis"),
            ).alias(f"stats_{c}")
            for c in columns
        ]
    )
    long = stats.select(F.explode(F.array(*[F.col(f"stats_{c}") for c in columns])).alias("s")).select("s.*")
    if exact_distinct:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("x")) for c in columns])
        values = data.select(F.explode(cells).alias("c")).select("c.*").where("x is not null").distinct()
        exact = values.groupBy("column").agg(F.count(F.lit(1)).alias("exact"))
        joined = long.join(exact, "column", "left")
        long = joined.withColumn("n_distinct", F.coalesce("exact", F.lit(0))).drop("exact")
    quarter = quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = quarter.groupBy("column").agg(
        *[
            F.max(F.when(F.col("share") == share, F.col("value"))).alias(name)
            for share, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    return long.join(wide, "column", "left")


def profile_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per text column: rows, nulls, distinct values, the most frequent one and its rows, entropy.

    Rows are counted per (column, value) in the map tasks; ties for the most frequent go to the first in
    alphabetical order.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("x")) for c in columns])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    held = F.when(F.col("x").isNotNull(), F.col("n"))
    sums = counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("x").alias("n_distinct"),
        F.min_by("x", F.when(F.col("x").isNotNull(), F.struct(-F.col("n"), F.col("x")))).alias("top"),
        F.max(held).alias("top_rows"),
        F.sum(held).alias("held"),
        F.sum(held * F.log(held.cast("double"))).alias("weighted"),
    )
    entropy = F.log(F.col("held").cast("double")) - F.col("weighted") / F.col("held")
    return sums.select("column", "n_rows", "n_null", "n_distinct", "top", "top_rows", entropy.alias("entropy"))


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (x, y, r): Pearson for each pair of columns, over rows where both are present, in one pass.

    A pair with a constant column gets null.
    """
    data = df.select([nan_as_null(c).alias(c) for c in columns])
    pairs = list(combinations(columns, 2))

    def pearson(x, y):
        # Spark's own corr fails on a constant column where ANSI mode is on.
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
        return divide(F.covar_pop(x, y), spread)

    one = data.agg(*[pearson(x, y).alias(f"r_{i}") for i, (x, y) in enumerate(pairs)])
    cells = F.array(
        *[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r_{i}").alias("r")) for i, (x, y) in enumerate(pairs)]
    )
    return one.select(F.explode(cells).alias("c")).select("c.*")


def rank_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (x, y, r): Spearman over rows where both are present, ties sharing their mean rank.

    Ranks are found per distinct value and pair counts are joined to them, so rows are only ever counted.
    """
    data = df.select(nan_as_null(x).alias("a"), nan_as_null(y).alias("b")).where("a is not null and b is not null")
    pairs = data.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    rank_a = average_ranks(data, "a").withColumnRenamed("rank", "ra")
    rank_b = average_ranks(data, "b").withColumnRenamed("rank", "rb")
    ranked = pairs.join(rank_a, "a").join(rank_b, "b")
    n = F.sum("n").cast("double")
    mean = (n + 1) / 2
    # The mean rank is known, so the sums are taken around it in a second step.
    sums = ranked.agg(
        n.alias("n"),
        F.sum(F.col("n") * F.col("ra") * F.col("rb")).alias("ab"),
        F.sum(F.col("n") * F.col("ra") * F.col("ra")).alias("aa"),
        F.sum(F.col("n") * F.col("rb") * F.col("rb")).alias("bb"),
        mean.alias("m"),
    )
    shift = F.col("n") * F.col("m") * F.col("m")
    # What rounding leaves of the spread of a constant column counts as none.
    spread_a, spread_b = [F.when(F.col(c) - shift > shift * 1e-12, F.col(c) - shift) for c in ("aa", "bb")]
    below = F.sqrt(spread_a * spread_b)
    return sums.select(F.lit(x).alias("x"), F.lit(y).alias("y"), divide(F.col("ab") - shift, below).alias("r"))


def mutual_information(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (x, y, n, mutual_information, entropy_x, entropy_y), natural logarithm.

    Rows are counted per cell in the map tasks, and grouping sets over the cells give the margins. The sums
    need no join: n * MI is the sum of c ln c over the cells, less those over both margins, plus n ln n.
    """
    known = df.select(F.col(x).alias("a"), F.col(y).alias("b")).where("a is not null and b is not null")
    cells = known.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    counts = cells.groupingSets([["a", "b"], ["a"], ["b"]], "a", "b").agg(
        F.sum("c").alias("c"), F.grouping_id().alias("g")
    )
    weight = F.col("c") * F.log(F.col("c").cast("double"))
    sums = counts.agg(
        F.sum(F.when(F.col("g") == 0, F.col("c"))).alias("n"),
        F.sum(F.when(F.col("g") == 0, weight)).alias("cells"),
        F.sum(F.when(F.col("g") == 1, weight)).alias("in_a"),
        F.sum(F.when(F.col("g") == 2, weight)).alias("in_b"),
    )
    n, log_n = F.col("n"), F.log(F.col("n").cast("double"))
    return sums.select(
        F.lit(x).alias("x"),
        F.lit(y).alias("y"),
        F.coalesce(n, F.lit(0)).alias("n"),
        ((F.col("cells") - F.col("in_a") - F.col("in_b")) / n + log_n).alias("mutual_information"),
        (log_n - F.col("in_a") / n).alias("entropy_x"),
        (log_n - F.col("in_b") / n).alias("entropy_y"),
    )


def chi_square(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (x, y, n, chi2, dof, cramers_v): Pearson's statistic over the full contingency table.

    n * (sum of c^2 / (row * column) - 1) covers empty cells without building them.
    """
    known = df.select(F.col(x).alias("a"), F.col(y).alias("b")).where("a is not null and b is not null")
    cells = known.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    margin_a = cells.groupBy("a").agg(F.sum("c").alias("row"))
    margin_b = cells.groupBy("b").agg(F.sum("c").alias("column"))
    filled = cells.join(margin_a, "a").join(margin_b, "b")
    c, row, column = F.col("c").cast("double"), F.col("row"), F.col("column")
    sums = filled.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.sum(c / row * (c / column)).alias("s"),
        # Each row's cells add up to the row, so these sums count rows and columns.
        F.sum(c / row).alias("rows"),
        F.sum(c / column).alias("columns"),
    )
    chi2 = F.col("n") * (F.col("s") - 1)
    rows, columns = F.round("rows").cast("bigint"), F.round("columns").cast("bigint")
    smaller = F.least(rows, columns) - 1
    return sums.select(
        F.lit(x).alias("x"),
        F.lit(y).alias("y"),
        "n",
        chi2.alias("chi2"),
        ((rows - 1) * (columns - 1)).alias("dof"),
        F.sqrt(divide(F.greatest(chi2, F.lit(0.0)), F.col("n") * smaller)).alias("cramers_v"),
    )


def stability_index(base: DataFrame, current: DataFrame, column: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, n, psi): drift of ``current`` against ``base`` over the base's quantile bins.

    Sum of (q - p) ln(q / p) with shares floored at ``SHARE_FLOOR``. The bin edges and base shares are a
    few numbers and become literals; each side is one aggregate per bin.
    """
    edges = fit_bins(base, column, n, "quantile")
    return stability_against(current, base_shares(base, column, edges), column, edges, by)


def base_shares(base: DataFrame, column: str, edges: Sequence[float]) -> list[float]:
    """Share of the base's rows in each bin."""
    bins = max(len(edges) - 1, 1)
    rows = (
        apply_bins(base.where(present(F.col(column).cast("double"))), column, edges, "_bin")
        .groupBy("_bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts = {r["_bin"]: r["n"] for r in rows}
    whole = sum(counts.values())
    return [counts.get(i, 0) / whole if whole else 0.0 for i in range(bins)]


def stability_against(
    current: DataFrame, shares: Sequence[float], column: str, edges: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Drift of ``current`` per ``by`` group against known bin shares."""
    marked = apply_bins(current.where(present(F.col(column).cast("double"))), column, edges, "_bin")
    counts = marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("_bin") == i, 1)).alias(f"_n{i}") for i in range(len(shares))],
    )
    return counts.where("n > 0").select(*by, "n", stability_of([F.col(f"_n{i}") for i in range(len(shares))], F.col("n"), shares).alias("psi"))


def stability_of(counts, total, shares):
    """The index as an expression over bin counts, their total and the base shares."""
    terms = F.lit(0.0)
    for count, share in zip(counts, shares):
        p = F.lit(max(share, SHARE_FLOOR))
        q = F.greatest(count / total, F.lit(SHARE_FLOOR))
        terms = terms + (q - p) * F.log(q / p)
    return terms
