"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Texts that pass the fixed limits give a vector of four transformed statistics. For each language and source a
minimum-covariance-determinant estimate (centre and covariance of the ``CORE`` share of texts that lies closest together)
is found by concentration steps, starting at the medians. A text is rejected when its squared Mahalanobis distance
exceeds ``CUTOFF``. A source with fewer than ``MIN_GROUP`` texts uses its language's estimate, a small language that of all texts.

Statistics are rounded to 1/1024, so equal vectors can be counted before anything is shuffled: the steps work on distinct
vectors with counts, sums are whole numbers, and the result does not depend on the partitioning. The core is
found on a grid of distances, so no group is ever sorted or gathered.

Defined cases: null text has no words and fails the fixed limits; null language or source is a group like any other; repeated
rows count as often as they occur; a table without passing texts rejects by the fixed limits alone; an empty table gives
an empty result; other columns pass through, and an older column named ``verdict`` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.shapes import with_shape
from marlstone.llm.storage import keep, map_pandas

GRID = 1024
CORE = 0.75
STEPS = 6
MIN_GROUP = 100
#: The 1 - 1e-5 quantile of chi-squared with four degrees of freedom.
CUTOFF = 28.47
#: The smallest spread believed of each statistic; without it, statistics that are 0 for most texts would reject any other value.
FLOOR = (0.06, 0.04, 0.12, 0.12)
STATS = ("x0", "x1", "x2", "x3")
PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]
BUCKETS = 32


def base_failed(shape: str = "shape") -> Column:
    """Fewer than 50 words, or more than half of them in repeated three-word windows."""
    n, repeated = F.col(f"{shape}.n_words"), F.col(f"{shape}.n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def statistics(shape: str = "shape") -> list[Column]:
    """Log mean word length, log of one plus symbols per word, share of repeated lines, share of repeated words; on the grid."""
    n = F.greatest(F.col(f"{shape}.n_words"), F.lit(1))
    values = [
        F.log(F.greatest(F.col(f"{shape}.word_chars"), F.lit(1)) / n),
        F.log1p(F.col(f"{shape}.n_symbols") / n),
        F.col(f"{shape}.n_dup_lines") / F.greatest(F.col(f"{shape}.n_lines"), F.lit(1)),
        F.col(f"{shape}.n_repeat_words") / n,
    ]
    return [F.round(v * GRID).cast("long").alias(name) for v, name in zip(values, STATS, strict=True)]


def consistency(core: float) -> float:
    """The factor that makes the covariance of the central ``core`` of normal data (four dimensions) that of all of it."""
    low, high = 0.0, 100.0
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if 1 - math.exp(-x / 2) * (1 + x / 2) < core else (low, x)
    return core / (1 - math.exp(-low / 2) * (1 + low / 2 + low * low / 8))


def estimate(n: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and inverse covariance from a core's count, sums and sums of products, on the grid's scale."""
    centre = sums / n
    spread = products / n - np.outer(centre, centre)
    spread = spread * consistency(CORE) + np.diag(np.square(np.array(FLOOR) * GRID))
    return centre, np.linalg.inv(spread)


def _estimates(cores: DataFrame) -> DataFrame:
    """Rows of ``cell, n, s0..s3, p00..p33`` to ``cell, centre, inverse`` (upper triangle)."""
    names = [f"p{i}{j}" for i, j in PAIRS]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            centres, inverses = [], []
            for row in frame[["n", "s0", "s1", "s2", "s3", *names]].to_numpy("f8"):
                products = np.zeros((4, 4))
                for (i, j), value in zip(PAIRS, row[5:], strict=True):
                    products[i, j] = products[j, i] = value
                centre, inverse = estimate(row[0], row[1:5], products)
                centres.append(centre)
                inverses.append([inverse[i, j] for i, j in PAIRS])
            yield pd.DataFrame({"level": frame.level, "lang": frame.lang, "source": frame.source, "centre": centres, "inverse": inverses})

    flat = cores.select("cell.*", "n", "s0", "s1", "s2", "s3", *names)
    kinds = {f.name: f.dataType.simpleString() for f in flat.schema if f.name in ("level", "lang", "source")}
    found = map_pandas(flat, run, ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", centre array<double>, inverse array<double>")
    return found.select(F.struct("level", "lang", "source").alias("cell"), "centre", "inverse")


def distance(centre: Column, inverse: Column) -> Column:
    """The squared Mahalanobis distance of a row's statistics."""
    off = [F.col(x) - centre[i] for i, x in enumerate(STATS)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + off[i] * off[j] * inverse[k] * (1 if i == j else 2)
    return total


def _medians(vectors: DataFrame) -> DataFrame:
    """``cell, centre``: the median of each statistic, from counts of its values."""
    long = vectors.select("cell", "n", F.posexplode(F.array(*STATS)).alias("k", "x"))
    counts = long.groupBy("cell", "k", "x").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("cell", "k").orderBy("x")
    counts = counts.withColumns({"upto": F.sum("n").over(order), "all": F.sum("n").over(Window.partitionBy("cell", "k"))})
    found = counts.where(2 * F.col("upto") >= F.col("all")).groupBy("cell", "k").agg(F.min("x").alias("x"))
    return found.groupBy("cell").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda s: s.x.cast("double")).alias("centre"))


def _concentrate(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: the estimate of the texts whose distance is within the smallest grid value that holds the core."""
    known = estimates.withColumnRenamed("cell", "_cell")
    rows = vectors.join(known, F.col("cell") == F.col("_cell"))
    bucket = F.floor(F.log2(F.lit(1.0) + distance(F.col("centre"), F.col("inverse"))) * BUCKETS).cast("long")
    weight = F.col("n")
    sums = [F.sum(weight * F.col(x)).alias(f"s{i}") for i, x in enumerate(STATS)]
    sums += [F.sum(weight * F.col(STATS[i]) * F.col(STATS[j])).alias(f"p{i}{j}") for i, j in PAIRS]
    rings = rows.withColumn("ring", bucket).groupBy("cell", "ring").agg(F.sum("n").alias("n"), *sums)
    before = F.sum("n").over(Window.partitionBy("cell").orderBy("ring")) - F.col("n")
    every = F.sum("n").over(Window.partitionBy("cell"))
    rings = rings.withColumns({"before": before, "every": every}).where(F.col("before") < CORE * F.col("every"))
    names = ["n", "s0", "s1", "s2", "s3", *(f"p{i}{j}" for i, j in PAIRS)]
    return _estimates(rings.groupBy("cell").agg(*[F.sum(c).alias(c) for c in names]))


def fit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, centre, inverse`` for every language and source with a text that passes the fixed limits.

    Without such texts there is no row.
    """
    rows = df.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    passed = with_shape(rows).where(~base_failed()).select("lang", "source", *statistics())
    vectors = keep(passed.groupBy("lang", "source", *STATS).agg(F.count(F.lit(1)).alias("n")), "rules-vectors")
    none = {c: F.lit(None).cast(vectors.schema[c].dataType) for c in ("lang", "source")}
    cell = lambda level, lang, source: F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))
    levels = [cell(0, none["lang"], none["source"]), cell(1, F.col("lang"), none["source"]), cell(2, F.col("lang"), F.col("source"))]
    spread = vectors.select("n", *STATS, F.explode(F.array(*levels)).alias("cell"))
    spread = spread.groupBy("cell", *STATS).agg(F.sum("n").alias("n"))
    sizes = spread.groupBy("cell").agg(F.sum("n").alias("size")).where((F.col("size") >= MIN_GROUP) | (F.col("cell.level") == 0))
    large = sizes.select(F.col("cell").alias("_cell"))
    spread = keep(spread.join(large, F.col("cell") == F.col("_cell")).drop("_cell"), "rules-cells")
    floors = [1 / (FLOOR[i] * GRID) ** 2 if i == j else 0.0 for i, j in PAIRS]
    estimates = _medians(spread).withColumn("inverse", F.array(*map(F.lit, floors)))
    for step in range(STEPS):
        estimates = _concentrate(spread, keep(estimates, f"rules-estimates-{step}"))
    estimates = keep(estimates, "rules-estimates")
    # Each language and source takes the most special estimate there is.
    groups = vectors.select("lang", "source").distinct()
    options = groups.select("lang", "source", F.explode(F.array(*levels)).alias("want"))
    found = options.join(estimates, F.col("want") == F.col("cell"))
    best = F.max_by(F.struct("centre", "inverse"), "cell.level").alias("best")
    return keep(found.groupBy("lang", "source").agg(best).select("lang", "source", "best.*"), "rules-groups")


def judge(
    df: DataFrame, fitted: DataFrame | None = None, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """All columns and a struct ``verdict``: the counts, ``base_failed, distance, kept``.

    ``fitted`` (from ``fit``) is a table of groups, joined to the rows as the planner sees fit from its size.
    """
    fitted = fit(df, lang_col, source_col, text_col) if fitted is None else fitted
    rows = with_shape(df, "verdict", text_col).withColumn("_failed", base_failed("verdict"))
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in df.drop("verdict").columns]).alias("row"), "verdict", "_failed", *statistics("verdict"))
    group = F.struct(F.col(f"row.`{lang_col}`").alias("lang"), F.col(f"row.`{source_col}`").alias("source"))
    known = fitted.select(F.struct("lang", "source").alias("_group"), "centre", "inverse")
    held = held.withColumn("_own", group).join(known, F.col("_own") == F.col("_group"), "left")
    far = F.when(~F.col("_failed"), distance(F.col("centre"), F.col("inverse")))
    verdict = F.struct(
        "verdict.*", F.col("_failed").alias("base_failed"), far.alias("distance"), (~F.col("_failed") & (far <= CUTOFF)).alias("kept")
    )
    return held.select("row.*", verdict.alias("verdict"))


def keep_good(df: DataFrame, **columns: str) -> DataFrame:
    """The rows whose text is kept, with the columns of ``df``."""
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{c}`") for c in ("lang", "source", "text")])
    return judge(held, **columns).where(F.coalesce("verdict.kept", F.lit(False))).select("row.*")
