"""Tables for predicted classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import divide, join_on

MAX_GRID_CLASSES = 1_000


def class_counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Rows (y, pred, n) for the pairs that occur; everything else here starts from it."""
    return df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Rows (y, pred, n) for every pair of classes, with zeros.

    The grid is built from the class list, which may hold up to ``MAX_GRID_CLASSES``; ``class_counts`` is
    the form for more. Rows without y or prediction are left out.
    """
    counts = class_counts(df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()), y, pred).persist()
    classes = counts.select(F.explode(F.array("y", "pred")).alias("y")).distinct()
    found = [r["y"] for r in classes.limit(MAX_GRID_CLASSES + 1).collect()]
    if len(found) > MAX_GRID_CLASSES:
        counts.unpersist()
        raise ValueError(f"more than {MAX_GRID_CLASSES} classes; use class_counts")
    kind = dict(counts.dtypes)["y"]
    every = F.array(*[F.lit(c) for c in found]).cast(f"array<{kind}>")
    grid = classes.select("y", F.explode(every).alias("pred"))
    return join_on(grid, counts, ["y", "pred"], "left").select("y", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then the macro, micro and weighted averages.

    An empty denominator gives 0.0. Works on pair counts, so it does not care how rows are spread over
    classes.
    """
    counts = class_counts(df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()), y, pred)
    hit = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").cast("string").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("pred").cast("string").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    per_class = (
        counts.select(F.explode(sides).alias("s"))
        .select("s.*")
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    zero = F.lit(0.0)

    def f1(precision, recall):
        return divide(2 * precision * recall, precision + recall, zero)

    scored = per_class.select(
        "class",
        divide(F.col("hits"), F.col("predicted"), zero).alias("precision"),
        divide(F.col("hits"), F.col("support"), zero).alias("recall"),
        "support",
        "hits",
    ).withColumn("f1", f1(F.col("precision"), F.col("recall")))
    measures = ("precision", "recall", "f1")
    averages = scored.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[divide(F.sum(F.col(m) * F.col("support")), F.sum("support"), zero).alias(f"weighted_{m}") for m in measures],
        divide(F.sum("hits"), F.sum("support"), zero).alias("micro"),
        F.sum("support").alias("support"),
    ).where("support is not null")
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            *[F.col("micro" if name == "micro" else f"{name}_{m}").alias(m) for m in measures],
            F.col("support").alias("support"),
        )
        for name in ("macro", "micro", "weighted")
    ]
    summary = averages.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    marked = lambda part, level: part.select(F.lit(level).alias("level"), "class", *measures, "support")
    return marked(scored, "class").unionByName(marked(summary, "average"))
