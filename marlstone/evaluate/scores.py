"""Tables for scores of a two-class target. ``y`` is 0 or 1, and a larger score means class 1.

Rows with a null y, or with a null or NaN score, cannot be placed and are left out. Curves first combine rows
per distinct score and then run their totals block by block, so neither one popular score nor
a large number of scores lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import KEY_NUMBER_BITS, divide, key_number, present
from marlstone.operators.blocks import add_blocks, block_edges, running_totals, value_totals

LOG_CLIP = 1e-15
TIE_BITS = 16


def _scored(df, y, score, by=()):
    known = df.where(F.col(y).isNotNull() & present(F.col(score).cast("double")))
    return known.select(*by, F.col(y).cast("bigint").alias("y"), F.col(score).cast("double").alias("score"))


def _counts(df, y, score, by, descending):
    return value_totals(
        _scored(df, y, score, by),
        "score",
        {"pos": F.sum("y"), "neg": F.count(F.lit(1)) - F.sum("y")},
        by,
        descending,
    )


def auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties counting one half; null when a class is missing."""
    counts = _counts(df, y, score, by, descending=False)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    # Pairs won less pairs lost. Both totals are used on both sides of the block join, which lets Spark
    # read and combine the scores once for the two.
    ahead = F.sum(pos * F.col("neg_before") - neg * F.col("pos_before"))
    return counts.groupBy(*by).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
        (divide(ahead, F.sum(pos) * F.sum(neg)) / 2 + 0.5).alias("auc"),
    )


def roc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score taken as threshold (score >= threshold is called positive)."""
    return _curve(df, y, score, by).select(
        *by,
        "threshold",
        "tp",
        "fp",
        divide(F.col("tp"), F.col("all_pos")).alias("tpr"),
        divide(F.col("fp"), F.col("all_neg")).alias("fpr"),
    )


def pr_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score taken as threshold, with precision and recall."""
    return _curve(df, y, score, by).select(
        *by,
        "threshold",
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))).alias("precision"),
        divide(F.col("tp"), F.col("all_pos")).alias("recall"),
    )


def _curve(df, y, score, by):
    return _counts(df, y, score, by, descending=True).select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("pos") + F.col("pos_before")).alias("tp"),
        (F.col("neg") + F.col("neg_before")).alias("fp"),
        F.col("pos_all").alias("all_pos"),
        F.col("neg_all").alias("all_neg"),
    )


def average_precision(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Step sum of precision over recall, without interpolation; null without positives."""
    counts = _counts(df, y, score, by, descending=True)
    tp, fp = F.col("pos") + F.col("pos_before"), F.col("neg") + F.col("neg_before")
    gained = F.sum(F.col("pos") * (tp.cast("double") / (tp + fp)))
    return counts.groupBy(*by).agg(divide(gained, F.sum("pos")).alias("average_precision"))


def probability_report(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, base rate, mean score, log loss and Brier score in one aggregate; scores are probabilities."""
    p = F.least(F.greatest(F.col("score"), F.lit(LOG_CLIP)), F.lit(1 - LOG_CLIP))
    loss = -F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p))
    miss = F.col("score") - F.col("y")
    return (
        _scored(df, y, score, by)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("y").alias("base_rate"),
            F.avg("score").alias("mean_score"),
            F.avg(loss).alias("log_loss"),
            F.avg(miss * miss).alias("brier"),
        )
    )


def calibration(df: DataFrame, y: str, score: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Rows (bin, n, mean_score, positive_rate, gap) over equal-width bins of [0, 1]."""
    place = F.least(F.greatest(F.floor(F.col("score") * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        _scored(df, y, score, by)
        .groupBy(*by, place.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("score").alias("mean_score"),
            F.avg("y").alias("positive_rate"),
            (F.avg("score") - F.avg("y")).alias("gap"),
        )
    )


def threshold_report(df: DataFrame, y: str, score: str, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at given thresholds, all in one aggregate."""
    data = _scored(df, y, score, by)
    cells = []
    for i, limit in enumerate(thresholds):
        called = F.col("score") >= F.lit(float(limit))
        cells += [F.count(F.when(called, 1)).alias(f"called_{i}"), F.count(F.when(called & (F.col("y") == 1), 1)).alias(f"tp_{i}")]
    sums = data.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"), *cells)
    rows = F.array(
        *[
            F.struct(F.lit(float(limit)).alias("threshold"), F.col(f"called_{i}").alias("called"), F.col(f"tp_{i}").alias("tp"))
            for i, limit in enumerate(thresholds)
        ]
    )
    zero = F.lit(0.0)
    return sums.select(*by, "n", "pos", F.explode(rows).alias("r")).select(
        *by,
        "r.*",
        divide(F.col("r.tp"), F.col("r.called"), zero).alias("precision"),
        divide(F.col("r.tp"), F.col("pos"), zero).alias("recall"),
        divide(F.col("r.called") - F.col("r.tp"), F.col("n") - F.col("pos"), zero).alias("fpr"),
    )


def lift(df: DataFrame, key: str, y: str, score: str, bands: int = 10) -> DataFrame:
    """Rows, positives, rate and lift per score band, the highest scores in band 1.

    Bands hold equal numbers of rows. Tied rows are put in the order of their key number (0 for a null key), then key. Rows are
    counted per (score, leading bits of the key number); a count that lies inside one band is
    finished, and only the few that cross a band's end have their rows put in order.
    """
    known = df.where(F.col(y).isNotNull() & present(F.col(score).cast("double")))
    rows = known.select(
        F.col(key).alias("key"), F.col(y).cast("bigint").alias("y"), F.col(score).cast("double").alias("score")
    ).withColumn("number", F.coalesce(key_number("key"), F.lit(0)))
    rows = rows.withColumn("tie", F.shiftright("number", KEY_NUMBER_BITS - TIE_BITS))
    counts = rows.groupBy("score", "tie").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    edges = block_edges(known, [score])
    placed = running_totals(
        add_blocks(counts, ["score"], edges, ["_block"]), ["score", "tie"], ["n", "pos"], "_block", descending=True
    )

    def band(place):
        return (F.floor(place * F.lit(bands) / F.col("n_all")) + 1).cast("int")

    whole = ["n_all", "pos_all"]
    first, last = band(F.col("n_before")), band(F.col("n_before") + F.col("n") - 1)
    inside = placed.where(first == last).select(first.alias("band"), "n", "pos", *whole)
    crossing = placed.where(first != last).select("score", "tie", "n_before", *whole)
    order = Window.partitionBy("score", "tie").orderBy("number", "key")
    split = (
        rows.join(F.broadcast(crossing), ["score", "tie"])  # fewer rows than bands
        .withColumn("place", F.col("n_before") + F.row_number().over(order) - 1)
        .select(band(F.col("place")).alias("band"), F.lit(1).cast("bigint").alias("n"), F.col("y").alias("pos"), *whole)
    )
    rate = F.col("positives") / F.col("n")
    return (
        inside.unionByName(split)
        .groupBy("band")
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("positives"), (F.max("pos_all") / F.max("n_all")).alias("base_rate"))
        .select("band", "n", "positives", rate.alias("rate"), divide(rate, F.col("base_rate")).alias("lift"))
    )
