"""Best single splits, and MLlib's trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import nan_as_null
from marlstone.operators.blocks import add_blocks, block_edges, running_totals


def best_split(train: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """Per feature the threshold with the lowest weighted Gini impurity; ties to the smaller threshold.

    Rows (feature, threshold, n_left, n_right, gini): left is ``value <= threshold``. Rows are combined per
    (feature, value) and their totals run block by block, so a feature with a value per row is
    spread over many tasks. A feature with a single value has no split and no row.
    """
    known = train.where(F.col(y).isNotNull())
    marks = [f"_block_{i}" for i in range(len(features))]
    numbers = known.select(F.col(y).cast("bigint").alias("_y"), *[nan_as_null(c).alias(c) for c in features])
    wide = add_blocks(numbers, features, block_edges(known, features), marks)
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(m).alias("block")) for c, m in zip(features, marks)]
    )
    values = (
        wide.select("_y", F.explode(cells).alias("c"))
        .select("_y", "c.*")
        .where("value is not null")
        .groupBy("feature", "block", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"))
    )
    placed = running_totals(values, ["value"], ["n", "pos"], "block", by=["feature"])
    left_n, left_pos = F.col("n_before") + F.col("n"), F.col("pos_before") + F.col("pos")

    def impurity(pos, n):
        share = pos / n
        return n * 2.0 * share * (1 - share)

    sides = placed.select("feature", "value", left_n.alias("n_left"), left_pos.alias("p"), F.col("n_all").alias("n"), F.col("pos_all").alias("all_p"))
    splits = sides.where("n_left < n").select(
        "feature",
        F.col("value").alias("threshold"),
        "n_left",
        (F.col("n") - F.col("n_left")).alias("n_right"),
        (
            (impurity(F.col("p"), F.col("n_left")) + impurity(F.col("all_p") - F.col("p"), F.col("n") - F.col("n_left")))
            / F.col("n")
        ).alias("gini"),
    )
    best = splits.groupBy("feature").agg(
        F.min(F.struct("gini", "threshold", "n_left", "n_right")).alias("b")
    )
    return best.select("feature", "b.threshold", "b.n_left", "b.n_right", "b.gini")


def fit_tree(train: DataFrame, features: Sequence[str], y: str, kind: str = "tree", seed: int = 7, **options) -> PipelineModel:
    """MLlib 'tree', 'forest' or 'boosted' for classes; continuous columns are binned by MLlib."""
    models = {"tree": DecisionTreeClassifier, "forest": RandomForestClassifier, "boosted": GBTClassifier}
    if kind not in models:
        raise ValueError(f"unknown kind {kind!r}")
    data = train.select(*features, F.col(y).cast("double").alias("label")).dropna().persist()
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        models[kind](seed=seed, **options),
    ]
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()
