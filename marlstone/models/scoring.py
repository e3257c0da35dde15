"""Applying fitted models and choosing between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marlstone.functions.columns import present
from marlstone.operators.splits import kfold


def batch_score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """The kept columns, ``pred`` and, for classifiers, ``score``, the probability of class 1.

    Every row stays; where a number the model needs is null or NaN, ``pred`` and ``score`` are null. A lazy column
    computation: no shuffle, and a stream works as well as a table.
    """
    needed = [c for stage in model.stages if isinstance(stage, VectorAssembler) for c in stage.getInputCols() if c in df.columns]
    numbers = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    whole = F.lit(True)
    for c in needed:
        whole = whole & (present(F.col(c).cast("double")) if c in numbers else F.col(c).isNotNull())
    scored = model.transform(df.withColumn("_whole", whole))
    columns = [F.col(c) for c in keep]
    if "probability" in scored.columns:
        columns.append(F.when(F.col("_whole"), F.element_at(vector_to_array("probability"), 2)).alias("score"))
    return scored.select(*columns, F.when(F.col("_whole"), F.col("prediction")).alias("pred"))


def cross_validate(
    train: DataFrame, estimator: Estimator, grid: list, key: str, folds: int = 3, label: str = "label", jobs: int = 2
):
    """Area under the ROC curve per grid point over folds that depend on the key only.

    Gives (model refitted on all rows, list of mean areas in the order of the grid).
    """
    data = kfold(train, key, folds, "_fold").persist()
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
        numFolds=folds,
        foldCol="_fold",
        parallelism=jobs,
    )
    try:
        fitted = search.fit(data)
    finally:
        data.unpersist()
    return fitted.bestModel, [float(m) for m in fitted.avgMetrics]
