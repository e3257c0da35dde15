"""Linear and logistic fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import join_small, nan_as_null


def fit_line(train: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group: slope, intercept, R2 and rows, in one aggregate."""
    data = train.select(*by, nan_as_null(x).alias("_x"), nan_as_null(y).alias("_y")).where("_x is not null and _y is not null")
    return data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.regr_r2("_y", "_x").alias("r2"),
    )


def apply_line(df: DataFrame, lines: DataFrame, x: str, by: Sequence[str] = (), out: str = "pred") -> DataFrame:
    """Add the line's value; rows of a group without a line get null."""
    if not by:
        line = lines.first()
        slope, intercept = F.lit(line["slope"]).cast("double"), F.lit(line["intercept"]).cast("double")
        return df.withColumn(out, intercept + slope * F.col(x))
    named = lines.select(*by, F.col("slope").alias("_slope"), F.col("intercept").alias("_intercept"))
    joined = join_small(df, named, by)
    return joined.withColumn(out, F.col("_intercept") + F.col("_slope") * F.col(x)).drop("_slope", "_intercept")


def fit_linear(train: DataFrame, features: Sequence[str], y: str, penalty: float = 0.0) -> PipelineModel:
    """Least squares on several columns by the normal equations: one pass, one small matrix to the driver."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        LinearRegression(labelCol=y, regParam=penalty, solver="normal"),
    ]
    return Pipeline(stages=stages).fit(train.select(*features, y).dropna())


def fit_logistic(
    train: DataFrame, features: Sequence[str] | str, y: str, penalty: float = 0.0, rounds: int = 50
) -> PipelineModel:
    """Logistic regression on number columns, or on one vector column given by name."""
    if isinstance(features, str):
        model = LogisticRegression(featuresCol=features, labelCol=y, regParam=penalty, maxIter=rounds)
        return Pipeline(stages=[model]).fit(train)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        LogisticRegression(labelCol=y, regParam=penalty, maxIter=rounds),
    ]
    data = train.select(*features, y).dropna().persist()  # read once per round otherwise
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Weight per column, and the intercept under ``(intercept)``."""
    last = model.stages[-1]
    return {**dict(zip(features, last.coefficients.toArray().tolist())), "(intercept)": float(last.intercept)}
