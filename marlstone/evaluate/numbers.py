"""Tables for predicted numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import divide, join_on, nan_as_null
from marlstone.operators.quantiles import quantiles


def regression_report(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, MAE, RMSE, bias, R2 and median absolute error, per group if asked.

    Everything but the median comes from one aggregate. R2 is null where y does not vary. Rows without y or
    prediction are left out.
    """
    data = df.select(*by, nan_as_null(y).alias("_y"), nan_as_null(pred).alias("_p")).where("_y is not null and _p is not null")
    error = F.col("_p") - F.col("_y")
    data = data.withColumn("_error", F.abs(error))
    spread = F.var_pop("_y") * F.count(F.lit(1))
    sums = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_error").alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("bias"),
        (1 - divide(F.sum(error * error), spread)).alias("r2"),
    )
    middle = quantiles(data, ["_error"], [0.5], by)
    if by:
        return join_on(sums, middle.select(*by, F.col("value").alias("median_ae")), by, "left")
    found = middle.first()
    return sums.withColumn("median_ae", F.lit(found["value"] if found else None).cast("double"))
