"""Features, scores and drift over streams. Event time must come with a lateness bound.

Each function takes a streaming DataFrame and gives one back; ``run_to_table`` drives it over
what has arrived so far. In append mode a window or session is written once, when the watermark
has passed its end; rows older than the watermark are dropped by Spark, as in any stream with
bounded state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.columns import nan_as_null, present
from marlstone.models.scoring import batch_score
from marlstone.operators.profile import stability_of
from marlstone.operators.scale import apply_bins
from marlstone.session import shared_dir


def _timed(df: DataFrame, ts: str, late: str) -> DataFrame:
    # Watermarks need a timestamp with a zone; the session zone is UTC.
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def window_features(
    df: DataFrame, key: Sequence[str], ts: str, value: str, width: str, late: str, slide: str | None = None
) -> DataFrame:
    """Count, sum, mean, minimum and maximum per key and tumbling or sliding window."""
    amount = nan_as_null(value)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    sums = _timed(df, ts, late).groupBy(window, *key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("total"),
        F.avg(amount).alias("mean"),
        F.min(amount).alias("smallest"),
        F.max(amount).alias("largest"),
    )
    return sums.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *key,
        "n",
        "total",
        "mean",
        "smallest",
        "largest",
    )


def session_features(df: DataFrame, key: Sequence[str], ts: str, value: str, gap: str, late: str) -> DataFrame:
    """Start, last event, events and sum per key and session; a session ends with a pause above the gap."""
    sums = _timed(df, ts, late).groupBy(F.session_window(ts, gap), *key).agg(
        F.max(ts).alias("last"), F.count(F.lit(1)).alias("events"), F.sum(nan_as_null(value)).alias("total")
    )
    return sums.select(
        *key,
        F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
        F.col("last").cast("timestamp_ntz").alias("session_end"),
        "events",
        "total",
    )


def drift_features(
    df: DataFrame, ts: str, value: str, width: str, late: str, edges: Sequence[float], shares: Sequence[float]
) -> DataFrame:
    """Rows (window_start, window_end, n, psi): drift of each window against known bin shares.

    The bins are counted next to each other, so a window is one state row per task and the index is a
    projection of the closed window.
    """
    marked = apply_bins(df.where(present(F.col(value).cast("double"))), value, edges, "_bin")
    counts = _timed(marked, ts, late).groupBy(F.window(ts, width)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("_bin") == i, 1)).alias(f"_n{i}") for i in range(len(shares))],
    )
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "n",
        stability_of([F.col(f"_n{i}") for i in range(len(shares))], F.col("n"), shares).alias("psi"),
    )


def score_stream(df: DataFrame, model_path: str, keep: Sequence[str]) -> DataFrame:
    """Score a stream with a saved model; the same columns as ``batch_score``."""
    return batch_score(df, PipelineModel.load(model_path), keep)


def run_to_table(spark: SparkSession, stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all that has arrived, append the results to parquet files and give them back as a table.

    Results and checkpoint lie in the shared folder unless told otherwise; with the same two paths a later
    call goes on where the last one stopped. The file sink commits each batch once.
    """
    path = path or shared_dir(spark, "stream-result")
    checkpoint = checkpoint or shared_dir(spark, "stream-state")
    run = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
