"""Reading input tables and writing feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """One parquet table of ``folder``; ``columns`` names what the scan has to read."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table that was just read out over the cores, if it lies in fewer pieces than there are cores.

    For work that is heavy per row. A table of many files is given back as it is, so at scale this costs
    nothing; a single small file would keep one core busy. With keys, rows are dealt out by key.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream; the schema is taken from the files at hand."""
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The stream source takes a single file only where the path is a pattern.
    return reader.parquet(f"{folder}/{name}[.]parquet")


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write a feature table as parquet, clustered by its partition columns.

    Rows are first clustered by the partition columns so that each folder gets few files;
    a folder that holds far more rows than others is split by adaptive execution.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Write a feature table bucketed and sorted by its key, so that later joins on the key need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
