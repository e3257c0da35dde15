"""Tables that a job writes to the shared folder and reads again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.session import shared_dir, ship_package


#: Spark's own setting: shuffle files go when the execution that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run in here go when it has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written as Parquet below the session's shared folder and read back.

    What follows starts from the written files: nothing is computed twice, a lost executor costs only the
    tasks that ran on it, and the planner knows the table's size when it chooses how to join. The shuffle files that went into the
    table are of no use from then on and are removed, so a job of many steps holds those of one step at a time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Delete tables given back by ``keep``; nothing that is still to be computed may read them."""
    for df in kept:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_label(row_id: str | Column, text: Column) -> Column:
    """A join key for one row: its id (null allowed) and a hash of its text, as a struct that is never null.

    Rows with the same label hold the same id and text and may be treated alike; the hash only tells apart
    rows that share an id, it is never taken as proof that texts are equal.
    """
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.struct(row_id.isNull().alias("no_id"), row_id.alias("id"), F.xxhash64(text).alias("mark"))


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package's code at hand on every worker."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_pandas(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInPandas`` with this package's code at hand on every worker."""
    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)
