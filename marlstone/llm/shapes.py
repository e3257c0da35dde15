"""Text statistics of whole columns, computed chunk by chunk in arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import Shape, chunks, flatten, shape
from marlstone.llm.storage import map_arrow


def with_measures(df: DataFrame, name: str, fields: dict[str, T.DataType], measure: Callable, text_col: str = "text") -> DataFrame:
    """All columns and a struct ``name`` (an older column of that name is replaced).

    ``measure`` turns the texts of a chunk into one array per field; null text is empty.
    """
    df = df.drop(name)
    names = df.columns
    spare = "_text"
    while spare in names:
        spare += "_"
    kind = T.StructType([T.StructField(f, k) for f, k in fields.items()])
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind), T.StructField(spare, T.StringType())])
    rows = df.select("*", F.lit(None).cast(kind).alias(name), F.col(text_col).cast("string").alias(spare))
    arrow = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names) + 1).to_pylist()
            for low, high in chunks(texts):
                part = batch.slice(low, high - low)
                values = [pa.array(v, arrow[k]) for v, k in zip(measure(texts[low:high]), fields.values(), strict=True)]
                found = pa.StructArray.from_arrays(values, names=list(fields))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], found, pa.nulls(high - low, pa.string())], names=schema.names)

    return map_arrow(rows, run, schema).drop(spare)


SHAPE_FIELDS = dict.fromkeys(Shape._fields, T.LongType())


def measure_shape(texts: list[str | None]) -> Shape:
    return shape(flatten(texts))


def with_shape(df: DataFrame, name: str = "shape", text_col: str = "text") -> DataFrame:
    """All columns and a struct of the counts of ``batches.Shape``."""
    return with_measures(df, name, SHAPE_FIELDS, measure_shape, text_col)


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Quotients, 0 where the divisor is 0."""
    return part / np.maximum(whole, 1)


