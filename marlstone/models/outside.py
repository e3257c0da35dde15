"""Scoring with models from outside Spark: a file of weights, loaded once per Python worker and applied batch by batch.

The file lies in the shared folder. Spark hands it to every executor (those that join later too), and ``predict_batch_udf`` keeps the loaded model for
the life of a worker. The format here is NumPy's own archive of a feed-forward network: ``w0, b0, w1, b1, ...`` and ``shapes``, the name of each layer's last
step. Other formats need a loader of their own, a function from a path to a function from a matrix of features to scores.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Callable, Sequence

import numpy as np
from pyspark import SparkFiles, cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marlstone.functions.columns import present
from marlstone.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "identity": lambda x: x,
    "relu": lambda x: np.maximum(x, 0.0),
    # Written so that no exponent overflows.
    "sigmoid": lambda x: np.where(x >= 0, 1 / (1 + np.exp(-np.abs(x))), np.exp(-np.abs(x)) / (1 + np.exp(-np.abs(x)))),
}

Layer = tuple[Sequence[Sequence[float]], Sequence[float], str]


def save_layers(spark: SparkSession, layers: Sequence[Layer]) -> str:
    """Write (weights, offsets, step) per layer to a new file of the shared folder; weights have a row per input."""
    arrays: dict[str, np.ndarray] = {"shapes": np.array([step for _, _, step in layers])}
    for i, (weights, offsets, step) in enumerate(layers):
        if step not in STEPS:
            raise ValueError(f"unknown step {step}")
        arrays[f"w{i}"], arrays[f"b{i}"] = np.array(weights, "float64"), np.array(offsets, "float64")
    held = io.BytesIO()
    np.savez(held, **arrays)
    path = f"{shared_dir(spark, 'model')}.npz"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(bytearray(held.getvalue()))
    finally:
        out.close()
    return path


def load_layers(path: str) -> Callable[[np.ndarray], np.ndarray]:
    """The network of a file as a function from rows of features to one score each."""
    with np.load(path) as told:
        layers = [(told[f"w{i}"], told[f"b{i}"], STEPS[str(step)]) for i, step in enumerate(told["shapes"])]

    def predict(features: np.ndarray) -> np.ndarray:
        found = np.asarray(features, "float64")
        for weights, offsets, step in layers:
            found = step(found @ weights + offsets)
        return found[:, 0]

    return predict


def score_outside(
    df: DataFrame, path: str, features: Sequence[str], keep: Sequence[str], out: str = "score", load=load_layers, batch_rows: int = 4_096
) -> DataFrame:
    """The kept columns and the score of a model file; null where a feature is null or NaN. Every row stays.

    A lazy column computation without a shuffle, for tables and streams.
    """
    context = df.sparkSession.sparkContext
    context.addFile(path)
    name = path.rsplit("/", 1)[-1]

    def make() -> Callable[[np.ndarray], np.ndarray]:
        return load(SparkFiles.get(name))

    predict = predict_batch_udf(make, return_type=DoubleType(), batch_size=batch_rows, input_tensor_shapes=[[len(features)]])
    numbers = [F.col(c).cast("double") for c in features]
    whole = F.lit(True)
    for number in numbers:
        whole = whole & present(number)
    # The function sees zeros in place of missing numbers; what becomes of them is not used.
    row = F.array(*[F.coalesce(F.when(present(n), n), F.lit(0.0)) for n in numbers])
    return df.select(*keep, F.when(whole, predict(row)).alias(out))
