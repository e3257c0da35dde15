"""Outside models: the file's numbers give the scores, loaded once per worker."""

import math
import os

import numpy as np
import pytest

from marlstone.models.outside import load_layers, save_layers, score_outside
from marlstone.plans.registry import load_all

LAYERS = [
    ([[1.0, -2.0, 0.5], [0.25, 1.0, -1.0]], [0.1, 0.2, -0.3], "relu"),
    ([[2.0], [-1.0], [0.5]], [0.05], "sigmoid"),
]


def plain(x, y):
    hidden = [max(0.0, x * w + y * v + b) for w, v, b in zip(LAYERS[0][0][0], LAYERS[0][0][1], LAYERS[0][1])]
    return 1 / (1 + math.exp(-(sum(h * w[0] for h, w in zip(hidden, LAYERS[1][0])) + 0.05)))


def test_scores_equal_the_formula_and_every_row_stays(spark):
    rows = [(i, (i - 50) / 7, (i * 13 % 29) / 5) for i in range(200)] + [(900, None, 1.0), (901, math.nan, 1.0), (902, 1.0, None)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double").repartition(5)
    path = save_layers(spark, LAYERS)
    found = {r.id: r.score for r in score_outside(df, path, ["x", "y"], ["id"], batch_rows=7).collect()}
    assert len(found) == 203 and found[900] is found[901] is found[902] is None
    assert all(math.isclose(found[i], plain(x, y), rel_tol=1e-12) for i, x, y in rows if i < 900)
    assert score_outside(df.limit(0), path, ["x", "y"], ["id"]).collect() == []


def test_far_inputs_do_not_overflow(spark, tmp_path):
    path = save_layers(spark, [([[1.0]], [0.0], "sigmoid")])
    df = spark.createDataFrame([(-1e6,), (0.0,), (1e6,)], "x double")
    assert [r.score for r in score_outside(df, path, ["x"], ["x"]).orderBy("x").collect()] == [0.0, 0.5, 1.0]


def test_the_file_is_in_the_shared_folder_and_loaded_once_per_worker(spark, tmp_path):
    path = save_layers(spark, [([[1.0]], [0.0], "identity")])
    assert path.startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))
    note = str(tmp_path / "loads")

    def noting(name):
        with open(note, "a") as out:
            out.write(f"{os.getpid()}\n")
        return load_layers(name)

    df = spark.range(2000).selectExpr("id", "cast(id as double) as x").repartition(4)
    found = score_outside(df, path, ["x"], ["id"], load=noting, batch_rows=50).collect()
    assert all(r.score == r.id for r in found)
    loads = open(note).read().split()
    # Forty batches, but one load for each worker at work.
    assert 1 <= len(loads) <= 4


def test_unknown_steps_are_an_error(spark):
    with pytest.raises(ValueError, match="unknown step"):
        save_layers(spark, [([[1.0]], [0.0], "step")])


def test_the_registered_model_scores_every_line(spark):
    found = load_all()["outside_scores_lineitem"].run(spark, "/root/testdata/sf0.001")
    scores = np.array([r.score for r in found.select("score").collect()])
    assert len(scores) == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() and 0 < scores.min() < scores.max() < 1
