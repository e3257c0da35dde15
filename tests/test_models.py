import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from marlstone.models.bayes import fit_bayes, score_bayes
from marlstone.models.linear import apply_line, coefficients, fit_line, fit_linear, fit_logistic
from marlstone.models.scoring import batch_score, cross_validate
from marlstone.models.trees import best_split, fit_tree
from marlstone.models.vectors import (
    apply_kmeans,
    assign_nearest,
    assign_nearest_table,
    fit_centroid_table,
    fit_centroids,
    fit_kmeans,
    kmeans_step,
    nearest_neighbours,
    pca,
)

from .conftest import close, rows_of


def test_line_per_group(spark):
    rows = [("a", float(x), 2.0 * x + 1) for x in range(5)] + [("b", float(x), -1.0 * x) for x in range(4)] + [("a", None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r["g"]: r for r in fit_line(df, "x", "y", ["g"]).collect()}
    assert close(got["a"]["slope"], 2.0) and close(got["a"]["intercept"], 1.0) and got["a"]["n"] == 5 and close(got["b"]["r2"], 1.0)
    applied = apply_line(df, fit_line(df, "x", "y", ["g"]), "x", ["g"]).where("x is not null")
    assert applied.where("abs(pred - y) > 1e-9").count() == 0
    assert apply_line(df.where("g = 'b'"), fit_line(df.where("g = 'b'"), "x", "y"), "x").where("abs(pred - y) > 1e-9").count() == 0


def test_linear_finds_the_weights(spark):
    rng = random.Random(4)
    rows = [(a, b, 3 * a - 2 * b + 5) for a, b in [(rng.random(), rng.random()) for _ in range(60)]]
    weights = coefficients(fit_linear(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y"), ["a", "b"])
    assert all(close(weights[k], v, 6) for k, v in {"a": 3, "b": -2, "(intercept)": 5}.items())


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(9)
    rows = [(i, x, z, int(x + 0.2 * z > 0.6)) for i, (x, z) in enumerate((rng.random(), rng.random()) for _ in range(300))]
    return spark.createDataFrame(rows, "id bigint, x double, z double, y int")


def test_logistic_and_trees_learn_a_clear_rule(separable):
    for model in (
        fit_logistic(separable, ["x", "z"], "y"),
        fit_tree(separable, ["x", "z"], "y", "tree"),
        fit_tree(separable, ["x", "z"], "y", "forest", numTrees=5),
        fit_tree(separable, ["x", "z"], "y", "boosted", maxIter=3),
    ):
        scored = batch_score(separable, model, ["id", "y"])
        assert scored.columns == ["id", "y", "score", "pred"] and scored.count() == 300
        assert scored.where("pred = y").count() > 270
    with pytest.raises(ValueError):
        fit_tree(separable, ["x"], "y", "other")


def test_cross_validation_prefers_the_small_penalty(separable):
    data = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(separable).withColumn("label", F.col("y").cast("double"))
    estimator = LogisticRegression(maxIter=20)
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.001, 50.0]).baseOn({estimator.elasticNetParam: 1.0}).build()
    model, areas = cross_validate(data, estimator, grid, "id")
    assert len(areas) == 2 and areas[0] > 0.98 > areas[1] and model.coefficients[0] > 0


def test_bayes_against_brute_force(spark):
    texts = [(1, "good good fine", "p"), (2, "bad awful bad", "n"), (3, "good bad", "p"), (4, "meh", None)]
    train = spark.createDataFrame(texts, "id int, t string, y string")
    model = fit_bayes(train, "id", "t", "y")
    assert model.classes == ("n", "p") and close(model.priors[0], math.log(1 / 3))
    # 4 known words; 3 words in class n, 5 in class p.
    words = {r["term"]: (r["ll_0"], r["ll_1"]) for r in model.words.collect()}
    assert set(words) == {"good", "fine", "bad", "awful"}
    assert close(words["bad"][0], math.log(3 / 7)) and close(words["bad"][1], math.log(2 / 9))
    test = spark.createDataFrame([(7, "bad bad unseen"), (8, ""), (9, None), (10, "Good FINE")], "id int, t string")
    got = {r["id"]: r for r in score_bayes(test, model, "id", "t").collect()}
    assert len(got) == 4
    assert close(got[7]["log_0"], math.log(1 / 3) + 2 * math.log(3 / 7)) and got[7]["pred"] == "n"
    assert close(got[8]["log_odds"], math.log(2)) and got[8]["pred"] == got[9]["pred"] == got[10]["pred"] == "p"


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(120, 6)).astype("float32")
    vectors[40:80] = vectors[0]  # a third of the rows are copies
    vectors[100] = 0.0
    rows = [(i, [float(x) for x in v], int(i % 4)) for i, v in enumerate(vectors)]
    return vectors, spark.createDataFrame(rows, "id bigint, v array<float>, label int").repartition(5)


def brute_neighbours(vectors, k):
    v = vectors.astype("float64")
    size = np.sqrt((v**2).sum(axis=1, keepdims=True))
    unit = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
    out = {}
    for i in range(len(v)):
        similarity = unit @ unit[i]
        order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-round(similarity[j], 12), j))
        out[i] = [(j, similarity[j]) for j in order[:k]]
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_numbers": 0, "block_rows": 25}, {"broadcast_numbers": 0}])
def test_neighbours(points, options):
    vectors, df = points
    expected = brute_neighbours(vectors, 5)
    found = nearest_neighbours(df, df, "id", "v", 5, **options).collect()
    assert len(found) == 5 * len(vectors)
    for i in range(len(vectors)):
        mine = sorted((r["place"], r["base_id"], r["similarity"]) for r in found if r["query_id"] == i)
        assert [p for p, *_ in mine] == [1, 2, 3, 4, 5]
        assert [base for _, base, _ in mine] == [base for base, _ in expected[i]]
        assert all(close(s, want) for (_, _, s), (_, want) in zip(mine, expected[i]))


def test_neighbours_when_there_are_few(spark, points):
    _, df = points
    few = df.where("id < 3")
    assert nearest_neighbours(few, few, "id", "v", 5).count() == 6
    assert nearest_neighbours(few.limit(0), few, "id", "v", 5).count() == 0
    assert nearest_neighbours(few, few.limit(0), "id", "v", 5).count() == 0
    assert nearest_neighbours(few, few.limit(0), "id", "v", 5, broadcast_numbers=0).count() == 0


def test_centroids_and_assignment(points):
    vectors, df = points
    centroids = fit_centroids(df, "v", "label")
    means = np.stack([vectors[np.arange(120) % 4 == c].astype("float64").mean(axis=0) for c in range(4)])
    assert [label for label, _ in centroids] == [0, 1, 2, 3]
    assert np.allclose([m for _, m in centroids], means)
    gaps = ((vectors[:, None, :].astype("float64") - means[None]) ** 2).sum(axis=2)
    for r in assign_nearest(df, centroids, "v").collect():
        assert r["pred"] == gaps[r["id"]].argmin() and close(r["pred_distance"], gaps[r["id"]].min())


def test_assignment_ties_and_missing_vectors(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, None), (3, [9.0])], "id int, v array<double>")
    got = {r["id"]: (r["pred"], r["pred_distance"]) for r in assign_nearest(df, [("a", [-1.0]), ("b", [1.0])], "v").collect()}
    assert got == {1: ("a", 1.0), 2: (None, None), 3: ("b", 64.0)}


def test_kmeans_cost_does_not_rise(points):
    _, df = points
    centroids = fit_centroids(df, "v", "label")
    costs = []
    for _ in range(4):
        step = kmeans_step(df, centroids, "v").collect()
        assert sum(r["n"] for r in step) == 120
        costs.append(sum(r["cost"] for r in step))
        centroids = sorted((r["cluster"], list(r["mean"])) for r in step)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    marked = apply_kmeans(df, fit_kmeans(df, "v", 3), "v")
    assert marked.count() == 120 and marked.select("cluster").distinct().count() <= 3


def test_projection_keeps_the_main_direction(spark):
    rows = [(i, [float(i), 2.0 * i + 0.01 * (i % 3), 0.0]) for i in range(20)]
    got = {r["id"]: r["projection"][0] for r in pca(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", 1).collect()}
    assert all(got[i] < got[i + 1] for i in range(19))  # the largest loading is positive


def test_best_split_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        x = 1.0 if i % 3 == 0 else round(rng.random() * 3, 1)
        rows.append((x, round(rng.random(), 3), 5.0, int(rng.random() < (0.8 if x > 1.5 else 0.3))))
    rows += [(None, 0.5, 5.0, 1), (0.1, 0.5, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    got = {r["feature"]: r for r in best_split(df, ["a", "b", "c"], "y").collect()}
    assert set(got) == {"a", "b"}
    for place, name in enumerate("ab"):
        known = [(r[place], r[3]) for r in rows if r[place] is not None and r[3] is not None]
        best = None
        for limit in sorted({v for v, _ in known})[:-1]:
            sides = [[y for v, y in known if v <= limit], [y for v, y in known if v > limit]]
            gini = sum(len(s) * 2 * np.mean(s) * (1 - np.mean(s)) for s in sides) / len(known)
            if best is None or gini < best[0] - 1e-12:
                best = (gini, limit, len(sides[0]), len(sides[1]))
        r = got[name]
        assert close(r["gini"], best[0]) and (r["threshold"], r["n_left"], r["n_right"]) == best[1:]


def test_line_without_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, y double")
    line = fit_line(df, "x", "y").first()
    assert (line["n"], line["slope"]) == (2, None)
    assert fit_line(df.limit(0), "x", "y").first()["slope"] is None
    flat = fit_line(df.select("x", F.lit(3.0).alias("y")).withColumn("x", F.monotonically_increasing_id().cast("double")), "x", "y").first()
    assert flat["slope"] == 0.0 and flat["intercept"] == 3.0


def test_scoring_keeps_rows_with_gaps(spark):
    rows = [(i, float(i), float(i % 7), float(i % 2)) for i in range(40)] + [(40, None, 1.0, 1.0), (41, float("nan"), 1.0, 0.0), (42, 3.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    for model in (fit_linear(df, ["a", "b"], "y"), fit_logistic(df, ["a", "b"], "y"), fit_tree(df, ["a", "b"], "y", maxDepth=2)):
        found = {r.id: r for r in batch_score(df, model, ["id"]).collect()}
        assert len(found) == 43 and found[42].pred is not None
        assert all((found[i].pred is None) == (i in (40, 41)) for i in found)
        assert all(found[40][c] is None for c in found[40].asDict() if c != "id")


@pytest.mark.parametrize("options", [{}, {"block_numbers": 10, "part_rows": 9}])
def test_centroid_tables_give_the_same_as_lists(points, options):
    _, df = points
    table = fit_centroid_table(df, "v", "label")
    found = assign_nearest_table(df, table, "id", "v", **options)
    plain = assign_nearest(df, fit_centroids(df, "v", "label"), "v")
    assert rows_of(found, "id", "pred") == rows_of(plain, "id", "pred")
    assert all(close(a[1], b[1]) for a, b in zip(rows_of(found, "id", "pred_distance"), rows_of(plain, "id", "pred_distance")))


def test_centroid_table_ties_missing_vectors_and_no_centroids(spark):
    df = spark.createDataFrame([(1, [0.0], "x"), (2, None, "y"), (3, [9.0], "z")], "id int, v array<double>, block string")
    table = spark.createDataFrame([("b", [1.0]), ("a", [-1.0]), ("c", [1.0])], "label string, mean array<double>")
    got = {r["id"]: (r["pred"], r["pred_distance"], r["block"]) for r in assign_nearest_table(df, table, "id", "v", block_numbers=1).collect()}
    assert got == {1: ("a", 1.0, "x"), 2: (None, None, "y"), 3: ("b", 64.0, "z")}
    assert {r["pred"] for r in assign_nearest_table(df, table.limit(0), "id", "v").collect()} == {None}
