import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone.operators.profile import (
    chi_square,
    correlation,
    mutual_information,
    profile,
    profile_categories,
    rank_correlation,
    stability_index,
)

from .conftest import close


def test_profile_with_gaps(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 7, None), (3.0, 7, None), (None, 7, None), (nan, 7, None), (5.0, 7, None)], "x double, k int, e double")
    got = {r["column"]: r for r in profile(df, ["x", "k", "e"], exact_distinct=True).collect()}
    x = got["x"]
    assert (x["n_rows"], x["n_null"], x["n_distinct"], x["min"], x["max"], x["mean"], x["stddev"]) == (5, 2, 3, 1.0, 5.0, 3.0, 2.0)
    assert (x["q1"], x["median"], x["q3"]) == (2.0, 3.0, 4.0)
    assert (got["k"]["stddev"], got["k"]["n_distinct"], got["k"]["median"]) == (0.0, 1, 7.0)
    assert (got["e"]["n_null"], got["e"]["mean"], got["e"]["median"]) == (5, None, None)


def test_correlation(spark):
    rng = random.Random(1)
    data = pd.DataFrame({"a": [rng.random() for _ in range(200)], "c": [1.0] * 200})
    data["b"] = data["a"] ** 3 + 0.1
    got = {(r["x"], r["y"]): r["r"] for r in correlation(spark.createDataFrame(data), ["a", "b", "c"]).collect()}
    assert close(got["a", "b"], data["a"].corr(data["b"])) and got["a", "c"] is None and got["b", "c"] is None


def test_rank_correlation_with_ties(spark):
    rng = random.Random(2)
    rows = [(1.0 if i % 3 == 0 else float(rng.randrange(20)), float(rng.randrange(10))) for i in range(500)]
    data = pd.DataFrame(rows, columns=["a", "b"])
    df = spark.createDataFrame(data).union(spark.createDataFrame([(None, 1.0), (1.0, None)], "a double, b double"))
    assert close(rank_correlation(df, "a", "b").first()["r"], data["a"].rank().corr(data["b"].rank()))
    assert close(rank_correlation(df.withColumn("b", F.col("a") * F.col("a") + 1), "a", "b").first()["r"], 1.0)
    assert rank_correlation(df.withColumn("b", F.lit(1.0)), "a", "b").first()["r"] is None


def test_association_of_independent_and_equal_columns(spark):
    df = spark.range(120).select((F.col("id") % 3).alias("a"), (F.col("id") % 4).alias("b"))
    assert close(mutual_information(df, "a", "b").first()["mutual_information"], 0.0)
    r = chi_square(df, "a", "b").first()
    assert close(r["chi2"], 0.0) and r["dof"] == 6 and close(r["cramers_v"], 0.0, 6)
    same = df.withColumn("b", F.col("a"))
    r = mutual_information(same, "a", "b").first()
    assert close(r["mutual_information"], math.log(3)) and close(r["entropy_x"], math.log(3))
    r = chi_square(same, "a", "b").first()
    assert close(r["chi2"], 240.0) and r["dof"] == 4 and close(r["cramers_v"], 1.0)


def test_association_skips_nulls_and_copes_with_nothing(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b"), ("a", "b")], "a string, b string")
    assert mutual_information(df, "a", "b").first()["n"] == 2
    r = chi_square(df, "a", "b").first()
    assert (r["n"], r["dof"], r["cramers_v"]) == (2, 0, None)
    assert mutual_information(df.limit(0), "a", "b").first()["n"] == 0


def test_stability_index(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert close(stability_index(base, base, "x", 10).first()["psi"], 0.0, 6)
    moved = base.withColumn("x", F.col("x") + 500)
    half = 0.5 - 1e-6
    # Half the bins empty out, and all of the other half's growth is in the last bin.
    psi = stability_index(base, moved, "x", 2).first()["psi"]
    assert psi == pytest.approx((1.0 - 0.5) * math.log(1.0 / 0.5) + (1e-6 - 0.5) * math.log(1e-6 / 0.5)) and half < 0.5
    by = stability_index(base, base.withColumn("g", (F.col("x") >= 500).cast("int")), "x", 2, ["g"]).collect()
    assert sorted((r["g"], r["n"]) for r in by) == [(0, 500), (1, 500)]


def test_profile_of_categories(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c string, e string")
    got = {r["column"]: r for r in profile_categories(df, ["c", "e"]).collect()}
    c = got["c"]
    assert (c["n_rows"], c["n_null"], c["n_distinct"], c["top"], c["top_rows"]) == (5, 1, 2, "a", 2)
    assert close(c["entropy"], math.log(2))
    e = got["e"]
    assert (e["n_rows"], e["n_null"], e["n_distinct"], e["top"], e["entropy"]) == (5, 5, 0, None, None)
