"""Running totals, ranks and exact quantiles against brute force, with hot values."""

import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone.operators.blocks import average_ranks, block_edges, value_totals
from marlstone.operators.quantiles import quantile_values, quantiles

from .conftest import close


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        # A third of all rows is one value of one group.
        if i % 3 == 0:
            rows.append(("hot", 7.0))
        else:
            rows.append((rng.choice("ab"), round(rng.gauss(0, 10), 1)))
    return pd.DataFrame(rows, columns=["g", "x"])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_value_totals(spark, skewed, by, descending):
    df = spark.createDataFrame(skewed)
    got = value_totals(df, "x", {"n": F.count(F.lit(1))}, by, descending).toPandas()
    groups = [((), skewed)] if not by else [((k,), part) for k, part in skewed.groupby("g")]
    seen = 0
    for key, part in groups:
        mine = got if not by else got[got["g"] == key[0]]
        for row in mine.itertuples():
            earlier = (part["x"] > row.x) if descending else (part["x"] < row.x)
            assert row.n_before == earlier.sum()
            assert row.n == (part["x"] == row.x).sum()
            assert row.n_all == len(part)
            seen += row.n
    assert seen == len(skewed)


def test_totals_do_not_depend_on_the_edges(spark, skewed):
    df = spark.createDataFrame(skewed)
    inf = float("inf")
    results = []
    for edges in ([-inf, 0.0, inf], [-inf, -1e9, 1e9, inf], block_edges(df, ["x"], 50)[0]):
        made = value_totals(df, "x", {"n": F.count(F.lit(1))}, edges=edges)
        results.append(sorted(tuple(r) for r in made.collect()))
    assert results[0] == results[1] == results[2]


def test_values_without_a_place_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    got = sorted(tuple(r) for r in value_totals(df, "x", {"n": F.count(F.lit(1))}).collect())
    assert got == [(float("-inf"), 1, 0, 3), (1.0, 1, 1, 3), (float("inf"), 1, 2, 3)]


def test_average_ranks(spark, skewed):
    got = {r["x"]: r["rank"] for r in average_ranks(spark.createDataFrame(skewed), "x").collect()}
    expected = skewed.assign(rank=skewed["x"].rank(method="average"))
    assert all(close(got[r.x], r.rank) for r in expected.itertuples())


def test_empty_and_null_group(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert value_totals(empty, "x", {"n": F.count(F.lit(1))}, ["g"]).count() == 0
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "g string, x double")
    got = {(r["g"], r["x"]): r["n_before"] for r in value_totals(df, "x", {"n": F.count(F.lit(1))}, ["g"]).collect()}
    assert got == {(None, 1.0): 0, (None, 2.0): 1, ("a", 3.0): 0}


SHARES = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


def test_quantiles(spark, skewed):
    df = spark.createDataFrame(skewed).withColumn("y", F.col("x") * 2)
    got = quantile_values(df, ["x", "y"], SHARES)
    for share in SHARES:
        assert close(got["x", share], np.quantile(skewed["x"], share))
        assert close(got["y", share], np.quantile(skewed["x"] * 2, share))


def test_quantiles_by_group(spark, skewed):
    rows = quantiles(spark.createDataFrame(skewed), ["x"], SHARES, ["g"], blocks=20).collect()
    assert len(rows) == 3 * len(SHARES)
    for r in rows:
        assert close(r["value"], np.quantile(skewed[skewed["g"] == r["g"]]["x"], r["share"]))


def test_quantiles_of_gaps_and_single_rows(spark):
    df = spark.createDataFrame([(None, 4.0), (float("nan"), None), (2.5, None)], "a double, b double")
    got = quantile_values(df, ["a", "b"], [0.3])
    assert got == {("a", 0.3): 2.5, ("b", 0.3): 4.0}


def test_block_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([], "x double"), ["x"], [0.5]).count() == 0


def test_quantiles_equal_percentile_bit_for_bit(spark):
    # Ties, infinities and values whose weighted mean is not exact.
    values = [0.01] * 990 + [0.3, 0.7, 1e300, -1e300, 0.1, 0.2, 1 / 3, float("inf"), float("-inf"), 5e-324]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)] + [(7, float("nan")), (7, None)], "g int, x double")
    shares = [0.0, 0.001, 0.0105, 0.2, 1 / 3, 0.5, 0.9, 0.9935, 0.9999, 1.0]
    clean = df.where("x is not null and not isnan(x)")
    theirs = clean.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, shares))).alias("p")).collect()
    expected = {(r.g, s): struct.pack("d", v) for r in theirs for s, v in zip(shares, r.p)}
    for blocks in (None, 7):
        got = {(r.g, r.share): struct.pack("d", r.value) for r in quantiles(df, ["x"], shares, ["g"], blocks=blocks).collect()}
        assert got == expected
