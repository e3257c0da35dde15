"""Scans along keys against loops, and the largest task where one key holds a third of all rows or more."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators import history
from marlstone.operators.history import asof, lags, rolling, sessions
from marlstone.operators.scans import carry_last, carry_sum

from .conftest import PARTS, largest_reads

@pytest.fixture(scope="module")
def cells():
    chance = random.Random(8)
    rows = {}
    for _ in range(500):
        key = chance.choice([None, "a", "b", "b", "b"])
        rows[key, chance.randrange(-300, 300)] = chance.choice([None, chance.randrange(9)])
    return [(k, p, v) for (k, p), v in rows.items()]


@pytest.mark.parametrize("levels, fan", [(1, 10), (2, 10), (3, 4), (5, 2), (3, 1024)])
def test_scans_equal_loops(spark, cells, levels, fan):
    df = spark.createDataFrame(cells, "k string, p bigint, v bigint")
    found = carry_last(df, ["k"], "p", "v", "before", fan, levels).collect()
    sums = carry_sum(df.fillna(0, ["v"]), ["k"], "p", "v", "before", fan, levels).collect()
    assert len(found) == len(sums) == len(cells)
    for r in found:
        earlier = sorted((p, v) for k, p, v in cells if k == r.k and p < r.p and v is not None)
        assert r.before == (earlier[-1][1] if earlier else None)
    for r in sums:
        assert r.before == sum(v or 0 for k, p, v in cells if k == r.k and p < r.p)


@pytest.fixture(scope="module")
def busy(spark):
    """24,000 events; one key holds half of them."""
    chance = random.Random(2)
    start = datetime(2024, 1, 1)
    rows = [(i, 0 if i % 2 else 1 + chance.randrange(40), start + timedelta(seconds=7 * i + chance.randrange(7)), float(i % 50)) for i in range(24_000)]
    return spark.createDataFrame(rows, "id bigint, k bigint, ts timestamp_ntz, v double").repartition(8).cache()


CASES = {
    "rolling": lambda df: rolling(df, "k", "ts", "v", 86_400),
    "lags": lambda df: lags(df, "k", "ts", "v", 2),
    "sessions": lambda df: sessions(df, "k", "ts", 5, "v"),
    "asof": lambda df: asof(df.where("id % 3 = 0"), df.where("id % 3 > 0"), "k", "ts", "ts", ["id"]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_a_key_with_half_of_the_rows_is_spread(spark, busy, many_tasks, name):
    busy.count()
    largest, _ = largest_reads(spark, lambda: CASES[name](busy).write.format("noop").mode("overwrite").save())
    # Rolling sees each row twice, as-of and lags keep parts of it beside it; one task for the key would read 12,000 or more.
    assert 0 < largest < 24_000 * 2 / PARTS * 1.9


@pytest.mark.parametrize("name", sorted(CASES))
def test_the_spread_plan_gives_the_same_rows(spark, busy, name):
    few = busy.where("id < 3000")
    spread = CASES[name](few)
    alone = None
    for key in few.select("k").distinct().limit(6).collect():
        mine = few.where(F.col("k") == key.k)
        part = CASES[name](mine)
        alone = part if alone is None else alone.unionByName(part)
    keys = [r.k for r in alone.select("k").distinct().collect()]
    plain = lambda df: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.where(F.col("k").isin(keys)).collect())
    assert plain(spread) == plain(alone)


@pytest.mark.parametrize("feature", [lambda df: rolling(df, "k", "ts", "v", 86_400), lambda df: lags(df, "k", "ts", "v")])
def test_a_task_gets_no_more_rows_where_the_table_grows(spark, monkeypatch, feature):
    start = datetime(2024, 1, 1)
    rows = [(i % 400, start + timedelta(seconds=i), float(i)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double").persist()
    df.count()
    wanted = sorted(map(repr, feature(df).collect()))
    monkeypatch.setattr(history, "TASK_ROWS", 500)
    # Four shuffle partitions would read 3,000 rows each.
    largest, found = largest_reads(spark, lambda: feature(df).collect())
    df.unpersist()
    assert sorted(map(repr, found)) == wanted and largest <= 2_000
