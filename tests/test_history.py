"""Time features against brute force, with one key holding most rows and with tied times."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators.history import asof, busiest, calendar, entity_aggregate, lags, rolling, sessions

from .conftest import close

START = datetime(1969, 12, 25)  # times before 1970 have negative microseconds


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(600):
        key = 0 if i % 3 else rng.randrange(1, 5)
        at = START + timedelta(seconds=rng.randrange(0, 12 * 86400))
        if i % 10 == 0 and out:
            key, at = out[-1][1], out[-1][2]  # same key and time as the row before
        out.append((i, key, at, float(rng.randrange(100))))
    out.append((600, 9, START, None))
    out.append((601, 0, None, 5.0))
    return out


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k bigint, ts timestamp_ntz, v double")


SLICED = [{}, {"frame_rows": 0}, {"frame_rows": 0, "window_rows": 5}]


@pytest.mark.parametrize("options", SLICED)
@pytest.mark.parametrize("span", [3600, 86400, 3 * 86400 + 7])
def test_rolling(events, rows, span, options):
    got = rolling(events, "k", "ts", "v", span, **options).collect()
    known = [r for r in rows if r[2] is not None]
    assert len(got) == len({(k, t) for _, k, t, _ in known})
    for r in got:
        past = [v for _, k, t, v in known if k == r["k"] and r["ts"] - timedelta(seconds=span) <= t < r["ts"] and v is not None]
        assert r["past_count"] == len(past)
        assert close(r["past_sum"], sum(past))
        assert close(r["past_mean"], sum(past) / len(past) if past else None)
        assert (r["past_min"], r["past_max"]) == ((min(past), max(past)) if past else (None, None))


@pytest.mark.parametrize("window_rows", [10**6, 3, 0])
@pytest.mark.parametrize("steps", [1, 3])
def test_lags(events, rows, steps, window_rows):
    points = {}
    for i, k, t, v in rows:
        if t is not None and (k, t) not in points or t is not None and points[k, t][0] < i:
            points[k, t] = (i, v)
    got = lags(events, "k", "ts", "v", steps, tie="id", window_rows=window_rows).collect()
    assert len(got) == len(points)
    for r in got:
        times = sorted(t for k, t in points if k == r["k"])
        place = times.index(r["ts"])
        assert r["v"] == points[r["k"], r["ts"]][1]
        for step in range(1, steps + 1):
            earlier = times[place - step] if place >= step else None
            assert r[f"v_lag{step}"] == (points[r["k"], earlier][1] if earlier else None)
            assert close(r[f"seconds_since{step}"], (r["ts"] - earlier).total_seconds() if earlier else None)


@pytest.mark.parametrize("gap", [600, 7200, 10**6])
def test_sessions(events, rows, gap):
    expected = []
    for key in {k for _, k, _, _ in rows}:
        mine = sorted((t, v) for _, k, t, v in rows if k == key and t is not None and v is not None)
        mine += [(t, 0.0) for _, k, t, v in rows if k == key and t is not None and v is None]
        run = []
        for t, v in mine:
            if run and (t - run[-1][0]).total_seconds() > gap:
                expected.append((key, run))
                run = []
            run.append((t, v))
        if run:
            expected.append((key, run))
    want = sorted((k, run[0][0], run[-1][0], len(run), sum(v for _, v in run)) for k, run in expected)
    got = sorted(
        (r["k"], r["session_start"], r["session_end"], r["events"], r["v_sum"] or 0.0)
        for r in sessions(events, "k", "ts", gap, "v").collect()
    )
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(close(g[4], w[4]) for g, w in zip(got, want))


def test_a_pause_of_exactly_the_gap_does_not_end_a_session(spark):
    at = datetime(2024, 1, 1, 0, 0, 1)
    times = [at, at + timedelta(seconds=60), at + timedelta(seconds=120, microseconds=1)]
    df = spark.createDataFrame([(1, t) for t in times], "k int, ts timestamp_ntz")
    got = sorted((r["session"], r["events"], r["seconds"]) for r in sessions(df, "k", "ts", 60).collect())
    assert got == [(1, 2, 60.0), (2, 1, 0.0)]


@pytest.mark.parametrize("window_rows", [10**6, 3])
def test_asof(events, rows, window_rows):
    left = events.where("id % 2 = 0").drop("v")
    right = events.where("id % 2 = 1")
    facts = {}
    for i, k, t, v in rows:
        if i % 2 == 1 and t is not None and (k, t) not in facts or i % 2 == 1 and t is not None and facts[k, t][0] < i:
            facts[k, t] = (i, v)
    got = asof(left, right, "k", "ts", "ts", ["id", "v"], tie="id", window_rows=window_rows).collect()
    assert sorted(r["id"] for r in got) == [i for i, *_ in rows if i % 2 == 0]
    for r in got:
        earlier = [t for k, t in facts if k == r["k"] and r["ts"] is not None and t < r["ts"]]
        best = max(earlier) if earlier else None
        assert r["asof_ts"] == best
        assert (r["asof_id"], r["asof_v"]) == (facts[r["k"], best] if best else (None, None))


def test_busiest(events):
    assert busiest(events, "k", "ts") > 300
    assert busiest(events.limit(0), "k", "ts") == 0


def test_entity_aggregate_looks_back_only(spark):
    day = datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, day, 10.0), (1, day - timedelta(days=1), 4.0), (1, day - timedelta(days=400), 2.0), (2, day, 5.0)],
        "k int, ts timestamp_ntz, v double",
    )
    got = {r["k"]: r for r in entity_aggregate(df, "k", "ts", "v", "2020-01-01").collect()}
    assert (got[1]["n"], got[1]["n_last_year"], got[1]["total"], got[1]["days_since_last"]) == (2, 1, 6.0, 1)
    assert (got[2]["n"], got[2]["total"], got[2]["mean"], got[2]["days_since_last"]) == (0, 0.0, None, None)


def test_calendar(spark):
    df = spark.sql("select timestamp_ntz'2021-01-03 23:30:00' as ts")  # a Sunday in ISO week 53 of 2020
    r = calendar(df, "ts").first()
    assert (r["year"], r["quarter"], r["month"], r["day"], r["isodow"], r["isoweek"], r["hour"]) == (2021, 1, 1, 3, 7, 53, 23)


def test_a_nan_counts_as_missing(spark):
    rows = [("k", f"2024-01-01 00:0{i}:00", v) for i, v in enumerate([1.0, float("nan"), 3.0, None, 5.0])]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    past = {r.t.minute: r for r in rolling(df, "k", "t", "v", 3600).collect()}
    assert (past[4].past_count, past[4].past_sum, past[4].past_mean, past[4].past_max) == (2, 4.0, 2.0, 3.0)
    assert sessions(df, "k", "t", 600, "v").first().v_sum == 9.0
    row = entity_aggregate(df, "k", "t", "v", "2025-01-01").first()
    assert (row.total, row["mean"], row.largest) == (9.0, 3.0, 5.0)
