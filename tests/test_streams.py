"""Streams on a file source: late rows, equality with the batch form, going on after a stop."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.models.linear import fit_logistic
from marlstone.models.scoring import batch_score
from marlstone.operators.history import sessions
from marlstone.operators.profile import base_shares, stability_against
from marlstone.operators.scale import fit_bins
from marlstone.session import shared_dir
from marlstone.sources.tables import read_table, stream_table, write_bucketed, write_features
from marlstone.streaming.features import drift_features, run_to_table, score_stream, session_features, window_features

START = datetime(2024, 1, 1)
SCHEMA = "k int, ts timestamp_ntz, v double"


def write_batch(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_late_rows_are_dropped_and_windows_close_once(spark, folder):
    result, state = os.path.join(folder, "result"), os.path.join(folder, "state")

    def run():
        made = window_features(stream_table(spark, folder, "events"), ["k"], "ts", "v", "1 hour", "30 minutes")
        return run_to_table(spark, made, result, state)

    write_batch(spark, folder, [(1, at(10), 1.0), (1, at(20), 2.0), (1, at(70), 5.0)])
    assert run().count() == 0  # the watermark is 00:40
    write_batch(spark, folder, [(1, at(50), 3.0), (1, at(100), 1.0), (2, at(185), 4.0)])
    got = sorted((r["window_start"], r["k"], r["n"], r["total"]) for r in run().collect())
    assert got == [(at(0), 1, 3, 6.0), (at(60), 1, 2, 6.0)]
    write_batch(spark, folder, [(1, at(55), 100.0), (1, at(400), 1.0)])  # 00:55 is before the watermark by now
    got = sorted((r["window_start"], r["k"], r["n"], r["total"]) for r in run().collect())
    assert got == [(at(0), 1, 3, 6.0), (at(60), 1, 2, 6.0), (at(180), 2, 1, 4.0)]


def test_stream_sessions_equal_batch_sessions(spark, folder):
    rows = [(i % 3, at(17 * i + (200 if i > 40 else 0)), float(i)) for i in range(80)]
    write_batch(spark, folder, rows)
    write_batch(spark, folder, [(9, at(100_000), 0.0)])  # moves the watermark past all others
    made = run_to_table(spark, session_features(stream_table(spark, folder, "events"), ["k"], "ts", "v", "55 minutes", "1 hour"))
    batch = sessions(read_table(spark, folder, "events"), "k", "ts", 55 * 60, "v").where("k <> 9")
    stream = sorted((r["k"], r["session_start"], r["session_end"], r["events"], r["total"]) for r in made.collect())
    assert stream == sorted((r["k"], r["session_start"], r["session_end"], r["events"], r["v_sum"]) for r in batch.collect())
    assert len(stream) > 3


def test_drift_stream_equals_batch(spark, folder):
    write_batch(spark, folder, [(1, at(7 * i), float((i * 37) % 50 + i // 10)) for i in range(120)])
    events = read_table(spark, folder, "events")
    base = events.where(F.col("ts") < F.lit(at(300)))
    edges = fit_bins(base, "v", 4, "quantile")
    shares = base_shares(base, "v", edges)
    made = run_to_table(spark, drift_features(stream_table(spark, folder, "events"), "ts", "v", "2 hours", "1 minute", edges, shares))
    hours = events.withColumn("w", F.window("ts", "2 hours")["start"].cast("timestamp_ntz"))
    batch = {r["w"]: (r["n"], round(r["psi"], 9)) for r in stability_against(hours, shares, "v", edges, ["w"]).collect()}
    got = {r["window_start"]: (r["n"], round(r["psi"], 9)) for r in made.collect()}
    assert len(got) == 6 and all(batch[w] == value for w, value in got.items())


def test_scored_stream_equals_scored_table(spark, folder):
    write_batch(spark, folder, [(i, at(i), float(i % 13)) for i in range(50)])
    table = read_table(spark, folder, "events")
    model = fit_logistic(table.withColumn("y", (F.col("v") > 6).cast("int")), ["v"], "y", penalty=0.1)
    path = shared_dir(spark, "test-model")
    model.write().save(path)
    made = run_to_table(spark, score_stream(stream_table(spark, folder, "events", files_per_batch=1), path, ["k"]))
    want = batch_score(table, model, ["k"])
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.collect()))


def test_feature_tables_are_written_by_partition(spark, folder):
    df = spark.range(100).withColumn("day", F.col("id") % 3)
    write_features(df, f"{folder}/features.parquet", ["day"])
    back = read_table(spark, folder, "features", ["id", "day"])
    assert back.count() == 100 and sorted(os.listdir(f"{folder}/features.parquet"))[-1].startswith("day=")


def test_bucketed_tables_join_without_a_shuffle(spark, folder):
    spark.sql(f"create database if not exists marl location '{folder}/marl.db'")
    for name in ("a", "b"):
        write_bucketed(spark.range(200).withColumnRenamed("id", "k"), f"marl.{name}", "k", 4, mode="overwrite")
    joined = spark.table("marl.a").hint("merge").join(spark.table("marl.b"), "k")
    assert joined.count() == 200
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql("drop database marl cascade")
