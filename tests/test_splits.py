import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone.functions.columns import join_on, key_number, ngrams, words
from marlstone.operators.splits import class_weights, downsample, hash_split, kfold, shared_entities, time_split

from .conftest import rows_of


def number(value):
    return int(hashlib.md5(str(value).encode()).hexdigest()[:7], 16)


def test_key_number(spark):
    df = spark.createDataFrame([(1,), (2,), (123456789,), (None,)], "k bigint").withColumn("n", key_number("k"))
    assert {r["k"]: r["n"] for r in df.collect()} == {k: (None if k is None else number(k)) for k in (1, 2, 123456789, None)}


def test_parts_cover_the_rows_and_follow_the_key(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 500)
    split = hash_split(df, "k", {"train": 6, "valid": 1, "test": 3})
    counts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    assert set(counts) == {"train", "valid", "test"} and sum(counts.values()) == 2000
    assert split.groupBy("k").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0
    assert counts["train"] > counts["test"] > counts["valid"]


def test_bad_parts(spark):
    with pytest.raises(ValueError):
        hash_split(spark.range(1), "id", {"train": 8, "test": 1})
    with pytest.raises(ValueError):
        kfold(spark.range(1), "id", 1)


def test_kfold(spark):
    got = {r["id"]: r["fold"] for r in kfold(spark.range(50), "id", 4).collect()}
    assert got == {i: number(i) % 4 for i in range(50)}


def test_time_split(spark):
    df = spark.sql("select * from values (timestamp_ntz'2020-01-01 00:00:00'), (timestamp_ntz'2020-01-02 00:00:00'), (null) as t(ts)")
    got = [r["part"] for r in time_split(df, "ts", "2020-01-02").orderBy(F.col("ts").asc_nulls_last()).collect()]
    assert got == ["train", "test", None]


def test_shared_entities_counts_rows_and_entities(spark):
    rows = [("a", "train")] * 5 + [("a", "test")] * 3 + [("b", "test")] * 2 + [("c", "train")] + [(None, "test")]
    got = shared_entities(spark.createDataFrame(rows, "e string, part string"), ["e"]).first()
    assert tuple(got) == (6, 3, 3, 1)
    assert tuple(shared_entities(spark.createDataFrame([], "e string, part string"), ["e"]).first()) == (0, 0, 0, 0)


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,)] * 30 + [(0,)] * 10 + [(None,)] * 4, "y int")
    got = rows_of(class_weights(df, "y"), "y", "n", "weight")
    assert got == [(0, 10, 2.0), (1, 30, 40 / 60)]
    assert sum(n * w for _, n, w in got) == pytest.approx(40)


def test_downsample_keeps_other_classes_and_is_stable(spark):
    df = spark.range(4000).withColumn("y", (F.col("id") % 2).cast("int"))
    kept = downsample(df, "id", "y", {1: 0.25})
    assert kept.where("y = 0").count() == 2000
    expected = [i for i in range(1, 4000, 2) if number(i) < 0.25 * 2**28]
    assert sorted(r["id"] for r in kept.where("y = 1").collect()) == expected


def test_words_keep_letters_of_any_script(spark):
    df = spark.createDataFrame([("Für die größte Straße, mañana été 日本語 x2y",)], "t string")
    assert df.select(words("t").alias("w")).first().w == ["für", "die", "größte", "straße", "mañana", "été", "日本語", "x", "y"]


def test_words_and_ngrams(spark):
    df = spark.createDataFrame([("One two,  TWO é three",), ("",), ("x",), (None,)], "t string")
    got = df.select(words("t").alias("w"), ngrams("t", 2).alias("g")).collect()
    assert got[0]["w"] == ["one", "two", "two", "é", "three"]
    assert got[0]["g"] == ["one two", "two two", "two é", "é three"]
    assert got[1]["w"] == [] and got[1]["g"] == [] and got[2]["g"] == [] and got[3]["w"] is None


def test_join_on_matches_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    got = rows_of(join_on(left, right, ["k"], "left"), "l", "r")
    assert got == [("a", "x"), ("b", "y"), ("c", None)]


def test_downsample_keeps_null_keys_of_whole_classes(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a")], "id long, label string")
    kept = downsample(df, "id", "label", {"b": 0.0})
    assert kept.where("label = 'a'").count() == 2 and kept.where("label = 'b'").count() == 0
