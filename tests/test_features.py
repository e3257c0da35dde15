import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.operators.categories import apply_index, apply_target_encode, fit_index, fit_target_encode, hash_features
from marlstone.operators.clean import apply_clip, apply_impute, fit_clip, fit_impute
from marlstone.operators.scale import apply_bins, apply_scale, fit_bins, fit_scale
from marlstone.operators.text import bag_of_words, tfidf

from .conftest import close, rows_of

NAN = float("nan")


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, 1.0, "b", 4), (2, None, "a", None), (3, NAN, None, 6), (4, 5.0, "a", 7), (5, 3.0, "b", 9)]
    return spark.createDataFrame(rows, "id bigint, x double, c string, k int")


def test_impute(gaps):
    fills = fit_impute(gaps, {"x": "mean", "c": "mode", "k": "median"})
    assert fills == {"x": 3.0, "c": "a", "k": 6.5}  # ties for the mode go to the smallest value
    got = apply_impute(gaps, fills, flag=True).orderBy("id").collect()
    assert [r["x"] for r in got] == [1.0, 3.0, 3.0, 5.0, 3.0]
    assert [r["x_was_null"] for r in got] == [False, True, True, False, False]
    assert [r["c"] for r in got] == ["b", "a", "a", "a", "b"]
    assert [r["k"] for r in got] == [4.0, 6.5, 6.0, 7.0, 9.0]


def test_impute_constant_and_unknown_rule(gaps):
    got = apply_impute(gaps, fit_impute(gaps, {"c": ("constant", "?")})).orderBy("id").collect()
    assert [r["c"] for r in got] == ["b", "a", "?", "a", "b"]
    with pytest.raises(ValueError):
        fit_impute(gaps, {"x": "guess"})


def test_fit_uses_train_rows_only(gaps):
    train = gaps.where("id <= 2")
    assert fit_impute(train, {"x": "mean"}) == {"x": 1.0}
    assert fit_scale(train, ["x"], "minmax") == {"x": (1.0, 0.0)}


def test_clip(gaps):
    limits = fit_clip(gaps, ["x"], 0.25, 0.75)
    assert limits == {"x": (2.0, 4.0)}
    got = [r["x"] for r in apply_clip(gaps, limits).orderBy("id").collect()]
    assert got == [2.0, None, None, 4.0, 3.0]


def test_scale(gaps):
    for method, expected in (("standard", [-1, None, None, 1, 0]), ("minmax", [0, None, None, 1, 0.5]), ("robust", [-1, None, None, 1, 0])):
        got = apply_scale(gaps, fit_scale(gaps, ["x"], method)).orderBy("id").collect()
        assert [r["x_scaled"] for r in got] == expected
    with pytest.raises(ValueError):
        fit_scale(gaps, ["x"], "other")


def test_scale_without_spread(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    for method in ("standard", "minmax", "robust"):
        assert [r["x_scaled"] for r in apply_scale(df, fit_scale(df, ["x"], method)).collect()] == [0.0, 0.0, None]


def test_bins_are_closed_on_the_left_and_take_all_values(spark):
    df = spark.createDataFrame([(float(x),) for x in range(9)], "x double")
    edges = fit_bins(df, "x", 4, "width")
    assert edges == [0.0, 2.0, 4.0, 6.0, 8.0]
    other = spark.createDataFrame([(-5.0,), (0.0,), (2.0,), (5.9,), (8.0,), (99.0,), (None,), (NAN,)], "x double")
    assert [r["bin"] for r in apply_bins(other, "x", edges).collect()] == [0, 0, 1, 2, 3, 3, None, None]
    assert fit_bins(df, "x", 2, "quantile") == [0.0, 4.0, 8.0]


def test_bins_of_a_constant(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    for method in ("width", "quantile"):
        edges = fit_bins(df, "x", 3, method)
        assert [r["bin"] for r in apply_bins(df, "x", edges).collect()] == [0, 0, None]


def test_index_order_unseen_and_null(spark):
    train = spark.createDataFrame([("b",)] * 2 + [("a",)] * 2 + [("c",)] * 3 + [(None,)] * 9, "c string")
    index = fit_index(train, "c")
    assert rows_of(index, "c", "n", "idx") == [("a", 2, 1), ("b", 2, 2), ("c", 3, 0)]
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = {r["c"]: (r["c_idx"], r["c_onehot"]) for r in apply_index(test, index, "c").collect()}
    assert got == {"a": (1, [0.0, 1.0, 0.0]), "z": (None, [0.0] * 3), None: (None, [0.0] * 3)}


def test_index_of_too_many_categories_is_refused(spark, monkeypatch):
    monkeypatch.setattr("marlstone.operators.categories.MAX_ONE_HOT", 5)
    with pytest.raises(ValueError):
        fit_index(spark.range(6), "id")


def test_target_encoding_never_sees_its_own_fold(spark):
    rows = [(c, f, float(y)) for c, f, y in [("a", 0, 1), ("a", 0, 0), ("a", 1, 1), ("b", 0, 0), ("b", 1, 1), ("b", 1, 1), (None, 1, 0)]]
    df = spark.createDataFrame(rows, "c string, fold int, y double")
    got = {(r["c"], r["fold"]): r["c_encoded"] for r in fit_target_encode(df, "c", "y", "fold", 2.0).collect()}
    for (c, fold), value in got.items():
        others = [y for _, f, y in rows if f != fold]
        same = [y for k, f, y in rows if f != fold and k == c]
        prior = sum(others) / len(others)
        assert close(value, (sum(same) + 2.0 * prior) / (len(same) + 2.0))
    coded = apply_target_encode(df, fit_target_encode(df, "c", "y", "fold", 2.0), "c", "fold")
    assert coded.count() == len(rows) and coded.where("c_encoded is null").count() == 0


def test_hash_features(spark):
    df = spark.createDataFrame([(1, "x", "p"), (2, None, "q"), (3, None, None)], "id int, a string, b string")
    got = {r["id"]: [(c["idx"], c["value"]) for c in r["hashed"]] for r in hash_features(df, ["a", "b"], 2).collect()}

    def expected(**pairs):
        cells = {}
        for name, value in pairs.items():
            if value is not None:
                digest = hashlib.md5(f"{name}={value}".encode()).hexdigest()
                idx = int(digest[:7], 16) % 2
                cells[idx] = cells.get(idx, 0.0) + (-1.0 if int(digest[7], 16) % 2 else 1.0)
        return sorted(cells.items())

    assert got == {1: expected(a="x", b="p"), 2: expected(a=None, b="q"), 3: []}


def test_bag_and_tfidf(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "123"), (4, None)], "id int, t string")
    assert rows_of(bag_of_words(df, "id", "t"), "id", "term", "tf") == [(1, "a", 2), (1, "b", 1), (2, "b", 1), (2, "c", 1)]
    got = {(r["id"], r["term"]): r["tfidf"] for r in tfidf(df, "id", "t").collect()}
    assert close(got[1, "a"], 2 * math.log(5 / 2)) and close(got[1, "b"], math.log(5 / 3)) and len(got) == 4


def test_whole_texts_are_counted(spark):
    df = spark.createDataFrame([(1, "word " * 30000 + "last")], "id int, t string")
    assert rows_of(bag_of_words(df, "id", "t"), "term", "tf") == [("last", 1), ("word", 30000)]
    assert bag_of_words(df, "id", "t", 2).where(F.col("term") == "word last").count() == 1


@pytest.mark.parametrize("n", [1, 2])
def test_terms_are_counted_where_the_texts_lie(spark, n):
    texts = [(i, "a b a b a c" + " d" * i) for i in range(5)] + [(5, None), (6, ""), (7, "a")]
    df = spark.createDataFrame(texts, "id int, t string")
    found = bag_of_words(df, "id", "t", n)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    wanted = []
    for i, text in texts:
        words = (text or "").split()
        grams = Counter(" ".join(words[j : j + n]) for j in range(len(words) - n + 1))
        wanted += [(i, term, tf) for term, tf in grams.items()]
    assert rows_of(found, "id", "term", "tf") == sorted(wanted, key=repr)


def test_texts_that_share_a_key_are_counted_together(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "b a b"), (None, "c"), (None, "c d"), (2, "a a"), (3, None), (3, "a")], "id int, t string")
    wanted = [(1, "a", 2), (1, "b", 3), (None, "c", 2), (None, "d", 1), (2, "a", 2), (3, "a", 1)]
    assert rows_of(bag_of_words(df, "id", "t"), "id", "term", "tf") == sorted(wanted, key=repr)
