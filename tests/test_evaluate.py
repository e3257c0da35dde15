"""Evaluation tables against brute force: ties, one class only, hot scores, empty input."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.evaluate import scores
from marlstone.evaluate.classes import class_report, confusion
from marlstone.evaluate.numbers import regression_report
from marlstone.evaluate.rankings import cluster_report, ranking_report, ranking_summary, silhouette

from .conftest import close, rows_of


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(900):
        score = 0.5 if i % 3 == 0 else round(rng.random(), 2)
        out.append((i, int(rng.random() < score), score, rng.choice("ab")))
    return out


@pytest.fixture(scope="module")
def scored(spark, rows):
    extra = [(1000, None, 0.3, "a"), (1001, 1, None, "a"), (1002, 0, float("nan"), "b")]
    return spark.createDataFrame(rows + extra, "id bigint, y int, score double, g string")


def brute_auc(rows):
    pos = np.array([s for _, y, s, _ in rows if y == 1])
    neg = np.array([s for _, y, s, _ in rows if y == 0])
    gaps = pos[:, None] - neg[None, :]
    return ((gaps > 0).sum() + 0.5 * (gaps == 0).sum()) / gaps.size


def test_auc(scored, rows):
    assert close(scores.auc(scored, "y", "score").first()["auc"], brute_auc(rows))
    by = {r["g"]: r["auc"] for r in scores.auc(scored, "y", "score", ["g"]).collect()}
    for g, value in by.items():
        assert close(value, brute_auc([r for r in rows if r[3] == g]))


def test_auc_is_unchanged_by_a_rising_map(scored):
    moved = scored.withColumn("score", F.exp(F.col("score") * 30) - 7)
    assert close(scores.auc(moved, "y", "score").first()["auc"], scores.auc(scored, "y", "score").first()["auc"])


def test_auc_without_one_class_or_rows(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, score double")
    assert tuple(scores.auc(one, "y", "score").first()) == (2, 0, None)
    assert scores.average_precision(one.withColumn("y", F.lit(0)), "y", "score").first()[0] is None
    assert tuple(scores.auc(one.limit(0), "y", "score").first()) == (0, 0, None)
    assert scores.roc(one, "y", "score").where("fpr is not null").count() == 0
    assert scores.roc(one.limit(0), "y", "score").count() == 0


def test_curves(scored, rows):
    pos, neg = sum(y for _, y, _, _ in rows), sum(1 - y for _, y, _, _ in rows)
    roc = {r["threshold"]: r for r in scores.roc(scored, "y", "score").collect()}
    pr = {r["threshold"]: r for r in scores.pr_curve(scored, "y", "score").collect()}
    assert set(roc) == set(pr) == {s for _, _, s, _ in rows}
    for limit, r in roc.items():
        tp = sum(y for _, y, s, _ in rows if s >= limit)
        fp = sum(1 - y for _, y, s, _ in rows if s >= limit)
        assert (r["tp"], r["fp"]) == (tp, fp) and close(r["tpr"], tp / pos) and close(r["fpr"], fp / neg)
        assert close(pr[limit]["precision"], tp / (tp + fp)) and close(pr[limit]["recall"], tp / pos)
    ap, last = 0.0, 0.0
    for limit in sorted(pr, reverse=True):
        ap += (pr[limit]["recall"] - last) * pr[limit]["precision"]
        last = pr[limit]["recall"]
    assert close(scores.average_precision(scored, "y", "score").first()[0], ap)


def test_probability_report(spark, scored, rows):
    r = scores.probability_report(scored, "y", "score").first()
    assert r["n"] == len(rows) and close(r["brier"], sum((s - y) ** 2 for _, y, s, _ in rows) / len(rows))
    sure = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, score double")
    assert close(scores.probability_report(sure, "y", "score").first()["log_loss"], -math.log(1e-15) / 2, 6)


def test_calibration_covers_all_rows(scored, rows):
    table = scores.calibration(scored, "y", "score", 5).collect()
    assert sum(r["n"] for r in table) == len(rows) and {r["bin"] for r in table} == set(range(5))
    top = [(y, s) for _, y, s, _ in rows if s >= 0.8]
    assert close(next(r["positive_rate"] for r in table if r["bin"] == 4), sum(y for y, _ in top) / len(top))


def test_threshold_report(scored, rows):
    for r in scores.threshold_report(scored, "y", "score", [0.0, 0.5, 2.0]).collect():
        called = [y for _, y, s, _ in rows if s >= r["threshold"]]
        assert (r["called"], r["tp"]) == (len(called), sum(called))
        assert close(r["precision"], sum(called) / len(called) if called else 0.0)


@pytest.mark.parametrize("bands", [1, 7, 10])
def test_lift_splits_tied_scores_by_key(scored, rows, bands):
    ordered = sorted(rows, key=lambda r: (-r[2], int(hashlib.md5(str(r[0]).encode()).hexdigest()[:7], 16), r[0]))
    want = {}
    for place, (_, y, _, _) in enumerate(ordered):
        n, pos = want.get(place * bands // len(ordered) + 1, (0, 0))
        want[place * bands // len(ordered) + 1] = (n + 1, pos + y)
    got = {r["band"]: (r["n"], r["positives"]) for r in scores.lift(scored, "id", "y", "score", bands).collect()}
    assert got == want


def test_confusion_has_zero_cells_and_sums_up(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), (None, "a"), ("a", None)], "y string, p string")
    got = rows_of(confusion(df, "y", "p"), "y", "pred", "n")
    assert len(got) == 9 and sum(n for *_, n in got) == 4
    assert ("c", "c", 0) in got and ("a", "b", 1) in got
    assert confusion(df.limit(0), "y", "p").count() == 0


def test_class_report(spark):
    rows = [("a", "a")] * 4 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "a")] + [("c", "a")]
    got = {(r["level"], r["class"]): r for r in class_report(spark.createDataFrame(rows, "y string, p string"), "y", "p").collect()}
    a, c = got["class", "a"], got["class", "c"]
    assert close(a["precision"], 4 / 6) and close(a["recall"], 4 / 6) and a["support"] == 6
    assert (c["precision"], c["recall"], c["f1"], c["support"]) == (0.0, 0.0, 0.0, 1)
    assert close(got["average", "micro"]["f1"], 7 / 11)
    assert close(got["average", "macro"]["recall"], (4 / 6 + 3 / 4 + 0) / 3)
    assert close(got["average", "weighted"]["recall"], 7 / 11)
    assert class_report(spark.createDataFrame([], "y string, p string"), "y", "p").count() == 0


def test_regression_report(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 3.5), ("a", 8.0, 5.0), ("b", 4.0, 4.0), ("b", None, 1.0), ("b", 2.0, None)]
    df = spark.createDataFrame(rows, "g string, y double, p double")
    whole = regression_report(df, "y", "p").first()
    assert whole["n"] == 4 and close(whole["mae"], 4.5 / 4) and close(whole["median_ae"], 0.75)
    y = [1.0, 3.0, 8.0, 4.0]
    assert close(whole["r2"], 1 - 10.25 / (np.var(y) * 4))
    by = {r["g"]: r for r in regression_report(df, "y", "p", ["g"]).collect()}
    assert by["a"]["median_ae"] == 1.0 and by["b"]["r2"] is None and by["b"]["mae"] == 0.0
    assert regression_report(df.limit(0), "y", "p").first()["median_ae"] is None


def test_ranking_report(spark):
    rows = [("q", i, 1.0 - i / 10, rel) for i, rel in enumerate([0, 1, 1, 0, 1])] + [("r", 1, 0.5, 0), ("s", 2, 0.5, 1), ("s", 1, 0.5, 0)]
    df = spark.createDataFrame(rows, "q string, item int, score double, rel int")
    report = ranking_report(df, "q", "item", "score", "rel", 3)
    got = {r["q"]: r for r in report.collect()}
    assert close(got["q"]["precision"], 2 / 3) and close(got["q"]["average_precision"], (1 / 2 + 2 / 3) / 3)
    ideal = 1 + 1 / math.log2(3) + 0.5
    assert close(got["q"]["ndcg"], (1 / math.log2(3) + 0.5) / ideal) and close(got["q"]["reciprocal_rank"], 0.5)
    assert (got["r"]["ndcg"], got["r"]["reciprocal_rank"], got["r"]["average_precision"]) == (0.0, 0.0, 0.0)
    assert close(got["s"]["reciprocal_rank"], 0.5)  # the tie goes to the smaller item
    assert ranking_summary(report, "q").first()["queries"] == 3


def test_cluster_report(spark):
    same = spark.createDataFrame([(i % 3, "abc"[i % 3]) for i in range(30)], "c int, l string")
    r = cluster_report(same, "c", "l").first()
    assert (r["n"], r["clusters"], r["classes"]) == (30, 3, 3) and close(r["purity"], 1.0) and close(r["adjusted_rand"], 1.0)
    mixed = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "b"), (1, "b"), (1, None)], "c int, l string")
    r = cluster_report(mixed, "c", "l").first()
    # Pairs: cells 1 + 0 + 1 = 2, clusters 3 + 1 = 4, classes 1 + 3 = 4, all 10.
    assert close(r["purity"], 4 / 5) and close(r["adjusted_rand"], (2 - 1.6) / (4 - 1.6))


def test_silhouette_of_far_clusters(spark):
    rows = [([0.0, 0.1 * i], 0) for i in range(5)] + [([50.0, 0.1 * i], 1) for i in range(5)]
    assert silhouette(spark.createDataFrame(rows, "v array<double>, c int"), "v", "c") > 0.99


def test_lift_keeps_null_keys(spark):
    rows = [(None if i % 2 else i, i % 3 == 0, 0.5) for i in range(20)]
    df = spark.createDataFrame([(k, int(y), s) for k, y, s in rows], "id long, y int, score double")
    assert [r.n for r in scores.lift(df, "id", "y", "score", 4).orderBy("band").collect()] == [5, 5, 5, 5]


def test_ranking_report_counts_relevant_items_beyond_the_judged(spark):
    judged = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 0), (1, 12, 0.7, 0)], "q long, item long, score double, rel int")
    few = ranking_report(judged, "q", "item", "score", "rel", 3).first()
    all_of_them = ranking_report(judged, "q", "item", "score", "rel", 3, spark.createDataFrame([(1, 50)], "q long, wanted long")).first()
    assert few.average_precision == 1.0 and abs(all_of_them.average_precision - 1 / 3) < 1e-12
    assert few.ndcg == 1.0 and abs(all_of_them.ndcg - 1 / (1 + 1 / math.log2(3) + 1 / 2)) < 1e-12
