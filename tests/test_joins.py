"""Joins split at heavy keys: the same rows, and no task that holds the heavy key."""

import math
import random
from collections import Counter

import pytest

from marlstone.functions.joins import join_split
from marlstone.models.bayes import fit_bayes, score_bayes
from marlstone.operators.text import tfidf

from .conftest import PARTS, close, largest_reads, rows_of


@pytest.fixture(scope="module")
def texts(spark):
    """4,000 texts of three words; one word is in all of them and holds a third of all rows."""
    rows = [(i, f"the w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} v{chr(97 + i % 23)}{chr(97 + i // 23 % 26)}", i % 2) for i in range(4_000)]
    return spark.createDataFrame(rows, "id bigint, text string, y int").repartition(8).cache()


def test_rows_equal_a_plain_join(spark):
    chance = random.Random(1)
    rows = [(i, chance.choice(["hot", "hot", "hot", None, *[f"k{j}" for j in range(30)]])) for i in range(900)]
    left = spark.createDataFrame(rows, "id bigint, k string").repartition(4)
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4), (None, 5)], "k string, v int")
    assert rows_of(join_split(left, right, "k")) == rows_of(left.join(right, "k"))
    assert join_split(left.limit(0), right, "k").collect() == [] and join_split(left, right.limit(0), "k").collect() == []


def test_tfidf_is_right_with_a_hot_term(texts):
    rows = texts.collect()
    frequency = Counter(w for r in rows for w in set(r.text.split()))
    found = tfidf(texts, "id", "text").collect()
    assert len(found) == 3 * len(rows)
    assert all(r.df == frequency[r.term] and close(r.tfidf, r.tf * math.log(4001 / (r.df + 1))) for r in found)


def test_a_hot_term_is_no_task_of_its_own(spark, texts, many_tasks):
    texts.count()
    largest, _ = largest_reads(spark, lambda: tfidf(texts, "id", "text").write.format("noop").mode("overwrite").save())
    # Counting texts and frequencies reads partial sums of eight tasks; the hot term alone has 4,000 rows.
    assert 0 < largest < 12_000 * 2 / PARTS


def test_bayes_scores_do_not_gather_a_hot_term(spark, texts, many_tasks):
    model = fit_bayes(texts, "id", "text", "y")
    score = lambda: score_bayes(texts, model, "id", "text").write.format("noop").mode("overwrite").save()
    largest, _ = largest_reads(spark, score)
    assert 0 < largest < 12_000 * 2 / PARTS
    model.words.unpersist()


def test_bayes_scores_equal_sums_of_logs(texts):
    rows = texts.collect()
    counts = [Counter(w for r in rows if r.y == c for w in r.text.split()) for c in (0, 1)]
    words = set(counts[0]) | set(counts[1])
    for r in score_bayes(texts, fit_bayes(texts, "id", "text", "y"), "id", "text").limit(50).collect():
        text = next(x.text for x in rows if x.id == r.id)
        for c in (0, 1):
            logs = [math.log((counts[c][w] + 1) / (sum(counts[c].values()) + len(words))) for w in text.split()]
            assert close(r[f"log_{c}"], math.log(0.5) + sum(logs))
