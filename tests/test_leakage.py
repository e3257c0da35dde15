"""Values shared between parts: exact for any size of the filter."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators.leakage import bloom_words, leakage_report, leaked_rows, may_hold, normalized

from .conftest import PARTS, largest_reads, rows_of

TRAIN = ["Same  Text", "two\tlines\nhere", "only train", "", None, "İ ß", *[f"train value {i}" for i in range(300)]]
TEST = ["same text ", "TWO lines here", "only test", " ", None, "same TEXT", *[f"test value {i}" for i in range(300)], *["train VALUE 7"] * 150]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)


def plain(text):
    return None if text is None else " ".join(text.lower().split())


def test_normalized_values_ignore_case_and_white_space(spark):
    found = table(spark, TRAIN + TEST).select("text", normalized(["text"]).alias("v")).collect()
    assert all(r.v == plain(r.text) for r in found if r.text != "İ ß")
    both = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("a", "")], "x string, y string").select(normalized(["x", "y"]).alias("v"))
    told = [r.v for r in both.collect()]
    assert told[2] is None and len(set(told)) == 4


@pytest.mark.parametrize("bits", [None, 20, 10, 7, 6])
def test_answers_are_exact_even_where_the_filter_is_full(spark, bits):
    train, test = table(spark, TRAIN), table(spark, TEST)
    held = {plain(t) for t in TRAIN if t is not None}
    seen = [i for i, t in enumerate(TEST) if t is not None and plain(t) in held]
    if bits == 6:
        digests = train.select(F.sha2(normalized(["text"]), 256).alias("_digest")).where("_digest is not null")
        # Every bit is set, so the filter keeps everything.
        assert [r.held for r in bloom_words(digests, 6).collect()] == [-1]
        assert may_hold(digests, bloom_words(digests, 6), 6).count() == digests.count()
    assert sorted(rows_of(leaked_rows(train, test, ["text"], bits), "id")) == [(i,) for i in seen]
    values = {plain(t) for t in TEST if t is not None}
    found = leakage_report(train, test, ["text"], bits).first()
    assert tuple(found) == (sum(t is not None for t in TEST), len(seen), len(values), len(values & held))


def test_the_filter_rules_most_out(spark):
    train, test = table(spark, TRAIN), table(spark, TEST)
    digest = lambda df: df.select(F.sha2(normalized(["text"]), 256).alias("_digest")).where("_digest is not null")
    theirs = digest(train)
    held = {r[0] for r in theirs.collect()}
    passed = [r[0] for r in may_hold(digest(test), bloom_words(theirs, 13), 13).collect()]
    assert sum(d not in held for d in passed) < 15
    assert sorted(d for d in passed if d in held) == sorted(r[0] for r in digest(test).collect() if r[0] in held)


def test_empty_parts(spark):
    none, some = table(spark, []), table(spark, TEST)
    assert leaked_rows(none, some, ["text"]).collect() == [] and leaked_rows(some, none, ["text"]).collect() == []
    assert leakage_report(none, some, ["text"]).first().test_rows_seen == 0
    assert tuple(leakage_report(some, none, ["text"]).first()) == (0, 0, 0, 0)


def test_a_value_that_fills_the_test_part_stays_where_it_lies(spark, many_tasks):
    train = table(spark, ["common", *[f"t{i}" for i in range(100)]])
    test = table(spark, ["common"] * 6000 + [f"t{i}" for i in range(6000)]).repartition(PARTS).cache()
    test.count()
    largest, _ = largest_reads(spark, lambda: leaked_rows(train, test, ["text"]).write.format("noop").mode("overwrite").save())
    assert 0 < largest < 12_000 * 2 / PARTS
    assert leaked_rows(train, test, ["text"]).count() == 6100
