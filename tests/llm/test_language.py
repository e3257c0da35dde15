import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm.language import ORDER, ContextTrees, byte_grams, fit_languages, identify
from marlstone.llm.samples import bounded_sample
from tests.llm.helpers import table

TRAIN = {"en": ["the cat sat on the mat", "a dog is in the house"], "de": ["die katze saß auf der matte", "ein hund ist im haus"]}


def plain_bits(texts, asked):
    """Code length of one text after plain counting, byte by byte."""
    follow = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for t in texts:
        raw = b"\n" * ORDER + t.encode()
        for i in range(ORDER, len(raw)):
            for k in range(ORDER + 1):
                follow[k][raw[i - k : i]][raw[i]] += 1
    total, raw = 0.0, b"\n" * ORDER + asked.encode()
    for i in range(ORDER, len(raw)):
        for k in range(ORDER, -1, -1):
            seen = follow[k][raw[i - k : i]]
            n, kinds = sum(seen.values()), len(seen)
            if seen[raw[i]]:
                total -= math.log2(seen[raw[i]] / (n + kinds))
                break
            if n:
                total -= math.log2(kinds / (n + kinds))
        else:
            total += 8
    return total


def trees():
    counted = {}
    for lang, texts in TRAIN.items():
        grams, counts = np.unique(byte_grams(texts)[0], return_counts=True)
        counted[lang] = (grams.astype("u8"), counts.astype("f8"))
    return ContextTrees(counted)


def test_code_lengths_equal_plain_counting():
    asked = ["the dog", "der hund saß", "x", "日本 the", "\n\n", "zzz q"]
    got = trees().code_lengths(asked)
    for row, text in zip(got, asked, strict=True):
        assert np.allclose(row, [plain_bits(TRAIN["de"], text), plain_bits(TRAIN["en"], text)], rtol=1e-5)


def test_fit_and_edges(spark):
    rows = [(i, t, lang) for lang, texts in TRAIN.items() for i, t in enumerate(texts)]
    rows += [(9, None, "en"), (9, "", "de"), (10, "no language", None), (11, "12 34!", "en")]
    df = table(spark, rows, "doc_id long, text string, language string")
    fitted = fit_languages(df.where("doc_id < 9"), lang_col="language")
    assert fitted.names == ["de", "en"]
    found = identify(df.withColumnRenamed("language", "lang"), fitted)
    by_text = {r.text: (r.language.lang_pred, r.language.score) for r in found.collect()}
    assert all(by_text[t][0] == lang and by_text[t][1] > 0.9 for lang, texts in TRAIN.items() for t in texts)
    assert by_text[None] == by_text[""] == by_text["12 34!"] == ("und", 0.0)
    empty = fit_languages(df.where(F.lit(False)), lang_col="language")
    assert {r.language.lang_pred for r in identify(df.drop("language"), empty).collect()} == {"und"}
    assert identify(df.where(F.lit(False)), fitted).count() == 0


def test_held_out_accuracy(spark):
    from marlstone.llm.queries import op2_ppm_language

    folder = "/root/testdata/sf0.01"
    found = op2_ppm_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.99
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_samples_are_bounded_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 = 0 as rare")
    first = bounded_sample(df, 50, "rare", "id")
    assert {r.rare: r["count"] for r in first.groupBy("rare").count().collect()} == {True: 50, False: 50}
    again = bounded_sample(df.repartition(7), 50, "rare", "id")
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
