"""Multinomial naive Bayes on words, held as tables."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import join_on, words
from marlstone.functions.joins import join_split
from marlstone.operators.text import bag_of_words

MAX_CLASSES = 200


@dataclass(frozen=True)
class BayesModel:
    """``words`` has one row per word seen in training, with a log likelihood column per class."""

    classes: tuple
    priors: tuple[float, ...]
    words: DataFrame

    @property
    def columns(self) -> list[str]:
        return [f"ll_{i}" for i in range(len(self.classes))]


def fit_bayes(train: DataFrame, key: str, text: str, y: str) -> BayesModel:
    """Class priors and add-one word likelihoods.

    Word counts are summed per (word, class) in the map tasks and turned into one row per word, so a common
    word is one row too. Only one number per class and the size of the vocabulary reach the driver.
    """
    known = train.where(F.col(y).isNotNull()).select(key, text, F.col(y).alias("_class"))
    sizes = known.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    sizes = sorted((r["_class"], r["n"]) for r in sizes)
    classes = tuple(c for c, _ in sizes)
    texts = sum(n for _, n in sizes)
    terms = known.select("_class", F.explode(words(text)).alias("term"))
    counts = terms.groupBy("term").agg(
        *[F.count(F.when(F.col("_class") == c, 1)).alias(f"n_{i}") for i, c in enumerate(classes)]
    ).persist()
    whole = counts.agg(
        F.count(F.lit(1)).alias("vocabulary"),
        *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(classes))],
    ).first()
    likelihood = [
        F.log((F.col(f"n_{i}") + 1.0) / F.lit(float(whole[f"n_{i}"] + whole["vocabulary"]))).alias(f"ll_{i}")
        for i in range(len(classes))
    ]
    return BayesModel(
        classes, tuple(log(n / texts) for _, n in sizes), counts.select("term", *likelihood)
    )


def score_bayes(df: DataFrame, model: BayesModel, key: str, text: str) -> DataFrame:
    """Rows (key, log_0, log_1, ..., pred): log prior plus log likelihoods of the known words.

    Words not seen in training are passed over; ties go to the first class. With two classes ``log_odds`` is
    the second minus the first. Words of very many texts meet their likelihoods where the rows lie.
    """
    counts = bag_of_words(df, key, text)
    known = join_split(counts, model.words, "term")
    sums = known.groupBy(key).agg(*[F.sum(F.col("tf") * F.col(c)).alias(c) for c in model.columns])
    joined = join_on(df.select(key), sums, [key], "left")
    logs = [
        (F.lit(prior) + F.coalesce(F.col(c), F.lit(0.0))).alias(f"log_{i}")
        for i, (c, prior) in enumerate(zip(model.columns, model.priors))
    ]
    scored = joined.select(key, *logs)
    best = F.lit(model.classes[0])
    top = F.col("log_0")
    for i in range(1, len(model.classes)):
        best = F.when(F.col(f"log_{i}") > top, F.lit(model.classes[i])).otherwise(best)
        top = F.greatest(top, F.col(f"log_{i}"))
    scored = scored.withColumn("pred", best)
    if len(model.classes) == 2:
        scored = scored.withColumn("log_odds", F.col("log_1") - F.col("log_0"))
    return scored
