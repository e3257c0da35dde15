"""Word counts and weights as long tables (id, term, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import join_on, ngrams
from marlstone.functions.joins import join_split


def term_counts(text: str | Column, n: int = 1) -> Column:
    """The distinct n-grams of a text with their counts, as an array of ``term, tf``: runs of equal neighbours in the sorted n-grams."""

    def lengths(terms, starts):
        end = lambda at: F.coalesce(F.get(starts, at + 1), F.size(terms))
        return F.transform(starts, lambda start, at: F.struct(F.get(terms, start).alias("term"), (end(at) - start).cast("bigint").alias("tf")))

    def runs(terms):
        places = F.when(F.size(terms) > 0, F.sequence(F.lit(0), F.size(terms) - 1))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1)))
        return F.flatten(F.transform(F.array(starts), lambda found: lengths(terms, found)))

    # One-element arrays bind what is used more than once, as in ``ngrams``.
    return F.flatten(F.transform(F.array(F.sort_array(ngrams(text, n))), runs))


def bag_of_words(df: DataFrame, key: str, text: str, n: int = 1) -> DataFrame:
    """Rows (key, term, tf): how often each n-gram of lower-case words occurs in the whole text.

    A text is counted where it lies and its terms are not shuffled. Keys with several texts are looked for first; only
    their counts are summed up by (key, term).
    """
    counted = lambda texts: texts.select(key, F.inline(term_counts(text, n)))
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(key)
    if not repeated.agg(F.count(F.lit(1))).first()[0]:
        return counted(df)
    summed = counted(join_on(df, repeated, [key], "left_semi")).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return counted(join_on(df, repeated, [key], "left_anti")).unionByName(summed)


def tfidf(df: DataFrame, key: str, text: str, n: int = 1) -> DataFrame:
    """Rows (key, term, tf, df, tfidf) with tf * ln((N + 1) / (df + 1)); N counts all texts.

    Document frequencies are counted with partial sums per task. The join on the term has one row per (text, term) on one side, so a word
    of nearly all texts would be one huge task; the frequencies tell which terms these are, and theirs go to the rows.
    """
    counts = bag_of_words(df, key, text, n)
    # Summing min(tf, 1) instead of counting rows keeps all uses of the counts alike. Each use splits the texts anew, which takes
    # more time than one shuffle of all counts but moves half as much.
    frequency = counts.groupBy("term").agg(F.sum(F.least("tf", F.lit(1))).alias("df"))
    texts = df.select(key).distinct().count()
    weight = F.col("tf") * F.log((F.lit(texts) + 1.0) / (F.col("df") + 1.0))
    weighted = join_split(counts, frequency, "term", frequency.select("term", F.col("df").alias("n")))
    return weighted.select(key, "term", "tf", "df", weight.alias("tfidf"))
