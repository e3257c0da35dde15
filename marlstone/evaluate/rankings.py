"""Tables for rankings and clusterings."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import divide, join_on, whole_vector


def ranking_report(df: DataFrame, query: str, item: str, score: str, relevant: str, k: int, wanted: DataFrame | None = None) -> DataFrame:
    """Per query: precision, average precision, NDCG and reciprocal rank of its k best items.

    ``relevant`` is 0 or 1; ties in the score go to the smaller item. The row_number limit lets Spark keep k
    rows per query and map task, so a query with very many candidates stays cheap. Average
    precision divides by min(k, relevant items of the query). Where ``df`` holds the judged items only, ``wanted`` (``query, wanted``) gives
    each query's relevant items among all.
    """
    best = Window.partitionBy(query).orderBy(F.desc(score), item)
    top = df.select(query, item, score, F.col(relevant).cast("int").alias("rel")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    seen = Window.partitionBy(query).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = top.withColumn("hits", F.sum("rel").over(seen))
    per_query = hits.groupBy(query).agg(
        F.sum("rel").alias("found"),
        F.sum(F.when(F.col("rel") == 1, F.col("hits") / F.col("place")).otherwise(0.0)).alias("ap"),
        F.sum(F.col("rel") / F.log2(F.col("place") + 1.0)).alias("dcg"),
        F.min(F.when(F.col("rel") == 1, F.col("place"))).alias("first_hit"),
    )
    if wanted is None:
        wanted = df.groupBy(query).agg(F.sum(F.col(relevant).cast("bigint")).alias("wanted"))
    joined = join_on(per_query, wanted, [query])
    possible = F.least("wanted", F.lit(k))
    gains = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: 1.0 / F.log2(i + 1.0))
    ideal = F.aggregate(F.slice(gains, F.lit(1), possible.cast("int")), F.lit(0.0), lambda a, g: a + g)
    zero = F.lit(0.0)
    return joined.select(
        query,
        (F.col("found") / F.lit(float(k))).alias("precision"),
        divide(F.col("ap"), possible, zero).alias("average_precision"),
        divide(F.col("dcg"), ideal, zero).alias("ndcg"),
        F.coalesce(1.0 / F.col("first_hit"), zero).alias("reciprocal_rank"),
    )


def ranking_summary(report: DataFrame, query: str) -> DataFrame:
    """Means of the per-query measures in one row."""
    return report.agg(
        F.count(query).alias("queries"),
        *[F.avg(c).alias(f"mean_{c}") for c in ("precision", "average_precision", "ndcg", "reciprocal_rank")],
    )


def cluster_report(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """One row with rows, clusters, classes, purity and adjusted Rand index, from pair counts."""
    known = df.select(F.col(cluster).alias("a"), F.col(label).alias("b")).where("a is not null and b is not null")
    cells = known.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    margins = cells.groupingSets([["a", "b"], ["a"], ["b"]], "a", "b").agg(
        F.sum("c").alias("c"), F.max("c").alias("top"), F.grouping_id().alias("g")
    )
    pairs = F.col("c").cast("double") * (F.col("c") - 1) / 2
    both, in_a, in_b = (F.col("g") == 0), (F.col("g") == 1), (F.col("g") == 2)
    sums = margins.agg(
        F.coalesce(F.sum(F.when(both, F.col("c"))), F.lit(0)).alias("n"),
        F.count(F.when(in_a, 1)).alias("clusters"),
        F.count(F.when(in_b, 1)).alias("classes"),
        F.sum(F.when(in_a, F.col("top"))).alias("top"),
        F.sum(F.when(both, pairs)).alias("p_ab"),
        F.sum(F.when(in_a, pairs)).alias("p_a"),
        F.sum(F.when(in_b, pairs)).alias("p_b"),
    )
    n = F.col("n").cast("double")
    expected = divide(F.col("p_a") * F.col("p_b"), n * (n - 1) / 2)
    largest = (F.col("p_a") + F.col("p_b")) / 2
    return sums.select(
        "n",
        "clusters",
        "classes",
        divide(F.col("top"), n).alias("purity"),
        divide(F.col("p_ab") - expected, largest - expected).alias("adjusted_rand"),
    )


def silhouette(df: DataFrame, vector: str, cluster: str) -> float:
    """Mean silhouette with squared Euclidean distance; MLlib needs one pass over cluster sums."""
    known = df.where(whole_vector(vector) & F.col(cluster).isNotNull())
    data = known.select(array_to_vector(vector).alias("features"), F.col(cluster).cast("double").alias("prediction"))
    return ClusteringEvaluator().evaluate(data)
