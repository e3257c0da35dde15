"""Centroids, nearest neighbours and projections for vector columns (arrays of numbers)."""

from __future__ import annotations

import sys
from math import ceil

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import whole_vector

# Python workers get the helpers below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_STATE_NUMBERS = 20_000_000
#: Similarities that a task holds at a time.
MATRIX_NUMBERS = 1 << 20


def fit_centroids(train: DataFrame, vector: str, label: str) -> list[tuple[object, list[float]]]:
    """Mean vector per label, as (label, vector) pairs in label order.

    MLlib's summarizer adds vectors up in the map tasks, so a large class is one partial sum per task.
    """
    known = train.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    means = known.groupBy(label).agg(Summarizer.mean(array_to_vector(vector)).alias("mean"))
    means = means.select(label, vector_to_array("mean").alias("mean")).persist()
    numbers = means.agg(F.coalesce(F.sum(F.size("mean")), F.lit(0))).first()[0]
    if numbers > MAX_STATE_NUMBERS:
        means.unpersist()
        raise ValueError(f"{numbers} numbers of centroids are too many to send to every task")
    rows = sorted((r[label], list(r["mean"])) for r in means.collect())
    means.unpersist()
    return rows


def fit_centroid_table(train: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean vector per label as a table ``label, mean``, for any number of labels; rows without a label or with a hole in the vector are left out."""
    known = train.where(F.col(label).isNotNull() & whole_vector(vector))
    means = known.groupBy(label).agg(Summarizer.mean(array_to_vector(vector)).alias("mean"))
    return means.select(F.col(label).alias("label"), vector_to_array("mean").alias("mean"))


def assign_nearest_table(
    df: DataFrame, centroids: DataFrame, key: str, vector: str, out: str = "pred", block_numbers: int = 1_000_000, part_rows: int = 65_536
) -> DataFrame:
    """The rows with the label of the nearest centroid of a table (ties to the smaller label) and ``<out>_distance``, as ``assign_nearest``.

    Centroids are cut into blocks of about ``block_numbers`` numbers and rows into parts; each pair of a part and a block is a group of its own,
    which gives back one row per vector, so that neither side ever has to fit anywhere whole. ``key`` identifies the rows.
    """
    told = centroids.agg(F.count("label"), F.max(F.size("mean"))).first()
    blocks = max(1, ceil(told[0] * (told[1] or 1) / block_numbers))
    known = df.where(whole_vector(vector)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    parts = max(1, ceil(known.count() / part_rows))
    kind = centroids.schema["label"].dataType.simpleString()
    hashed = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = known.withColumn("part", hashed("id", parts)).withColumn("block", every(blocks))
    centres = centroids.withColumn("block", hashed("label", blocks)).withColumn("part", every(parts))

    def nearest(points, means):
        if points.empty or means.empty:
            return pd.DataFrame({"id": points["id"][:0], "distance": np.zeros(0), "label": means["label"][:0].reset_index(drop=True)})
        means = means.sort_values("label")
        held = np.stack(points["v"].to_list())
        place, best = np.zeros(len(held), "int64"), np.full(len(held), np.inf)
        for i, mean in enumerate(means["mean"]):
            gap = ((held - mean) ** 2).sum(axis=1)
            closer = gap < best
            place[closer], best[closer] = i, gap[closer]
        return pd.DataFrame({"id": points["id"], "distance": best, "label": means["label"].to_numpy()[place]})

    schema = f"id {known.schema['id'].dataType.simpleString()}, distance double, label {kind}"
    found = rows.groupBy("part", "block").cogroup(centres.groupBy("part", "block")).applyInPandas(nearest, schema)
    best = found.groupBy(F.col("id").alias("_id")).agg(F.min(F.struct("distance", "label")).alias("_best"))
    joined = df.join(best, F.col(key) == F.col("_id"), "left")
    return joined.select(*df.columns, F.col("_best.label").alias(out), F.col("_best.distance").alias(f"{out}_distance"))


def assign_nearest(df: DataFrame, centroids: list[tuple[object, list[float]]], vector: str, out: str = "pred") -> DataFrame:
    """Add the label of the nearest centroid (ties to the first) and ``<out>_distance``, its squared distance.

    A vector that is null or holds a null or NaN gets neither.
    """
    matrix = np.array([mean for _, mean in centroids], dtype="float64")

    @F.pandas_udf("struct<place:int,distance:double>")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        place = np.full(len(vectors), -1, dtype="int32")
        distance = np.full(len(vectors), np.nan)
        held = np.array([v is not None and not np.isnan(np.asarray(v, "float64")).any() for v in vectors], bool)
        if held.any():
            points = np.stack(vectors[held].to_list()).astype("float64")
            nearest_yet, best = np.zeros(len(points), "int32"), np.full(len(points), np.inf)
            for i, centre in enumerate(matrix):
                gap = ((points - centre) ** 2).sum(axis=1)
                closer = gap < best
                nearest_yet[closer], best[closer] = i, gap[closer]
            place[held], distance[held] = nearest_yet, best
        return pd.DataFrame({"place": place, "distance": distance})

    names = F.array(*[F.lit(label) for label, _ in centroids])
    marked = df.withColumn("_near", nearest(F.col(vector)))
    return marked.select(
        *df.columns,
        F.when(F.col("_near.place") >= 0, F.element_at(names, F.col("_near.place") + 1)).alias(out),
        F.when(F.col("_near.place") >= 0, F.col("_near.distance")).alias(f"{out}_distance"),
    )


def kmeans_step(df: DataFrame, centroids: list[tuple[object, list[float]]], vector: str) -> DataFrame:
    """One assign-and-update step: rows (cluster, n, cost, mean) of the clusters that got a point."""
    marked = assign_nearest(df.where(whole_vector(vector)), centroids, vector, "cluster")
    return marked.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cluster_distance").alias("cost"),
        vector_to_array(Summarizer.mean(array_to_vector(vector))).alias("mean"),
    )


def fit_kmeans(df: DataFrame, vector: str, k: int, seed: int = 7, rounds: int = 20) -> KMeansModel:
    """MLlib k-means (scalable initialization); the vectors are kept in memory for its passes."""
    data = df.where(whole_vector(vector)).select(array_to_vector(vector).alias("features")).persist()
    try:
        return KMeans(k=k, seed=seed, maxIter=rounds).fit(data)
    finally:
        data.unpersist()


def apply_kmeans(df: DataFrame, model: KMeansModel, vector: str, out: str = "cluster") -> DataFrame:
    """Add the cluster; null where the vector is null or holds a null or NaN."""
    marked = df.withColumn("features", array_to_vector(_or_zeros(vector, len(model.clusterCenters()[0]))))
    found = model.setPredictionCol(out).transform(marked).drop("features")
    return found.withColumn(out, F.when(whole_vector(vector), F.col(out)))


def _or_zeros(vector: str, dims: int):
    """MLlib takes no missing vectors; what becomes of the zeros is not used."""
    zeros = F.array_repeat(F.lit(0.0), dims)
    return F.when(whole_vector(vector), F.col(vector).cast("array<double>")).otherwise(zeros)


def pca(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """Rows (key, projection) on the first ``k`` components; each component's largest loading is positive.

    Vectors that are null or hold a null or NaN are not fitted and have a null projection.
    """
    known = df.where(whole_vector(vector)).select(array_to_vector(vector).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="projected").fit(known)
    loadings = model.pc.toArray()
    data = df.select(key, whole_vector(vector).alias("_whole"), array_to_vector(_or_zeros(vector, len(loadings))).alias("features"))
    signs = [1.0 if column[np.abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    turned = F.transform(
        F.arrays_zip(vector_to_array("projected").alias("p"), F.array(*[F.lit(s) for s in signs]).alias("s")),
        lambda cell: cell["p"] * cell["s"],
    )
    return model.transform(data).select(key, F.when(F.col("_whole"), turned).alias("projection"))


def _unit(vectors) -> np.ndarray:
    points = np.stack(list(vectors)).astype("float64")
    length = np.sqrt((points**2).sum(axis=1, keepdims=True))
    return np.divide(points, length, out=np.zeros_like(points), where=length > 0)


def _chunks(queries: int, rows: int):
    """Slices of the queries that meet ``rows`` rows in at most ``MATRIX_NUMBERS`` numbers, or one query at a time."""
    step = max(1, MATRIX_NUMBERS // max(rows, 1))
    return (slice(low, low + step) for low in range(0, queries, step))


def _best_places(query_ids, query_points, base_ids, base_points, k):
    """Row, place among the row's k best, base id and similarity of the best pairs of one matrix, in that order; ties to the smaller id.

    Similarities are rounded to 12 places: matrix products of equal vectors can differ in the last bits, and copies should tie.
    """
    similarity = query_points @ base_points.T
    similarity[query_ids[:, None] == base_ids[None, :]] = -np.inf
    width = min(k, similarity.shape[1])
    if width < similarity.shape[1]:
        floor = np.partition(similarity, -width, axis=1)[:, -width]
    else:
        floor = np.full(len(query_ids), -np.inf)
    # Only what may round to the k-th best or more is rounded.
    row, column = np.nonzero((similarity >= floor[:, None] - 2e-12) & (similarity > -np.inf))
    return _placed(row, base_ids[column], np.round(similarity[row, column], 12), np.round(floor, 12), width)


def _better(query_ids, query_points, base_ids, base_points, k, least):
    """As ``_best_places``, of those that are ``least`` (one for each query, rounded) or more."""
    similarity = query_points @ base_points.T
    row, column = np.divmod(np.flatnonzero(similarity >= least[:, None] - 2e-12), len(base_ids))
    other = query_ids[row] != base_ids[column]
    row, column = row[other], column[other]
    return _placed(row, base_ids[column], np.round(similarity[row, column], 12), least, min(k, len(base_ids)))


def _placed(row, base, value, floor, width):
    """The ``width`` best per row of those that reach the row's floor, with their places."""
    high = value >= floor[row]
    row, value, base = row[high], value[high], base[high]
    order = np.lexsort((base, -value, row))
    row, value, base = row[order], value[order], base[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < width
    return row[kept], place[kept], base[kept], value[kept]


def _best(query_ids, query_points, base_ids, base_points, k):
    """The k best base rows per query; ties to the smaller id. Matrices are bounded, whatever the number of rows."""
    found = []
    for part in _chunks(len(query_ids), len(base_ids)):
        row, _, base, value = _best_places(query_ids[part], query_points[part], base_ids, base_points, k)
        found.append((query_ids[part][row], base, value))
    if not found:
        return pd.DataFrame({"query_id": [], "base_id": [], "similarity": []}).astype({"query_id": "int64", "base_id": "int64"})
    columns = [np.concatenate(parts) for parts in zip(*found)]
    return pd.DataFrame(dict(zip(("query_id", "base_id", "similarity"), columns)))


class _Kept:
    """The k best rows per query out of several batches, in two arrays that are changed in place."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.ids, self.values = np.zeros((queries, 0), "int64"), np.zeros((queries, 0))

    def make_room(self, base_ids) -> None:
        """For the rows of one more batch; ids with a null among them are doubles."""
        more = min(self.k - self.ids.shape[1], len(base_ids))
        if more:
            self.ids = np.pad(self.ids, ((0, 0), (0, more)))
            self.values = np.pad(self.values, ((0, 0), (0, more)), constant_values=-np.inf)
        self.ids = self.ids.astype(np.result_type(self.ids, base_ids), copy=False)

    def add(self, part: slice | np.ndarray, row, place, base, value) -> None:
        ids, values = np.zeros_like(self.ids[part]), np.full_like(self.values[part], -np.inf)
        ids[row, place], values[row, place] = base, value
        ids, values = np.hstack([self.ids[part], ids]), np.hstack([self.values[part], values])
        order = np.lexsort((ids, -values), axis=1)[:, : self.ids.shape[1]]
        self.ids[part], self.values[part] = np.take_along_axis(ids, order, axis=1), np.take_along_axis(values, order, axis=1)

    def frames(self, query_ids, rows: int = 4_096):
        for low in range(0, len(query_ids), rows):
            values = self.values[low : low + rows]
            row, place = np.nonzero(values > -np.inf)
            yield pd.DataFrame({"query_id": query_ids[low + row], "base_id": self.ids[low + row, place], "similarity": values[row, place]})


FOUND = "query_id bigint, base_id bigint, similarity double"


def nearest_neighbours(
    queries: DataFrame,
    base: DataFrame,
    key: str,
    vector: str,
    k: int,
    broadcast_numbers: int = MAX_STATE_NUMBERS,
    block_rows: int = 16_384,
) -> DataFrame:
    """Rows (query_id, place, base_id, similarity): exact cosine top-k, never the query itself.

    Every query meets every base vector as matrix products, but only k rows per query leave a task; pairs are
    never made into rows. Query vectors of up to ``broadcast_numbers`` numbers, summed up first, are sent to all
    tasks and the base is read where it lies. More queries are cut into blocks, and each block of queries meets
    each block of the base in a task of its own. Either way the k best of all parts are merged at the
    end; the row_number limit lets Spark keep k rows per query in each map task.
    """
    data_q = queries.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))
    data_b = base.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))
    n_queries, numbers = data_q.agg(F.count("id"), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    if numbers <= broadcast_numbers:
        parts = _against_all(data_q, data_b, k)
    else:
        parts = _block_by_block(data_q, data_b, k, ceil(n_queries / block_rows), ceil(max(data_b.count(), 1) / block_rows))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "base_id")
    ranked = parts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return ranked.select("query_id", "place", "base_id", "similarity")


def _against_all(queries, base, k):
    held = queries.orderBy("id").toPandas()
    if held.empty:
        return queries.sparkSession.createDataFrame([], FOUND)
    # In the numbers' own type, half as large as doubles for floats; lengths are taken chunk by chunk.
    shared = queries.sparkSession.sparkContext.broadcast((held["id"].to_numpy(), np.stack(held["v"].to_list())))

    def search(batches):
        ids, points = shared.value
        kept = _Kept(len(ids), k)
        for batch in batches:
            if len(batch):
                base_ids, base_points = batch["id"].to_numpy(), _unit(batch["v"])
                kept.make_room(base_ids)
                for part in _chunks(len(ids), len(batch)):
                    kept.add(part, *_best_places(ids[part], _unit(points[part]), base_ids, base_points, k))
        yield from kept.frames(ids)

    return base.mapInPandas(search, FOUND)


def _block_by_block(queries, base, k, query_blocks, base_blocks):
    def block(n):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("qb", block(query_blocks)).withColumn("bb", every(base_blocks))
    right = base.withColumn("bb", block(base_blocks)).withColumn("qb", every(query_blocks))

    def search(left_part, right_part):
        if left_part.empty or right_part.empty:
            return pd.DataFrame({"query_id": [], "base_id": [], "similarity": []})
        return _best(left_part["id"].to_numpy(), _unit(left_part["v"]), right_part["id"].to_numpy(), _unit(right_part["v"]), k)

    return left.groupBy("qb", "bb").cogroup(right.groupBy("qb", "bb")).applyInPandas(search, FOUND)
