"""Centroid clustering of integer vectors with a progressive search in Walsh-Hadamard space.

Vectors of ``DIMS`` components become integers; vectors and centroids go through the exact integer transform, whose coefficients are put in
the order of their sign changes, coarse ones first. The transform keeps distances up to the factor ``DIMS``, so the sum over the first
coefficients never exceeds the whole. Each vector finishes the centroid that looks nearest on the coarsest coefficients. The others gather
coefficient differences coarse to fine and leave as soon as their sum is strictly above the finished one; those that stay
finish all coefficients. So the nearest centroid and ties (smaller number) are exact.

The integer vectors are written once. A round is one pass over them: each task gives back at most one row of sums per centroid, Spark adds
them up and the driver divides, ``k`` rows of ``DIMS`` numbers. A round that moves nothing ends the rounds, as all later ones would do the same.

Defined cases: a vector that is null, has another number of components or holds a null, NaN or infinity is left out; null ids stay,
and are starting points last; rows may repeat; fewer than ``k`` vectors give fewer centroids; an empty table gives no rows;
other columns are ignored. Numbers that do not fit (a component of 2**52 or more after scaling, a distance or sum above a long) are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.storage import keep, map_arrow

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
#: Coefficients are compared up to these places.
STEPS = (1, 2, 4, 8, 16, 32, 64)
#: Components below this keep every sum of squared coefficients within 64 bits; others are worked on as Python integers.
NARROW = 1 << 23
LARGEST = 1 << 52


def sign_change_order(size: int = DIMS) -> np.ndarray:
    """The rows of the natural transform by their number of sign changes."""
    rows = transform(np.eye(size, dtype="i8"))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def transform(vectors: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix by sums and differences; exact for integers (or Python integers as objects)."""
    found, size = vectors.copy(), vectors.shape[1]
    half = 1
    while half < size:
        pairs = found.reshape(len(found), size // (2 * half), 2, half)
        found = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(found.shape)
        half *= 2
    return found


_ORDER = sign_change_order()


def coefficients(vectors: np.ndarray) -> np.ndarray:
    return transform(vectors)[:, _ORDER]


def nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of the nearest centre of each vector, its squared distance, and how many coefficient differences were left out."""
    wide = max(abs(int(v)) for a in (vectors, centres) if a.size for v in (a.max(), a.min())) >= NARROW if vectors.size else False
    kind = object if wide else np.int64
    points, marks = coefficients(vectors.astype(kind)), coefficients(centres.astype(kind))
    n, k = len(points), len(marks)
    sums = np.zeros((n, k), kind)
    open_ = np.ones((n, k), bool)
    everyone = np.arange(n)
    finished = np.full(n, -1)
    most = None
    skipped, low = 0, 0
    for high in STEPS:
        for c in range(k):
            rows = np.flatnonzero(open_[:, c] & (finished != c))
            gap = points[rows, low:high] - marks[c, low:high]
            sums[rows, c] += (gap * gap).sum(axis=1)
        if most is None:
            finished = sums.argmin(axis=1) if kind is not object else np.array([min(range(k), key=row.__getitem__) for row in sums], int)
            gap = points[:, high:] - marks[finished, high:]
            sums[everyone, finished] += (gap * gap).sum(axis=1)
            most = sums[everyone, finished]
        worse = open_ & (sums > most[:, None]).astype(bool)
        skipped += int(worse.sum()) * (STEPS[-1] - high)
        open_ &= ~worse
        low = high
    # What is open is complete; a closed one lies strictly above the finished one, so it is neither nearest nor tied.
    best = np.full(n, -1)
    least = most.copy()
    for c in range(k):
        rows = np.flatnonzero(open_[:, c])
        closer = rows[((sums[rows, c] < least[rows]) | ((best[rows] < 0) & (sums[rows, c] == least[rows]))).astype(bool)]
        best[closer], least[closer] = c, sums[closer, c]
    return best, least // DIMS, skipped


def as_integers(vector: str | Column) -> Column:
    """``floor(SCALE * x)`` of all components as longs, null for vectors that do not count."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    whole = lambda x: F.floor(x.cast("double") * SCALE)
    fits = lambda x: F.abs(x.cast("double") * SCALE) < LARGEST
    known = F.when((F.size(vector) == DIMS) & F.forall(vector, finite), vector)
    error = F.raise_error(F.lit(f"a component of {LARGEST} or more after scaling")).cast("array<bigint>")
    return F.when(known.isNotNull(), F.when(F.forall(known, fits), F.transform(known, whole)).otherwise(error))


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("i8").reshape(len(column), DIMS)


SUMS = T.StructType(
    [T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("inertia", T.LongType())]
    + [T.StructField(f"c{i}", T.LongType()) for i in range(DIMS)]
)


def cluster_sums(vectors: DataFrame, centres: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Per centre with a vector: their count, the distances added up and the component sums."""
    matrix = np.array(centres, "i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(matrix)
        counts, inertia, totals = [0] * k, [0] * k, [[0] * DIMS for _ in range(k)]
        for batch in batches:
            rows = _rows(batch.column(0))
            found, distance, _ = nearest(rows, matrix)
            for c in np.unique(found).tolist():
                mine = found == c
                counts[c] += int(mine.sum())
                inertia[c] += sum(distance[mine].tolist())
                totals[c] = [a + b for a, b in zip(totals[c], _sums(rows[mine]), strict=True)]
        held = [c for c in range(k) if counts[c]]
        if held:
            columns = [held, [counts[c] for c in held], [inertia[c] for c in held], *([totals[c][i] for c in held] for i in range(DIMS))]
            kinds = [pa.int32(), *[pa.int64()] * (DIMS + 2)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names=SUMS.names)

    parts = map_arrow(vectors.select("vector"), run, SUMS)
    totals = parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in SUMS.names[1:]])
    return {r[0]: (r[1], r[2], list(r[3:])) for r in totals.collect()}


def _sums(rows: np.ndarray) -> list[int]:
    """Exact sums per component: the halves of the numbers are added up apart."""
    high, low = (rows >> 26).sum(axis=0).tolist(), (rows & ((1 << 26) - 1)).sum(axis=0).tolist()
    return [(h << 26) + l for h, l in zip(high, low, strict=True)]


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3
) -> DataFrame:
    """One row per vector that counts: ``id, cluster, distance, cluster_inertia, inertia, centroid``.

    The starting centroids are the vectors with the smallest SHA-256 of ``<seed>:<id>``.
    """
    vectors = df.select(F.col(id_col).alias("id"), as_integers(vector_col).alias("vector")).where(F.col("vector").isNotNull())
    vectors = keep(vectors, "centroid-vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = vectors.select("vector", digest.alias("digest")).orderBy(F.asc_nulls_last("digest"), "vector").limit(clusters)
    centres = [list(r["vector"]) for r in starts.collect()]
    for _ in range(rounds if centres else 0):
        moved = list(centres)
        for c, (n, _, totals) in cluster_sums(vectors, centres).items():
            moved[c] = [total // n for total in totals]
        if moved == centres:
            break
        centres = moved
    found = cluster_sums(vectors, centres) if centres else {}
    return _assigned(vectors, centres, {c: inertia for c, (_, inertia, _) in found.items()})


def _assigned(vectors: DataFrame, centres: list[list[int]], inertia: dict[int, int]) -> DataFrame:
    matrix = np.array(centres, "i8")
    schema = T.StructType([vectors.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, distance, _ = nearest(_rows(batch.column(1)), matrix)
            columns = [batch.column(0), pa.array(found, pa.int32()), pa.array(distance.tolist(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    if not centres:
        rows = vectors.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance"))
    else:
        rows = map_arrow(vectors.select("id", "vector"), run, schema)
    kinds = T.ArrayType(T.LongType()), T.ArrayType(T.ArrayType(T.LongType()))
    sums = F.lit([inertia.get(c, 0) for c in range(len(centres))]).cast(kinds[0])
    lists = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in centre]) for centre in centres]).cast(kinds[1])
    place = F.col("cluster") + 1
    return rows.select(
        "*",
        F.get(sums, place - 1).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.get(lists, place - 1).alias("centroid"),
    )
