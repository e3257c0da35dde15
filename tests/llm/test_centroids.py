import hashlib
import math
import random

import numpy as np
import pytest

from marlstone.llm.centroids import DIMS, cluster_vectors, coefficients, nearest, sign_change_order, transform

SCHEMA = "vec_id long, embedding array<float>"


def plain_clusters(rows, clusters=8, rounds=10, seed=3):
    """Brute force in Python integers: ``(id, cluster, distance, cluster_inertia, inertia, centroid)``."""
    vectors = []
    for i, v in rows:
        if v is not None and len(v) == DIMS and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centres = [v for _, v in sorted(vectors, key=lambda r: (digest(r[0]), r[1]))[:clusters]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((apart(v, c), k) for k, c in enumerate(centres)) for _, v in vectors]
    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(vectors, found) if c == k]
            if mine:
                centres[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centres))]
    return [(i, c, d, inertia[c], sum(inertia), centres[c]) for (i, _), (d, c) in zip(vectors, found)]


def run(spark, rows, **options):
    found = cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_transform_keeps_distances_and_orders_by_sign_changes():
    points = np.array([[random.Random(i * 64 + j).randrange(-1000, 1000) for j in range(DIMS)] for i in range(20)])
    gaps = transform(points)[1:] - transform(points)[:-1]
    assert ((gaps**2).sum(axis=1) == DIMS * ((points[1:] - points[:-1]) ** 2).sum(axis=1)).all()
    assert sorted(sign_change_order()) == list(range(DIMS))
    rows = coefficients(np.eye(DIMS, dtype="i8")).T
    assert [(np.diff(row) != 0).sum() for row in rows] == list(range(DIMS))


def test_search_is_exact_with_ties_and_leaves_work_out():
    chance = random.Random(5)
    centres = np.array([[chance.randrange(-300, 300) for _ in range(DIMS)] for _ in range(6)])
    centres[4] = centres[1]
    points = np.array([[int(x) + chance.randrange(-40, 40) for x in centres[i % 6]] for i in range(300)] + [[0] * DIMS])
    found, distance, skipped = nearest(points, centres)
    apart = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert 4 not in found and skipped > 0
    none, _, _ = nearest(points[:0], centres)
    assert len(none) == 0


def test_wide_numbers_are_exact():
    points = np.array([[(1 << 26) + i * j for j in range(DIMS)] for i in range(5)])
    centres = points[::2] - 3
    found, distance, _ = nearest(points, centres)
    apart = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, c)) for c in centres] for p in points]
    assert found.tolist() == [row.index(min(row)) for row in apart] and [int(d) for d in distance] == [min(row) for row in apart]


def test_rows_equal_brute_force(spark):
    chance = random.Random(7)
    near = [[chance.uniform(-1, 1) for _ in range(DIMS)] for _ in range(5)]
    rows = [(i, [x + chance.uniform(-0.2, 0.2) for x in near[i % 5]]) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(70)]  # a vector that holds a third of the rows
    rows += [(3, rows[3][1]), (None, rows[4][1]), (None, None), (900, None), (901, []), (902, rows[0][1][:63]), (903, rows[0][1] + [0.5])]
    rows += [(904, [None] + rows[0][1][1:]), (905, [float("nan")] + rows[0][1][1:]), (906, [float("inf")] + rows[0][1][1:])]
    assert run(spark, rows) == sorted(plain_clusters(rows), key=repr)


@pytest.mark.parametrize("count", [0, 3, 8])
def test_few_vectors(spark, count):
    rows = [(i, [float(i)] * DIMS) for i in range(count)]
    assert run(spark, rows) == sorted(plain_clusters(rows), key=repr)


def test_other_columns_and_types(spark):
    rows = [(i, [i / 7 + j / 64 for j in range(DIMS)], "x", i) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance long")
    found = cluster_vectors(df, clusters=2, rounds=3)
    assert found.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and found.count() == 20


def test_numbers_that_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="after scaling"):
        run(spark, [(1, [3.0e38] * DIMS)])
