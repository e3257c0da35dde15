import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from marlstone.models import neighbours
from marlstone.models.neighbours import (
    ProjectionIndex,
    approximate_neighbours,
    fit_angles,
    fit_projections,
    meet,
    neighbour_recall,
    pruned_neighbours,
    pruned_visits,
)
from marlstone.models.vectors import _best, _unit, nearest_neighbours
from tests.conftest import largest_reads, rows_of

SCHEMA = "id long, v array<double>"


def clustered(n, groups=12, dims=16, seed=3, spread=0.15):
    chance = random.Random(seed)
    middle = [[chance.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    return [(i, [x + chance.gauss(0, spread) for x in middle[i % groups]]) for i in range(n)]


def odd_rows(n=150):
    """Clusters, a vector that holds a third of all rows, zeros and vectors that do not count."""
    rows = clustered(n)
    rows += [(1000 + i, rows[5][1]) for i in range(n // 2)]
    rows += [(2000, [0.0] * 16), (2001, [0.0] * 16), (2002, None), (2003, [None] * 16), (2004, [math.nan] * 16), (2005, [-x for x in rows[0][1]])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def usable(df):
    return df.where("v is not null and not exists(v, x -> x is null or isnan(x))")


@pytest.mark.parametrize("k", [1, 4, 300])
def test_pruned_search_equals_the_plain_one(spark, k):
    df = frame(spark, odd_rows())
    assert rows_of(pruned_neighbours(df, df, "id", "v", k)) == rows_of(nearest_neighbours(usable(df), usable(df), "id", "v", k))


def test_pruned_search_with_small_parts_and_other_queries(spark):
    df = frame(spark, odd_rows())
    queries = frame(spark, [(i + 5000, v) for i, v in clustered(20, seed=9)] + [(5, odd_rows()[5][1])])
    found = pruned_neighbours(queries, df, "id", "v", 3, block_rows=7, query_rows=3)
    assert rows_of(found) == rows_of(nearest_neighbours(queries, usable(df), "id", "v", 3))


def test_blocks_are_skipped_where_vectors_lie_in_groups(spark):
    df = frame(spark, clustered(400))
    index = fit_angles(df, "id", "v", centres=12, rings=3)
    _, more = pruned_visits(df, df, "id", "v", 5, index)
    blocks = len(index.blocks)
    first = index.first(_unit([v for _, v in clustered(400)]), 5).sum()
    assert index.rows.sum() == 400 and blocks > 12
    # Of all pairs of a query and a block, four fifths are never met: a query needs most blocks of its own group only.
    assert more.count() + first < 400 * blocks / 5


def test_bounds_hold_for_every_row():
    chance = np.random.default_rng(4)
    points = chance.standard_normal((300, 8))
    points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
    middle = points[:6]
    index = neighbours.AngleIndex(middle, np.sort(chance.random((6, 2)), axis=1), *[np.zeros(0)] * 4)
    block, angle = index.places(points)
    known = np.unique(block)
    index = neighbours.AngleIndex(
        middle, index.rings, known, np.array([angle[block == b].min() for b in known]), np.array([angle[block == b].max() for b in known]), np.ones(len(known))
    )
    bounds, similarity = index.bounds(points), points @ points.T
    for j, b in enumerate(known):
        assert (similarity[:, block == b].max(axis=1) <= bounds[:, j] + 1e-12).all()


def test_no_pair_of_parts_is_larger_than_stated(spark):
    rows = [(i, [1.0, float(i % 3)], 0) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v array<double>, block bigint")
    # The sizes of the parts that the block is cut into.
    parts = math.ceil(500 / 40)
    counted = df.selectExpr(f"pmod(xxhash64(id, 2), {parts}) as part").groupBy("part").count().collect()
    seen = [r["count"] for r in counted]
    assert len(seen) == parts and max(seen) <= 80 and sum(seen) == 500
    found = meet(df.where("id < 9"), df, 3, block_rows=40, query_rows=2)
    # Every part of the base gives its own three best.
    assert found.groupBy("query_id").count().agg({"count": "max"}).first()[0] == 3 * parts


def test_probes_are_the_nearest_buckets_and_reach_all():
    chance = np.random.default_rng(1)
    index = ProjectionIndex(chance.standard_normal((5, 8)), chance.standard_normal(5) / 9, 1, 0.0)
    points = chance.standard_normal((40, 8))
    probed = index.probed(points, 32)
    assert (probed[:, 0] == index.buckets(points)).all()
    assert all(sorted(row) == list(range(32)) for row in probed)
    margins = index.margins(points)
    for row, margin in zip(probed, margins):
        cost = [sum(margin[b] ** 2 for b in range(5) if (bucket ^ row[0]) >> b & 1) for bucket in row]
        assert cost == sorted(cost)


def test_approximate_search_finds_most_and_invents_nothing(spark):
    df = frame(spark, odd_rows(900))
    found = approximate_neighbours(df, df, "id", "v", 10).cache()
    exact = nearest_neighbours(usable(df), usable(df), "id", "v", 10)
    assert neighbour_recall(found, exact).first()["recall"] >= 0.9
    told = {(r.query_id, r.base_id): r.similarity for r in nearest_neighbours(usable(df), usable(df), "id", "v", 2000).collect()}
    assert all(told[r.query_id, r.base_id] == r.similarity for r in found.collect())
    assert found.count() == found.select("query_id", "base_id").distinct().count()


def test_few_rows_are_looked_at_where_vectors_lie_in_groups(spark):
    rows = clustered(1500, groups=60, dims=32)
    index = fit_projections(frame(spark, rows), "id", "v", 10)
    points = _unit([v for _, v in rows])
    filled = np.bincount(index.buckets(points), minlength=1 << len(index.cuts))
    assert filled[index.probed(points)].sum(axis=1).mean() < len(rows) / 5 and index.sample_recall >= 0.95


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, folder):
    vectors = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    queries = vectors.where("vec_id % 50 = 0")
    index = fit_projections(vectors, "vec_id", "embedding", 10)
    found = approximate_neighbours(queries, vectors, "vec_id", "embedding", 10, index)
    told = neighbour_recall(found, nearest_neighbours(queries, vectors, "vec_id", "embedding", 10)).first()
    assert told["recall"] >= 0.9 and told["queries"] == queries.count()
    # Not by looking everywhere.
    assert index.probes < 1 << len(index.cuts)


def test_the_sample_is_bounded_and_every_row_is_indexed(spark):
    df = frame(spark, clustered(300))
    index = fit_projections(df, "id", "v", 5, sample_rows=40)
    found = approximate_neighbours(df, df, "id", "v", 5, index)
    assert found.select("query_id").distinct().count() == 300
    assert found.select("base_id").distinct().count() > 200


def test_empty_and_tiny_tables(spark):
    none, one = frame(spark, []), frame(spark, [(1, [1.0, 2.0])])
    for search in (pruned_neighbours, approximate_neighbours):
        assert search(none, none, "id", "v", 3).collect() == []
        assert search(one, one, "id", "v", 3).collect() == []
        assert search(none, one, "id", "v", 3).collect() == []
        two = frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])
        assert rows_of(search(two, two, "id", "v", 3)) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]


def loose(n, dims=16, seed=5):
    chance = np.random.default_rng(seed)
    return [(i, [float(x) for x in v]) for i, v in enumerate(chance.standard_normal((n, dims)))]


def test_vectors_without_structure_need_no_more_probes_than_stated(spark):
    df = frame(spark, loose(2000))
    index = fit_projections(df, "id", "v", 10, bucket_rows=1)
    assert index.probes <= neighbours.MOST_PROBES and index.sample_recall >= 0.95
    found = approximate_neighbours(df.where("id % 50 = 0"), df, "id", "v", 10, index)
    assert neighbour_recall(found, nearest_neighbours(df.where("id % 50 = 0"), df, "id", "v", 10)).first()["recall"] >= 0.9


def _largest_held(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_search_holds_few_similarities_at_a_time():
    chance = np.random.default_rng(6)
    asked, points = _unit(chance.standard_normal((1024, 8))), _unit(chance.standard_normal((16_384, 8)))
    assert _largest_held(lambda: _best(np.arange(1024), asked, np.arange(16_384), points, 10)) < 64e6


class _Asks:
    """Stands for a table of queries; keeps the function that its rows would go through."""

    schema = {"v": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda self: "array<double>"})()})()}

    def mapInPandas(self, run, schema):
        self.run = run
        return self

    def select(self, *columns):
        return self


def test_copies_of_queries_are_never_made_in_python():
    points = _unit(np.random.default_rng(7).standard_normal((1024, 64)))
    none = np.zeros(256)
    index = neighbours.AngleIndex(points[:64], np.zeros((64, 3)), np.arange(256), none, none + 4, none.astype(int))
    asks = _Asks()
    neighbours._visits(asks, index, lambda p, _: index.bounds(p) >= -1)
    batch = pd.DataFrame({"id": np.arange(1024), "v": list(points)})
    given = list(asks.run(iter([batch])))
    assert sum(len(g) for g in given) == 1024 and all(len(b) == 256 for g in given for b in g["blocks"])


@pytest.mark.parametrize("broadcast_numbers", [10**9, 0])
def test_search_over_many_batches_equals_brute_force(spark, broadcast_numbers):
    rows = [(i, v) for i, v in clustered(60, dims=4)] + [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(30)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = frame(spark, rows)
        found = rows_of(nearest_neighbours(df, df, "id", "v", 9, broadcast_numbers=broadcast_numbers, block_rows=40), "query_id", "place", "base_id")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    points = _unit([v for _, v in rows])
    wanted = []
    for i, (query, _) in enumerate(rows):
        near = sorted((-round(float(points[i] @ points[j]), 12), base) for j, (base, _) in enumerate(rows) if base != query)[:9]
        wanted += [(query, place, base) for place, (_, base) in enumerate(near, 1)]
    assert found == sorted(wanted, key=repr)


def test_a_null_id_among_the_rows_is_still_found(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], SCHEMA)
    found = nearest_neighbours(df.where("id = 1"), df, "id", "v", 2).orderBy("place").collect()
    assert [r["base_id"] for r in found] == [None, 2]


def test_parts_hold_whole_blocks_or_shares_of_a_large_one():
    first, several = neighbours.block_parts(np.array([3, 4, 3, 25, 2, 9, 10, 0]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 5, 6, 6]
    assert several.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]
    assert [v.tolist() for v in neighbours.block_parts(np.zeros(0, "int64"), 10)] == [[], []]


def test_open_blocks_do_not_make_copies_of_queries(spark):
    """Vectors without structure leave most blocks open; what is shuffled must not grow with their number."""
    df = spark.createDataFrame(loose(1500, 16), SCHEMA).repartition(3)
    index = fit_angles(df, "id", "v")
    _, visits = pruned_visits(df, df, "id", "v", 5, index)
    assert visits.count() > 1500 * 60
    largest, found = largest_reads(spark, lambda: rows_of(pruned_neighbours(df, df, "id", "v", 5, index)))
    assert found == rows_of(nearest_neighbours(df, df, "id", "v", 5))
    assert largest < 1500 * 10


def test_repeated_ids_and_large_blocks_in_small_tiles(spark):
    rows = odd_rows()[:220] + odd_rows()[:40] + [(i, v) for i, v in clustered(9, seed=4)]
    df = frame(spark, rows)
    found = pruned_neighbours(df, df, "id", "v", 4, fit_angles(df, "id", "v", centres=12, rings=3), block_rows=16, query_rows=50)
    assert rows_of(found) == rows_of(nearest_neighbours(df, df, "id", "v", 4))


def test_few_numbers_of_a_tile_stay_in_memory():
    assert neighbours.tile_rows(10_000_000, 64) * 64 <= neighbours.TILE_NUMBERS
    assert neighbours.tile_rows(51_282, 64) == math.ceil(51_282 / neighbours.TILE_SIDES)
    assert neighbours.tile_rows(200, 64) == neighbours.STEP_ROWS
    assert neighbours.tile_rows(100, neighbours.TILE_NUMBERS * 2) == 1
