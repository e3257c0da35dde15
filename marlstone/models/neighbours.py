"""Nearest neighbours through an index: an approximate one of random projections, and an exact one that skips blocks by their angles.

Either index cuts the base into blocks. It is fitted on a bounded sample (at most ``SAMPLE_ROWS`` vectors, those with the smallest hash of
their id), but every row gets its block. Queries are sent to the blocks they need, and a block that is met by many
or holds many rows is cut into parts, so that no task compares more than ``QUERY_ROWS`` queries with ``BLOCK_ROWS`` rows, whatever
the data: a vector that fills a third of the table is one block of many parts. Pairs are matrix products; only the k best per query leave a task.
The exact index leaves many blocks open, so its later visits are not copied block by block: blocks lie together in parts of many rows, and a
query goes to each part once, with a bit for every block that is still open (``meet_open``).

Vectors that are null or hold a null or NaN are left out; a vector of zeros has similarity 0 to all. Ids identify rows, ties go
to the smaller id, and similarities are rounded to 12 places, all as in ``nearest_neighbours``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import whole_vector
from marlstone.models.vectors import FOUND, _best, _better, _chunks, _Kept, _unit

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 4_096
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
#: Bits of the projection index, and of the bits with the smallest margins those that probes may flip.
MOST_BITS, FLIPPED_BITS = 20, 12
#: Buckets that a query looks into at most; where these hold too few of the nearest, buckets are made larger.
MOST_PROBES = 256
#: Rows that a bucket is meant to hold, where that takes no more probes.
BUCKET_ROWS = 16
#: Numbers that the vectors of one side of a tile may have (32 MB as doubles), and rows of the base that are multiplied at a time.
TILE_NUMBERS, STEP_ROWS = 1 << 22, 4_096
#: Either side is cut into so many parts, if they have ``STEP_ROWS`` rows or more: enough tiles for many tasks, few enough copies.
TILE_SIDES = 8
#: Angles are compared with this much to spare (radians), far above the rounding of a dot product near 1.
SPARE = 1e-6


def _plain(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where(whole_vector(vector) & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))


def sample_points(rows: DataFrame, limit: int = SAMPLE_ROWS) -> np.ndarray:
    """Unit vectors of the rows with the smallest hashes of their ids; the same ones on every run."""
    held = rows.orderBy(F.xxhash64("id"), "id").limit(limit).select("v").toPandas()
    return _unit(held["v"]) if len(held) else np.zeros((0, 0))


def _in_blocks(rows: DataFrame, blocks_of) -> DataFrame:
    """Rows ``id, v, block``; ``blocks_of`` gives the block of each unit vector."""

    def run(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(block=blocks_of(_unit(batch["v"])))

    return rows.mapInPandas(run, f"id bigint, v {rows.schema['v'].dataType.simpleString()}, block bigint")


def _sent(asks: DataFrame, blocks_of) -> DataFrame:
    """Rows ``id, v, block``, once per block of the lists ``blocks`` that ``blocks_of`` adds; Spark copies the vectors, so that no Python worker holds copies."""
    kind = asks.schema["v"].dataType.simpleString()
    return asks.mapInPandas(blocks_of, f"id bigint, v {kind}, blocks array<bigint>").select("id", "v", F.explode("blocks").alias("block"))


def meet(asks: DataFrame, base: DataFrame, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best rows per query (``query_id, base_id, similarity``) for ``id, v, block`` rows that meet in their blocks.

    A pair of parts is a group of its own; its size is bounded by ``block_rows`` and ``query_rows`` (up to the evenness of a hash).
    A row is copied once per part of the other side in its own block, never for other blocks.
    """

    def parts(side, limit, name):
        return side.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias(name))

    sizes = parts(base, block_rows, "base_parts").join(parts(asks, query_rows, "ask_parts"), "block")

    def dealt(side, mine, other, salt):
        part = F.pmod(F.xxhash64("id", F.lit(salt)), F.col(f"{mine}_parts")).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(other)
        # New names, so that both sides may come from one table.
        return side.join(sizes, "block").select("id", "v", "block", part, every).toDF("id", "v", "block", mine, other)

    left = dealt(asks, "ask", "base", 1).groupBy("block", "base", "ask")
    right = dealt(base, "base", "ask", 2).groupBy("block", "base", "ask")

    def search(queries, rows):
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "base_id": [], "similarity": []}).astype({"query_id": "int64", "base_id": "int64"})
        return _best(queries["id"].to_numpy(), _unit(queries["v"]), rows["id"].to_numpy(), _unit(rows["v"]), k)

    return left.cogroup(right).applyInPandas(search, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "base_id")
    ranked = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return ranked.select("query_id", "place", "base_id", "similarity")


@dataclass(frozen=True)
class ProjectionIndex:
    """A bucket is the signs of some projections, cut at the sample's medians; queries look into the ``probes`` nearest buckets."""

    directions: np.ndarray
    cuts: np.ndarray
    probes: int
    sample_recall: float

    def margins(self, points: np.ndarray) -> np.ndarray:
        return points @ self.directions.T - self.cuts

    def buckets(self, points: np.ndarray) -> np.ndarray:
        return (self.margins(points) > 0) @ (1 << np.arange(len(self.cuts), dtype="int64"))

    def probed(self, points: np.ndarray, probes: int | None = None) -> np.ndarray:
        """Per point the buckets to look into, nearest first: bits with small margins are flipped, cheapest sets of them first."""
        margins = self.margins(points)
        bits = len(self.cuts)
        flipped = min(bits, FLIPPED_BITS)
        near = np.argsort(np.abs(margins), axis=1, kind="stable")[:, :flipped]
        cost = np.take_along_axis(margins, near, axis=1) ** 2
        sets = (np.arange(1 << flipped)[:, None] >> np.arange(flipped)) & 1
        order = np.argsort(cost @ sets.T, axis=1, kind="stable")[:, : probes or self.probes]
        own = self.buckets(points)
        change = (sets[order] * (1 << near.astype("int64"))[:, None, :]).sum(axis=2)
        return own[:, None] ^ change


def fit_projections(
    base: DataFrame, key: str, vector: str, k: int = 10, recall: float = 0.95, bucket_rows: int = BUCKET_ROWS, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> ProjectionIndex:
    """An index with as many probes as it takes to find the share ``recall`` of the k nearest within the sample.

    In the whole table the k nearest are nearer than in the sample, so more of them share a bucket there. How much of the table
    the probes cover depends on the vectors: a few hundredths where they lie in groups, most of it where they have no structure. A query
    has at most ``MOST_PROBES`` of them, so what is sent grows with the queries; where the nearest lie in more buckets, there are fewer and larger ones.
    """
    rows = _plain(base, key, vector)
    count, points = rows.count(), sample_points(rows, sample_rows)
    bits = min(max(1, ceil(log2(max(count, 1) / bucket_rows))), MOST_BITS) if count else 1
    dims = points.shape[1] if len(points) else 1
    chance = np.random.default_rng(seed)
    directions = chance.standard_normal((bits, dims))
    if bits <= dims:
        directions = np.linalg.qr(directions.T)[0].T
    cuts = np.median(points @ directions.T, axis=0) if len(points) else np.zeros(bits)
    if len(points) <= k:
        return ProjectionIndex(directions, cuts, 1 << min(bits, FLIPPED_BITS), 1.0)
    asked = points[:256]
    similarity = asked @ points.T
    similarity[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argsort(-similarity, axis=1, kind="stable")[:, :k]
    # Fewer bits where more would need too many probes; few enough for looking everywhere always do.
    while True:
        index = ProjectionIndex(directions[:bits], cuts[:bits], 1, 0.0)
        buckets = index.buckets(points)
        probed = index.probed(asked, 1 << min(bits, FLIPPED_BITS))
        # At which probe is each neighbour's bucket looked into?
        at = np.array([[np.flatnonzero(row == b)[0] if (row == b).any() else probed.shape[1] for b in buckets[near]] for row, near in zip(probed, nearest)])
        share = np.array([(at < p).mean() for p in range(1, min(probed.shape[1], MOST_PROBES) + 1)])
        enough = np.flatnonzero(share >= recall)
        if len(enough) or 1 << bits <= MOST_PROBES:
            probes = int(enough[0]) + 1 if len(enough) else len(share)
            return ProjectionIndex(index.directions, index.cuts, probes, float(share[probes - 1]))
        bits -= 1


def approximate_neighbours(
    queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, index: ProjectionIndex | None = None, **limits: int
) -> DataFrame:
    """Rows ``query_id, place, base_id, similarity``: the k best of the rows in the probed buckets, never the query itself."""
    index = index or fit_projections(base, key, vector, k)
    rows = _in_blocks(_plain(base, key, vector), index.buckets)
    asks = _plain(queries, key, vector)

    def probe(batches):
        for batch in batches:
            for low in range(0, len(batch), 256):
                some = batch.iloc[low : low + 256]
                yield some.assign(blocks=list(index.probed(_unit(some["v"]))))

    return _ranked(meet(_sent(asks, probe), rows, k, **limits), k)


def neighbour_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``queries, wanted, found, recall`` of the exact rows that are among the found ones."""
    hits = found.select("query_id", "base_id", F.lit(1).alias("hit"))
    judged = exact.select("query_id", "base_id").join(hits, ["query_id", "base_id"], "left")
    return judged.agg(
        F.countDistinct("query_id").alias("queries"),
        F.count(F.lit(1)).alias("wanted"),
        F.count("hit").alias("found"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )


@dataclass(frozen=True)
class AngleIndex:
    """Blocks are rings of angles round centres. ``low`` and ``high`` are the least and largest angles over all rows of a block."""

    centres: np.ndarray
    rings: np.ndarray
    blocks: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    def angles(self, points: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(points @ self.centres.T, -1, 1))

    def places(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each point and its angle there; zeros have the block -1, as they lie in no direction."""
        angles = self.angles(points)
        centre = angles.argmin(axis=1)
        angle = angles[np.arange(len(points)), centre]
        ring = (angle[:, None] > self.rings[centre]).sum(axis=1)
        zero = ~points.any(axis=1)
        return np.where(zero, -1, centre * (self.rings.shape[1] + 1) + ring), np.where(zero, 0.0, angle)

    def bounds(self, points: np.ndarray) -> np.ndarray:
        """The highest similarity that each point can have to any row of each block."""
        centre = np.maximum(self.blocks, 0) // (self.rings.shape[1] + 1)
        angles = self.angles(points)[:, centre]
        gap = np.maximum(np.maximum(angles - self.high, self.low - angles) - SPARE, 0)
        found = np.cos(gap)
        found[:, self.blocks < 0] = 0.0
        found[~points.any(axis=1)] = 0.0
        return found

    def first(self, points: np.ndarray, k: int) -> np.ndarray:
        """Per point which blocks are looked into first: those with the highest bounds that hold more than k rows together."""
        order = np.argsort(-self.bounds(points), axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        chosen = np.zeros(order.shape, bool)
        np.put_along_axis(chosen, order, before <= k, axis=1)
        return chosen


def _sphere_means(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of the sample by a few rounds of means on the sphere, from evenly spaced sample rows."""
    points = points[points.any(axis=1)]
    if not len(points):
        return np.zeros((1, points.shape[1]))
    centres = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)]
    for _ in range(rounds):
        owner = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def fit_angles(base: DataFrame, key: str, vector: str, centres: int = 64, rings: int = 4, sample_rows: int = SAMPLE_ROWS) -> AngleIndex:
    """Centres and rings from the sample; the blocks' angles and sizes from all rows, which makes the bounds hold.

    There are at most ``centres * rings + 1`` blocks, whatever the size of the table, and one row per block reaches the driver.
    """
    rows = _plain(base, key, vector)
    points = sample_points(rows, sample_rows)
    middle = _sphere_means(points, centres) if len(points) else np.zeros((1, 1))
    cuts = np.zeros((len(middle), rings - 1))
    if len(points):
        angles = np.arccos(np.clip(points @ middle.T, -1, 1))
        owner = angles.argmin(axis=1)
        for c in range(len(middle)):
            mine = angles[owner == c, c]
            if len(mine):
                cuts[c] = np.quantile(mine, np.arange(1, rings) / rings)
    none = np.zeros(0)
    index = AngleIndex(middle, cuts, none.astype("int64"), none, none, none.astype("int64"))

    def measure(batches):
        for batch in batches:
            if len(batch):
                block, angle = index.places(_unit(batch["v"]))
                told = pd.DataFrame({"block": block, "angle": angle}).groupby("block")["angle"].agg(["min", "max", "count"]).reset_index()
                yield told.rename(columns={"min": "low", "max": "high", "count": "n"})

    parts = rows.mapInPandas(measure, "block bigint, low double, high double, n bigint")
    known = parts.groupBy("block").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("block").toPandas()
    return AngleIndex(middle, cuts, *(known[c].to_numpy() for c in ("block", "low", "high", "n")))


def _visits(asks: DataFrame, index: AngleIndex, wanted) -> DataFrame:
    """``asks`` once per block that ``wanted(points, frame)`` names for it, as a matrix of points and blocks."""

    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), 1024):
                some = batch.iloc[low : low + 1024]
                row, block = np.nonzero(wanted(_unit(some["v"]), some))
                ends = np.searchsorted(row, np.arange(1, len(some)))
                yield some[["id", "v"]].assign(blocks=np.split(index.blocks[block], ends))

    return _sent(asks, run)


def _still_open(first: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """The queries ``id, v, least`` with the k-th best so far; queries that have fewer take every block."""
    least = first.where(F.col("place") == k).select(F.col("query_id").alias("id"), F.col("similarity").alias("least"))
    return asks.join(least, "id", "left").select("id", "v", F.coalesce("least", F.lit(-2.0)).alias("least"))


def _leaves_open(index: AngleIndex, k: int):
    """Which blocks are left open for the points of a frame of ``_still_open``, without those looked into first."""

    def still(points, frame):
        return (index.bounds(points) >= frame["least"].to_numpy()[:, None] - 1e-12) & ~index.first(points, k)

    return still


def _first_found(asks: DataFrame, rows: DataFrame, k: int, index: AngleIndex, limits: dict) -> DataFrame:
    """The k best of the blocks that each query looks into first."""
    return _ranked(meet(_visits(asks, index, lambda points, _: index.first(points, k)), rows, k, **limits), k)


def pruned_visits(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, index: AngleIndex, **limits: int) -> tuple[DataFrame, DataFrame]:
    """What the k best of the first blocks are, and the further ``id, v, block`` visits that they leave open."""
    asks = _plain(queries, key, vector)
    rows = _in_blocks(_plain(base, key, vector), lambda points: index.places(points)[0])
    first = _first_found(asks, rows, k, index, limits)
    return first, _visits(_still_open(first, asks, k), index, _leaves_open(index, k))


def tile_rows(count: int, numbers: int) -> int:
    """Rows of a part of a table of ``count`` rows with so many numbers each."""
    return max(1, min(TILE_NUMBERS // max(numbers, 1), max(STEP_ROWS, ceil(count / TILE_SIDES))))


def block_parts(rows: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each block the first part that holds it and how many do: neighbouring blocks share a part of up to ``limit`` rows, larger ones have several of their own."""
    first, several = np.zeros(len(rows), "int64"), np.ones(len(rows), "int64")
    part, held = -1, limit
    for i, n in enumerate(rows.tolist()):
        if held + n > limit:
            part, held = part + 1, 0
        first[i], several[i] = part, max(1, ceil(n / limit))
        part, held = part + int(several[i]) - 1, limit if several[i] > 1 else held + n
    return first, several


def meet_open(asks: DataFrame, base: DataFrame, k: int, index: AngleIndex, wanted, base_rows: int, ask_parts: int) -> DataFrame:
    """The k best rows per query (``query_id, base_id, similarity``) of the blocks that ``wanted(points, frame)`` names, none below ``least``.

    ``asks`` has ``id, v, least``, ``base`` has ``id, v, block``. A tile is a part of the base, whole blocks or a share of a large one, and a part of the
    queries. Either side is copied once per part of the other, whatever the number of open blocks; queries that leave no block of a part
    open are not sent there. Inside a tile only open blocks are met, and the k-th best found so far rises on the way.
    """
    first, several = block_parts(index.rows, base_rows)
    parts = int((first + several).max()) if len(first) else 0
    kind = asks.schema["v"].dataType.simpleString()

    def send(batches):
        for batch in batches:
            for low in range(0, len(batch), 1024):
                some = batch.iloc[low : low + 1024]
                met = wanted(_unit(some["v"]), some)
                to = np.zeros((len(some), parts), bool)
                for block in range(len(first)):
                    to[:, first[block] : first[block] + several[block]] |= met[:, block, None]
                row, part = np.nonzero(to)
                ends = np.searchsorted(row, np.arange(1, len(some)))
                yield some.assign(blocks=[b.tobytes() for b in np.packbits(met, axis=1)], parts=np.split(part, ends))

    sent = asks.mapInPandas(send, f"id bigint, v {kind}, least double, blocks binary, parts array<bigint>")
    ask = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(ask_parts)).cast("int")
    left = sent.select("id", "v", "least", "blocks", ask.alias("ask"), F.explode("parts").alias("part"))

    def deal(batches):
        for batch in batches:
            batch = batch[np.isin(batch["block"], index.blocks)]
            at = np.searchsorted(index.blocks, batch["block"].to_numpy())
            yield batch.assign(block=at, part=first[at], several=several[at])

    dealt = base.mapInPandas(deal, f"id bigint, v {base.schema['v'].dataType.simpleString()}, block bigint, part bigint, several bigint")
    part = F.col("part") + F.pmod(F.xxhash64("id", F.lit(2)), F.col("several"))
    every = F.explode(F.sequence(F.lit(0), F.lit(ask_parts - 1))).alias("ask")
    # New names, so that both sides may come from one table.
    right = dealt.select("id", "v", "block", part.alias("part"), every).toDF("id", "v", "block", "part", "ask")

    def search(queries, rows):
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "base_id": [], "similarity": []}).astype({"query_id": "int64", "base_id": "int64"})
        # Vectors stay in the numbers' own type; lengths are taken chunk by chunk.
        ids, points, least = queries["id"].to_numpy(), np.stack(queries["v"].to_list()), queries["least"].to_numpy().copy()
        met = np.frombuffer(b"".join(queries["blocks"]), "u1").reshape(len(ids), -1)
        order = np.argsort(rows["block"].to_numpy(), kind="stable")
        base_ids, block = rows["id"].to_numpy()[order], rows["block"].to_numpy()[order]
        vectors = rows["v"].to_numpy()
        kept = _Kept(len(ids), k)
        turns = np.flatnonzero(np.diff(block, prepend=-1, append=len(first)))
        for begin, end in zip(turns[:-1].tolist(), turns[1:].tolist()):
            asked = np.flatnonzero(met[:, block[begin] >> 3] & (128 >> (block[begin] & 7)))
            for low in range(begin, end, STEP_ROWS):
                some = slice(low, min(end, low + STEP_ROWS))
                some_ids, some_points = base_ids[some], _unit(vectors[order[some]])
                kept.make_room(some_ids)
                for chunk in _chunks(len(asked), len(some_ids)):
                    at = asked[chunk]
                    row, place, found, value = _better(ids[at], _unit(points[at]), some_ids, some_points, k, least[at])
                    hit, row = np.unique(row, return_inverse=True)
                    kept.add(at[hit], row, place, found, value)
                    if kept.ids.shape[1] == k:
                        least[at[hit]] = np.maximum(least[at[hit]], kept.values[at[hit], k - 1])
        return pd.concat(kept.frames(ids))

    return left.groupBy("part", "ask").cogroup(right.groupBy("part", "ask")).applyInPandas(search, FOUND)


def pruned_neighbours(
    queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, index: AngleIndex | None = None, **limits: int
) -> DataFrame:
    """Rows ``query_id, place, base_id, similarity``: exact cosine top-k, never the query itself.

    By the triangle inequality of angles, a block whose ring lies further from the query than the k-th best found so far holds nothing better.
    Each query first looks into its nearest blocks and then only into those that its bound leaves open. Where
    vectors have no structure few blocks are skipped, and the plain search does less work. ``block_rows`` and ``query_rows`` bound the parts of either side.
    """
    index = index or fit_angles(base, key, vector)
    asks = _plain(queries, key, vector)
    rows = _in_blocks(_plain(base, key, vector), lambda points: index.places(points)[0])
    dims, n_asks = index.centres.shape[1], asks.count()
    base_rows = limits.get("block_rows") or tile_rows(int(index.rows.sum()), dims)
    # A task holds the k best of its queries as well.
    ask_rows = limits.get("query_rows") or tile_rows(n_asks, max(dims, 2 * k))
    first = _first_found(asks, rows, k, index, {"block_rows": base_rows, "query_rows": ask_rows})
    later = meet_open(_still_open(first, asks, k), rows, k, index, _leaves_open(index, k), base_rows, max(1, ceil(n_asks / ask_rows)))
    return _ranked(first.select("query_id", "base_id", "similarity").unionByName(later), k)
