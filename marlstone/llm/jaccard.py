"""Exact Jaccard links among the members of many groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.columns import SMALL_TABLE_ROWS
from marlstone.llm.storage import keep, map_arrow

BLOCK_ROWS = 1000
BLOCK_MEMBERS = 1_000_000
SIMILARITY = (75, 100)
#: All pairs of groups of up to so many rows are compared together.
FEW = 16


def similar(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the similarity of sets of these sizes is 0.75 or more, in whole numbers."""
    low, high = SIMILARITY
    return high * common >= low * (left + right - common)


def _dealt(rows: DataFrame, columns: list[str], size: Column) -> DataFrame:
    """The rows of groups (``key``) dealt by ``key, i, j`` and sorted: a pair of blocks of one group lies together.

    A group with more than ``BLOCK_ROWS`` rows or ``BLOCK_MEMBERS`` in ``size`` is cut into blocks; ``mine`` is a row's own.
    """
    totals = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("total") / BLOCK_MEMBERS, F.lit(1.0))).cast("int")
    large = keep(totals.where("n > 1").select(F.col("key").alias("_key"), blocks.alias("blocks")).where("blocks > 1"), "large-groups")
    # Few groups are large, so that the rows need not move to learn of them; if they are many, they are joined as any table.
    told = F.broadcast(large) if large.count() <= SMALL_TABLE_ROWS else large
    dealt = rows.join(told, F.col("key") == F.col("_key"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", *columns, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    # One pass over sorted rows handles many small groups per batch, which a call per group would not.
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of whole groups, their bounds and their ``key, i, j``, of rows dealt as above."""
    held: pa.Table | None = None
    for batch in chain(batches, [None]):
        table = held if batch is None else pa.concat_tables([held, pa.table(batch)]) if held is not None else pa.table(batch)
        if table is None or not table.num_rows:
            continue
        keys = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
        # The last group may go on in the next batch.
        done = table.num_rows if batch is None else int(starts[-1])
        held = None if batch is None else table.slice(done)
        yield table.slice(0, done), np.unique(np.append(starts[starts <= done], done)), keys


def link_groups(rows: DataFrame) -> DataFrame:
    """Links ``a, b`` between nodes of one group (``key``) whose sets are similar.

    ``rows`` has ``key, node, root, members`` (sorted 64-bit numbers as bytes); nodes with one root are connected already. All pairs of a group are
    compared inside a task, one set against all others of a block at once, and of the links found only those are given back that
    connect more than was connected, so the result grows with the rows, not with the pairs. Each pair of blocks of a large group is
    a task's group of its own.
    """
    dealt = _dealt(rows, ["node", "root", "members"], F.octet_length("members") / 8)
    kind = rows.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds, keys in _whole_groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind_of(kind)) for c in _links(table, bounds, keys)], names=schema.names)

    return map_arrow(dealt, run, schema)


def open_nodes(rows: DataFrame, sketch: int, least: int) -> DataFrame:
    """The nodes (long) of each group (``key``) whose sketch leaves it open whether their set is similar to that of another node of the group.

    A ``sketch`` is the size of a set and its smallest hashes in order, at most ``sketch`` of them, as 32-bit numbers. A pair is ruled out by
    the sizes alone, or where sketches hold whole sets by what they share; of larger sets, the smallest ``sketch`` hashes of both together
    must hold at least ``least`` shared ones.
    """
    dealt = _dealt(rows, ["node", "sketch"], F.octet_length("sketch") / 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds, keys in _whole_groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_open(table, bounds, keys, sketch, least), pa.int64())], names=["node"])

    return map_arrow(dealt, run, "node long")


def _open(table: pa.Table, bounds: np.ndarray, keys: np.ndarray, sketch: int, least: int) -> np.ndarray:
    """Rows are laid out as a matrix, one sketch each, and compared at growing distances within their groups, a distance at a time."""
    n = table.num_rows
    node, mine = table.column("node").to_numpy(), table.column("mine").to_numpy()
    raw = table.column("sketch").combine_chunks()
    raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
    offsets = np.frombuffer(raw.buffers()[1], "<i4")[raw.offset : raw.offset + n + 1].astype("i8") // 4
    held = np.frombuffer(raw.buffers()[2], "<u4") if n else np.zeros(0, "<u4")
    size = held[offsets[:-1]].astype("i8") if n else np.zeros(0, "i8")
    count = np.diff(offsets) - 1
    # Free places hold numbers above all hashes, different on the left and the right.
    marks = np.full((n, sketch), 1 << 33, "i8")
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.arange(n), count)
    marks[row, place] = held[np.repeat(offsets[:-1] + 1, count) + place]
    end = np.repeat(bounds[1:], np.diff(bounds))
    found = np.zeros(n, bool)
    first, second = keys[1, :n], keys[2, :n]
    longest = int(np.diff(bounds).max()) if len(bounds) > 1 else 0
    going = np.arange(n)
    for step in range(1, longest):
        # Rows whose group ends before this distance are done with.
        going = going[going + step < end[going]]
        left, right = going, going + step
        # Within one block all pairs, between two blocks those across; a pair that is settled need not be looked at.
        fits = ((first[left] == second[left]) | (mine[left] != mine[right])) & ~(found[left] & found[right])
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        fits &= SIMILARITY[1] * small >= SIMILARITY[0] * large
        left, right, large = left[fits], right[fits], large[fits]
        for low in range(0, len(left), 1 << 14):
            a, b, whole = (v[low : low + (1 << 14)] for v in (left, right, large))
            alike = _may_be_similar(marks[a], marks[b], size[a], size[b], whole <= sketch, sketch, least)
            found[a[alike]] = found[b[alike]] = True
    return node[found]


def _may_be_similar(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, whole: np.ndarray, sketch: int, least: int) -> np.ndarray:
    """For each row of two matrices of sorted hashes (above 2**32: none) whether the sets they stand for may be similar."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] < 1 << 32)
    exact = similar(twice.sum(axis=1), na, nb)
    # Place in the order of the different hashes of both.
    rank = np.cumsum(~twice, axis=1)
    among = (twice & (rank < sketch)).sum(axis=1)
    return np.where(whole, exact, among >= least)


def kind_of(kind: T.DataType) -> pa.DataType:
    return pa.int64() if isinstance(kind, T.LongType) else pa.binary()


def _links(table: pa.Table, bounds: np.ndarray, keys: np.ndarray) -> tuple[list, list]:
    """Connecting links of the groups between neighbouring bounds."""
    node, root, members = (table.column(c).to_pylist() for c in ("node", "root", "members"))
    mine = table.column("mine").to_numpy()
    a, b = [], []
    for x, y in _few(members, root, bounds, keys):
        a.append(node[x])
        b.append(node[y])
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low < 2 or high - low <= FEW and keys[1, low] == keys[2, low]:
            continue
        sets = [np.frombuffer(m, "<u8") for m in members[low:high]]
        for k, m in _connect(sets, root[low:high], mine[low:high], int(keys[1, low]), int(keys[2, low])):
            a.append(node[low + k])
            b.append(node[low + m])
    return a, b


def _few(members: list[bytes], root: list, bounds: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Similar rows of small groups that connect what was not connected: pairs at growing distances, those of many groups together."""
    rows = np.diff(bounds)
    small = np.flatnonzero((rows > 1) & (rows <= FEW) & (keys[1, bounds[:-1]] == keys[2, bounds[:-1]]))
    size = np.fromiter((len(m) // 8 for m in members), "i8", len(members))
    before = np.concatenate([[0], np.cumsum(size)])
    share = np.cumsum(before[bounds[small + 1]] - before[bounds[small]]) // BLOCK_MEMBERS
    for some in np.split(small, np.flatnonzero(np.diff(share)) + 1):
        if len(some):
            row = np.concatenate([np.arange(bounds[g], bounds[g + 1]) for g in some.tolist()])
            tops: dict[int, dict] = {}
            for one, other, group in _alike([members[r] for r in row.tolist()], size[row], np.repeat(some, rows[some])):
                top = tops.setdefault(group, {})
                left, right = _top(top, root[row[one]]), _top(top, root[row[other]])
                if left != right:
                    top[left] = right
                    yield int(row[one]), int(row[other])


def _alike(members: list[bytes], size: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """All similar pairs of rows of one group, and the group."""
    first = np.cumsum(size) - size
    values, places = np.unique(np.frombuffer(b"".join(members), "<u8"), return_inverse=True)
    # Rows one after the other, each with its members in order: all of it is in order.
    held = np.repeat(np.arange(len(size)), size) * len(values) + places
    for step in range(1, FEW):
        left = np.flatnonzero(group[:-step] == group[step:])
        low, high = np.minimum(size[left], size[left + step]), np.maximum(size[left], size[left + step])
        left = left[(SIMILARITY[1] * low >= SIMILARITY[0] * high) & (low > 0)]
        if not len(left):
            continue
        n = size[left]
        begin = np.cumsum(n) - n
        own = np.repeat(first[left] - begin, n) + np.arange(int(n.sum()))
        sought = places[own] + np.repeat(left + step, n) * len(values)
        found = held[np.minimum(np.searchsorted(held, sought), len(held) - 1)] == sought
        for k in left[similar(np.add.reduceat(found, begin, dtype="i8"), n, size[left + step])].tolist():
            yield k, k + step, int(group[k])


def _top(roots: dict, node: object) -> object:
    while node in roots:
        node = roots[node]
    return node


def _connect(sets: list[np.ndarray], root: list, mine: np.ndarray, first: int, second: int) -> Iterator[tuple[int, int]]:
    """Pairs of one block with another (or itself) that are similar and connect what was not connected."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    _, places = np.unique(np.concatenate(sets), return_inverse=True)
    numbers: dict = {}
    part = np.array([numbers.setdefault(r, len(numbers)) for r in root])
    marked = np.zeros(len(places), bool)
    for k in np.flatnonzero(mine == first).tolist():
        against = (mine == second) & (part != part[k])
        if not against.any():
            continue
        own = places[starts[k] : starts[k] + sizes[k]]
        marked[own] = True
        common = np.add.reduceat(marked[places], starts, dtype="i8")
        marked[own] = False
        for m in np.flatnonzero(against & similar(common, sizes, sizes[k])).tolist():
            if part[m] != part[k]:
                part[part == part[m]] = part[k]
                yield k, m
