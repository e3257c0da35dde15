"""Packing documents into sequences of a fixed number of tokens with a grouping genetic algorithm.

A solution is a list of bins (sequences). Crossover takes well-filled bins of one parent whole into the other, dissolves the
bins there that share items with them, and puts the displaced items back by best fit, longest first. Mutation dissolves some of the least filled bins.

Work is dealt out at random into chunks of about ``CHUNK_ITEMS`` pieces. Each chunk is evolved on ``ISLANDS`` islands, which are rows
of their own and run anywhere; between epochs every island gets the elite of its neighbour in a ring. Bins that are nearly full
are final after the first round. The others move, whole, to new chunks of a second round and start there as one member of the population,
so a second round never needs more bins than the first. Only lengths go through Python; other columns stay in Spark.

Defined cases: a null length counts as 0, a length above the capacity is an error; rows may repeat; an empty table gives an empty
result; a piece as long as a sequence has one to itself; columns named as the result's are replaced.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import chunks
from marlstone.llm.bpe import library_encoder
from marlstone.llm.storage import keep, map_arrow, map_pandas
from marlstone.llm.token_files import ends_added

CAPACITY = 2048
CHUNK_ITEMS = 4096
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 12
POPULATION = 4
NEARLY_FULL = 0.995

Bins = list[list[int]]


def cut_pieces(
    df: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encoded documents, each followed by ``end_id``, as pieces: ``piece, start, length, ids_crc32`` beside the id.

    A document of more than ``capacity`` ids is cut so that only its first piece may be shorter.
    """
    rows = df.select(id_col, F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts):
                ids, bounds = ends_added(*coder.encode(texts[low:high]), end_id)
                whole = memoryview(ids.astype("<u4").tobytes())
                size = np.diff(bounds)
                n_pieces = -(-size // capacity)
                owner = np.repeat(np.arange(len(size)), n_pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                head = size - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[owner], capacity)
                at = bounds[owner] + start
                crc = [zlib.crc32(whole[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                names = batch.column(0).slice(low, high - low).take(pa.array(owner))
                columns = [pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))]
                yield pa.RecordBatch.from_arrays([names, *columns], names=schema.names)

    return map_arrow(rows, run, schema)


def best_fit(bins: Bins, items: Sequence[int], lengths: Sequence[int], capacity: int) -> None:
    """Put the items, longest first, into the bin they leave the least room in, or a new one."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, held in enumerate(bins):
        room = capacity - sum(lengths[i] for i in held)
        stacks[room].append(b)
        mask |= 1 << room
    for i in sorted(items, key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                mask ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        stacks[room - size].append(b)
        mask |= 1 << (room - size)


def fills(bins: Bins, lengths: Sequence[int]) -> list[int]:
    return [sum(lengths[i] for i in held) for held in bins]


def fitness(bins: Bins, lengths: Sequence[int]) -> tuple[int, int]:
    """Smaller is better: bins first, then evenness (full bins beside nearly empty ones are better to work with)."""
    return len(bins), -sum(f * f for f in fills(bins, lengths))


def crossover(into: Bins, giver: Bins, lengths: Sequence[int], capacity: int, chance: random.Random, share: float) -> Bins:
    """A child of two solutions."""
    loads = fills(giver, lengths)
    order = sorted(range(len(giver)), key=lambda b: (-loads[b], b))
    full = order[: max(1, len(order) // 2)]
    injected = [giver[b] for b in chance.sample(full, max(1, int(len(full) * share)))]
    taken = {i for held in injected for i in held}
    child, displaced = [list(held) for held in injected], []
    for held in into:
        if taken.isdisjoint(held):
            child.append(list(held))
        else:
            displaced += [i for i in held if i not in taken]
    best_fit(child, displaced, lengths, capacity)
    return child


def mutate(bins: Bins, lengths: Sequence[int], capacity: int, chance: random.Random) -> Bins:
    loads = fills(bins, lengths)
    order = sorted(range(len(bins)), key=lambda b: (loads[b], b))
    worst = set(order[: max(1, len(order) // 50)]) | set(chance.sample(range(len(bins)), max(1, len(bins) // 50)))
    child = [list(held) for b, held in enumerate(bins) if b not in worst]
    loose = [i for b in sorted(worst) for i in bins[b]]
    chance.shuffle(loose)
    best_fit(child, loose, lengths, capacity)
    return child


def evolve(seeds: list[Bins], lengths: Sequence[int], capacity: int, seed: int, generations: int = GENERATIONS) -> Bins:
    """The best solution found from the seeds; never worse than any of them."""
    chance = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    people = [[list(held) for held in bins] for bins in seeds]
    if len(people) < 2:
        bins: Bins = []
        best_fit(bins, range(len(lengths)), lengths, capacity)
        people.append(bins)
    while len(people) < POPULATION:
        # Starting points that differ: a random tenth of the items is placed first.
        first = chance.sample(range(len(lengths)), len(lengths) // 10)
        bins = []
        best_fit(bins, first, lengths, capacity)
        chosen = set(first)
        best_fit(bins, [i for i in range(len(lengths)) if i not in chosen], lengths, capacity)
        people.append(bins)
    ranked = sorted(((fitness(p, lengths), p) for p in people), key=lambda x: x[0])
    for _ in range(generations):
        if ranked[0][0][0] <= least:
            break
        a, b = chance.sample(range(len(ranked)), 2)
        child = crossover(ranked[min(a, b)][1], ranked[max(a, b)][1], lengths, capacity, chance, chance.uniform(0.05, 0.3))
        if chance.random() < 0.5:
            child = mutate(child, lengths, capacity, chance)
        scored = fitness(child, lengths)
        if scored < ranked[-1][0] and all(scored != s for s, _ in ranked):
            ranked[-1] = (scored, child)
            ranked.sort(key=lambda x: x[0])
    return ranked[0][1]


def _as_bins(numbers: Sequence[int]) -> Bins:
    found: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        found.setdefault(int(b), []).append(i)
    return list(found.values())


def _as_numbers(bins: Bins, size: int) -> list[int]:
    out = [0] * size
    for b, held in enumerate(bins):
        for i in held:
            out[i] = b
    return out


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """``chunk, island, lengths, seeds`` (bin numbers of some solutions) to ``chunk, island, bins`` and its count of bins."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for chunk, island, lengths, seeds in zip(frame.chunk, frame.island, frame.lengths, frame.seeds, strict=True):
                lengths = [int(n) for n in lengths]
                # Pieces that fill a sequence alone need no search.
                loose = [i for i, n in enumerate(lengths) if n < capacity]
                sizes = [lengths[i] for i in loose]
                known = [_as_bins([numbers[i] for i in loose]) for numbers in seeds]
                bins = evolve(known, sizes, capacity, zlib.crc32(f"{chunk} {island} {epoch}".encode())) if loose else []
                whole = [[loose[i] for i in held] for held in bins] + [[i] for i, n in enumerate(lengths) if n >= capacity]
                found.append((chunk, island, _as_numbers(whole, len(lengths)), len(whole), -sum(f * f for f in fills(bins, sizes))))
            yield pd.DataFrame(found, columns=["chunk", "island", "bins", "n_bins", "evenness"])

    return map_pandas(islands, run, "chunk long, island int, bins array<int>, n_bins int, evenness long")


def _round(items: DataFrame, capacity: int, tag: str) -> DataFrame:
    """Pack ``chunk, ticket, row, length, former`` (a former bin or null): adds ``bin`` and the bin's ``fill``."""
    packed = items.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("ticket", "length", "former", "row"))).alias("items"))
    packed = keep(packed, f"packing-chunks-{tag}")
    lengths = packed.select("chunk", F.col("items.length").alias("lengths"), F.col("items.former").alias("former"))
    # Former bins, if any, as one solution.
    numbers = F.transform("former", lambda f: F.array_position("former", f).cast("int"))
    seeds = F.when(F.exists("former", lambda f: f.isNotNull()), F.array(numbers)).otherwise(F.array().cast("array<array<int>>"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    base = lengths.withColumn("seeds", seeds).drop("former")
    state = base.select("chunk", "lengths", "seeds", islands)
    elites = None
    for epoch in range(EPOCHS):
        elites = keep(_epoch(state.repartition("chunk", "island"), capacity, epoch), f"packing-elites-{tag}-{epoch}")
        if epoch + 1 < EPOCHS:
            # Every island starts again from its own elite and its neighbour's.
            ring = elites.select("chunk", F.expr(f"(island + 1) % {ISLANDS}").alias("island"), F.col("bins").alias("near"))
            both = elites.join(ring, ["chunk", "island"]).select("chunk", "island", F.array("bins", "near").alias("seeds"))
            state = both.join(base.select("chunk", "lengths"), "chunk")
    best = elites.groupBy("chunk").agg(F.min_by("bins", F.struct("n_bins", "evenness", "island")).alias("bins"))
    solved = packed.join(best, "chunk").select("chunk", F.explode(F.arrays_zip("items", "bins")).alias("x"))
    solved = solved.select("chunk", "x.items.ticket", "x.items.row", "x.items.length", F.col("x.bins").alias("bin"))
    return keep(solved, f"packing-solved-{tag}")


def pack(df: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """All columns, ``sequence_id`` and ``offset``: the row's place in a sequence without gaps."""
    names = [c for c in df.columns if c not in ("sequence_id", "offset")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    # The ticket deals rows out at random; it is written down, so that it stays the same from here on.
    ticket = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
    rows = keep(df.select(row, F.coalesce(F.col(length_col).cast("long"), F.lit(0)).alias("length"), ticket.alias("ticket")), "packing-rows")
    count, longest = rows.agg(F.count(F.lit(1)), F.max("length")).first()
    if (longest or 0) > capacity:
        raise ValueError(f"a piece of {longest} tokens does not fit into {capacity}")
    n_chunks = max(1, -(-count // CHUNK_ITEMS))
    first = rows.select(
        F.pmod("ticket", F.lit(n_chunks)).cast("long").alias("chunk"), "ticket", "row", "length", F.lit(None).cast("long").alias("former")
    )
    solved = _round(first, capacity, "first").withColumn("former", F.col("chunk") * F.lit(1 << 24) + F.col("bin"))
    loads = solved.groupBy("former").agg(F.sum("length").alias("load"), F.count(F.lit(1)).alias("n"))
    loads = keep(loads, "packing-loads")
    open_items = loads.where(F.col("load") < NEARLY_FULL * capacity).agg(F.sum("n")).first()[0] or 0
    solved = solved.join(loads.select("former", "load"), "former")
    full = solved.where(F.col("load") >= NEARLY_FULL * capacity)
    again = max(1, -(-open_items // CHUNK_ITEMS))
    rest = solved.where(F.col("load") < NEARLY_FULL * capacity).select(
        F.pmod(F.xxhash64("former"), F.lit(again)).cast("long").alias("chunk"), "ticket", "row", "length", "former"
    )
    second = _round(rest, capacity, "second").select(
        (F.lit(-1) - (F.col("chunk") * F.lit(1 << 24) + F.col("bin"))).alias("sequence_id"), "ticket", "row", "length"
    )
    final = full.select(F.col("former").alias("sequence_id"), "ticket", "row", "length").unionByName(second)
    # A sequence has at most ``capacity`` pieces of a token or more; those without tokens take no place.
    before = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("ticket").rowsBetween(Window.unboundedPreceding, -1))
    return final.select("row.*", "sequence_id", F.coalesce(before, F.lit(0)).alias("offset"))
