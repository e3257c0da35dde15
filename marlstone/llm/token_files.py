"""Token ids in files of patched frame-of-reference blocks.

A block holds ``BLOCK`` ids: their minimum is subtracted, the differences are packed at the width that ``PERCENTILE`` per cent
of them fit into, and the high bits of the others go to a list of exceptions. Layout of a segment's ``blocks``:

* ``u4`` number of blocks, then ``u4`` start of each block within what follows;
* per block: ``u4`` minimum, ``u1`` width, ``u1`` number of exceptions, the packed differences (the first in the lowest bits
  of little-endian 64-bit words), then ``u1`` place and ``u4`` high bits of each exception. The last block is filled up with its minimum.

A segment is one row of a Parquet table written by Spark, so that a failed task leaves nothing behind and any store will do:
``shard, segment, first`` (ids of the shard before it), ``n_ids``, ``docs`` (id and number of ids of each document, in order)
and ``blocks``. Shards follow each other in ascending order of ids, segments within a shard too.

Defined cases: null text is empty, so it gives the end id alone; null ids come first; repeated ids are kept, ordered among
themselves by a hash of their text; an empty table gives no segments; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import chunks
from marlstone.llm.bpe import library_encoder
from marlstone.llm.storage import map_arrow

BLOCK = 128
PERCENTILE = 90
SEGMENT_IDS = 1 << 20
SHARD_BYTES = 32 << 20


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers below ``2 ** width`` as rows of bytes."""
    words = np.zeros((len(values), BLOCK * width // 64), "<u8")
    for j in range(BLOCK if width else 0):
        at, shift = divmod(j * width, 64)
        words[:, at] |= values[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, at + 1] |= values[:, j] >> np.uint64(64 - shift)
    return words.view("u1")


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(raw).view("<u8")
    values = np.zeros((len(words), BLOCK), "u8")
    for j in range(BLOCK if width else 0):
        at, shift = divmod(j * width, 64)
        values[:, j] = words[:, at] >> np.uint64(shift)
        if shift + width > 64:
            values[:, j] |= words[:, at + 1] << np.uint64(64 - shift)
    return values & np.uint64((1 << width) - 1)


def write_blocks(ids: np.ndarray) -> bytes:
    """The ids (0 to 2**32 - 1) as one segment."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.zeros(1, "<u4").tobytes()
    full = np.full(n_blocks * BLOCK, ids[-1], "u8")
    full[: len(ids)] = ids
    rows = full.reshape(n_blocks, BLOCK)
    rows[-1, len(ids) - (n_blocks - 1) * BLOCK :] = rows[-1, : len(ids) - (n_blocks - 1) * BLOCK].min()
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    bits = np.frexp(rest.astype("f8"))[1]
    widths = np.sort(bits, axis=1)[:, -(-BLOCK * PERCENTILE // 100) - 1]
    patched = bits > widths[:, None]
    n_patched = patched.sum(axis=1)
    sizes = 6 + BLOCK // 8 * widths + 5 * n_patched
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), "u1")
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        head = np.zeros((len(some), 6), "u1")
        head[:, :4] = low[some].astype("<u4").view("u1").reshape(-1, 4)
        head[:, 4], head[:, 5] = width, n_patched[some]
        packed = _pack(rest[some] & np.uint64((1 << int(width)) - 1), int(width))
        out[starts[some][:, None] + np.arange(6 + packed.shape[1])] = np.hstack([head, packed])
    block, place = np.nonzero(patched)
    nth = np.arange(len(block)) - (np.cumsum(n_patched) - n_patched)[block]
    at = starts[block] + 6 + BLOCK // 8 * widths[block]
    out[at + nth] = place
    high = (rest[block, place] >> widths[block].astype("u8")).astype("<u4").view("u1").reshape(-1, 4)
    out[(at + n_patched[block] + 4 * nth)[:, None] + np.arange(4)] = high
    return np.array([n_blocks], "<u4").tobytes() + starts.astype("<u4").tobytes() + out.tobytes()


def read_blocks(data: bytes, n_ids: int, first: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` ids from place ``first`` on (all by default); only the blocks that hold them are read."""
    count = n_ids - first if count is None else count
    if not count:
        return np.zeros(0, "<u4")
    n_blocks = int(np.frombuffer(data, "<u4", 1)[0])
    begin, end = first // BLOCK, -(-(first + count) // BLOCK)
    starts = np.frombuffer(data, "<u4", n_blocks, 4)[begin:end].astype("i8")
    raw = np.frombuffer(data, "u1", -1, 4 + 4 * n_blocks)
    low = raw[starts[:, None] + np.arange(4)].copy().view("<u4")[:, 0].astype("u8")
    widths, n_patched = raw[starts + 4].astype("i8"), raw[starts + 5].astype("i8")
    values = np.zeros((len(starts), BLOCK), "u8")
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        packed = raw[starts[some][:, None] + 6 + np.arange(BLOCK // 8 * int(width))]
        values[some] = _unpack(packed, int(width))
    block = np.repeat(np.arange(len(starts)), n_patched)
    nth = np.arange(len(block)) - (np.cumsum(n_patched) - n_patched)[block]
    at = starts[block] + 6 + BLOCK // 8 * widths[block]
    place = raw[at + nth]
    high = raw[(at + n_patched[block] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1).astype("u8")
    values[block, place] |= high << widths[block].astype("u8")
    ids = (values + low[:, None]).reshape(-1)
    return ids[first - begin * BLOCK :][:count].astype("<u4")


def ends_added(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def write_token_files(
    df: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0
) -> None:
    """Encode all texts, each followed by ``end_id``, and write them in ascending order of ids.

    Rows are dealt into ranges of ids with about ``SHARD_BYTES`` of text; a task encodes a range in order, segment by segment,
    and holds one segment at a time.
    """
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(max(1, -(-size // SHARD_BYTES)), "id").sortWithinPartitions("id", F.xxhash64("text"))
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("docs", T.ArrayType(T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType())]))),
            T.StructField("blocks", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = library_encoder(vocabulary), TaskContext.get().partitionId()
        segment = first = held = 0
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        parts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            ids, lengths = np.concatenate(parts), np.concatenate(sizes)
            docs = pa.StructArray.from_arrays([pa.concat_arrays(names), pa.array(lengths, pa.int64())], names=["id", "n"])
            values = [[shard], [segment], [first], [held]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            return pa.RecordBatch.from_arrays([*arrays, lists, pa.array([write_blocks(ids)], pa.binary())], names=schema.names)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts):
                ids, bounds = ends_added(*coder.encode(texts[low:high]), end_id)
                names.append(batch.column(0).slice(low, high - low))
                sizes.append(np.diff(bounds))
                parts.append(ids)
                held += len(ids)
                if held >= SEGMENT_IDS:
                    yield row()
                    segment, first, held = segment + 1, first + held, 0
                    names, sizes, parts = [], [], []
        if held:
            yield row()

    map_arrow(rows, run, schema).write.parquet(path)


def _bases(files: DataFrame) -> DataFrame:
    """Ids in all shards before each; one short row per shard."""
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row per document: ``id, start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    With ``digest``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) takes the place of the ids.
    """
    files = spark.read.parquet(path)
    kind = files.schema["docs"].dataType.elementType["id"].dataType
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.LongType()))
    schema = T.StructType(
        [T.StructField("shard", T.IntegerType()), T.StructField("id", kind), T.StructField("place", T.LongType()), T.StructField("n_tokens", T.LongType()), last]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, first, n_ids, data = (batch.column(c)[i].as_py() for c in (0, 1, 2, 4))
                docs = batch.column(3)[i].values
                lengths = docs.field("n").to_numpy(zero_copy_only=False).astype("i8")
                ids = read_blocks(data, n_ids)
                ends = np.cumsum(lengths)
                if digest:
                    whole = memoryview(ids.tobytes())
                    spans = zip((ends - lengths).tolist(), ends.tolist(), strict=True)
                    found = pa.array([zlib.crc32(whole[4 * a : 4 * b]) for a, b in spans], pa.int64())
                else:
                    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
                    found = pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int64()))
                shards = pa.array(np.full(len(lengths), shard), pa.int32())
                places = pa.array(first + ends - lengths, pa.int64())
                yield pa.RecordBatch.from_arrays([shards, docs.field("id"), places, pa.array(lengths, pa.int64()), found], names=schema.names)

    docs = map_arrow(files.select("shard", "first", "n_ids", "docs", "blocks"), run, schema)
    bases = _bases(files).withColumnRenamed("shard", "_shard")
    docs = docs.join(bases, F.col("shard") == F.col("_shard"))
    return docs.select("id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", schema.names[-1])
