"""BPE encoding and decoding of whole columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marlstone.llm.batches import chunks
from marlstone.llm.bpe import encoder
from marlstone.llm.storage import map_arrow


def _with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def _appended(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """All columns and the text's ids. ``vocabulary`` is the path of a tokenizers file on every executor."""
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for low, high in chunks(texts):
                ids, bounds = coder.encode(texts[low:high])
                yield _appended(
                    batch.slice(low, high - low), out, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                )

    return map_arrow(df, run, _with_field(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the text that the ids stand for; special tokens are kept. Null ids give an empty text."""
    place = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary).vocabulary
        for batch in batches:
            texts = [words.decode(ids or []) for ids in batch.column(place).to_pylist()]
            yield _appended(batch, out, pa.array(texts, pa.string()))

    return map_arrow(df, run, _with_field(df, out, T.StringType()))


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text and return digests: ``n_tokens, ids_sha256, decoded_sha256`` beside the id.

    ``ids_sha256`` is of the decimal ids joined by one blank, ``decoded_sha256`` of the decoded text. Ids and decoded
    texts stay in the task that made them.
    """
    rows = df.select(id_col, text_col)
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        words = coder.vocabulary
        digits = [str(i) for i in range(len(words.tokens))]
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found, decoded, counts = [], [], []
            for low, high in chunks(texts):
                ids, bounds = coder.encode(texts[low:high])
                every = ids.tolist()
                counts.append(np.diff(bounds))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    one = every[a:b]
                    found.append(sha(" ".join(map(digits.__getitem__, one))))
                    decoded.append(sha(words.decode(one)))
            sizes = np.concatenate(counts) if counts else np.zeros(0, "i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.string()), pa.array(decoded, pa.string())],
                names=schema.names,
            )

    return map_arrow(rows, run, schema)
