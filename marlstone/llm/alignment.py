"""Alignment of two tokenizations of the same texts through sparse token-byte matrices.

Each text, a blank put before it, is encoded by a byte-level vocabulary (A) and by a vocabulary of word pieces (B). A tokenization is a matrix
with a row per token and a one for each byte of the token, held as compressed rows. Row products (each nonzero of a row of the left
matrix adds a multiple of a row of the right one) of A with the transposed B count the bytes that two tokens share:

* ``overlap`` links: all pairs of tokens that share a byte, with the number of shared bytes;
* ``end`` links: those whose byte ranges end together;
* ``group`` links: places where tokens of both end cut a text into groups, and the product of the token-group matrices pairs
  all tokens of a group. A group may be as long as its text, so these products are made and given out in bounded blocks of rows.

Word pieces never cross from a letter to a blank (checked when the model is loaded), so texts are cut before each run of blanks and every
worker gives each distinct stretch to the library once. Encoded texts are written once; counting and scoring read them back.
Two tokens that end together are suffixes of each other, so the pairs that can ever be linked that way are bounded by
the two vocabularies alone (``most_end_pairs``), whatever the texts; their counts may go to every task.

Defined cases: texts that are null, empty, or whose joined tokens of either side differ from the text have no tokens; special
tokens' strings are plain text; null and repeated ids stay, each row is a document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import Spans, Texts, chunks, flatten, text_of
from marlstone.llm.bpe import Encoder, library_encoder
from marlstone.llm.storage import keep, map_arrow

CHUNK_POINTS = 250_000
PRODUCT_CELLS = 1_000_000
KINDS = ("overlap", "end", "group")
#: The character that stands for a blank in word pieces.
BLANK = "▁"


class Rows(NamedTuple):
    """A sparse matrix by compressed rows: row ``i`` has ``values`` in the columns ``columns`` from ``begin[i]`` to ``begin[i + 1]``."""

    begin: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def count(self) -> int:
        return len(self.begin) - 1


def incidence(ends: np.ndarray) -> Rows:
    """Tokens by bytes, from the place after each token's last byte."""
    size = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate([[0], ends]), np.arange(size), np.ones(size, "i8"), size)


def membership(owner: np.ndarray, width: int) -> Rows:
    """One column per row: items by the group each is in."""
    return Rows(np.arange(len(owner) + 1), owner, np.ones(len(owner), "i8"), width)


def transposed(rows: Rows) -> Rows:
    order = np.argsort(rows.columns, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(rows.columns, minlength=rows.width))])
    owner = np.repeat(np.arange(rows.count), np.diff(rows.begin))
    return Rows(begin, owner[order], rows.values[order], rows.count)


def row_products(left: Rows, right: Rows, limit: int = PRODUCT_CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nonzeros ``(row, column, value)`` of the product in the order of rows and columns.

    Each block takes as many nonzeros of the left side as bring at most ``limit`` cells, at least one, so a row's
    sums may come in parts when the row alone brings more; a cell is never in two parts where the rows of ``right`` are disjoint.
    """
    owner = np.repeat(np.arange(left.count), np.diff(left.begin))
    size = np.diff(right.begin)[left.columns]
    upto = np.cumsum(size)
    low = 0
    while low < len(owner):
        done = int(upto[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + limit, side="right")))
        if high < len(owner):
            # Whole rows where one fits.
            whole = int(left.begin[owner[high]])
            high = whole if whole > low else high
        some = slice(low, high)
        n = size[some]
        at = np.repeat(right.begin[left.columns[some]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        cell = np.repeat(owner[some], n) * right.width + right.columns[at]
        value = np.repeat(left.values[some], n) * right.values[at]
        if len(cell):
            if (np.diff(cell) < 0).any():
                order = np.argsort(cell, kind="stable")
                cell, value = cell[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            cell, value = cell[first], np.add.reduceat(value, first)
            yield cell // right.width, cell % right.width, value
        low = high


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Places where tokens of both sides end; they close the groups."""
    if not len(b_ends):
        return a_ends[:0]
    return a_ends[b_ends[np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)] == a_ends]


def links(a_ends: np.ndarray, b_ends: np.ndarray, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Linked places of A and B tokens, with the bytes they share (``group``: 1), in bounded blocks."""
    if kind not in KINDS:
        raise ValueError(f"links are one of {', '.join(KINDS)}")
    if kind == "group":
        ends = shared_ends(a_ends, b_ends)
        a_group = membership(np.searchsorted(ends, a_ends), len(ends))
        b_group = membership(np.searchsorted(ends, b_ends), len(ends))
        yield from row_products(a_group, transposed(b_group))
        return
    for a, b, shared in row_products(incidence(a_ends), transposed(incidence(b_ends))):
        if kind == "end":
            together = a_ends[a] == b_ends[b]
            a, b, shared = a[together], b[together], shared[together]
        yield a, b, shared


class WordPieces(Encoder):
    """Ids of a model of word pieces for whole texts that begin with a blank."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(BLANK in name.lstrip(BLANK) for name in names):
            raise ValueError("pieces cross from letters to blanks")
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.IsByte(i) else b"" if self.model.IsControl(i) else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        self._blank = self.model.piece_to_id(BLANK)
        super().__init__(None, self._stretches)

    def _stretches(self, raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = raw.tobytes()
        # The library puts a blank before each text: the one that the stretch begins with.
        texts = [whole[a + 1 : a + n].decode() for a, n in zip(first.tolist(), size.tolist(), strict=True)]
        found = [ids or [self._blank] for ids in self.model.encode(texts, num_threads=1)]
        counts = np.fromiter(map(len, found), "i8", len(found))
        return np.fromiter(chain.from_iterable(found), "i4", int(counts.sum())), counts

    def pieces(self, texts: Sequence[str]) -> tuple[Texts, Spans]:
        flat = flatten(texts)
        blank = flat.points == 0x20
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        opens[flat.starts[:-1][np.diff(flat.starts) > 0]] = True
        first = np.flatnonzero(opens)
        return flat, Spans(first, np.append(first[1:], len(blank)), text_of(flat, first))


class Side(NamedTuple):
    """An encoder with the bytes of each id: ``pool[at[i]:at[i] + size[i]]``."""

    coder: Encoder
    pool: np.ndarray
    at: np.ndarray
    size: np.ndarray


def _side(coder: Encoder, tokens: Sequence[bytes]) -> Side:
    size = np.array([len(t) for t in tokens], "i8")
    return Side(coder, np.frombuffer(b"".join(tokens), "u1"), np.cumsum(size) - size, size)


_sides: dict[tuple[str, str], tuple[Side, Side]] = {}


def sides(vocabulary: str, pieces: str) -> tuple[Side, Side]:
    """This process's encoders."""
    if (vocabulary, pieces) not in _sides:
        a = library_encoder(vocabulary)
        b = WordPieces(pieces)
        _sides[vocabulary, pieces] = _side(a, a.vocabulary.token_bytes()), _side(b, b.bytes)
    return _sides[vocabulary, pieces]


def _joined(side: Side, ids: np.ndarray) -> np.ndarray:
    size = side.size[ids]
    begin = np.cumsum(size) - size
    return side.pool[np.repeat(side.at[ids] - begin, size) + np.arange(int(size.sum()))]


class Aligned(NamedTuple):
    """Ids of texts end to end and the bounds of each text, per side, and whether each token closes a group."""

    a_ids: np.ndarray
    a_bounds: np.ndarray
    b_ids: np.ndarray
    b_bounds: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray


def encode_both(texts: Sequence[str | None], a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and bounds of both sides; texts that do not come back whole from both have none."""
    spaced = [" " + t if t else "" for t in texts]
    raws = [t.encode("utf-8", "surrogatepass") for t in spaced]
    raw = np.frombuffer(b"".join(raws), "u1")
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raws], dtype="i8")])
    coded = []
    whole = np.ones(len(texts), bool)
    for side in (a, b):
        ids, bounds = side.coder.encode_plain(spaced)
        coded.append((ids, bounds))
        joined = _joined(side, ids)
        places = np.concatenate([[0], np.cumsum(side.size[ids])])[bounds]
        if not (np.array_equal(places, starts) and np.array_equal(joined, raw)):
            whole &= [np.array_equal(joined[p:q], raw[s:e]) for p, q, s, e in zip(places, places[1:], starts, starts[1:])]
    if whole.all():
        return *coded[0], *coded[1]
    kept = []
    for ids, bounds in coded:
        size = np.diff(bounds)
        kept += [ids[np.repeat(whole, size)], np.concatenate([[0], np.cumsum(np.where(whole, size, 0))])]
    return tuple(kept)


def align_texts(texts: Sequence[str | None], a: Side, b: Side) -> Aligned:
    a_ids, a_bounds, b_ids, b_bounds = encode_both(texts, a, b)
    a_ends, b_ends = np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
    # Both sides cover the same bytes, so every text's end closes a group.
    ends = shared_ends(a_ends, b_ends)
    a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    a_last[np.searchsorted(a_ends, ends)] = True
    b_last[np.searchsorted(b_ends, ends)] = True
    return Aligned(a_ids, a_bounds, b_ids, b_bounds, a_last, b_last)


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per text of numbers that lie end to end."""
    offsets = (bounds * values.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _bits(marks: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per text of a bit per token."""
    size = np.diff(bounds)
    begin = np.concatenate([[0], np.cumsum(-(-size // 8))])
    padded = np.zeros(8 * int(begin[-1]), bool)
    padded[np.repeat(8 * begin[:-1] - bounds[:-1], size) + np.arange(len(marks))] = marks
    return _blobs(np.packbits(padded), begin)


def _unblobbed(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and the bounds of each row."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1].astype("i8")
    data = column.buffers()[2]
    raw = np.frombuffer(data, "u1")[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, "u1")
    return np.frombuffer(raw.tobytes(), kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _unbits(column: pa.Array, bounds: np.ndarray) -> np.ndarray:
    raw, begin = _unblobbed(column, "u1")
    size = np.diff(bounds)
    return np.unpackbits(raw)[np.repeat(8 * begin[:-1] - bounds[:-1], size) + np.arange(int(size.sum()))].astype(bool)


def _width(side: Side) -> str:
    return "<u2" if len(side.size) <= 1 << 16 else "<u4"


PACKED = ("a_ids", "b_ids", "a_last", "b_last")


def align(df: DataFrame, vocabulary: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id`` and the tokens of both sides, packed; ``token_lists`` unpacks them, other functions read them.

    ``vocabulary`` is a tokenizers file, ``pieces`` a model of word pieces, both at the same path on every executor. ``a_ids`` and
    ``b_ids`` hold little-endian unsigned integers (16 bits where the vocabulary allows), ``a_last`` and ``b_last`` a bit per
    token that is set where it closes a group.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, T.BinaryType()) for n in PACKED]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(vocabulary, pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts, CHUNK_POINTS):
                found = align_texts(texts[low:high], a, b)
                columns = [
                    _blobs(found.a_ids.astype(_width(a)), found.a_bounds), _blobs(found.b_ids.astype(_width(b)), found.b_bounds),
                    _bits(found.a_last, found.a_bounds), _bits(found.b_last, found.b_bounds),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=schema.names)

    return map_arrow(rows, run, schema)


def _read(batches: Iterator[pa.RecordBatch], a: Side, b: Side, limit: int = CHUNK_POINTS) -> Iterator[tuple[pa.Array, Aligned, np.ndarray, np.ndarray]]:
    """Ids of documents, their alignment and the ends of all tokens, for some documents at a time."""
    for batch in batches:
        _, sizes = _unblobbed(batch.column(1), "u1")
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(sizes, sizes[low] + limit, side="right")) - 1
            some = batch.slice(low, min(max(high, low + 1), batch.num_rows) - low)
            a_ids, a_bounds = _unblobbed(some.column(1), _width(a))
            b_ids, b_bounds = _unblobbed(some.column(2), _width(b))
            a_ids, b_ids = a_ids.astype("i8"), b_ids.astype("i8")
            found = Aligned(a_ids, a_bounds, b_ids, b_bounds, _unbits(some.column(3), a_bounds), _unbits(some.column(4), b_bounds))
            yield some.column(0), found, np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
            low += some.num_rows


def token_lists(aligned: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """``id, a_ids, b_ids`` and ``group_a, group_b``, the numbers of tokens of both sides in each group."""
    names = ("a_ids", "b_ids", "group_a", "group_b")
    schema = T.StructType([aligned.schema["id"], *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(vocabulary, pieces)
        lists = lambda bounds, values: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
        for ids, found, _, _ in _read(batches, a, b):
            groups, n_groups = _group_sizes(found)
            columns = [lists(found.a_bounds, found.a_ids), lists(found.b_bounds, found.b_ids), *(lists(n_groups, g) for g in groups)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)

    return map_arrow(aligned.select("id", *PACKED), run, schema)


def _group_sizes(found: Aligned) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The numbers of tokens of both sides in each group, and the bounds of each text's groups."""
    upto = [np.flatnonzero(last) + 1 for last in (found.a_last, found.b_last)]
    sizes = tuple(np.diff(np.concatenate([[0], u])) for u in upto)
    return sizes, np.searchsorted(upto[0], found.a_bounds, side="right")


def link_rows(aligned: DataFrame, vocabulary: str, pieces: str, kind: str) -> DataFrame:
    """One row per link: ``id, a_place, b_place`` (from 0 in the document), ``a_id, b_id`` and the ``n_bytes`` shared (``group``: null)."""
    if kind not in KINDS:
        raise ValueError(f"links are one of {', '.join(KINDS)}")
    names = ("a_place", "b_place", "a_id", "b_id", "n_bytes")
    schema = T.StructType([aligned.schema["id"], *[T.StructField(n, T.IntegerType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(vocabulary, pieces)
        for ids, found, a_ends, b_ends in _read(batches, a, b):
            for i, j, shared in links(a_ends, b_ends, kind):
                owner = np.searchsorted(found.a_bounds, i, side="right") - 1
                values = [i - found.a_bounds[owner], j - found.b_bounds[owner], found.a_ids[i], found.b_ids[j]]
                told = pa.nulls(len(i), pa.int32()) if kind == "group" else pa.array(shared, pa.int32())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner)), *(pa.array(v, pa.int32()) for v in values), told], names=schema.names)

    return map_arrow(aligned.select("id", *PACKED), run, schema)


COUNTS = "a_id int, b_id int, n long"


def link_counts(aligned: DataFrame, vocabulary: str, pieces: str, kind: str = "end") -> DataFrame:
    """How many links of all documents hold each pair of ids: ``a_id, b_id, n``.

    A task adds up its own links first; it gives its sums out whenever it holds more pairs than ``PRODUCT_CELLS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(vocabulary, pieces)
        pairs, counts = np.zeros(0, "i8"), np.zeros(0, "i8")

        def told() -> pa.RecordBatch:
            values = ((pairs >> 32, pa.int32()), (pairs & 0xFFFFFFFF, pa.int32()), (counts, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in values], names=["a_id", "b_id", "n"])

        for _, found, a_ends, b_ends in _read(batches, a, b):
            for i, j, _ in links(a_ends, b_ends, kind):
                more, n = np.unique(found.a_ids[i] << 32 | found.b_ids[j], return_counts=True)
                pairs, where = np.unique(np.concatenate([pairs, more]), return_inverse=True)
                sums = np.zeros(len(pairs), "i8")
                np.add.at(sums, where, np.concatenate([counts, n]))
                counts = sums
                if len(pairs) > PRODUCT_CELLS:
                    yield told()
                    pairs, counts = np.zeros(0, "i8"), np.zeros(0, "i8")
        if len(pairs):
            yield told()

    parts = map_arrow(aligned.select("id", *PACKED), run, COUNTS)
    return parts.groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def most_end_pairs(vocabulary: str, pieces: str) -> int:
    """How many pairs of ids can end together at all: one's bytes are a suffix of the other's."""
    a, b = sides(vocabulary, pieces)
    held = []
    for side in (a, b):
        whole = side.pool.tobytes()
        held.append([whole[p : p + n] for p, n in zip(side.at.tolist(), side.size.tolist(), strict=True) if n])
    total = 0
    for shorter, longer, strict in ((held[0], held[1], 0), (held[1], held[0], 1)):
        times = Counter(shorter)
        total += sum(times[token[k:]] for token in longer for k in range(strict, len(token)))
    return total


def score_end_links(aligned: DataFrame, counts: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """Per document ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``counts`` are those of ``end`` links; ``n_best`` links hold the highest count of their B id, ties included. The digest is of
    ``a1,a2|b1;a3|b2,b3``: decimal ids of each group; documents without tokens have an empty one.
    """
    bound = most_end_pairs(vocabulary, pieces)
    table = counts.select("a_id", "b_id", "n").limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError("the counts are not those of links that end together")
    pair = table["a_id"].to_numpy().astype("i8") << 32 | table["b_id"].to_numpy().astype("i8")
    order = np.argsort(pair, kind="stable")
    times, b_of = table["n"].to_numpy()[order], table["b_id"].to_numpy()[order]
    highest = np.zeros(int(b_of.max()) + 1 if len(b_of) else 0, "i8")
    np.maximum.at(highest, b_of, times)
    shared = aligned.sparkSession.sparkContext.broadcast((pair[order], times, times == highest[b_of]))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([aligned.schema["id"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(vocabulary, pieces)
        known, times, best = shared.value
        texts = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(a.size), len(b.size)))]
        step = len(texts) // 3
        for ids, found, a_ends, b_ends in _read(batches, a, b):
            n = len(ids)
            sums = np.zeros((3, n), "i8")
            for i, j, _ in links(a_ends, b_ends, "end"):
                place = np.searchsorted(known, found.a_ids[i] << 32 | found.b_ids[j])
                owner = np.searchsorted(found.a_bounds, i, side="right") - 1
                for row, values in enumerate((np.ones(len(i), "i8"), best[place].astype("i8"), times[place])):
                    np.add.at(sums[row], owner, values)
            # Tokens in the order of groups, A before B, each with the mark that follows it.
            (group_a, group_b), n_groups = _group_sizes(found)
            upto_a, upto_b = np.cumsum(group_a), np.cumsum(group_b)
            a_place = np.arange(len(found.a_ids)) + np.repeat(upto_b - group_b, group_a)
            b_place = np.arange(len(found.b_ids)) + np.repeat(upto_a, group_b)
            codes = np.zeros(len(found.a_ids) + len(found.b_ids), "i8")
            codes[a_place], codes[b_place] = found.a_ids, found.b_ids
            codes[a_place[upto_a - 1]] += step
            codes[b_place[upto_b - 1]] += 2 * step
            every = codes.tolist()
            bounds = (found.a_bounds + found.b_bounds).tolist()
            digests = [
                hashlib.sha256("".join(map(texts.__getitem__, every[p:q]))[:-1].encode()).hexdigest() if q > p else ""
                for p, q in zip(bounds, bounds[1:])
            ]
            values = (np.diff(found.a_bounds), np.diff(found.b_bounds), np.diff(n_groups), *sums)
            columns = [ids, *(pa.array(v, pa.int64()) for v in values), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(aligned.select("id", *PACKED), run, schema)


def alignment_scores(df: DataFrame, vocabulary: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_end_links`` of the table, with the counts of the whole table."""
    aligned = keep(align(df, vocabulary, pieces, id_col, text_col), "aligned")
    counts = keep(link_counts(aligned, vocabulary, pieces), "link-counts")
    return score_end_links(aligned, counts, vocabulary, pieces)
