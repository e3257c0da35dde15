"""Packing encoded documents into sequences in their order, with cuts chosen by dynamic programming.

The documents of a partition, each with its end id, are one stream of tokens in the order of the rows. A sequence is a stretch of at most
``capacity`` tokens between two places where cutting is allowed: ends of documents, which cost nothing, and ends of sentences or lines
within one, which cost ``SENTENCE_CUT`` tokens. Only where a stretch longer than a sequence has neither may it be cut between words, or
tokens where words are that long, for ``WORD_CUT``. A sequence is filled up to ``capacity``, except where its length is a power of two. The least cost
up to a place is the place's own penalty plus the least, over all allowed starts within reach, of the cost up to the start and the filling.
Filling is capacity less length, so starts compare by cost plus place, and a monotone queue gives the best one at a
constant price; starts at a distance of a power of two are looked up apart. Ties go to the longer sequence.

The stream is worked through chunk by chunk. What all open ends have in common is settled and leaves the task, so that the result is that
of the whole stream and memory holds little more than a chunk. Some streams never settle (say, sentences of one length only); after
``HORIZON`` open tokens the end of the last document read becomes a cut. Nothing is shuffled: the last sequence of each
partition is the only one that its neighbours could have filled.

Defined cases: null text is empty, so the document is its end id alone; null and repeated ids stay, each row is a document; an empty
table gives no pieces; a text longer than a sequence is cut as above; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import CHUNK_POINTS, chunks
from marlstone.llm.bpe import Vocabulary, library_encoder
from marlstone.llm.storage import map_arrow
from marlstone.llm.token_files import ends_added

CAPACITY = 2048
SENTENCE_CUT = 8
WORD_CUT = 64
HORIZON = 1 << 22
#: What ends a sentence, and what may follow it before the next one.
STOPS = ".!?…。！？"
CLOSERS = "\"')]}»”’"


class Cutter:
    """Cheapest cuts of a growing stream."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self._powers = [1 << b for b in range(capacity.bit_length()) if 1 << b < capacity]
        self._restart(0, 0)

    def _restart(self, place: int, number: int) -> None:
        # State ``i`` is the place ``_place[i - _low]``, reached at ``_cost`` from the state ``_back``.
        self._place, self._cost, self._back, self._low = [place], [0], [number], number
        self._queue = deque([(place, number)])
        self.root = number

    @property
    def end(self) -> int:
        return self._place[-1]

    def extend(self, places: np.ndarray, penalties: np.ndarray) -> None:
        """Rising places after ``end`` where a cut is allowed, no two neighbours further apart than the capacity."""
        reach, low, n_known = self.capacity, self._low, self._low + len(self._place)
        recent = np.array(self._place[-reach:], "i8")
        every = np.concatenate([recent, places])
        shift = n_known - len(recent)
        at, start = [], []
        for power in self._powers:
            found = np.searchsorted(every, places - power)
            hit = np.flatnonzero(every[np.minimum(found, len(every) - 1)] == places - power)
            at.append(hit)
            start.append(found[hit] + shift)
        order = np.argsort(np.concatenate(at), kind="stable") if at else np.zeros(0, "i8")
        exact_at = [*np.concatenate(at)[order].tolist(), -1] if at else [-1]
        exact = np.concatenate(start)[order].tolist() if at else []
        known, cost, back, queue = self._place, self._cost, self._back, self._queue
        k = 0
        for j, (place, penalty) in enumerate(zip(places.tolist(), penalties.tolist(), strict=True)):
            while known[queue[0][1] - low] < place - reach:
                queue.popleft()
            least, start_ = queue[0]
            least += reach - place
            while exact_at[k] == j:
                if cost[exact[k] - low] < least:
                    least, start_ = cost[exact[k] - low], exact[k]
                k += 1
            least += penalty
            known.append(place)
            cost.append(least)
            back.append(start_)
            while queue and queue[-1][0] > least + place:
                queue.pop()
            queue.append((least + place, n_known + j))

    def _path(self, last: int) -> list[int]:
        found = []
        while last > self.root:
            found.append(self._place[last - self._low])
            last = self._back[last - self._low]
        return found[::-1]

    def settle(self, horizon: int = HORIZON, done: bool = False) -> list[int]:
        """The next cuts that no later place can change; all of them when ``done``."""
        low, last = self._low, self._low + len(self._place) - 1
        if done or self.end - self._place[self.root - low] > horizon:
            found = self._path(last)
            self._restart(self.end, last)
            return found
        open_ = [-i for i in range(last, low - 1, -1) if self._place[i - low] >= self.end - self.capacity]
        heapq.heapify(open_)
        common = -heapq.heappop(open_)
        while open_:
            following = -heapq.heappop(open_)
            if following != common:
                # The later one steps back until all have met.
                heapq.heappush(open_, -following)
                heapq.heappush(open_, -max(self._back[common - low], self.root))
                common = -heapq.heappop(open_)
        found = self._path(common)
        self.root = common
        del self._place[: common - low], self._cost[: common - low], self._back[: common - low]
        self._low = common
        return found


class Breaks:
    """Where the tokens of a vocabulary end a sentence or a line, and where they begin a word."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        texts = [vocabulary.decode([i]) for i in range(len(vocabulary.tokens))]
        self.ends = np.array([t.rstrip(CLOSERS)[-1:] in STOPS and t.rstrip(CLOSERS) != "" for t in texts])
        self.line = np.array(["\n" in t for t in texts])
        self.begins = np.array([t[:1].isspace() for t in texts])

    def places(self, ids: np.ndarray, bounds: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
        """Allowed cuts of documents (with end ids) and their penalties; cuts are counted from the first token."""
        word = np.zeros(len(ids) + 1, bool)
        word[1:-1] = self.begins[ids[1:]]
        sentence = np.zeros(len(ids) + 1, bool)
        sentence[1:-1] = (self.ends[ids[:-1]] & word[1:-1]) | self.line[ids[:-1]]
        sentence[bounds[1:] - 1] = False  # not before an end id
        sentence[0] = False
        whole = np.zeros(len(ids) + 1, bool)
        whole[bounds[1:]] = True
        found = np.flatnonzero(sentence | whole)
        for level in (word, np.ones(len(ids) + 1, bool)):
            before = np.concatenate([[0], found[:-1]]) if len(found) else found
            wide = np.flatnonzero(found - before > capacity)
            more = [np.flatnonzero(level[before[g] + 1 : found[g]]) + before[g] + 1 for g in wide.tolist()]
            found = np.sort(np.concatenate([found, *more]), kind="stable")
        penalties = np.where(whole[found], 0, np.where(sentence[found], SENTENCE_CUT, WORD_CUT))
        return found, penalties


def pack_in_order(
    df: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    chunk_points: int = CHUNK_POINTS,
    horizon: int = HORIZON,
) -> DataFrame:
    """One row per piece: ``id, start`` (the document's ids before it), ``length, doc_tokens, sequence_id, offset, ids``.

    With ``digest``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) takes the place of the ids.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.LongType()))
    names = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, T.LongType()) for n in names], last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(vocabulary)
        breaks = Breaks(coder.vocabulary)
        cutter = Cutter(capacity)
        sequence = TaskContext.get().partitionId() << 40
        # The open part of the stream: its first place, tokens, and the documents with tokens in it.
        first, held = 0, np.zeros(0, "<u4")
        owners = None
        starts, sizes = np.zeros(0, "i8"), np.zeros(0, "i8")

        def pieces(cuts: list[int]) -> pa.RecordBatch:
            nonlocal first, held, owners, starts, sizes, sequence
            ends = np.array(cuts, "i8")
            opens = np.concatenate([[first], ends[:-1]])
            inside = starts[(starts > first) & (starts < ends[-1])]
            begin = np.union1d(opens, inside)
            size = np.diff(np.append(begin, ends[-1]))
            owner = np.searchsorted(starts, begin, side="right") - 1
            window = np.searchsorted(opens, begin, side="right") - 1
            places = (begin - first).tolist()
            if digest:
                whole = memoryview(held.tobytes())
                told = pa.array([zlib.crc32(whole[4 * a : 4 * (a + n)]) for a, n in zip(places, size.tolist(), strict=True)], pa.int64())
            else:
                bounds = pa.array([*places, int(ends[-1]) - first], pa.int32())
                told = pa.ListArray.from_arrays(bounds, pa.array(held[: int(ends[-1]) - first], pa.int64()))
            values = (begin - starts[owner], size, sizes[owner], sequence + window, begin - opens[window])
            columns = [owners.take(pa.array(owner)), *(pa.array(v, pa.int64()) for v in values), told]
            sequence += len(cuts)
            held, first = held[ends[-1] - first :], int(ends[-1])
            gone = int(np.searchsorted(starts + sizes, first, side="right"))
            owners, starts, sizes = owners.slice(gone), starts[gone:], sizes[gone:]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts, chunk_points):
                ids, bounds = ends_added(*coder.encode(texts[low:high]), end_id)
                end = first + len(held)
                places, penalties = breaks.places(ids, bounds, capacity)
                cutter.extend(places + end, penalties)
                held = np.concatenate([held, ids.astype("<u4")])
                some = batch.column(0).slice(low, high - low)
                owners = some if owners is None or not len(owners) else pa.concat_arrays([owners, some])
                starts, sizes = np.concatenate([starts, end + bounds[:-1]]), np.concatenate([sizes, np.diff(bounds)])
                cuts = cutter.settle(horizon)
                if cuts:
                    yield pieces(cuts)
        if len(held):
            yield pieces(cutter.settle(done=True))

    return map_arrow(rows, run, schema)
