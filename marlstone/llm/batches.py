"""The texts of a batch as flat arrays of code points: words, lines, hashes and shingles without a loop per word.

Everything here works on one chunk of a batch at a time, so memory depends on the chunk's size
and on the longest single text only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
from xxhash import xxh3_64_intdigest

CHUNK_POINTS = 2_000_000
#: Numbers that steps over long arrays work on at a time.
CACHED = 1 << 14
SHINGLE_WORDS = 5
SHORT = 32
_BASE = 0x9E3779B97F4A7C15
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], "u8")


class Texts(NamedTuple):
    """``points`` of all texts end to end; text ``i`` is ``points[starts[i]:starts[i + 1]]``."""

    points: np.ndarray
    starts: np.ndarray

    @property
    def count(self) -> int:
        return len(self.starts) - 1


class Spans(NamedTuple):
    """Stretches ``[first, last)`` of the points and the number of the text that holds each."""

    first: np.ndarray
    last: np.ndarray
    text: np.ndarray


def flatten(texts: Sequence[str | None]) -> Texts:
    """Null counts as empty."""
    parts = [t or "" for t in texts]
    starts = np.zeros(len(parts) + 1, "i8")
    np.cumsum(np.fromiter(map(len, parts), "i8", len(parts)), out=starts[1:])
    return Texts(np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4"), starts)


def chunks(texts: Sequence[str | None], limit: int = CHUNK_POINTS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` code points each; a longer text is a range of its own."""
    low = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > limit:
            yield low, i
            low, held = i, 0
        held += size
    if low < len(texts):
        yield low, len(texts)


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (a bijection)."""
    out = values.astype("u8", copy=True)
    # Stretches that stay in the processor's cache through all steps.
    held = np.empty(min(len(out), CACHED), "u8")
    for low in range(0, len(out), CACHED):
        v = out[low : low + CACHED]
        t = held[: len(v)]
        v ^= np.right_shift(v, np.uint64(30), out=t)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= np.right_shift(v, np.uint64(27), out=t)
        v *= np.uint64(0x94D049BB133111EB)
        v ^= np.right_shift(v, np.uint64(31), out=t)
    return out


class HashIndex:
    """Distinct 64-bit keys, numbered in the order they were added; lookups of many keys are a few array steps."""

    def __init__(self, keys: np.ndarray | None = None) -> None:
        self.keys = np.zeros(0, "u8")
        self._size = 0
        self._slots = np.full(1 << 10, -1, "i4")
        if keys is not None:
            self.add(keys)

    def __len__(self) -> int:
        return self._size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        bits = len(self._slots).bit_length() - 1
        return ((keys * np.uint64(_BASE)) >> np.uint64(64 - bits)).astype("i8")

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slots, mask = self._slot(keys), len(self._slots) - 1
        while len(numbers):
            free = self._slots[slots] < 0
            self._slots[slots[free]] = numbers[free]
            lost = self._slots[slots] != numbers
            slots, numbers = (slots[lost] + 1) & mask, numbers[lost]

    def add(self, keys: np.ndarray) -> None:
        """Keys must be distinct and new."""
        size = self._size + len(keys)
        if size > len(self.keys):
            grown = np.zeros(max(size, 2 * len(self.keys)), "u8")
            grown[: self._size] = self.keys[: self._size]
            self.keys = grown
        self.keys[self._size : size] = keys
        if 2 * size > len(self._slots):
            self._slots = np.full(1 << (4 * size).bit_length(), -1, "i4")
            self._put(self.keys[:size], np.arange(size, dtype="i4"))
        else:
            self._put(keys, np.arange(self._size, size, dtype="i4"))
        self._size = size

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        if not self._size:
            return np.full(len(keys), -1, "i8")
        slots, mask = self._slot(keys), len(self._slots) - 1
        found = self._slots[slots]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & mask
            found[wrong] = self._slots[slots[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[found[wrong]] != keys[wrong])]
        return found.astype("i8")


def range_hashes(marks: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the marks in each range ``[first, last)``; it depends on nothing else.

    Ranges of up to ``SHORT`` marks take in one mark after the other, all ranges together, each step scattering what was there before, so that
    no regular text cancels out; longer ones go through XXH3 one by one.
    """
    size = last - first
    out = np.zeros(len(size), "u8")
    # The longest come first, so that those that still take in marks are the first ones of the arrays.
    order = np.argsort(SHORT + 1 - np.minimum(size, SHORT + 1).astype("u1"), kind="stable")
    n_long = int((size > SHORT).sum())
    if n_long:
        marks = np.ascontiguousarray(marks)
        view = memoryview(marks)
        spans = zip(first[order[:n_long]].tolist(), last[order[:n_long]].tolist(), strict=True)
        out[order[:n_long]] = np.fromiter((xxh3_64_intdigest(view[a:b]) for a, b in spans), "u8", n_long)
    order = order[n_long:]
    begin, length = first[order], size[order]
    state = mix(length.astype("u8") + np.uint64(_BASE))
    held = np.empty(min(len(state), CACHED), "u8")
    for low in range(0, len(state), CACHED):
        here, sizes = begin[low : low + CACHED].copy(), length[low : low + CACHED]
        going = len(sizes) - np.cumsum(np.bincount(sizes, minlength=SHORT + 1))
        for k in range(int(sizes[0])):
            some, t, at = state[low : low + going[k]], held[: going[k]], here[: going[k]]
            some ^= marks[at]
            at += 1
            some *= np.uint64(_BASE)
            some ^= np.right_shift(some, np.uint64(29), out=t)
    out[order] = mix(state)
    return out


def span_hashes(points: np.ndarray, spans: Spans) -> np.ndarray:
    """A 64-bit hash of the points of each span."""
    return range_hashes(points, spans.first, spans.last)


def is_space(points: np.ndarray) -> np.ndarray:
    """The characters 0x20 and 0x09 to 0x0D."""
    return (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))


def lower_ascii(points: np.ndarray) -> np.ndarray:
    # Below 65 the difference wraps round; the letters' bit of 32 is free.
    return points | ((points - np.uint32(65) <= 90 - 65).astype("u4") << np.uint32(5))


def _runs(texts: Texts, inside: np.ndarray) -> Spans:
    """Longest stretches of points marked ``inside``; none crosses the end of a text."""
    size = len(inside)
    if not size:
        none = np.zeros(0, "i8")
        return Spans(none, none, none)
    edge = np.zeros(size + 1, bool)
    edge[texts.starts] = True
    begins = inside & edge[:-1]
    begins[1:] |= inside[1:] & ~inside[:-1]
    ends = inside & edge[1:]
    ends[:-1] |= inside[:-1] & ~inside[1:]
    first = np.flatnonzero(begins)
    # The texts begin at fewer places than runs do.
    per_text = np.diff(np.searchsorted(first, texts.starts))
    return Spans(first, np.flatnonzero(ends) + 1, np.repeat(np.arange(texts.count), per_text))


def text_of(texts: Texts, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(texts.starts, places, side="right") - 1


def words(texts: Texts) -> Spans:
    """Runs of characters other than 0x20 and 0x09 to 0x0D."""
    return _runs(texts, ~is_space(texts.points))


def lines(texts: Texts) -> Spans:
    """What lies between line feeds, empty lines included; an empty text has one empty line."""
    breaks = np.flatnonzero(texts.points == 10)
    first = np.sort(np.concatenate([texts.starts[:-1], breaks + 1]), kind="stable")
    last = np.sort(np.concatenate([texts.starts[1:], breaks]), kind="stable")
    per_text = np.bincount(text_of(texts, breaks), minlength=texts.count) + 1
    return Spans(first, last, np.repeat(np.arange(texts.count), per_text))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` neighbouring hashes, for ``n`` up to five."""
    size = max(0, len(hashes) - n + 1)
    total = np.full(size, n, "u8")
    for j in range(n):
        total = mix(total ^ hashes[j : size + j]) * _ODD[j]
    return total


def shingles(word_hashes: np.ndarray, text: np.ndarray, n_texts: int, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and their texts, in order; a text with fewer words gives its whole sequence once."""
    counts = np.bincount(text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    found, owners = [], []
    if len(word_hashes) >= n:
        whole = text[: len(text) - n + 1] == text[n - 1 :]
        found.append(sequence_hashes(word_hashes, n)[whole])
        owners.append(text[: len(text) - n + 1][whole])
    for m in range(1, n):
        few = np.flatnonzero(counts == m)
        if len(few):
            found.append(sequence_hashes(word_hashes, m)[first[few]])
            owners.append(few)
    if not found:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    hashes, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]


def in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The hashes made different for each text of the chunk."""
    return mix(hashes ^ mix(text.astype("u8") + np.uint64(0x51ED270B)))


class Shape(NamedTuple):
    """Counts per text, all as arrays of int64."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_lines: np.ndarray


SYMBOLS = "#*$%&|<>"


def shape(texts: Texts) -> Shape:
    """Words, their code points, symbols, repeated lines and words in repeated three-word windows."""
    points, n = texts.points, texts.count
    found = words(texts)
    per_text = lambda owner, weights=None: np.bincount(owner, weights, minlength=n).astype("i8")
    marked = np.flatnonzero(np.isin(points, np.array([ord(c) for c in SYMBOLS], "u4")))
    rows = lines(texts)
    word_sums = np.concatenate([[0], np.cumsum(~is_space(points))])
    with_word = word_sums[rows.last] > word_sums[rows.first]
    rows = Spans(rows.first[with_word], rows.last[with_word], rows.text[with_word])
    n_lines = per_text(rows.text)
    _, where = np.unique(in_text(span_hashes(points, rows), rows.text), return_index=True)
    hashes = in_text(span_hashes(points, found), found.text)
    repeated = np.zeros(len(hashes) + 3, bool)
    if len(hashes) >= 3:
        same = found.text[:-2] == found.text[2:]
        windows = sequence_hashes(hashes, 3)
        starts = np.flatnonzero(same)
        _, which, times = np.unique(windows[starts], return_inverse=True, return_counts=True)
        often = starts[times[which] > 1]
        for j in range(3):
            repeated[often + j] = True
    return Shape(
        per_text(found.text),
        per_text(found.text, found.last - found.first),
        per_text(text_of(texts, marked)),
        n_lines - per_text(rows.text[where]),
        per_text(found.text[repeated[: len(hashes)]]),
        n_lines,
    )
