"""Byte-pair encoding and decoding with a published vocabulary.

Each piece of text is short. Its parts and the ranks of neighbouring parts lie in contiguous arrays; the lowest rank is looked for
by scanning, its boundary deleted, and the two ranks beside it are looked up again until no pair has a rank. Pieces
of equal length go through these steps together, one row each, so that a step is a few array operations for
thousands of pieces. Pieces above ``LONG_PIECE`` bytes, where scanning over and over would take quadratic time, keep
their ranks in a heap; both give the same ids.

Pieces repeat a lot, so each worker process keeps the ids of those it has seen, at most ``CACHE_PIECES``.

Defined cases: null text is empty, an empty text has no ids; special tokens of the vocabulary found in a text become
their id; text beyond Latin letters is covered through its bytes; other columns pass through unchanged.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np

from marlstone.llm.batches import HashIndex, Spans, Texts, chunks, flatten, span_hashes
from marlstone.llm.pieces import cut, plain_lower

LONG_PIECE = 128
CACHE_PIECES = 2_000_000
BLOCK_CELLS = 1_000_000
NO_RANK = np.iinfo("i8").max


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary files.

    Printable bytes stand for themselves, the others get the characters from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ids, ranks and special tokens of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.joined = told["normalizer"] is None
        size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, number in (*ids.items(), *self.special.items()):
            self.tokens[number] = token
        letters = byte_letters()
        self.of_byte = np.array([ids[c] for c in letters], "i8")
        self.of_last = np.array([ids[c + self.suffix] for c in letters], "i8")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._pairs = HashIndex(np.array([ids[a] << 32 | ids[b] for a, b in pairs], "u8"))
        self._merged = np.array([ids[a + b] for a, b in pairs], "i8")
        self._byte_of = {c: b for b, c in enumerate(letters)}
        self._special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NO_RANK`` for pairs that never merge."""
        found = self._pairs.find((left << 32 | right).astype("u8").ravel()).reshape(left.shape)
        return np.where(found >= 0, found, NO_RANK)

    def encode_pieces(self, raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces ``raw[first:first + size]`` (bytes) end to end, and how many each has."""
        counts = np.zeros(len(first), "i8")
        blocks: list[tuple[np.ndarray, np.ndarray]] = []
        for width in np.unique(size):
            where = np.flatnonzero(size == width)
            for low in range(0, len(where), max(1, BLOCK_CELLS // int(width))):
                some = where[low : low + max(1, BLOCK_CELLS // int(width))]
                rows = raw[first[some][:, None] + np.arange(width)]
                parts = self.of_byte[rows]
                parts[:, -1] = self.of_last[rows[:, -1]]
                if width > LONG_PIECE:
                    blocks += [(some[k : k + 1], self._merge_long(row.tolist())[None]) for k, row in enumerate(parts)]
                else:
                    self._merge_rows(parts, some, blocks)
        for where, parts in blocks:
            counts[where] = parts.shape[1]
        begin = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), "i4")
        for where, parts in blocks:
            ids[begin[where][:, None] + np.arange(parts.shape[1])] = parts
        return ids, counts

    def _merge_rows(self, parts: np.ndarray, where: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Merge all rows step by step; rows that are done go to ``blocks``."""
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while True:
            n, width = parts.shape
            if width > 1:
                best = ranks.argmin(axis=1)
                lowest = ranks[np.arange(n), best]
                ended = lowest == NO_RANK
            else:
                ended = np.ones(n, bool)
            if ended.any():
                blocks.append((where[ended], parts[ended]))
            if ended.all():
                return
            going = ~ended
            parts, ranks, where, best, lowest = parts[going], ranks[going], where[going], best[going], lowest[going]
            n, rows = len(parts), np.arange(len(parts))
            parts[rows, best] = self._merged[lowest]
            stays = np.ones((n, width), bool)
            stays[rows, best + 1] = False
            parts = parts[stays].reshape(n, width - 1)
            stays = np.ones((n, width - 1), bool)
            stays[rows, best] = False
            ranks = ranks[stays].reshape(n, width - 2)
            for shift in (-1, 0):
                at = best + shift
                inside = np.flatnonzero((at >= 0) & (at < width - 2))
                ranks[inside, at[inside]] = self.ranks(parts[inside, at[inside]], parts[inside, at[inside] + 1])

    def _merge_long(self, parts: list[int]) -> np.ndarray:
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        known = self.ranks(np.array(parts[:-1], "i8"), np.array(parts[1:], "i8"))
        heap = [(int(known[i]), int(i)) for i in np.flatnonzero(known != NO_RANK)]
        heapq.heapify(heap)
        alive, rank_at = [True] * size, dict((i, r) for r, i in heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if not alive[i] or rank_at.get(i) != rank:
                continue
            gone = after[i]
            parts[i], alive[gone], after[i] = int(self._merged[rank]), False, after[gone]
            if after[i] < size:
                before[after[i]] = i
            rank_at.pop(gone, None)
            for left in (before[i], i):
                rank_at.pop(left, None)
                if left >= 0 and after[left] < size:
                    pair = np.array([parts[left], parts[after[left]]], "i8")
                    found = int(self.ranks(pair[:1], pair[1:])[0])
                    if found != NO_RANK:
                        rank_at[left] = found
                        heapq.heappush(heap, (found, left))
        return np.array([p for p, held in zip(parts, alive, strict=True) if held], "i8")

    def token_bytes(self) -> list[bytes]:
        """What each id stands for, special tokens as their names."""
        plain = lambda token: bytes(map(self._byte_of.__getitem__, token))
        return [token.encode() if token in self.special else plain(token) for token in self.tokens]

    def special_parts(self, text: str) -> list[str]:
        """The text cut at special tokens; every second part is such a token."""
        return re.split(f"({self._special_pattern.pattern})", text)

    def holds_special(self, text: str) -> bool:
        return self._special_pattern is not None and self._special_pattern.search(text) is not None

    def decode(self, ids: Sequence[int], tokens: Sequence[str] | None = None) -> str:
        """Vocabularies with white space in their pieces give the text back; the others give tokens joined by blanks."""
        tokens = self.tokens if tokens is None else tokens
        if not self.joined:
            return " ".join(map(tokens.__getitem__, ids))
        found, out = bytearray(), []
        names = self.special
        for token in map(tokens.__getitem__, ids):
            if token in names:
                out += [found.decode("utf-8", "replace"), token]
                found = bytearray()
            else:
                found += bytes(map(self._byte_of.__getitem__, token))
        return "".join([*out, found.decode("utf-8", "replace")])


class Encoder:
    """Encodes chunks of texts, remembering the ids of pieces. One per worker process.

    ``encode_pieces`` takes bytes, first places and sizes of pieces, and gives all ids and the count of each.
    """

    def __init__(self, vocabulary: Vocabulary, encode_pieces: Callable | None = None) -> None:
        self.vocabulary = vocabulary
        self._encode_pieces = encode_pieces or vocabulary.encode_pieces
        self._forget()

    def _forget(self) -> None:
        self._known = HashIndex()
        self._begin = np.zeros(0, "i4")
        self._count = np.zeros(0, "i4")
        self._pool = np.zeros(0, "i4")

    def _learn(self, hashes: np.ndarray, points: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Encode pieces of the points that were not seen before."""
        size = last - first
        begin = np.cumsum(size) - size
        text = points[np.repeat(first - begin, size) + np.arange(int(size.sum()))]
        raw = np.frombuffer(text.tobytes().decode("utf-32-le", "replace").encode(), "u1")
        width = 1 + (text > 0x7F).astype("i8") + (text > 0x7FF) + (text > 0xFFFF)
        places = np.concatenate([[0], np.cumsum(width)])
        ids, counts = self._encode_pieces(raw, places[begin], places[begin + size] - places[begin])
        self._begin = np.concatenate([self._begin, (len(self._pool) + np.cumsum(counts) - counts).astype("i4")])
        self._count = np.concatenate([self._count, counts.astype("i4")])
        self._pool = np.concatenate([self._pool, ids.astype("i4")])
        self._known.add(hashes)

    def pieces(self, texts: Sequence[str]) -> tuple[Texts, Spans]:
        """The texts end to end, and the stretches of them that are encoded apart from each other."""
        if not self.vocabulary.joined:
            texts = [plain_lower(t) for t in texts]
        flat = flatten(texts)
        return flat, cut(flat, self.vocabulary.joined)

    def encode_plain(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin; the strings of special tokens are plain text."""
        flat, pieces = self.pieces(texts)
        hashes = span_hashes(flat.points, pieces)
        if len(self._known) > CACHE_PIECES:
            self._forget()
        place = self._known.find(hashes)
        unseen = np.flatnonzero(place < 0)
        if len(unseen):
            fresh, where = np.unique(hashes[unseen], return_index=True)
            where = unseen[where]
            self._learn(fresh, flat.points, pieces.first[where], pieces.last[where])
            place[unseen] = self._known.find(hashes[unseen])
        counts = self._count[place]
        ends = np.cumsum(counts, dtype="i8")
        total = int(ends[-1]) if len(ends) else 0
        ids = self._pool[np.repeat((self._begin[place] - (ends - counts)).astype("i4"), counts) + np.arange(total, dtype="i4")]
        bounds = np.concatenate([[0], ends])[np.searchsorted(pieces.first, flat.starts)]
        return ids, bounds

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk of texts end to end as int32, and the bounds of each text's ids."""
        texts = [t or "" for t in texts]
        special = self.vocabulary.special
        if not any(self.vocabulary.holds_special(t) for t in texts):
            return self.encode_plain(texts)
        parts = [self.vocabulary.special_parts(t) for t in texts]
        plain, bounds = self.encode_plain([p for found in parts for p in found[::2]])
        out, sizes, k = [], [], 0
        for found in parts:
            size = 0
            for j, part in enumerate(found):
                ids = np.array([special[part]], "i4") if j % 2 else plain[bounds[k] : bounds[k + 1]]
                k += 1 - j % 2
                out.append(ids)
                size += len(ids)
            sizes.append(size)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if (path, "scan") not in _encoders:
        _encoders[path, "scan"] = Encoder(Vocabulary(path))
    return _encoders[path, "scan"]


def library_encoder(path: str) -> Encoder:
    """The same, but pieces not seen before go through the tokenizers library's own model.

    Each distinct piece is given to the library once per process; cutting and looking up happen in arrays.
    """
    if (path, "library") not in _encoders:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path).model
        letters = np.array([ord(c) for c in byte_letters()], "<u4")

        def encode_pieces(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            names = letters[raw].tobytes().decode("utf-32-le")
            found = [[t.id for t in model.tokenize(names[a : a + n])] for a, n in zip(first.tolist(), size.tolist(), strict=True)]
            counts = np.fromiter(map(len, found), "i8", len(found))
            return np.fromiter(chain.from_iterable(found), "i4", int(counts.sum())), counts

        _encoders[path, "library"] = Encoder(Vocabulary(path), encode_pieces)
    return _encoders[path, "library"]


def encode_in_chunks(
    texts: Sequence[str | None], encode: Callable, limit: int | None = None
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their ids and bounds."""
    for low, high in chunks(texts, limit) if limit else chunks(texts):
        ids, bounds = encode(texts[low:high])
        yield low, high, ids, bounds
