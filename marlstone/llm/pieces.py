"""Cutting texts into the pieces within which a BPE vocabulary merges, for a whole chunk of texts at once.

Two published patterns are covered, told apart by the vocabulary file:

* ``joined``: a blank belongs to the piece after it, every character ends up in some piece;
* ``bare``: letters, single digits and other runs of lower-cased text, white space dropped.

In both, the endings 's 't 're 've 'm 'll 'd are pieces of their own where a piece starts with their apostrophe.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import regex

from marlstone.llm.batches import Spans, Texts, text_of

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Fixed values of the published patterns.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.zeros(0x110000, "u1")
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for found in regex.finditer(pattern, every):
                table[low + found.start() : low + found.end()] = kind
    return table


def kinds_of(points: np.ndarray) -> np.ndarray:
    return _kinds()[points]


def plain_lower(text: str) -> str:
    """Composed and lower-cased character by character, so without a special form for a last sigma."""
    composed = unicodedata.normalize("NFC", text)
    return composed.replace("Σ", "σ").lower()


def _endings(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray, end_of: np.ndarray) -> list[tuple[int, int]]:
    """Places of apostrophes that open a piece and are followed by one of the endings, with the ending's length."""
    found = []
    for place in opens.tolist():
        rest = points[place + 1 : min(place + 3, end_of[place])]
        for ending in ENDINGS:
            if len(rest) >= len(ending) and all(rest[i] == ord(c) for i, c in enumerate(ending)):
                found.append((place, len(ending)))
                break
    return found


def cut(texts: Texts, joined: bool) -> Spans:
    """The pieces of all texts, in order."""
    points, size = texts.points, len(texts.points)
    if not size:
        none = np.zeros(0, "i8")
        return Spans(none, none, none)
    kinds = _kinds()[points]
    edge = np.zeros(size + 1, bool)
    edge[texts.starts] = True
    change = edge[:-1].copy()
    change[1:] |= kinds[1:] != kinds[:-1]
    starts = change.copy()
    if not joined:
        starts |= kinds == NUMBER
    solid = kinds != SPACE
    blank_before = np.zeros(size, bool)
    blank_before[1:] = (points[:-1] == 0x20) & ~edge[1:-1]
    apostrophe = np.flatnonzero((points == 0x27) & change & ~(blank_before & joined))
    if joined:
        # The last of several white characters before a solid one is cut off; a blank then joins what follows.
        opens = np.flatnonzero(change & solid)
        opens = opens[(opens > 0) & ~edge[opens]]
        opens = opens[kinds[opens - 1] == SPACE]
        starts[opens - 1] = True
        starts[opens[points[opens - 1] == 0x20]] = False
    if len(apostrophe):
        held = texts.starts[text_of(texts, apostrophe) + 1]
        for place, length in _endings(points, kinds, apostrophe, dict(zip(apostrophe.tolist(), held.tolist(), strict=True))):
            starts[place + 1] = False
            after = place + 1 + length
            if after < size and (solid[after] or edge[after] or change[after]):
                starts[after] = True
    first = np.flatnonzero(starts)
    last = np.append(first[1:], size)
    if not joined:
        # White space opens stretches of its own above; they are not pieces.
        wanted = kinds[first] != SPACE
        first, last = first[wanted], last[wanted]
    return Spans(first, last, text_of(texts, first))
