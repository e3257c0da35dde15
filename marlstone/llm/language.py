"""Language identification by prediction by partial matching.

Per language, a tree of byte contexts up to ``ORDER`` bytes long holds frozen counts. A byte's code length is that of its count in the
longest known context; where the context has never been followed by it, an escape (method C: as many escapes as different
followers) is paid and the next shorter context asked, down to all bytes alike. Symbols of longer contexts are not excluded from shorter ones, so the lengths
are a little longer than they need be, for all languages alike. A text belongs to the language with the shortest code.

The tables of all languages share one index of byte strings, so a chunk of texts is scored with a few array steps per order; only bytes not seen
in their context go on to shorter ones.

The trees are learned from a sample of at most ``SAMPLE_TEXTS`` whole texts, the same number per language.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything where nothing was learned; ties go
to the smaller name; the score is the winner's share of probability among the learned languages; rows may repeat; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import HashIndex, chunks
from marlstone.llm.samples import bounded_sample
from marlstone.llm.shapes import with_measures
from marlstone.llm.storage import map_arrow

ORDER = 3
SAMPLE_TEXTS = 6000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def byte_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the ``ORDER`` bytes before it as one number, and the text it is in. Texts begin after line feeds."""
    raw = [b"\n" * ORDER + t.encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, raw), "i8", len(raw))
    whole = np.frombuffer(b"".join(raw), "u1").astype("u4")
    grams = np.zeros(max(0, len(whole) - ORDER), "u4")
    for j in range(ORDER + 1):
        grams = (grams << np.uint32(8)) | whole[j : j + len(grams)]
    text = np.repeat(np.arange(len(raw)), sizes)
    # Places whose context would reach into the text before are the padding itself.
    inside = np.ones(len(whole), bool)
    starts = np.cumsum(sizes) - sizes
    for j in range(ORDER):
        inside[starts + j] = False
    return grams[inside[ORDER:]], text[ORDER:][inside[ORDER:]]


class ContextTrees:
    """Frozen code lengths in bits for all languages."""

    def __init__(self, counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.names = sorted(counted)
        n = len(self.names)
        self._grams: list[HashIndex] = []
        self._contexts: list[HashIndex] = []
        self._bits: list[np.ndarray] = []
        self._escapes: list[np.ndarray] = []
        for order in range(ORDER + 1):
            mask = np.uint64((1 << 8 * (order + 1)) - 1)
            own = []
            for name in self.names:
                grams, counts = counted[name]
                found, which = np.unique(grams.astype("u8") & mask, return_inverse=True)
                own.append((found, np.bincount(which, counts, len(found))))
            keys = np.unique(np.concatenate([g for g, _ in own])) if own else np.zeros(0, "u8")
            contexts = np.unique(keys >> np.uint64(8))
            bits = self._shorter(keys, order).astype("f8")
            escapes = np.zeros((len(contexts), n), "f4")
            for column, (found, counts) in enumerate(own):
                above = np.searchsorted(contexts, found >> np.uint64(8))
                total = np.bincount(above, counts, len(contexts))
                kinds = np.bincount(above, minlength=len(contexts))
                seen = total > 0
                escapes[seen, column] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                bits[:, column] += escapes[np.searchsorted(contexts, keys >> np.uint64(8)), column]
                bits[np.searchsorted(keys, found), column] = -np.log2(counts / (total[above] + kinds[above]))
            self._grams.append(HashIndex(keys))
            self._contexts.append(HashIndex(contexts))
            self._bits.append(bits.astype("f4"))
            self._escapes.append(escapes)

    def _shorter(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Code lengths in the context one byte shorter."""
        if order == 0:
            return np.full((len(grams), len(self.names)), 8.0, "f4")
        return self.bits(grams & np.uint64((1 << 8 * order) - 1), order - 1)

    def bits(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code lengths of last bytes after their contexts, a row per byte and a column per language."""
        place = self._grams[order].find(grams)
        out = self._bits[order][place]
        missing = np.flatnonzero(place < 0)
        if len(missing):
            context = self._contexts[order].find(grams[missing] >> np.uint64(8))
            escapes = np.where(context[:, None] >= 0, self._escapes[order][context], 0)
            out[missing] = self._shorter(grams[missing], order) + escapes
        return out

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each whole text, a column per language."""
        grams, owner = byte_grams(texts)
        total = np.zeros((len(texts), len(self.names)))
        step = max(1, 4_000_000 // max(1, len(self.names)))
        for low in range(0, len(grams), step):
            some, at = self.bits(grams[low : low + step].astype("u8")), owner[low : low + step]
            for column in range(len(self.names)):
                total[:, column] += np.bincount(at, some[:, column], len(texts))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Name and score of each text."""
        known = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if known.any() and self.names:
            lengths = self.code_lengths([t for t, k in zip(texts, known, strict=True) if k])
            best = lengths.argmin(axis=1)
            names[known] = np.array(self.names, object)[best]
            scores[known] = 1 / np.exp2(-np.minimum(lengths - lengths.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        return names.tolist(), scores


def fit_languages(df: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_texts: int = SAMPLE_TEXTS) -> ContextTrees:
    """Learn from rows with a text and a language: at most ``sample_texts`` of them, in equal numbers per language."""
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("text") != ""))
    n = rows.select("lang").distinct().count()
    sample = bounded_sample(rows, max(1, sample_texts // max(1, n)), "lang", "text")
    schema = T.StructType([T.StructField(c, k) for c, k in (("lang", T.StringType()), ("gram", T.LongType()), ("n", T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for low, high in chunks(texts):
                grams, owner = byte_grams(texts[low:high])
                for lang in sorted(set(langs[low:high])):
                    found, counts = np.unique(grams[(langs[low:high] == lang)[owner]], return_counts=True)
                    columns = [pa.array([lang] * len(found), pa.string()), pa.array(found.astype("i8")), pa.array(counts.astype("i8"))]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    counted = map_arrow(sample.select("text", "lang"), run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    groups: dict[str, pd.DataFrame] = dict(list(counted.groupby("lang")))
    return ContextTrees({lang: (g.gram.to_numpy("u8"), g.n.to_numpy("f8")) for lang, g in groups.items()})


def identify(df: DataFrame, trees: ContextTrees, text_col: str = "text", name: str = "language") -> DataFrame:
    """All columns and a struct ``name`` of ``lang_pred`` and ``score``."""
    fields = {"lang_pred": T.StringType(), "score": T.DoubleType()}
    return with_measures(df, name, fields, trees.predict, text_col)
