"""A generalised additive model with pairwise interactions for the quality of texts.

Each feature is cut into bins at quantiles of the sample. Boosting goes round the features: each in turn gets a shallow tree over its
bins, fitted to the current gradients and added with a small rate to the feature's lookup table. Then the pairs whose joint
table explains most of what is left get tables of their own in the same way. A score is the sum of looked-up values through the logistic function, so scoring is a
search and an addition per feature for a whole chunk of texts.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows, half of them per label, weighted back to the labels' shares.

Defined cases: null text is empty and gets the score of its features (all 0); a sample with one label only, or none, gives that label's share (0.5
without any) to all; labels that are null or whose text is missing are not used; rows may repeat; other columns pass through.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import flatten, in_text, shape, span_hashes, text_of, words
from marlstone.llm.pieces import LETTER, NUMBER, OTHER, SPACE, kinds_of
from marlstone.llm.samples import bounded_sample
from marlstone.llm.shapes import share, with_measures

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 80
PAIR_ROUNDS = 30
PAIRS = 6
RATE = 0.15
LEAVES = 3
RIDGE = 2.0

FEATURES = (
    "log_words", "word_length", "symbols_per_word", "dup_lines", "repeated_words", "upper_share", "digit_share",
    "mark_share", "marks_per_word", "words_per_line", "distinct_words", "space_share", "letter_share", "bars_per_word",
)


@cache
def _upper() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for found in regex.finditer(r"\p{Lu}+", every):
            table[low + found.start() : low + found.end()] = True
    return table


def features(texts: list[str | None]) -> list[np.ndarray]:
    """One array per feature."""
    flat = flatten(texts)
    counts, n = shape(flat), flat.count
    kinds = kinds_of(flat.points)
    size = np.diff(flat.starts)

    def per_text(marked: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marked)])
        return sums[flat.starts[1:]] - sums[flat.starts[:-1]]

    letters, marks = per_text(kinds == LETTER), per_text(kinds == OTHER)
    found = words(flat)
    hashes = in_text(span_hashes(flat.points, found), found.text)
    _, where = np.unique(hashes, return_index=True)
    distinct = np.bincount(found.text[where], minlength=n)
    bars = np.bincount(text_of(flat, np.flatnonzero(flat.points == ord("|"))), minlength=n)
    return [
        np.log1p(counts.n_words),
        share(counts.word_chars, counts.n_words),
        share(counts.n_symbols, counts.n_words),
        share(counts.n_dup_lines, counts.n_lines),
        share(counts.n_repeat_words, counts.n_words),
        share(per_text(_upper()[flat.points]), letters),
        share(per_text(kinds == NUMBER), size),
        share(marks, size),
        share(marks, counts.n_words),
        share(counts.n_words, counts.n_lines),
        share(distinct, counts.n_words),
        share(per_text(kinds == SPACE), size),
        share(letters, size),
        share(bars, counts.n_words),
    ]


def _leaf(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient / (hessian + RIDGE)


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` leaves, grown by the best gain."""
    parts = [(0, len(gradient))]
    gain = lambda a, b: gradient[a:b].sum() ** 2 / (hessian[a:b].sum() + RIDGE)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for part in parts:
            a, b = part
            g, h = np.cumsum(gradient[a:b])[:-1], np.cumsum(hessian[a:b])[:-1]
            if not len(g):
                continue
            whole_g, whole_h = gradient[a:b].sum(), hessian[a:b].sum()
            split = g**2 / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - gain(a, b)
            at = int(split.argmax())
            if split[at] > best[0]:
                best = (split[at], part, a + at + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = _leaf(gradient[a:b].sum(), hessian[a:b].sum())
    return values


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """The same for a grid: the best cut along one axis, then the best along the other on each side."""
    best, values = -1.0, np.zeros_like(gradient)
    for axis in (0, 1):
        g, h = (gradient, hessian) if axis == 0 else (gradient.T, hessian.T)
        for cut in range(1, len(g)):
            sides = [_tree(g[a:b].sum(axis=0), h[a:b].sum(axis=0), 2) for a, b in ((0, cut), (cut, len(g)))]
            grid = np.vstack([np.tile(sides[0], (cut, 1)), np.tile(sides[1], (len(g) - cut, 1))])
            gained = (g * grid - 0.5 * h * grid**2).sum()
            if gained > best:
                best, values = gained, grid if axis == 0 else grid.T
    return values


class AdditiveModel:
    """Lookup tables for single features and pairs."""

    def __init__(self, columns: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> None:
        self.edges = [self._cuts(c, BINS) for c in columns]
        self.coarse = [self._cuts(c, PAIR_BINS) for c in columns]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.grids: list[np.ndarray] = []
        total = float(weight.sum())
        mean = float((label * weight).sum()) / total if total else 0.5
        self.offset = float(np.log((mean + 1e-6) / (1 - mean + 1e-6)))
        if 0 < mean < 1:
            self._fit(columns, label, weight)

    @staticmethod
    def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
        """Middles between neighbouring values at the quantiles of all values and of those that are not 0."""
        known = np.unique(values)
        if len(known) < 2:
            return np.zeros(0)
        nonzero = values[values != 0]
        shares = np.arange(1, bins) / bins
        wanted = np.quantile(values, shares)
        if len(nonzero):
            # Where most values are 0, quantiles of the others tell them apart.
            wanted = np.concatenate([wanted, np.quantile(nonzero, shares)])
        at = np.searchsorted(known, np.unique(wanted))
        at = np.unique(np.clip(at, 1, len(known) - 1))
        return (known[at - 1] + known[at]) / 2

    def _fit(self, columns: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> None:
        bins = [np.searchsorted(e, c) for e, c in zip(self.edges, columns, strict=True)]
        raw = np.full(len(label), self.offset)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-raw))
            return weight * (label - p), np.maximum(weight * p * (1 - p), 1e-9)

        for _ in range(ROUNDS):
            for k, place in enumerate(bins):
                size = len(self.tables[k])
                gradient, hessian = slopes()
                step = RATE * _tree(np.bincount(place, gradient, size), np.bincount(place, hessian, size), LEAVES)
                self.tables[k] += step
                raw += step[place]
        coarse = [np.searchsorted(e, c) for e, c in zip(self.coarse, columns, strict=True)]
        shapes = [len(e) + 1 for e in self.coarse]

        def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            cell = coarse[i] * shapes[j] + coarse[j]
            gradient, hessian = slopes()
            size = shapes[i] * shapes[j]
            form = (shapes[i], shapes[j])
            return cell, np.bincount(cell, gradient, size).reshape(form), np.bincount(cell, hessian, size).reshape(form)

        scored = []
        for i, j in combinations(range(len(columns)), 2):
            _, g, h = grid(i, j)
            scored.append((-float((g**2 / (h + RIDGE)).sum()), i, j))
        self.pairs = [(i, j) for _, i, j in sorted(scored)[:PAIRS]]
        self.grids = [np.zeros((shapes[i], shapes[j])) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (i, j) in enumerate(self.pairs):
                cell, g, h = grid(i, j)
                step = RATE * _pair_tree(g, h)
                self.grids[k] += step
                raw += step.reshape(-1)[cell]

    def score(self, columns: list[np.ndarray]) -> np.ndarray:
        raw = np.full(len(columns[0]), self.offset)
        for table, edges, values in zip(self.tables, self.edges, columns, strict=True):
            raw += table[np.searchsorted(edges, values)]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            raw += grid[np.searchsorted(self.coarse[i], columns[i]), np.searchsorted(self.coarse[j], columns[j])]
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """``_text, _label, _weight`` of at most ``rows`` labelled documents, half per label; weights add up to the labels' counts."""
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
    sample = bounded_sample(marked, rows // 2, "_label", "_id")
    sizes = {row[0]: row[1] for row in marked.groupBy("_label").count().collect()}
    weight = F.coalesce(*[F.when(F.col("_label") == k, F.lit(n / min(n, rows // 2))) for k, n in sizes.items()], F.lit(1.0))
    # The sample's size is bounded by ``rows``, so it may go to every task.
    return docs.join(F.broadcast(sample), F.col(id_col) == F.col("_id")).select(F.col("text").alias("_text"), "_label", weight.alias("_weight"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on the given labels; pass the training part only. ``docs`` has ``doc_id`` and ``text``."""
    sample = labelled_sample(docs, labels, label, rows)
    found = with_measures(sample, "x", dict.fromkeys(FEATURES, T.DoubleType()), features, "_text")
    held = found.select("_label", "_weight", "x.*").limit(2 * rows).toPandas().sort_values([*FEATURES, "_label"])
    columns = [held[f].to_numpy("f8") for f in FEATURES]
    return AdditiveModel(columns, held["_label"].to_numpy("f8"), held["_weight"].to_numpy("f8"))


def score_quality(df: DataFrame, model: AdditiveModel, text_col: str = "text", name: str = "quality") -> DataFrame:
    """All columns and a struct ``name`` with the ``score``."""
    return with_measures(df, name, {"score": T.DoubleType()}, lambda texts: [model.score(features(texts))], text_col)
