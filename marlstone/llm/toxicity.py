"""Toxicity by a weighted grammar of clauses.

Words are read as symbols: insults (learned stems with learned weights), threats, targets, negations and reports (the short fixed
lists below). Four small weighted transducers run over a clause together, each in its own state:

* the *negation* transducer opens a scope of ``NEGATION_REACH`` words,
* the *report* transducer marks what follows a verb of saying, up to the end of the clause,
* the *target* transducer remembers whether somebody is addressed or spoken of,
* the *threat* transducer accepts a threat that is followed by a target within ``THREAT_REACH`` words.

Their composition reads an insult or an accepted threat in the joint state and emits its weight to one of ``KINDS``: plain, targeted, negated,
reported or threat. Only clauses with an insult or a threat are read at all; they are found by array lookups. A text's sums per kind go into a
logistic function. Which words insult, and how much each kind counts, is learned from at most ``SAMPLE_ROWS`` labelled texts: stems (beginnings
of words, whole words included) that tell the labels apart, some of them only where a text has two
words that begin so, are taken greedily, most telling first, until they cover the toxic texts.

Defined cases: null and empty texts have no clause and get the lowest score; without toxic or without clean labelled texts nothing is learned,
and the share of toxic ones (0 without labels) is everybody's score; rows may repeat; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import HashIndex, Texts, chunks, flatten, in_text, range_hashes, text_of
from marlstone.llm.gam import labelled_sample
from marlstone.llm.pieces import LETTER, kinds_of
from marlstone.llm.shapes import with_measures
from marlstone.llm.storage import map_arrow

SAMPLE_ROWS = 6000
STEM_LETTERS = range(3, 9)
LEAST_TEXTS = 3
LEAST_SHARE = 0.01
CLEAN_COST = 1.5
TIMES = (1, 2)
LEAST_ODDS = 2.0
CANDIDATES = 20_000
NEGATION_REACH = 3
THREAT_REACH = 4
KINDS = ("plain", "targeted", "negated", "reported", "threat")

# Fixed word lists of the grammar, in English, German, French and Spanish.
TARGETS = {*"you your yours he she him her they them these those du dich dir euch ihr sie tu toi vous te ti usted ustedes él ella ellos".split()}
NEGATIONS = {*"not no never nobody isn aren don doesn nicht kein keine nie niemals pas jamais ni nunca jamás".split()}
REPORTS = {*"said says say told wrote writes called quoted sagte sagt schrieb nannte dit disait écrit dijo dice escribió".split()}
THREATS = {*"kill hurt destroy beat shoot stab töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()}
CLAUSE_ENDS = ".!?;:\n"


@cache
def _lower() -> np.ndarray:
    """Lower case of each code point, where it is one code point."""
    table = np.arange(0x110000, dtype="u4")
    for point in range(0x1E944):
        if not 0xD800 <= point < 0xE000:
            low = chr(point).lower()
            if len(low) == 1:
                table[point] = ord(low)
    return table


class Words:
    """Runs of letters of a chunk of texts, lower-cased, and the clause each lies in."""

    def __init__(self, texts: list[str | None]) -> None:
        flat = flatten(texts)
        self.points = _lower()[flat.points]
        letters = kinds_of(self.points) == LETTER
        edge = np.zeros(len(letters) + 1, bool)
        edge[flat.starts] = True
        begins, ends = letters & edge[:-1], letters & edge[1:]
        if len(letters):
            begins[1:] |= letters[1:] & ~letters[:-1]
            ends[:-1] |= letters[:-1] & ~letters[1:]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = text_of(Texts(self.points, flat.starts), self.first)
        stops = np.isin(self.points, np.array([ord(c) for c in CLAUSE_ENDS], "u4")) | edge[:-1]
        self.clause = np.cumsum(stops)[self.first] if len(letters) else self.first
        self.marks = self.points

    def beginnings(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` letters of every word; of shorter words, 0."""
        long = self.last - self.first >= size
        out = np.zeros(len(self.first), "u8")
        out[long] = range_hashes(self.marks, self.first[long], self.first[long] + size)
        return out

    def whole(self) -> np.ndarray:
        return range_hashes(self.marks, self.first, self.last)

    def word(self, k: int) -> str:
        return self.points[self.first[k] : self.last[k]].tobytes().decode("utf-32-le", "replace")


@cache
def _threats() -> HashIndex:
    """The threats; besides insults, they make a clause worth reading."""
    names = sorted(THREATS)
    flat = flatten(names)
    return HashIndex(range_hashes(flat.points, flat.starts[:-1], flat.starts[1:]))


def read_clause(symbols: list[tuple[str, float]]) -> dict[str, float]:
    """Run the composed transducers over a clause given as words with insult weights (0 for other words)."""
    out = dict.fromkeys(KINDS, 0.0)
    negation, reported, targeted, threat = 0, False, False, 0
    waiting = 0.0
    for word, weight in symbols:
        target = word in TARGETS
        if weight > 0:
            if negation:
                out["negated"] += weight
            elif reported:
                out["reported"] += weight
            elif targeted:
                out["targeted"] += weight
            else:
                # The target may still follow in the same clause.
                waiting += weight
        if threat and target and not negation:
            out["reported" if reported else "threat"] += 1.0
            threat = 0
        negation = NEGATION_REACH if word in NEGATIONS else max(0, negation - 1)
        threat = THREAT_REACH if word in THREATS else max(0, threat - 1)
        reported = reported or word in REPORTS
        if target and not targeted:
            targeted = True
            out["targeted"] += waiting
            waiting = 0.0
    out["plain"] += waiting
    return out


class Grammar:
    """Learned stems and the weights of the kinds of clauses."""

    def __init__(self, stems: dict[str, tuple[int, float]], factors: np.ndarray | None = None, offset: float = 0.0) -> None:
        self.stems = stems
        names = sorted(stems)
        flat = flatten(names)
        self._index = HashIndex(range_hashes(flat.points, flat.starts[:-1], flat.starts[1:]))
        self._times = np.array([stems[n][0] for n in names] + [0])
        self._weights = np.array([stems[n][1] for n in names] + [0.0])
        self._sizes = sorted({len(n) for n in names})
        self.factors, self.offset = factors, offset

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """A row per text with the sum of each kind of clause, on a log scale."""
        found = Words(texts)
        weight = np.zeros(len(found.first))
        for size in self._sizes:
            place = self._index.find(found.beginnings(size))
            hits = np.flatnonzero(place >= 0)
            # Some stems insult only where a text has several words that begin so.
            _, which, seen = np.unique(found.text[hits] * len(self._weights) + place[hits], return_inverse=True, return_counts=True)
            hits = hits[seen[which] >= self._times[place[hits]]]
            weight[hits] = np.maximum(weight[hits], self._weights[place[hits]])
        opens = (weight > 0) | (_threats().find(found.whole()) >= 0)
        out = np.zeros((len(texts), len(KINDS)))
        if opens.any():
            wanted = np.unique(found.clause[opens])
            low, high = np.searchsorted(found.clause, wanted), np.searchsorted(found.clause, wanted, side="right")
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                read = read_clause([(found.word(k), weight[k]) for k in range(a, b)])
                out[found.text[a]] += [read[k] for k in KINDS]
        return np.log1p(out)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.factors is None:
            return np.full(len(texts), self.offset)
        raw = self.offset + self.sums(texts) @ self.factors
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def fit_logistic(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Factors and offset by Newton's method, with a small penalty on the factors."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * rows.shape[1] + [1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (label - p)) - penalty @ beta
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def _stems_of(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each stem of one size in each text once: stem, text, an example word and the number of words that begin so."""
    stems = found.beginnings(size)
    held = np.flatnonzero(stems)
    _, where, times = np.unique(in_text(stems[held], found.text[held]), return_index=True, return_counts=True)
    word = held[where]
    return stems[word], found.text[word], word, times


def _stem_counts(sample: DataFrame) -> DataFrame:
    """``stem, times, toxic, clean``: texts with at least ``times`` words that begin so, summed over distinct texts."""
    names = ["stem", "times", "toxic", "clean"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, label = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for low, high in chunks(texts):
                found, mine = Words(texts[low:high]), label[low:high]
                for size in STEM_LETTERS:
                    stems, text, _, seen = _stems_of(found, size)
                    for times in TIMES:
                        some = seen >= times
                        stem, which = np.unique(stems[some], return_inverse=True)
                        toxic = np.bincount(which, mine[text[some]] == 1, len(stem)).astype("i8")
                        both = np.bincount(which, minlength=len(stem)).astype("i8")
                        columns = [stem.view("i8"), np.full(len(stem), times, "i8"), toxic, both - toxic]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return map_arrow(sample, run, schema).groupBy("stem", "times").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _stem_texts(sample: DataFrame, stems: np.ndarray) -> DataFrame:
    """``text, stem, seen, name`` for the candidate stems in toxic texts; ``text`` is a hash of the text, ``seen`` how many words begin so."""
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("text", "stem", "seen")], T.StructField("name", T.StringType())])
    wanted = HashIndex(stems.view("u8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for low, high in chunks(texts):
                found = Words(texts[low:high])
                for size in STEM_LETTERS:
                    stem, text, word, seen = _stems_of(found, size)
                    at = np.flatnonzero(wanted.find(stem) >= 0)
                    names = [found.word(k)[:size] for k in word[at].tolist()]
                    columns = [pa.array(c.astype("i8")) for c in (marks[low + text[at]], stem[at].view("i8"), seen[at])]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string())], names=schema.names)

    return map_arrow(sample.where("_label = 1").select("_text", F.xxhash64("_text").alias("mark")), run, schema)


def choose_stems(
    held: list[tuple[int, int, int, str]], odds: dict[tuple[int, int], float], cost: dict[tuple[int, int], float], n_toxic: int
) -> dict[str, tuple[int, float]]:
    """Greedy cover: (text, stem, seen, name) rows to the chosen names, how often a text must hold them, and their weights.

    A stem is worth the toxic texts it is found in often enough, each halved for every stem chosen before that is in it too, less its cost. The
    best goes first (of equals the longest, which says most) until none is worth ``LEAST_TEXTS`` or ``LEAST_SHARE`` of the
    toxic texts. Beginnings and extensions of chosen stems are left out.
    """
    texts: dict[tuple[str, int], set[int]] = {}
    key_of: dict[tuple[str, int], tuple[int, int]] = {}
    for text, stem, seen, name in held:
        for times in TIMES:
            if seen >= times and (stem, times) in odds:
                texts.setdefault((name, times), set()).add(text)
                key_of[name, times] = (stem, times)
    need = dict.fromkeys({t for found in texts.values() for t in found}, 1.0)
    least = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    chosen: dict[str, tuple[int, float]] = {}
    left = {k for k in texts if len(texts[k]) - cost[key_of[k]] >= least}
    while left:
        worth = {k: sum(need[t] for t in texts[k]) - cost[key_of[k]] for k in left}
        best = min(left, key=lambda k: (-worth[k], -len(k[0]), k))
        if worth[best] < least:
            break
        name, times = best
        chosen[name] = (times, odds[key_of[best]])
        for t in texts[best]:
            need[t] /= 2
        # Needs only shrink, so what is worth too little now stays so.
        left = {k for k in left if worth[k] >= least and not (k[0].startswith(name) or name.startswith(k[0]))}
    return chosen


def fit_grammar(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Grammar:
    """Fit on the given labels; pass the training part only. ``docs`` has ``doc_id`` and ``text``."""
    sample = labelled_sample(docs, labels, label, rows).where(F.col("_text").isNotNull() & (F.col("_text") != ""))
    # Copies of a text say no more about its words than one of them.
    single = sample.groupBy("_text", "_label").agg(F.sum("_weight").alias("_weight")).limit(2 * rows)
    sizes = {k: (n, w) for k, n, w in single.groupBy("_label").agg(F.count(F.lit(1)), F.sum("_weight")).collect()}
    if len(sizes) < 2:
        return Grammar({}, None, 1.0 if 1 in sizes else 0.0)
    toxic, clean = sizes[1][0], sizes[0][0]
    odds = F.log(((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1)))
    counts = _stem_counts(single.select("_text", "_label")).where(F.col("toxic") >= LEAST_TEXTS).withColumn("odds", odds)
    best = counts.where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("toxic"), "stem", "times").limit(CANDIDATES).toPandas()
    keys = list(zip(best.stem.tolist(), best.times.tolist(), strict=True))
    weights = dict(zip(keys, best.odds.tolist(), strict=True))
    # In the sample toxic texts are more frequent than among all; a clean text counts for as many as it stands for.
    ratio = (sizes[0][1] / clean) / (sizes[1][1] / toxic)
    cost = dict(zip(keys, (CLEAN_COST * ratio * best.clean).tolist(), strict=True))
    held = _stem_texts(single, np.unique(best.stem.to_numpy("i8"))).collect() if keys else []
    grammar = Grammar(choose_stems([tuple(r) for r in held], weights, cost, toxic))
    fields = dict.fromkeys(KINDS, T.DoubleType())
    found = with_measures(single, "x", fields, lambda texts: list(grammar.sums(texts).T), "_text")
    table = found.select("_label", "_weight", "x.*").toPandas().sort_values([*KINDS, "_label", "_weight"])
    grammar.factors, grammar.offset = fit_logistic(
        table[[*KINDS]].to_numpy("f8"), table["_label"].to_numpy("f8"), table["_weight"].to_numpy("f8")
    )
    return grammar


def score_toxicity(df: DataFrame, grammar: Grammar, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns and a struct ``name`` with the ``score``."""
    return with_measures(df, name, {"score": T.DoubleType()}, lambda texts: [grammar.score(texts)], text_col)
