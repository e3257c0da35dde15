"""Near duplicates by HyperMinHash sketches, banding and verification on full shingle sets.

A sketch has ``REGISTERS`` registers. A shingle's hash picks one by its first bits; the register keeps the smallest remaining
value, compressed to its count of leading zeros and the ``MANTISSA`` bits after the first one. Empty registers borrow from others
in an order fixed for all texts, so a register agrees with the probability of the Jaccard similarity for short texts too.

1. Texts with equal shingle sets form a class; from here on only classes are looked at.
2. Classes that agree in all registers of a band meet. Each meets the band's smallest class first: the pair's similarity is
   estimated from the registers, corrected for accidental agreement, and pairs not clearly below the threshold are verified exactly.
3. Components of the verified links. Bands whose classes now lie in one component are done. In the others, classes of different
   components are compared inside a task on their full sets, all of a band with all, in blocks where there are many. Links inside a component
   need no further check and only links that connect are given back, so copies never become pairs.
4. Components of all links. A component's id is the smallest document id in it.

With 32 bands of four registers a pair at similarity 0.75 fails to meet with a probability of about 5e-6. A pair is clearly below the threshold
when its estimate lies ``SURE`` standard errors below it.

Defined cases: null and empty texts and texts without words have an empty set, link with nothing and form a component of their own; texts with
fewer than five words have one shingle, the whole sequence; repeated ids share a component; a component without any id has a null id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import Spans, Texts, flatten, lower_ascii, mix, shingles, span_hashes, words
from marlstone.llm.components import components
from marlstone.llm.jaccard import SIMILARITY, link_groups, similar
from marlstone.llm.shapes import with_measures
from marlstone.llm.storage import keep, map_arrow, row_label

REGISTER_BITS = 7
REGISTERS = 1 << REGISTER_BITS
MANTISSA = 9
BAND = 4
SURE = 4.5


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, after lower-casing A to Z."""
    flat = flatten(texts)
    points = lower_ascii(flat.points)
    flat = Texts(points, flat.starts)
    found: Spans = words(flat)
    hashes, owner = shingles(span_hashes(points, found), found.text, flat.count)
    bounds = np.searchsorted(owner, np.arange(flat.count + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def sketch(values: np.ndarray) -> np.ndarray:
    """The registers of a non-empty sorted set of 64-bit hashes."""
    values = mix(values)
    values.sort()
    which = (values >> np.uint64(64 - REGISTER_BITS)).astype("i8")
    held, first = np.unique(which, return_index=True)
    # A double holds 53 bits exactly: its exponent is the count of leading zeros, its fraction begins with the mantissa.
    rest = (values[first] << np.uint64(REGISTER_BITS)) >> np.uint64(11)
    bits = (rest.astype("f8") + 1.0).view("u8") >> np.uint64(52 - MANTISSA)
    code = (bits & np.uint64((1 << (MANTISSA + 6)) - 1)).astype("u2") + np.uint16(1)
    registers = np.zeros(REGISTERS, "u2")
    registers[held] = code
    empty = np.flatnonzero(registers == 0)
    attempt = 0
    filled = registers.copy()
    while len(empty):
        lender = (mix((empty.astype("u8") << np.uint64(32)) + np.uint64(attempt + 1)) >> np.uint64(64 - REGISTER_BITS)).astype("i8")
        filled[empty] = registers[lender]
        empty = empty[filled[empty] == 0]
        attempt += 1
    return filled


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One key per band of four registers; a row of ``rows`` is a sketch."""
    n_bands = REGISTERS // BAND
    packed = rows.reshape(-1, BAND).astype("u8")
    key = np.tile(mix(np.arange(n_bands, dtype="u8") + np.uint64(77)), len(rows))
    for j in range(BAND):
        key = mix(key ^ packed[:, j])
    return key.view("i8").reshape(len(rows), n_bands)


def estimate(agreeing: np.ndarray) -> np.ndarray:
    """Jaccard similarity from counts of agreeing registers, less the agreement by accident.

    Two different minima get the same code with a probability of about 2 ** -MANTISSA times the chance of equal leading zeros (1 / 3).
    """
    accident = 2.0**-MANTISSA / 3
    return np.clip((agreeing / REGISTERS - accident) / (1 - accident), 0, 1)


def lowest_estimate(n_small: np.ndarray, threshold: float) -> np.ndarray:
    """The estimate below which a pair is clearly not similar; the smaller set has ``n_small`` members."""
    independent = np.minimum(n_small, REGISTERS / 2)
    error = np.sqrt(threshold * (1 - threshold) / np.maximum(independent, 1))
    return np.maximum(0.0, threshold - SURE * error)


def _fingerprint(sets: list[np.ndarray]) -> list[bytes | None]:
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def _measure_sketch(texts: list[str | None]) -> list:
    sets = shingle_sets(texts)
    registers = [sketch(s).tobytes() if len(s) else None for s in sets]
    return [np.fromiter(map(len, sets), "i8", len(sets)), _fingerprint(sets), registers]


def _measure_class(texts: list[str | None]) -> list:
    return [_fingerprint(shingle_sets(texts))]


def _measure_set(texts: list[str | None]) -> list:
    sets = shingle_sets(texts)
    return [_fingerprint(sets), [s.astype("<u8").tobytes() for s in sets]]


_SKETCH = {"n_shingles": T.LongType(), "class": T.BinaryType(), "registers": T.BinaryType()}


def _explode_bands(classes: DataFrame) -> DataFrame:
    """``key, class`` for every band of every class."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("class", T.BinaryType())])
    n_bands = REGISTERS // BAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), "u2")
            keys = band_keys(registers.reshape(-1, REGISTERS))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), n_bands))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), batch.column(0).take(owner)], names=schema.names)

    return map_arrow(classes.select("class", "registers"), run, schema)


def _plausible(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` whose registers do not put them clearly below the threshold."""
    side = lambda s: classes.select(F.col("class").alias(s), F.col("registers").alias(f"r{s}"), F.col("n_shingles").alias(f"n{s}"))
    low, high = SIMILARITY
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(high * F.least("na", "nb") >= low * F.greatest("na", "nb"))
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u2").reshape(-1, REGISTERS) for c in (2, 3))
            small = batch.column(4).to_numpy(zero_copy_only=False)
            wanted = estimate((left == right).sum(axis=1)) >= lowest_estimate(small, threshold)
            chosen = pa.array(np.flatnonzero(wanted))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)], names=schema.names)

    return map_arrow(sized.select("a", "b", "ra", "rb", F.least("na", "nb").alias("n")), run, schema)


def _sets(docs: DataFrame, representatives: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, members`` of the wanted classes, from the texts of their representatives.

    ``docs`` has ``doc`` (a row label) and ``text``; ``representatives`` names one row per class.
    """
    rows = keep(wanted.join(representatives, "class").select(F.col("doc").alias("_doc")), "near-wanted")
    texts = docs.join(rows.hint("merge"), F.col("doc") == F.col("_doc")).select("text")
    sets = with_measures(texts, "set", {"class": T.BinaryType(), "members": T.BinaryType()}, _measure_set)
    # Repeated rows have the same label and the same set.
    return keep(sets.select("set.*"), "near-sets").dropDuplicates(["class"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of classes with a Jaccard similarity of 0.75 or more, on full sets."""
    side = lambda s: sets.select(F.col("class").alias(s), F.col("members").alias(f"m{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ma", "mb")
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for i in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u8") for c in (2, 3))
                # Sets are sorted: members of one found in the other.
                place = np.minimum(np.searchsorted(left, right), len(left) - 1)
                if similar(int((left[place] == right).sum()), len(left), len(right)):
                    chosen.append(i)
            chosen = pa.array(chosen, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)], names=schema.names)

    return map_arrow(both, run, schema)


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns and a struct ``near``: ``n_shingles, class, component_id, kept, chosen, copies``.

    ``class`` names the text's shingle set (null for an empty one). ``kept`` is true where the id is the component's, ``chosen`` where
    the row also has the smallest label of its component; ``copies`` counts rows with the same id and text.
    """
    threshold = SIMILARITY[0] / SIMILARITY[1]
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # The row that stands for a class has the smallest label, so the smallest id.
    labelled = docs.select(_label("id", "text").alias("doc"), "text")
    marks = keep(with_measures(labelled, "near", _SKETCH, _measure_sketch).select("doc", "near.*").where("class is not null"), "near-marks")
    first = F.min_by(F.struct("n_shingles", "registers"), "doc").alias("x")
    classes = keep(marks.groupBy("class").agg(F.min("doc").alias("doc"), first).select("class", "doc", "x.*"), "near-classes")
    representatives = classes.select("class", "doc")
    bands = _explode_bands(classes)
    leaders = bands.groupBy("key").agg(F.min("class").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", "leader")
    met = keep(bands.join(leaders, "key").select("key", "class", "leader"), "near-bands")
    sets = _sets(labelled, representatives, met.select("class").distinct())
    stars = met.where(F.col("class") != F.col("leader")).select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    links = keep(_verified(_plausible(stars, classes, threshold), sets), "near-links")
    roots = components(links, "near-first")
    # Bands that still hold several components.
    rooted = met.select("key", "class").join(roots.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.select("key", F.col("class").alias("node"), F.coalesce("root", "class").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    rest = rooted.join(mixed, "key").join(sets.withColumnRenamed("class", "node"), "node")
    roots = components(links.unionByName(keep(link_groups(rest), "near-more")), "near-all")
    grouped = representatives.join(roots.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.select("class", F.coalesce("root", "class").alias("root"), "doc")
    chosen = grouped.groupBy("root").agg(F.min("doc").alias("chosen"))
    known = grouped.join(chosen, "root").select(F.col("class").alias("_class"), "chosen", F.col("chosen.id").alias("component_id"))
    known = keep(known, "near-known")
    return _attach(df, marks, known, id_col, text_col)


def _label(id_col: str, text_col: str) -> Column:
    return row_label(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _attach(df: DataFrame, marks: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The result for every row, by its label; repeated rows share a label and a result."""
    named = marks.groupBy("doc", "class").agg(F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"))
    named = named.join(known, F.col("class") == F.col("_class"))
    near = F.struct("n_shingles", "class", "component_id", "copies", F.col("doc").eqNullSafe(F.col("chosen")).alias("chosen"))
    named = named.select(F.col("doc").alias("_doc"), near.alias("_near"))
    rows = df.drop("near").withColumn("_own", _label(id_col, text_col)).join(named, F.col("_own") == F.col("_doc"), "left")
    alone = F.col("_near").isNull()
    component = F.when(alone, F.col(id_col)).otherwise(F.col("_near.component_id"))
    near = F.struct(
        F.coalesce("_near.n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
        F.col("_near.class").alias("class"),
        component.alias("component_id"),
        F.col(id_col).eqNullSafe(component).alias("kept"),
        (alone | F.col("_near.chosen")).alias("chosen"),
        F.coalesce("_near.copies", F.lit(1)).alias("copies"),
    )
    return rows.withColumn("near", near).drop("_own", "_doc", "_near")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component and all rows with an empty set, with the columns of ``df``."""
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marked = near_components(held, "_id", "_text").where("near.chosen")
    single = marked.where("near.copies = 1")
    several = marked.where("near.copies > 1").dropDuplicates(["_id", "_text"])
    return single.unionByName(several).select("row.*")
