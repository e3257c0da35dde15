import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import packing
from marlstone.llm.packing import best_fit, crossover, cut_pieces, evolve, fills, mutate, pack
from tests.llm.helpers import table
from tests.llm.test_bpe import odd_texts


def valid(bins, lengths, capacity):
    return sorted(i for held in bins for i in held) == list(range(len(lengths))) and max(fills(bins, lengths)) <= capacity


def test_operators_keep_every_item():
    chance = random.Random(1)
    lengths = [chance.randint(1, 100) for _ in range(300)]
    people = []
    for _ in range(2):
        order, bins = list(range(300)), []
        chance.shuffle(order)
        for part in (order[:100], order[100:]):
            best_fit(bins, part, lengths, 100)
        people.append(bins)
    assert all(valid(p, lengths, 100) for p in people)
    assert valid(crossover(*people, lengths, 100, chance, 0.3), lengths, 100)
    assert valid(mutate(people[0], lengths, 100, chance), lengths, 100)


def test_evolution_beats_best_fit_where_it_is_not_best():
    # Triples that fill a bin exactly, which best fit misses.
    chance = random.Random(3)
    lengths = []
    for _ in range(40):
        a = chance.randint(260, 480)
        b = chance.randint(260, 1000 - a - 250)
        lengths += [a, b, 1000 - a - b]
    bins = []
    best_fit(bins, range(120), lengths, 1000)
    found = evolve([], lengths, 1000, 7, generations=400)
    assert valid(found, lengths, 1000) and len(found) <= len(bins)
    again = evolve([found], lengths, 1000, 8, generations=3)
    assert len(again) <= len(found)


@pytest.mark.parametrize("chunk", [4096, 60])
def test_rows_are_packed_without_gaps(spark, monkeypatch, chunk):
    monkeypatch.setattr(packing, "CHUNK_ITEMS", chunk)
    chance = random.Random(chunk)
    rows = [(i // 2, chance.choice([chance.randint(1, 2047), 2048, chance.randint(1, 300)]), "x") for i in range(400)]
    rows += [(None, 5, None), (1, None, "y"), rows[0], rows[0]]
    df = table(spark, rows, "id long, length int, offset string")
    packed = pack(df)
    assert packed.columns == ["id", "length", "sequence_id", "offset"]
    found = packed.toPandas()
    assert len(found) == len(rows)
    for _, held in found.fillna(0).groupby("sequence_id"):
        held = held.sort_values(["offset", "length"])
        assert held.offset.tolist() == [0, *np.cumsum(held.length)[:-1]] and held.length.sum() <= 2048
    bound = -(-sum(r[1] or 0 for r in rows) // 2048)
    assert found.sequence_id.nunique() <= bound * 1.03 + 2
    assert pack(df.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError):
        pack(df.withColumn("length", F.lit(2049)))


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    known, texts = Tokenizer.from_file(path), odd_texts(80)
    rows = [(None if i == 4 else i, t, 7) for i, t in enumerate(texts)]
    found = cut_pieces(table(spark, rows, "doc_id long, text string, piece int"), path, capacity=16).collect()
    expected = []
    for i, t, _ in rows:
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 16 or 16, len(ids) + 1, 16)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected.append((i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
