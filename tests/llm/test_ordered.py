import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marlstone.llm.bpe import library_encoder
from marlstone.llm.ordered import SENTENCE_CUT, WORD_CUT, Breaks, Cutter, pack_in_order
from tests.llm.helpers import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def filling(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def least_cost(places, penalties, capacity):
    """The cheapest cost of all ways to cut, looking at every start for every end."""
    known = {0: 0}
    for place, penalty in zip(places, penalties):
        starts = [(c + filling(place - p, capacity), p) for p, c in known.items() if place - p <= capacity]
        known[place] = min(starts)[0] + penalty
    return known[places[-1]]


def cost_of(cuts, places, penalties, capacity):
    told = dict(zip(places, penalties))
    return sum(filling(b - a, capacity) + told[b] for a, b in zip([0, *cuts[:-1]], cuts))


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_cheapest_however_the_stream_arrives(seed):
    chance = random.Random(seed)
    capacity = chance.choice([16, 48, 64, 100])
    places, penalties, at = [], [], 0
    for _ in range(400):
        at += chance.randrange(1, chance.choice([4, 12, capacity + 1]))
        places.append(at)
        penalties.append(chance.choice([0, 3, 9]))
    penalties[-1] = 0
    cutter, cuts, at = Cutter(capacity), [], 0
    while at < len(places):
        step = chance.randrange(1, 60)
        cutter.extend(np.array(places[at : at + step]), np.array(penalties[at : at + step]))
        at += step
        cuts += cutter.settle()
        assert len(cutter._place) < 400
    cuts += cutter.settle(done=True)
    assert all(b - a <= capacity for a, b in zip([0, *cuts], cuts)) and cuts[-1] == places[-1]
    assert cost_of(cuts, places, penalties, capacity) == least_cost(places, penalties, capacity)


def test_streams_that_never_settle_are_bounded():
    cutter, cuts = Cutter(100), []
    for k in range(50):
        cutter.extend(np.arange(1, 201) * 7 + k * 1400, np.full(200, 2))
        cuts += cutter.settle(horizon=5000)
        assert cutter.end - cutter._place[0] <= 5000 + 1400
    cuts += cutter.settle(done=True)
    assert cuts[-1] == 70_000 and max(np.diff([0, *cuts])) <= 100


def test_places_are_ends_of_documents_sentences_and_else_words():
    coder = library_encoder(BYTE_BPE)
    breaks = Breaks(coder.vocabulary)
    texts = ['One two. "Three four!" Five', "", "a b c d e f g h i j", "x" * 4000 + "."]
    ids, bounds = coder.encode(texts)
    ids, bounds = np.insert(ids, bounds[1:], 1), bounds + np.arange(len(bounds))
    places, penalties = breaks.places(ids, bounds, 8)
    told = {coder.vocabulary.decode(ids[a:b].tolist()) for a, b in zip([0, *places[:-1]], places)}
    assert {'One two.', ' "Three four!"'} <= told
    assert (np.diff([0, *places]) <= 8).all() and set(bounds[1:]) <= set(places)
    assert all((penalty == 0) == (place in bounds) for place, penalty in zip(places, penalties))
    assert set(penalties) == {0, SENTENCE_CUT, WORD_CUT}


def plain_ids(text):
    return Tokenizer.from_file(BYTE_BPE).encode(text or "", add_special_tokens=False).ids + [1]


def held(spark, rows, capacity=2048, parts=3, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(parts)
    return pack_in_order(df, BYTE_BPE, capacity, **options).collect()


def check_rows(rows, found, capacity):
    texts = {i: plain_ids(t) for i, t in rows}
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == texts[i]
        assert all(r["length"] == len(r["ids"]) > 0 and r["doc_tokens"] == len(texts[i]) for r in pieces)
        assert [r["start"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(r["length"] for r in pieces) <= capacity
    return by_sequence


CHANCE = random.Random(3)
PROSE = lambda n: " ".join(" ".join(CHANCE.choice(["alpha", "beta", "rain", "of"]) for _ in range(CHANCE.randrange(3, 12))) + "." for _ in range(n))
ROWS = [(i, PROSE(CHANCE.randrange(0, 30))) for i in range(60)]
ROWS += [(100, None), (101, ""), (102, "word " * 3000), (103, "x" * 9000), (104, "é\n" * 700), (None, "No id."), (105, PROSE(900)), (106, ROWS[0][1])]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_hold_every_id_once_and_in_order(spark, capacity):
    found = held(spark, ROWS, capacity, chunk_points=5000)
    sequences = check_rows(ROWS, found, capacity)
    places = {i: k for k, (i, _) in enumerate(ROWS)}
    order = [places[r["id"]] for s in sorted(sequences) for r in sequences[s]]
    parts = [order[0]]
    for a in order[1:]:
        if a < parts[-1]:
            break  # the next partition
        parts.append(a)
    assert order[: len(parts)] == sorted(order[: len(parts)])


def test_whole_stream_is_cut_at_the_least_cost(spark):
    found = held(spark, ROWS, 256, parts=1, chunk_points=3000)
    lengths = {}
    for r in found:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    cuts = np.cumsum([lengths[s] for s in sorted(lengths)]).tolist()
    coder = library_encoder(BYTE_BPE)
    ids, bounds = coder.encode([t for _, t in ROWS])
    ids, bounds = np.insert(ids, bounds[1:], 1), bounds + np.arange(len(bounds))
    places, penalties = (a.tolist() for a in Breaks(coder.vocabulary).places(ids, bounds, 256))
    assert cost_of(cuts, places, penalties, 256) == least_cost(places, penalties, 256)


def test_digest_is_of_the_same_ids(spark):
    ids = {(r["id"], r["start"]): r["ids"] for r in held(spark, ROWS)}
    found = held(spark, ROWS, digest=True)
    assert {(r["id"], r["start"]): r["ids_crc32"] for r in found} == {
        k: zlib.crc32(np.array(v, "<u4").tobytes()) for k, v in ids.items()
    }


def test_empty_table_and_other_columns(spark):
    assert held(spark, []) == []
    rows = [(i, f"Text {i}.", "a", 7) for i in range(5)]
    df = table(spark, rows, "doc_id long, text string, sequence_id string, length int")
    assert pack_in_order(df, BYTE_BPE).columns == ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
