import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marlstone.llm.batches import flatten, range_hashes, shape
from marlstone.llm.bpe import encoder, library_encoder
from marlstone.llm.exact import mark_copies
from marlstone.llm.minhash import near_components
from marlstone.llm.ordered import pack_in_order
from marlstone.llm.packing import cut_pieces
from marlstone.llm.paragraphs import Paragraphs, repeated_paragraphs
from marlstone.llm.token_files import read_token_files, write_token_files
from tests.llm.helpers import shape_of, shingle_set, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(size, turned=False):
    """Strings that any sum of powers modulo a power of two takes for equal when the letters are swapped."""
    return "".join("ab"[(bin(i).count("1") + turned) % 2] for i in range(size))


PAIR = [thue_morse(2048), thue_morse(2048, True)]


def test_hashes_depend_on_the_range_only():
    chance = np.random.default_rng(1)
    points = chance.integers(0, 3, 6000).astype("u4")
    first = chance.integers(0, 5000, 4000)
    last = first + np.where(chance.random(4000) < 0.8, chance.integers(0, 12, 4000), chance.integers(12, 90, 4000))
    found = range_hashes(points, first, last)
    # Alone and elsewhere they are the same; different ranges differ.
    told = {}
    for a, b, h in zip(first.tolist(), last.tolist(), found.tolist()):
        assert told.setdefault(points[a:b].tobytes(), h) == h
    assert len(set(told.values())) == len(told)
    moved = np.concatenate([np.full(77, 9, "u4"), points])
    assert (range_hashes(moved, first + 77, last + 77) == found).all()
    assert len(range_hashes(points, first[:0], last[:0])) == 0


@pytest.mark.parametrize("size", [32, 33, 1024])
def test_turned_strings_of_any_length_differ(size):
    flat = flatten([thue_morse(size), thue_morse(size, True)])
    found = range_hashes(flat.points, flat.starts[:-1], flat.starts[1:])
    assert found[0] != found[1]


def test_regular_strings_differ():
    flat = flatten(PAIR)
    found = range_hashes(flat.points, flat.starts[:-1], flat.starts[1:])
    assert found[0] != found[1]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
@pytest.mark.parametrize("make", [encoder, library_encoder])
def test_regular_pieces_keep_their_ids(path, make):
    if make is library_encoder and path == WORD_BPE:
        pytest.skip("for byte vocabularies")
    ids, bounds = make(path).encode(PAIR)
    plain = Tokenizer.from_file(path)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in PAIR]


def test_regular_lines_and_words_are_counted_apart():
    text = "\n".join([*PAIR, "x y", PAIR[0]])
    found = shape(flatten([text]))
    assert [int(v[0]) for v in found] == list(shape_of(text))


def wordy(turned):
    return " ".join("ab"[c == "b"] * 3 for c in thue_morse(2048, turned))


def test_regular_texts_in_the_operators(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([*PAIR, wordy(False), wordy(True)])]
    df = table(spark, rows)
    near = {r["doc_id"]: r["near"] for r in near_components(df).collect()}
    assert near[0].component_id == 0 and near[1].component_id == 1
    assert [near[i].n_shingles for i in range(4)] == [len(shingle_set(t)) for _, t in rows]
    assert {r["doc_id"] for r in mark_copies(df).where("copies.group_size > 1").collect()} == set()
    plain = Tokenizer.from_file(BYTE_BPE)
    ids = [plain.encode(t, add_special_tokens=False).ids for _, t in rows]
    write_token_files(df, BYTE_BPE, str(tmp_path / "files"))
    assert {r["id"]: r["ids"] for r in read_token_files(spark, str(tmp_path / "files")).collect()} == {i: x + [0] for i, x in enumerate(ids)}
    pieces = cut_pieces(df, BYTE_BPE).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in pieces} == {i: len(x) + 1 for i, x in enumerate(ids)}
    found = {}
    for r in sorted(pack_in_order(df, BYTE_BPE).collect(), key=lambda r: (r["id"], r["start"])):
        found.setdefault(r["id"], []).extend(r["ids"])
    assert found == {i: x + [1] for i, x in enumerate(ids)}


def test_regular_paragraphs_differ(spark):
    # Words of one letter kind would share shingles; these share none.
    swap = str.maketrans("ab", "cd")
    rows = [(i, " ".join(f"{c}{k}" for k, c in enumerate(t))) for i, t in enumerate([PAIR[0][:64], PAIR[1][:64].translate(swap)])]
    assert repeated_paragraphs(table(spark, rows)).count() == 0
    found = Paragraphs([" ".join(PAIR[0][:1024]), " ".join(PAIR[1][:1024])])
    words = [tuple(found.hashes[a:b].tolist()) for a, b in zip(found.first, found.last)]
    assert len(set(words)) == len(set(found.content.tolist()))
