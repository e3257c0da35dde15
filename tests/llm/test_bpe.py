import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm.bpe import Vocabulary, encode_in_chunks, encoder, library_encoder
from marlstone.llm.bpe_frames import decode, encode, round_trip
from tests.llm.helpers import table

PARTS = [
    "a", "b", "the", "T", "'s", "'ll", "'", "''", " ", "  ", "\n", "\n\n", "\t", "1", "23", "é", "ß", "Σ", "İ", "中", "文字", "!", "!!", "'d", "'re'",
    ".", "<|endoftext|>", "<|startoftext|>", "\U0001f600", "é", "\x1c", "\x85", "²", "Ⅷ", "́", "'S", "'T",
]


def odd_texts(n):
    chance = random.Random(1)
    made = ["".join(chance.choice(PARTS) for _ in range(chance.randint(0, 30))) for _ in range(n)]
    return [*made, "", None, "x" * 700, "ab" * 300, "'", "'s", " 's", "a 's", "\n's", "a\n 's", "it's's", "'sun 'l 'll", "word " * 5000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("make", [encoder, library_encoder])
def test_ids_and_decoding_equal_the_library(name, make):
    path = public_tokenizers.path(name)
    known, mine, texts = Tokenizer.from_file(path), make(path), odd_texts(800)
    theirs = [e.ids for e in known.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for limit in (200, None):
        got = []
        for low, high, ids, bounds in encode_in_chunks(texts, mine.encode, limit):
            got += [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(high - low)]
        assert got == theirs
    for ids in theirs:
        assert mine.vocabulary.decode(ids) == known.decode(ids, skip_special_tokens=False)


def test_long_pieces_give_the_same_as_scanning(monkeypatch):
    import numpy as np

    from marlstone.llm import bpe

    words = Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    chance = random.Random(2)
    pieces = ["".join(chance.choice("etaoin shrdlu") for _ in range(n)).encode() for n in (1, 2, 5, 40, 120)]
    raw = np.frombuffer(b"".join(pieces), "u1")
    size = np.array([len(p) for p in pieces])
    first = np.cumsum(size) - size
    short = words.encode_pieces(raw, first, size)
    monkeypatch.setattr(bpe, "LONG_PIECE", 1)
    long = words.encode_pieces(raw, first, size)
    assert short[0].tolist() == long[0].tolist() and short[1].tolist() == long[1].tolist()


def test_frames(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    known, texts = Tokenizer.from_file(path), odd_texts(60)
    rows = [(None if i == 3 else i // 2, t, "x") for i, t in enumerate(texts)]
    df = table(spark, rows, "doc_id long, text string, n_tokens string")
    coded = decode(encode(df, path), path)
    for row in coded.collect():
        ids = known.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == known.decode(ids, skip_special_tokens=False) and row.n_tokens == "x"
    digests = round_trip(df, path).collect()
    expected = []
    for i, t, _ in rows:
        ids = known.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(known.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, digests), key=repr) == sorted(expected, key=repr)
    assert round_trip(df.where(F.lit(False)), path).collect() == []
    with pytest.raises(ValueError):
        encode(coded, path)
