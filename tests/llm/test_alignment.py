import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from marlstone.llm import alignment
from marlstone.llm.alignment import (
    align,
    alignment_scores,
    incidence,
    link_counts,
    link_rows,
    links,
    membership,
    most_end_pairs,
    row_products,
    sides,
    token_lists,
    transposed,
)
from marlstone.llm.bpe import byte_letters
from tests.llm.helpers import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CHANCE = random.Random(2)
TEXTS = [
    "The quick brown fox, jumps over 13 lazy dogs.", "tokenization isn't   alignment", "", None, " ", "  two", "tail  ", "a\tb\nc\r\n", "é è ü ñ ß",
    "日本語 テスト 😀😀", "x▁y", "<|endoftext|> and <s> </s> <0x41>", "a\0b", " odd ", "word " * 500, "q" * 3000, "tokenization isn't   alignment",
    *["".join(CHANCE.choice("abc  \n.é1T") for _ in range(CHANCE.randrange(1, 60))) for _ in range(40)],
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "No id here."), (3, "again 3")]


def plain_tokens():
    """A function from texts to both lists of (id, bytes), by the libraries alone."""
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PIECES)
    letters = {c: i for i, c in enumerate(byte_letters())}

    def split(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        found = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in found.ids]
        right = []
        for i in b.encode(text):
            name = b.id_to_piece(i)
            right.append((i, bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
        same = all(b"".join(t for _, t in side) == whole for side in (left, right))
        return (left, right) if same else ([], [])

    return split


def ranges(tokens):
    at, found = 0, []
    for _, raw in tokens:
        found.append((at, at + len(raw)))
        at += len(raw)
    return found


def plain_links(left, right, kind):
    a, b = ranges(left), ranges(right)
    ends = sorted({e for _, e in a} & {e for _, e in b})
    group = lambda span: sum(e < span[1] for e in ends)
    found = []
    for i, s in enumerate(a):
        for j, t in enumerate(b):
            shared = min(s[1], t[1]) - max(s[0], t[0])
            if (kind == "overlap" and shared > 0) or (kind == "end" and s[1] == t[1]) or (kind == "group" and group(s) == group(t)):
                found.append((i, j, left[i][0], right[j][0], None if kind == "group" else shared))
    return found


def plain_groups(left, right):
    a, b = ranges(left), ranges(right)
    found, i, j = [], 0, 0
    for end in sorted({e for _, e in a} & {e for _, e in b}):
        parts = []
        for spans, tokens, low in ((a, left, i), (b, right, j)):
            parts.append(",".join(str(tokens[k][0]) for k in range(low, len(spans)) if spans[k][1] <= end))
        i, j = sum(e <= end for _, e in a), sum(e <= end for _, e in b)
        found.append("|".join(parts))
    return found


def plain_scores(rows):
    split = plain_tokens()
    tokens = [split(t) for _, t in rows]
    pairs = [[(x, y) for _, _, x, y, _ in plain_links(*t, "end")] for t in tokens]
    times = Counter(p for some in pairs for p in some)
    highest = {}
    for (_, y), n in times.items():
        highest[y] = max(n, highest.get(y, 0))
    found = []
    for (i, _), (left, right), some in zip(rows, tokens, pairs):
        groups = plain_groups(left, right)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if left else ""
        best = sum(times[p] == highest[p[1]] for p in some)
        found.append((i, len(left), len(right), len(groups), len(some), best, sum(times[p] for p in some), digest))
    return sorted(found, key=repr)


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_row_products_equal_dense_ones(limit):
    chance = np.random.default_rng(4)
    owner_a, owner_b = np.sort(chance.integers(0, 9, 30)), np.sort(chance.integers(0, 9, 25))
    for left, right in (
        (membership(owner_a, 9), transposed(membership(owner_b, 9))),
        (incidence(np.array([3, 4, 9, 12])), transposed(incidence(np.array([1, 5, 6, 12])))),
    ):
        dense = [np.zeros((m.count, m.width), int) for m in (left, right)]
        for out, m in zip(dense, (left, right)):
            for i in range(m.count):
                for k in range(m.begin[i], m.begin[i + 1]):
                    out[i, m.columns[k]] += m.values[k]
        found = np.zeros((left.count, right.width), int)
        blocks = list(row_products(left, right, limit))
        for i, j, v in blocks:
            np.add.at(found, (i, j), v)
        assert (found == dense[0] @ dense[1]).all() and (limit > 100 or len(blocks) > 1)
    assert list(row_products(incidence(np.zeros(0, int)), transposed(incidence(np.zeros(0, int))))) == []


def test_unknown_kind_is_an_error():
    with pytest.raises(ValueError):
        list(links(np.array([1]), np.array([1]), "near"))


def test_ids_and_groups_equal_the_libraries(spark):
    split = plain_tokens()
    found = token_lists(align(table(spark, ROWS), BYTE_BPE, PIECES), BYTE_BPE, PIECES).collect()
    mine, theirs = [], []
    for r in found:
        a, b, groups = list(r["a_ids"]), list(r["b_ids"]), []
        for m, n in zip(r["group_a"], r["group_b"]):
            groups.append(",".join(map(str, a[:m])) + "|" + ",".join(map(str, b[:n])))
            a, b = a[m:], b[n:]
        assert not a and not b
        mine.append((r["id"], list(r["a_ids"]), list(r["b_ids"]), groups))
    for i, text in ROWS:
        left, right = split(text)
        theirs.append((i, [x for x, _ in left], [y for y, _ in right], plain_groups(left, right)))
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)


@pytest.mark.parametrize("kind", ["overlap", "end", "group"])
def test_links_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(alignment, "PRODUCT_CELLS", 50)
    rows = [(i, t) for i, t in enumerate(TEXTS) if len(t or "") < 200]
    aligned = align(table(spark, rows), BYTE_BPE, PIECES)
    split = plain_tokens()
    theirs = [(i, *x) for i, t in rows for x in plain_links(*split(t), kind)]
    found = [tuple(r) for r in link_rows(aligned, BYTE_BPE, PIECES, kind).collect()]
    assert sorted(found, key=repr) == sorted(theirs, key=repr)
    counted = {(r["a_id"], r["b_id"]): r["n"] for r in link_counts(aligned, BYTE_BPE, PIECES, kind).collect()}
    assert counted == Counter((x[3], x[4]) for x in theirs)


def test_scores_equal_brute_force(spark):
    found = alignment_scores(table(spark, ROWS), BYTE_BPE, PIECES).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_scores(ROWS)


def test_scores_of_the_smallest_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = [(i, t) for i, t in rows if len(t or "") < 1200]
    found = alignment_scores(docs.where("coalesce(length(text), 0) < 1200"), BYTE_BPE, PIECES).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_scores(short)


def test_empty_table_and_other_columns(spark):
    assert alignment_scores(table(spark, []), BYTE_BPE, PIECES).collect() == []
    df = table(spark, [(1, "Some text.", "x", 3)], "doc_id long, text string, a_ids string, id int")
    assert alignment_scores(df, BYTE_BPE, PIECES).first()["id"] == 1


def test_pairs_that_can_end_together_are_bounded():
    a, b = sides(BYTE_BPE, PIECES)
    bound = most_end_pairs(BYTE_BPE, PIECES)
    assert len(a.size) < bound < 1_000_000
