import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import jaccard
from marlstone.llm.components import components
from marlstone.llm.minhash import drop_near_copies, estimate, near_components, sketch
from tests.llm.helpers import near_roots, shingle_set, table


def near_texts(seed, families=12, words=60):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for f in range(families):
        base = [chance.choice(vocabulary) for _ in range(words if f % 3 else 12)]
        texts.append(" ".join(base))
        for _ in range(chance.randint(0, 6)):
            other = list(base)
            for _ in range(chance.randint(0, 3)):
                other[chance.randrange(len(other))] = chance.choice(vocabulary)
            if chance.random() < 0.5:
                other += [chance.choice(vocabulary) for _ in range(chance.randint(1, 12))]
            texts.append(("  " if chance.random() < 0.3 else " ").join(other).upper() if chance.random() < 0.3 else " ".join(other))
    texts += [None, "", "  \n", "one two", "ONE two", "one two three", "É b", "é b", texts[0], texts[0]]
    chance.shuffle(texts)
    return texts


def expected(rows):
    roots = near_roots(rows)
    members = {}
    for (i, _), r in zip(rows, roots, strict=True):
        members.setdefault(r, []).append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return sorted(((i, len(shingle_set(t)), smallest[r], i == smallest[r]) for (i, t), r in zip(rows, roots, strict=True)), key=repr)


@pytest.mark.parametrize("block", [1000, 2])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rows = [(1000 - i, t) for i, t in enumerate(near_texts(block))]
    rows += [(None, rows[0][1]), (None, "only here without id nine words long it is")]
    found = near_components(table(spark, rows)).select("doc_id", "near.n_shingles", "near.component_id", "near.kept").collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_one_row_of_each_component_stays(spark):
    rows = [(i // 2, t, "x") for i, t in enumerate(near_texts(5))]
    rows += [rows[4], rows[4]]
    df = table(spark, rows, "doc_id long, text string, near string")
    kept = drop_near_copies(df)
    assert kept.columns == df.columns
    plain = [(i, t) for i, t, _ in rows]
    roots = near_roots(plain)
    empty = sum(not shingle_set(t) for _, t in plain)
    with_words = {r for r, (_, t) in zip(roots, plain, strict=True) if shingle_set(t)}
    assert kept.count() == len(with_words) + empty
    assert near_components(df.where(F.lit(False))).count() == 0


def test_a_third_are_near_copies(spark):
    chance = random.Random(3)
    base = [f"h{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base) if i % 3 == 0 else [f"x{chance.randrange(10**6)}" for _ in range(30)]
        if i % 3 == 0:
            words[chance.randrange(80)] = f"e{i}"
        rows.append((i, " ".join(words)))
    found = near_components(table(spark, rows)).select("doc_id", "near.n_shingles", "near.component_id", "near.kept").collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_estimates_follow_the_similarity():
    chance = np.random.default_rng(1)
    values = chance.integers(0, 2**63, 3000).astype("u8")
    for common in (0, 500, 1000):
        a, b = np.unique(values[:1000]), np.unique(values[1000 - common : 2000 - common])
        agreeing = (sketch(a) == sketch(b)).sum()
        assert abs(estimate(np.array([agreeing]))[0] - common / (2000 - common)) < 0.13
    assert (sketch(values[:1]) == sketch(values[:1])).all() and len(set(sketch(values[:1]))) == 1


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (55, 54), (40, 39)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 54: 54, 55: 54}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0
