import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import quality_rules as rules
from marlstone.llm.batches import chunks, flatten, shape
from marlstone.llm.quality_rules import judge, keep_good
from tests.llm.helpers import SCHEMA, base_failed, shape_of, table


def odd_texts(n=300):
    chance = random.Random(4)
    parts = ["a", "b", "the", "the the the", " ", "  ", "\n", "\n\n", "\t", "\x0b", "é", "#", "***", "a|b", "<x>", "\xa0", "\x1c", "line\nline\n", "文字"]
    return [*["".join(chance.choice(parts) for _ in range(chance.randint(0, 60))) for _ in range(n)], "", None, "a", "\n", "w " * 100]


@pytest.mark.parametrize("limit", [50, 10**6])
def test_shapes_equal_plain_counting(limit):
    texts = odd_texts()
    got = [row for a, b in chunks(texts, limit) for row in zip(*shape(flatten(texts[a:b])), strict=True)]
    assert [tuple(map(int, row)) for row in got] == [shape_of(t) for t in texts]


def plain_distances(vectors):
    """Concentration steps over all vectors of one group, without the distributed form."""
    x = np.array(vectors, "f8")
    centre = np.array([np.sort(c)[(len(c) + 1) // 2 - 1] for c in x.T])
    inverse = np.diag([1 / (f * rules.GRID) ** 2 for f in rules.FLOOR])
    far = lambda c, inv: np.einsum("ni,ij,nj->n", x - c, inv, x - c)
    for _ in range(rules.STEPS):
        ring = np.floor(np.log2(1 + far(centre, inverse)) * rules.BUCKETS)
        core = np.zeros(len(x), bool)
        for r in np.unique(ring):
            if core.sum() >= rules.CORE * len(x):
                break
            core |= ring == r
        centre, inverse = rules.estimate(core.sum(), x[core].sum(axis=0), x[core].T @ x[core])
    return far(centre, inverse)


def vector(s):
    n = max(s[0], 1)
    values = [math.log(max(s[1], 1) / n), math.log1p(s[2] / n), s[3] / max(s[5], 1), s[4] / n]
    return [math.floor(v * rules.GRID + 0.5) for v in values]


def test_verdicts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("verdict")
    found = {r.doc_id: r.verdict for r in judge(docs).collect()}
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    shapes = {r.doc_id: shape_of(r.text) for r in rows}
    groups = {}
    for r in rows:
        if not base_failed(shapes[r.doc_id]):
            for cell in ((), (r.lang,), (r.lang, r.source)):
                groups.setdefault(cell, []).append(r.doc_id)
    distance = {c: dict(zip(ids, plain_distances([vector(shapes[i]) for i in ids]), strict=True)) for c, ids in groups.items() if len(ids) >= rules.MIN_GROUP or not c}
    for r in rows:
        v, s = found[r.doc_id], shapes[r.doc_id]
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.n_lines) == s
        assert v.base_failed == base_failed(s)
        if v.base_failed:
            assert v.kept is False and v.distance is None
            continue
        cell = max((c for c in ((), (r.lang,), (r.lang, r.source)) if c in distance), key=len)
        assert abs(v.distance - distance[cell][r.doc_id]) < 1e-6 * (1 + v.distance)
        assert v.kept == (v.distance <= rules.CUTOFF)
    assert 700 < sum(v.kept for v in found.values()) < 900


def test_consistency_factor():
    sample = np.random.default_rng(0).normal(size=(200_000, 4))
    near = sample[np.argsort((sample**2).sum(axis=1))[:150_000]]
    assert abs(np.var(near[:, 0]) * rules.consistency(0.75) - 1) < 0.02


def test_edges(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{good} extra{i}", "en" if i % 2 else None, None, 1) for i in range(40)]
    rows += [(None, None, None, None, None), (50, "", "en", "s", 0), (51, "short text", "en", "s", 0), (3, rows[3][1], "en", None, 1), (60, "### " * 30 + good, "xx", "y", 1)]
    df = table(spark, [(*r, "v") for r in rows], SCHEMA + ", verdict string")
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(40), 3])
    assert judge(df).count() == len(rows)
    assert keep_good(df.where(F.lit(False))).count() == 0
    assert keep_good(df.where("text = 'short text'")).count() == 0
