import hashlib
import re

import pytest
from pyspark.sql import functions as F

from marlstone.llm import exact
from marlstone.llm.exact import drop_copies, mark_copies
from tests.llm.helpers import by_key, table

LONG = "long text " * 3000
ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (4, " a b c"), (1, None), (2, ""), (9, LONG + "x"), (8, LONG + "y"), (7, LONG + "x"), (6, LONG.replace(" ", "\n") + "x"),
    (None, "a b c"), (None, "zzz"), (None, "zzz"), (20, "same"), (20, "same"), (20, "other"), (21, "other"), (30, "é b"), (31, "é b"), (32, "\x0b"), (33, " "),
    (40, "p" * 64), (41, "p" * 64), (42, "p" * 65), (43, "p" * 64 + "q"), (44, "p" * 4160), (45, "p" * 4160), (46, "p" * 4159 + "q"),
]


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = by_key((plain(t), i) for i, t in rows)
    out = []
    for i, t in rows:
        ids = [x for x in groups[plain(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[plain(t)]), i == keep, hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("first, following, growth", [(64, 4096, 16), (1, 1, 2), (2, 3, 4)])
def test_groups_equal_brute_force(spark, monkeypatch, first, following, growth):
    monkeypatch.setattr(exact, "FIRST_BYTES", first)
    monkeypatch.setattr(exact, "NEXT_BYTES", following)
    monkeypatch.setattr(exact, "GROWTH", growth)
    rows = ROWS if first == 64 else [(i, t if t is None or len(t) < 70 else t[-60:]) for i, t in ROWS]
    found = mark_copies(table(spark, rows)).select("doc_id", "copies.*").collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_one_row_of_each_group_stays(spark):
    df = table(spark, [(i, t, "e", "s", 1) for i, t in ROWS], "doc_id long, text string, copies string, row string, _text int")
    kept = drop_copies(df).collect()
    assert drop_copies(df).columns == df.columns
    assert sorted(plain(r.text) for r in kept) == sorted({plain(t) for _, t in ROWS})
    smallest = {plain(t): keep for (_, t), (keep) in zip(ROWS, [None] * len(ROWS), strict=True)}
    for i, t in ROWS:
        known = smallest[plain(t)]
        smallest[plain(t)] = i if known is None else known if i is None else min(i, known)
    assert {plain(r.text): r.doc_id for r in kept} == smallest


def test_a_third_of_all_rows_and_an_empty_table(spark):
    rows = [(i, "hot copy" if i % 3 == 0 else f"text {i}") for i in range(300)]
    found = mark_copies(table(spark, rows)).where("copies.group_size > 1").select("doc_id", "copies.keep_id", "copies.group_size").collect()
    assert sorted(map(tuple, found)) == [(i, 0, 100) for i in range(0, 300, 3)]
    assert mark_copies(table(spark, rows).where(F.lit(False))).collect() == []
