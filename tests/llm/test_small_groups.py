import numpy as np
import pyarrow as pa

from marlstone.llm import jaccard


def test_small_groups_are_linked_as_large_ones_are(monkeypatch):
    """The pairs of many small groups compared together connect what comparing each group by itself connects."""
    chance = np.random.default_rng(2)
    rows = []
    for key in range(300):
        base = chance.integers(0, 2**63, 40, "u8")
        for _ in range(int(chance.integers(1, 20))):
            own = np.unique(np.concatenate([base[chance.random(40) < chance.choice([0.95, 0.7])], chance.integers(0, 2**63, 3, "u8")]))
            rows.append((key, 0, 0, 0, len(rows), len(rows) if chance.random() < 0.8 else 10**9 + key, own.tobytes()))
    table = pa.table(dict(zip(["key", "i", "j", "mine", "node", "root", "members"], map(list, zip(*rows, strict=True)), strict=True)))
    keys = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys[0])) + 1, [len(rows)]])
    # As in a slice of few members, so that there are several.
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 500)
    few = jaccard._links(table, bounds, keys)
    monkeypatch.setattr(jaccard, "FEW", 1)
    plain = jaccard._links(table, bounds, keys)
    assert len(few[0]) == len(plain[0]) > 100 and _parts(rows, few) == _parts(rows, plain)


def _parts(rows, links):
    top = {}

    def of(x):
        while x in top:
            x = top[x]
        return x

    for a, b in [*((r[4], r[5]) for r in rows), *zip(*links, strict=True)]:
        low, high = sorted((of(a), of(b)))
        if low != high:
            top[high] = low
    return [of(r[4]) for r in rows]
