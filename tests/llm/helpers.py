"""Plain versions of what the operators compute."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def shingle_set(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_roots(rows):
    """The root position of each row, linking sets with a Jaccard similarity of 0.75 or more."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(k) for k in range(len(rows))]


def shape_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def base_failed(shape):
    return shape[0] < 50 or 100 * shape[4] > 50 * shape[0]


def by_key(pairs):
    found = defaultdict(list)
    for key, value in pairs:
        found[key].append(value)
    return found


