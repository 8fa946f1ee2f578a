"""Small fixtures and plain-Python versions of the operators' definitions."""

import random
import re

WORDS = [a + b for a in ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha") for b in ("e", "at", "is", "ou", "ly", "ing")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edge_rows():
    """Nulls, empty and blank texts, a very long text, ties, repeated rows; (doc_id, text)."""
    a, b = prose(1, 60), prose(2, 60)
    near = a.split()
    near[30] = "changed"
    return [(1, a), (2, a), (2, a), (3, None), (4, ""), (5, " \n\t "), (6, prose(3, 20000)), (None, a),
            (7, a.replace(" ", "  ")), (8, "one"), (9, "one two"), (10, "One  two"), (11, b), (12, " ".join(near)),
            (13, b + "\n" + prose(4, 30)), (14, "x" * 400), (-5, "é ñ 日本 " + b)]


def edge_docs(spark, rows=None):
    """As a table with extra columns whose names clash with the operators' internal ones."""
    data = [(i, t, "en", f"s{k % 3}", k, "x", k) for k, (i, t) in enumerate(edge_rows() if rows is None else rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, _key int, _id string, bucket int")


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingles(text, size):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def near_components(rows, size, percent):
    """Smallest reachable id per id, over all pairs."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, size)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}
