"""Ranked search, SimHash dedup and the divergence audit against plain definitions."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import divergence, lexical, simhash
from tests.llm.helpers import edge_docs, edge_rows, prose, words


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- ranked search ---------------------------------------------------------------------------


def plain_search(docs, items, k=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold(t))
    rows = [(i, Counter(cut(t))) for i, t in docs if cut(t)]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(cut(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c in rows:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in ts if t in c)
            if s > 0:
                scored.append((-s, i is not None, i))
        for r, (s, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, r, i, -s))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard,block", [(500_000, 512), (150, 3)])
def test_ranked_search_matches_scoring_every_document(spark, shard, block):
    rng = random.Random(5)
    rows = edge_rows() + [(100 + i, prose(i % 7, rng.randint(1, 40)) + " " + prose(50 + i, 5)) for i in range(60)]
    items = [(1, prose(1, 12)), (2, "Thehe ERon!"), (2, prose(3, 4)), (3, None), (4, ""), (5, "nowhere-to-be-found"),
             (6, "日本 x x one"), (7, prose(5, 30)), (None, "one two")]
    docs = edge_docs(spark, rows)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.ranked_search(docs, asked, shard=shard, block=block)
    assert found(got) == plain_search(rows, items)


def test_ranked_search_of_empty_tables(spark):
    docs = edge_docs(spark)
    asked = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    for d, i in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.limit(0), asked.limit(0))):
        got = lexical.ranked_search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_best_positions_stop_early_and_never_cut_a_tie():
    n, rng = 5000, np.random.default_rng(3)
    doc = np.tile(np.arange(n), 2)
    term = np.repeat([0, 1], n)
    impact = np.concatenate([rng.permutation(n), rng.permutation(n)]) // 50  # many ties
    lists = lexical.ImpactLists(doc, term, impact, n, 2)
    total = impact[:n] * 3 + impact[n:] * 2
    want = np.lexsort((np.arange(n), -total))[:10]
    for _ in range(2):  # the lists are as before after a search
        best, score, looked_up = lists.best(np.array([0, 1]), np.array([3, 2]), np.arange(n), 10)
        assert best.tolist() == want.tolist() and score.tolist() == total[want].tolist() and looked_up < n
    flat = lexical.ImpactLists(np.arange(300), np.zeros(300, int), np.full(300, 7), 300, 1)
    rank = np.arange(300)[::-1].copy()  # the documents read last come first
    assert flat.best(np.array([0]), np.array([1]), rank, 10)[0].tolist() == list(range(299, 289, -1))


# ---- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    w = words(text)
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_simhash_matches_all_pairs(spark):
    base = prose(9, 300).split()
    rows = edge_rows()
    for i in range(60):
        w = list(base)
        for j in range(i % 9):
            w[(37 * j + i) % 300] = f"w{i}x{j}"
        rows.append((200 + i, " ".join(w)))
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = components(len(rows), [(a, b) for a, b in combinations(range(len(rows)), 2) if bin(fps[a] ^ fps[b]).count("1") <= 3])
    least = {}
    for c, (i, _) in zip(comp, rows, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, f"{fp:016x}", least.get(c)) for (i, _), fp, c in zip(rows, fps, comp, strict=True)), key=str)
    got = simhash.simhash(edge_docs(spark, rows))
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()), key=str) == want
    assert len(set(fps)) > len(set(comp)) > 5
    assert simhash.simhash(edge_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block", [4, 1024])
def test_variant_links_join_exactly_the_near_fingerprints(spark, block):
    """Chains, dense balls and one lower half shared by many, in small and in large blocks."""
    rng = random.Random(11)
    fps = {0, -1, 1 << 63, (1 << 62) | 7}
    center = rng.getrandbits(64)
    for _ in range(150):
        x = center
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    low = rng.getrandbits(32)
    fps |= {(rng.getrandbits(7) << 40) | (rng.getrandbits(5) << 59) | low for _ in range(80)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted({f - (1 << 64) if f >= 1 << 63 else f for f in fps})
    dist = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    near = [(a, b) for a, b in combinations(range(len(fps)), 2) if dist(fps[a], fps[b]) <= 3]
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), block).collect()
    assert all(0 < dist(r["a"], r["b"]) <= 3 for r in got)
    at = {f: i for i, f in enumerate(fps)}
    assert components(len(fps), near) == components(len(fps), [(at[r["a"]], at[r["b"]]) for r in got])


def test_fingerprints_do_not_depend_on_the_slab(monkeypatch):
    text = prose(4, 500)
    want = plain_fingerprint(text)
    for slab in (1, 7, 498, 1 << 16):
        monkeypatch.setattr(simhash, "SLAB", slab)
        assert simhash.fingerprint(text.encode()) % (1 << 64) == want


# ---- divergence audit ------------------------------------------------------------------------


def plain_divergence(rows, min_docs, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(t))) for lang, source, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, ts in mine for t in set(ts))
        keep = {t for t, n in df.items() if n >= min_docs}
        counts = {}
        for _, s, ts in mine:
            counts.setdefault(s, Counter()).update(t for t in ts if t in keep)
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + (10**9 * (c[t] + 5)) // (sum(c.values()) + 5 * len(keep))

        for s, c in counts.items():
            pairs = sorted((-sum(abs(p(c, t) - p(d, t)) for t in keep), o.encode()) for o, d in counts.items() if o != s)
            diff = sorted((p(whole, t) - p(c, t), t.encode()) for t in c if c[t] > 0 and p(c, t) > p(whole, t))[:top]
            for part, ranked in (("pair", pairs), ("term", diff)):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("sources,chunk,entries", [(64, 8192, 500_000), (2, 5, 20)])
def test_divergence_matches_definition(spark, monkeypatch, sources, chunk, entries):
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    rng = random.Random(2)
    vocab = [*(a + b for a in ("Th", "er", "é", "日", "z") for b in ("e", "at", "ou"))]
    data = [(rng.choice(["en", "en", None, "fr"]), rng.choice(["a", "b", None, "ü", "z1", "z0", "c"]),
             rng.choice([None, "", "1 2 3!"] + [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 30)))] * 9))
            for _ in range(150)]
    data += [("xx", "only", "rare words"), ("xx", "other", None), ("en", "wordless", "12 34"), *[("en", "a", "tie1b tie2a")] * 3]
    df = spark.createDataFrame([(i, t, lang, s, 1, "x") for i, (lang, s, t) in enumerate(data)],
                               "doc_id long, text string, lang string, source string, n int, value string")
    for min_docs, top in ((3, 50), (5, 4)):
        got = sorted(tuple(r) for r in divergence.divergence(df, min_docs, top)
                     .select("lang", "source", "part", "item", "value", "rank").collect())
        assert got == plain_divergence(data, min_docs, top)
    assert divergence.divergence(df.limit(0)).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, v = 9_000_000_000_000, 10_000_000_000_001, 77_777
    got = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(
        divergence.share("n", "total", "v").alias("p"), F.lit(1)).first()["p"]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)
