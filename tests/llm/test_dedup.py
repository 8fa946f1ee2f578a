import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, id_filter, line_dedup, near_dedup, suffix_dedup
from quarry.llm.common import connected_components
from tests.llm.helpers import edge_docs, edge_rows, near_components, prose, shingles


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_exact_decisions_match_definition(spark):
    rows = edge_rows()
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    want = []
    for i, t in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[k])
        want.append((i, best[3], len(groups[k]), i == best[3] and len(t or "") == -best[0],
                     hashlib.sha256(k.encode()).hexdigest()))
    got = by_row(exact_dedup.decisions(edge_docs(spark)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=str)


def test_exact_dedup_keeps_columns_and_one_row_of_each_text(spark):
    docs = edge_docs(spark)
    out = exact_dedup.exact_dedup(docs)
    assert out.schema == docs.schema
    keys = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in out.collect()]
    assert len(keys) == len(set(keys)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in edge_rows()})
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == exact_dedup.decisions(docs.limit(0)).count() == 0


def test_repeat_filter_flags_every_repeat_and_few_others(spark):
    keys = spark.range(5000).selectExpr("cast(id % 4000 as string) AS _key")
    bits, cells = exact_dedup.repeat_filter(keys)
    flagged = exact_dedup.flag(keys, bits, cells).where("_maybe").groupBy("_key").count()
    got = {r["_key"] for r in flagged.collect()}
    assert {str(i) for i in range(1000)} <= got and len(got) < 1100


def test_id_filter_never_misses(spark):
    keys = spark.range(0, 3000, 7).toDF("k")
    rows = spark.range(-5, 3005)
    got = id_filter.maybe_among(rows, F.col("id"), keys)
    maybe = {r["id"] for r in got.where("_maybe").collect()}
    assert set(range(0, 3000, 7)) <= maybe and len(maybe) < 1.2 * 3000 / 7
    assert id_filter.maybe_among(rows, F.col("id"), keys.limit(0)).where("_maybe").count() == 0


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(spark, size, percent):
    base = [prose(s, 80).split() for s in range(6)]
    rows = []
    for k in range(60):
        w = list(base[k % 6])
        for j in range(k // 6):
            w[(17 * j + k) % 80] = f"edit{k}x{j}"
        rows.append((1000 - k, " ".join(w)))
    rows += [(i, t) for i, t in edge_rows() if i is not None and i != 2]
    want = near_components(rows, size, percent)
    got = near_dedup.near_duplicates(edge_docs(spark, rows), shingle=size, percent=percent).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t, size)) for i, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_edges(spark):
    docs = edge_docs(spark)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(edge_rows())
    assert all(r["kept"] and r["n_shingles"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    out = near_dedup.near_dedup(docs)
    assert out.columns == docs.columns
    ids = {r["doc_id"] for r in out.collect()}
    assert 1 in ids and not ids & {2, 7} and {3, 4, 5, 8} <= ids
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0


def test_blocks_of_a_large_group_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = prose(9, 60).split()
    rows = []
    for k in range(40):
        base = list(base)
        base[(7 * k) % 60] = f"step{k}"  # a chain: neighbours are alike, ends are not
        rows.append((k, " ".join(base)))
    got = near_dedup.near_duplicates(edge_docs(spark, rows), shingle=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_components(rows, 3, 85)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 62, 500).astype(np.uint64))
    b = np.concatenate([a[:400], rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    s = near_dedup.sketches([a, b, a[:1], a[:3]])
    assert not (s == near_dedup.FULL).any()
    assert abs((s[0] == s[1]).mean() - 400 / 600) < 0.15


def test_connected_components_of_path_and_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}


def brute_suffix(rows):
    first, out = {}, []
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for s in range(len(b) - 49):
            first.setdefault(b[s:s + 50], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if i is not None:
            for s in range(len(b) - 49):
                if first[b[s:s + 50]] < i:
                    gone[s:s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,piece", [(1 << 22, 1 << 18), (2000, 300)])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, chunk, piece):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    shared = prose(20, 30)
    rows = [(i, t if i != 6 else prose(3, 600)) for i, t in edge_rows()]
    rows += [(50 + k, prose(30 + k, 10) + shared[k: 200 - k] + prose(60 + k, 10)) for k in range(8)]
    rows += [(70, "ab" * 200), (71, "ab" * 100 + "c" + "ab" * 40)]
    got = by_row(suffix_dedup.suffix_dedup(edge_docs(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert [(*r[:4], bytes(r[4])) for r in got] == brute_suffix(rows)
    assert suffix_dedup.suffix_dedup(edge_docs(spark, rows).limit(0)).count() == 0


def test_distinct_ranks_are_placed_without_a_sort(monkeypatch):
    ranks = np.random.default_rng(2).permutation(500)[:300]
    want = np.argsort(ranks).tolist()
    assert np.diff(np.array([3, 1, 1, 0])[suffix_dedup._order(np.array([3, 1, 1, 0]), 4)]).min() >= 0
    monkeypatch.setattr(suffix_dedup.np, "argsort", None)  # was: two stable sorts of permutations in every suffix array
    assert suffix_dedup._order(ranks, 500).tolist() == want and suffix_dedup._order(ranks[:0], 0).tolist() == []


def test_suffix_ranks_order_suffixes():
    rng = np.random.default_rng(3)
    for n, letters in ((1, 2), (2, 2), (7, 1), (300, 2), (900, 30)):
        s = rng.integers(1, letters + 1, n)
        if n == 900:
            s[450:] = s[:450]
        order = np.argsort(suffix_dedup.suffix_ranks(s, 50), kind="stable")
        heads = [tuple(s[i:i + 50]) for i in order]
        assert heads == sorted(heads)


def brute_lines(rows, window=3):
    seen, parts = {}, {}
    for k, (i, t) in enumerate(rows):
        lines = [x for x in (t or "").split("\n") if x]
        parts[k] = lines
        n = min(window, len(lines))
        if i is not None and n:
            for p in range(len(lines) - n + 1):
                key = tuple(lines[p:p + n])
                seen[key] = min(seen.get(key, (i, p)), (i, p))
    out = []
    for k, (i, t) in enumerate(rows):
        lines, n = parts[k], min(window, len(parts[k]))
        gone = set()
        if i is not None and n:
            for p in range(len(lines) - n + 1):
                if seen[tuple(lines[p:p + n])] < (i, p):
                    gone |= set(range(p, p + n))
        left, at = [], -1
        for x in (t or "").split("\n"):
            at += x != ""
            if x == "" or at not in gone:
                left.append(x)
        out.append((i, None if t is None else "\n".join(left), len(lines), len(gone), sum(1 for g in gone if g - 1 not in gone)))
    return sorted(out, key=str)


def test_line_dedup_matches_brute_force(spark):
    block = ["first line", "second line", "third line", "fourth line", "fifth line"]
    rows = [(1, "\n".join(["a", *block, "b"])), (2, "\n".join(["c", *block[1:], "", "d"])), (3, "\n".join(block[:2])),
            (4, "\n".join(block[:2])), (5, None), (6, ""), (7, "\n\n"), (8, "same\n" * 6), (9, "same\nsame\nsame"),
            (None, "\n".join(block)), (10, "\n".join(["x", *block[2:], "y", *block[:3]])), (0, "alone"), (11, "alone"),
            (12, "\n".join(f"l{k}" for k in range(3000)))]
    docs = edge_docs(spark, rows)
    out = line_dedup.line_dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed", "n_runs"]
    assert by_row(out, "doc_id", "text", "n_lines", "n_removed", "n_runs") == brute_lines(rows)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_every_repeated_line_goes_whatever_the_run_or_document(spark, tmp_path):
    from quarry.llm.queries import QUERIES

    long = "a line of its own with many words " * 8
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, long), (4, "b\nc"), (5, None), (6, ""), (7, "e\n\ne\nf\ng"),
            (8, "x\nf\ng\ny"), (9, "\n".join(f"l{k % 2000}" for k in range(3000))), (0, "alone"), (10, "y\nalone")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_line_dedup_every_line"](spark, str(tmp_path)).collect()
    want = {i: (n, gone, runs) for i, _, n, gone, runs in brute_lines(rows, 1)}
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_runs"]) for r in got} == want
    assert want[2][1] == want[3][1] == 1 and want[8][1] == 2 and want[9][1] == 1000
    more = edge_docs(spark, [*rows, (None, long), (2, "again\nagain")])
    out = line_dedup.line_dedup(more, window=1)
    assert out.where("doc_id IS NULL").first()["n_removed"] == 0
    assert out.columns == [*more.columns, "n_lines", "n_removed", "n_runs"]


def test_line_fingerprints_cover_every_window():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 50):
        lines = rng.integers(0, 5, n)
        runs = line_dedup.selected_runs(lines, 3)
        windows = [w for _, a, b in runs for w in range(a, b + 1)]
        assert windows == list(range(max(n - 2, 1)))
        assert all(a <= p < a + 3 or n < 3 for p, a, _ in runs[:1])
