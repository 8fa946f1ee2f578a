import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.operators import rank as rk
from quarry.spec import near, phrase, term


def Q(spark, rows_):
    return ix.queries_from_terms(spark, rows_)


def test_match_all_any(spark, idx):
    q = Q(spark, [(1, 0, "the"), (1, 1, "fox"), (2, 0, "dog"), (2, 1, "cat")])
    assert rows(mt.match_all(idx, q)) == [(1, 1), (1, 6), (2, 1), (2, 3)]
    assert rows(mt.match_any(idx, q).where("query_id = 2")) == [(2, 1), (2, 3)]


def test_match_phrase_and_near(spark, idx):
    q = Q(spark, [(1, 0, "of"), (1, 1, "the"), (2, 0, "the"), (2, 1, "of")])
    assert rows(mt.match_phrase(idx, q)) == [(1, 2)]
    assert rows(mt.match_near(idx, q, 2)) == [(1, 2), (2, 2)]
    q3 = Q(spark, [(3, 0, "quick"), (3, 1, "lazy")])
    assert rows(mt.match_near(idx, q3, 7)) == [(3, 1)]
    assert rows(mt.match_near(idx, q3, 6)) == []


def test_containment_phrase_near_all_any(spark, idx):
    q = Q(spark, [(1, 0, "the"), (1, 1, "sea"), (2, 0, "fox"), (2, 1, "the"), (3, 0, "a"), (3, 1, "cat")])
    ph, nr = set(rows(mt.match_phrase(idx, q))), set(rows(mt.match_near(idx, q, 3)))
    al, an = set(rows(mt.match_all(idx, q))), set(rows(mt.match_any(idx, q)))
    assert ph <= nr <= al <= an


def test_boolean_extended(spark, idx):
    assert rows(mt.match_boolean(idx, term("fox") & ~term("dog"))) == [(1, 6)]
    assert rows(mt.match_boolean(idx, ~term("the"))) == [(1, 4), (1, 5)]
    assert rows(mt.match_boolean(idx, term("the", field="title"))) == [(1, 1), (1, 2)]
    assert rows(mt.match_boolean(idx, phrase("of", "the") | term("yard"))) == [(1, 2), (1, 3)]
    assert rows(mt.match_boolean(idx, near("fox", "end", n=3) & term("news"))) == [(1, 6)]
    assert rows(mt.match_boolean(idx, {7: term("cat"), 8: term("sea")})) == [(7, 1), (7, 3), (8, 2)]


def test_fullscan_and_main_delta(spark, idx, docs):
    assert mt.match_fullscan(idx).count() == 6
    changed = docs.where("doc_id = 6").withColumn("body", docs.body.substr(1, 0))
    delta = ix.build_index("t", changed, ("title", "body"), "doc_id", attrs=["lang", "source", "author_id", "created_on"])
    full = ix.build_index("t", docs.where("doc_id <> 6").unionByName(changed), ("title", "body"), "doc_id",
                          attrs=["lang", "source", "author_id", "created_on"])
    both = mt.main_delta(idx, delta)
    q = Q(spark, [(1, 0, "fox")])
    assert rows(mt.match_all(both, q)) == rows(mt.match_all(full, q)) == [(1, 1), (1, 6)]
    cols = ("term", "doc_id", "field", "pos")
    assert rows(both.postings, *cols) == rows(full.postings, *cols)


def _bm25(idx, words, doc):
    n, avg = idx.docs.sparkSession.range(1).select(*idx.stats()).first()
    p = [(r["term"], r["doc_id"]) for r in idx.postings.collect()]
    dl = sum(1 for _, d in p if d == doc)
    s = 0.0
    for w in set(words):
        tf = sum(1 for t, d in p if t == w and d == doc)
        if not tf:
            continue
        df = len({d for t, d in p if t == w})
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg))
    return round(s, 6)


def test_bm25_brute_force(spark, idx):
    q = Q(spark, [(1, 0, "the"), (1, 1, "fox")])
    got = {r["doc_id"]: r["weight"] for r in rk.rank(idx, q, mt.match_any(idx, q), "bm25").collect()}
    for d, w in got.items():
        assert w == pytest.approx(_bm25(idx, ["the", "fox"], d), abs=1e-6)


def test_proximity_wordcount_weights(spark, idx):
    q = Q(spark, [(1, 0, "of"), (1, 1, "the"), (1, 2, "sea")])
    prox = {r["doc_id"]: r["weight"] for r in rk.rank(idx, q, mt.match_any(idx, q), "proximity").collect()}
    assert prox[2] == 3 + 3  # title "of the sea" and body "songs of the sea ..." both hold the run of 3
    wc = {r["doc_id"]: r["weight"] for r in rk.rank(idx, q, mt.match_any(idx, q), "wordcount", {"title": 10}).collect()}
    assert wc[2] == 3 * 10 + 5
    none = rk.rank(idx, q, mt.match_any(idx, q), "none")
    assert {r["weight"] for r in none.collect()} == {1.0}


def _runs(words, toks):
    """(longest in-order run, hits, distinct words) of query ``words`` in a field's words."""
    at = {(p - q, q): w for q, w in enumerate(words) for p, t in enumerate(toks) if t == w}
    best = 0
    for d, q in at:
        n = 0
        while (d, q + n) in at:
            n += 1
        best = max(best, n)
    return best, len(at), len(set(at.values()))


def test_longest_run_matches_brute_force_at_any_length(spark):
    toks = [f"w{i % 90}" for i in range(300)]
    docs = spark.createDataFrame([(1, " ".join(toks)), (2, "the quick the of the sea and"), (3, ""), (4, None)],
                                 "doc_id long, body string")
    index = ix.build_index("r", docs, ("body",), "doc_id")
    long_query = [f"w{i}" for i in range(100)]  # more than 62 words on few positions
    queries = {1: ["the", "quick", "the"], 2: ["of", "the", "sea", "and"], 3: long_query, 4: ["the", "the"]}
    q = Q(spark, [(k, i, w) for k, ws in queries.items() for i, w in enumerate(ws)])
    got = {(r["query_id"], r["doc_id"]): (r["lcs"], r["hits"], r["n_words"]) for r in rk.lcs_per_field(index, q).collect()}
    fields = {1: toks, 2: "the quick the of the sea and".split()}
    want = {(k, d): _runs(ws, t) for k, ws in queries.items() for d, t in fields.items() if set(ws) & set(t)}
    assert got == want and got[3, 1][2] == 90


def test_batch_of_expressions_is_one_plan(spark, idx):
    from quarry.spec import near, phrase, term

    exprs = {1: term("the") & ~term("dog"), 2: phrase("of", "the") | term("fox", "title"), 3: ~term("the"),
             4: near("sea", "songs", n=4) & term("wind"), 5: near("cat", "dog", n=3), 6: near("dog", "cat", n=4, field="body")}
    got = rows(mt.match_boolean(idx, exprs))
    one_by_one = [rows(mt.match_boolean(idx, e, k)) for k, e in exprs.items()]
    assert got == sorted(r for part in one_by_one for r in part)
    assert one_by_one[4] == [] and one_by_one[5] == [(6, 3)]
    many = {k: exprs[k % 6 + 1] for k in range(60)}
    scans = mt.match_boolean(idx, many)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans == mt.match_boolean(idx, exprs)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")


def test_stored_index_reads_the_files_of_its_words(spark, docs):
    from quarry.session import scratch_path
    from quarry.sources import index_io as io
    from quarry.streaming.delta import compact

    main = ix.build_index("m", docs, ("title", "body"), "doc_id", attrs=["lang"])
    path = scratch_path(spark, "t-main")
    io.write_index(main, path, rows_per_file=5)
    stored = io.read_index(spark, path)
    q = Q(spark, [(1, 0, "fox"), (1, 1, "the")])
    whole = len(stored.lists().inputFiles())
    assert whole > 5 and len(stored.lists(Q(spark, [(1, 0, "wind")])).inputFiles()) == 1
    for df in (mt.match_phrase(stored, q), mt.match_all(stored, q), rk.match_and_rank(stored, q, "all", "proximity_bm25")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [In(term, [fox,the])" in plan and "lengths" not in plan
        assert len(df.inputFiles()) < whole
        assert "Exchange" in plan and "doc_lengths" not in plan
    assert mt.match_any(stored, Q(spark, [(1, 0, "zzz")])).count() == mt.match_any(stored, Q(spark, [])).count() == 0
    io.PUSHED_WORDS, kept = 1, io.PUSHED_WORDS
    try:  # more words than are pushed: the same result
        assert rows(mt.match_any(io.read_index(spark, path), q)) == rows(mt.match_any(stored, q))
    finally:
        io.PUSHED_WORDS = kept
    delta = ix.build_index("d", docs.where("doc_id = 1").withColumn("body", F.lit("a new text with the wolf")),
                           ("title", "body"), "doc_id", attrs=["lang"])
    both = mt.main_delta(stored, delta)
    words = Q(spark, [(1, 0, "wolf"), (2, 0, "quick"), (3, 0, "the")])
    assert rows(mt.match_any(both, words)) == [(1, 1), (3, 1), (3, 2), (3, 3), (3, 6)]
    once = compact(stored, delta, scratch_path(spark, "t-compact"))
    twice = compact(once, delta, scratch_path(spark, "t-compact"))
    cols = ("term", "doc_id", "field", "pos")
    assert rows(once.postings, *cols) == rows(twice.postings, *cols) == rows(both.postings, *cols)
    assert rows(rk.rank(twice, words, None, "proximity_bm25")) == rows(rk.rank(both, words, None, "proximity_bm25"))


def test_main_delta_counts_equal_a_rebuild(spark, docs):
    """Replaced, changed to nothing and new documents: vocabulary and statistics without main's lists."""
    from quarry.session import scratch_path
    from quarry.sources import index_io as io

    new = docs.where("doc_id IN (1, 2)").withColumn("body", F.expr("CASE WHEN doc_id = 1 THEN 'wolf the wolf' ELSE '' END"))
    new = new.union(docs.where("doc_id = 3").withColumn("doc_id", F.lit(70000).cast("long")))
    path = scratch_path(spark, "t-main")
    make = lambda d: ix.build_index("m", d, ("title", "body"), "doc_id", attrs=["lang"])
    io.write_index(make(docs), path)
    whole = make(docs.join(new, "doc_id", "left_anti").union(new))
    for main in (io.read_index(spark, path), make(docs)):
        both = mt.main_delta(main, make(new))
        assert rows(both.vocabulary(), "term", "docs", "hits") == rows(whole.vocabulary(), "term", "docs", "hits")
        cols = lambda i: spark.range(1).select(i.stats()[0].alias("n"), F.round(i.stats()[1], 9).alias("mean")).first()
        assert tuple(cols(both)) == tuple(cols(whole))
        q = Q(spark, [(1, 0, "the"), (1, 1, "wolf"), (2, 0, "cat")])
        for mode, ranker in (("any", "proximity_bm25"), ("all", "bm25"), ("phrase", "matchany"), ("any", "wordcount")):
            assert rows(rk.match_and_rank(both, q, mode, ranker)) == rows(rk.match_and_rank(whole, q, mode, ranker))
        plan = rk.match_and_rank(both, q, "any", "proximity_bm25")._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan


def test_id_bitmap(spark):
    from quarry.operators import bitmap as bm

    ids = [0, 1, 7, 8, 32767, 32768, 32769, 10**12, -1, -32768, None]
    held = bm.id_bitmap(spark.createDataFrame([(i,) for i in ids], "id long"))
    probe = spark.createDataFrame([(i,) for i in [*ids, 2, 9, 32770, 10**12 + 1, -2, 5]], "doc_id long")
    assert {r[0] for r in bm.within(probe, held).collect()} == {i for i in ids if i is not None}
    assert {r[0] for r in bm.without(probe, held).collect()} == {2, 9, 32770, 10**12 + 1, -2, 5, None}


@pytest.mark.parametrize("mode", ["any", "all", "phrase"])
@pytest.mark.parametrize("ranker", ["bm25", "wordcount", "proximity", "matchany", "proximity_bm25", "none"])
def test_match_and_rank_is_match_then_rank(spark, idx, mode, ranker):
    q = Q(spark, [(1, 0, "of"), (1, 1, "the"), (2, 0, "the"), (2, 1, "fox"), (2, 2, "the"), (3, 0, "zzz"), (4, 0, "fox")])
    cols = ("query_id", "doc_id", "weight")
    want = rk.rank(idx, q, mt.match(idx, q, mode), ranker, {"title": 3})
    assert rows(rk.match_and_rank(idx, q, mode, ranker, {"title": 3}), *cols) == rows(want, *cols)


def test_spans_and_phrases_against_plain_code(spark):
    """The counting sweep and the shifted positions on random texts."""
    import random

    rng = random.Random(7)
    texts = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(80)]
    index = ix.build_index("r", spark.createDataFrame(texts, "doc_id long, body string"), ("body",), "doc_id")
    queries = [["a", "b"], ["a", "b", "c"], ["a", "a", "b"], ["d"], ["a", "b", "c", "d"]]
    q = Q(spark, [(k, p, w) for k, ws in enumerate(queries) for p, w in enumerate(ws)])
    for n in (1, 2, 3, 5):
        want = [(k, i) for k, ws in enumerate(queries) for i, t in texts if any(
            set(ws) <= set(t.split()[s:s + n]) for s in range(len(t.split())))]
        assert rows(mt.match_near(index, q, n)) == sorted(want)
    want = [(k, i) for k, ws in enumerate(queries) for i, t in texts if any(
        t.split()[s:s + len(ws)] == ws for s in range(len(t.split())))]
    assert rows(mt.match_phrase(index, q)) == sorted(want)


@pytest.mark.parametrize("ranker", ["bm25", "wordcount", "proximity", "matchany", "proximity_bm25", "none"])
def test_rank_any_set_direct_equals_join(spark, idx, ranker):
    # matched=None scores the any-word set directly; it must equal ranking match_any's pairs
    q = Q(spark, [(1, 0, "the"), (1, 1, "fox"), (2, 0, "dog"), (2, 1, "zzz"), (3, 0, "zzz")])
    cols = ("query_id", "doc_id", "weight")
    assert rows(rk.rank(idx, q, None, ranker), *cols) == rows(rk.rank(idx, q, mt.match_any(idx, q), ranker), *cols)


def test_bm25_from_stored_vocabulary(spark, docs):
    # idf from a persisted or stored vocabulary (one row per word) equals counting the document lists
    from dataclasses import replace

    from quarry.session import scratch_path
    from quarry.sources import index_io as io

    base = ix.build_index("v", docs, ("title", "body"), "doc_id", attrs=["lang"])
    q = Q(spark, [(1, 0, "the"), (1, 1, "fox"), (2, 0, "sea"), (2, 1, "zzz")])
    cols = ("query_id", "doc_id", "weight")
    want = rows(rk.rank(base, q, None, "bm25"), *cols)
    kept = replace(base).persist()
    assert kept._vocab is not None
    assert rows(rk.rank(kept, q, None, "bm25"), *cols) == want
    path = scratch_path(spark, "t-vocab-index")
    io.write_index(base, path)
    stored = io.read_index(spark, path)
    assert stored.vocabulary().columns == ["term", "docs", "hits"]
    assert rows(stored.vocabulary()) == rows(base.vocabulary())
    assert rows(rk.rank(stored, q, None, "bm25"), *cols) == want


def test_small_known_query_table_same_results(spark, idx):
    # a persisted (proven small) query table runs as one partition; results must not change
    rows_ = [(1, 0, "the"), (1, 1, "fox"), (2, 0, "of"), (2, 1, "the"), (3, 0, "dog")]
    plain, kept = Q(spark, rows_), Q(spark, rows_).persist()
    kept.count()
    for f in (mt.match_all, mt.match_any, mt.match_phrase, lambda i, q: mt.match_near(i, q, 3)):
        assert rows(f(idx, kept)) == rows(f(idx, plain))
    cols = ("query_id", "doc_id", "weight")
    for r in ("bm25", "proximity_bm25", "wordcount"):
        assert rows(rk.rank(idx, kept, mt.match_all(idx, kept), r), *cols) == \
            rows(rk.rank(idx, plain, mt.match_all(idx, plain), r), *cols)
    kept.unpersist()


def test_clause_table_equals_conditions(spark, idx, monkeypatch):
    """Random expressions, NOT only and impossible ones among them, as table rows and as conditions."""
    import random

    from quarry.spec import near, phrase, term

    rng = random.Random(3)
    leaves = [*map(term, ("the", "fox", "cat", "of", "dog", "zzz")), phrase("of", "the"), near("cat", "dog", n=4), term("fox", "title")]

    def make(depth):
        kind = rng.randrange(4) if depth else 3
        if kind == 0:
            return make(depth - 1) & make(depth - 1)
        if kind == 1:
            return make(depth - 1) | make(depth - 1)
        return ~make(depth - 1) if kind == 2 else rng.choice(leaves)

    exprs = {k: make(rng.randint(0, 4)) for k in range(60)} | {60: term("the") & ~term("the"), 61: ~term("zzz")}
    want = rows(mt.match_boolean(idx, exprs))
    monkeypatch.setattr(mt, "CONDITIONS", 5)
    assert rows(mt.match_boolean(idx, exprs)) == want
    monkeypatch.setattr(mt, "CLAUSES", 2)  # most expressions fall back to conditions
    assert rows(mt.match_boolean(idx, {k: exprs[k] for k in range(12)})) == [r for r in want if r[0] < 12]


def test_standing_queries_with_a_hot_word_meet_few_documents(spark):
    """20,000 queries hold a word of every document; pairs examined follow the rarer words."""
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('the word', id % 100, ' body') AS body")
    index = ix.build_index("s", docs, ("body",), "doc_id")
    ids = spark.range(20000)
    q = (ids.selectExpr("cast(id AS int) AS query_id", "0 AS qpos", "'the' AS term")
         .union(ids.selectExpr("cast(id AS int)", "1", "concat('word', id)"))
         .union(spark.sql("SELECT 20000, 0, 'the' UNION ALL SELECT 20001, 0, 'zzz' UNION ALL SELECT 20001, 1, 'the'")))
    got = mt.match_standing(index.lists_for(q), q)
    assert rows(got) == rows(mt.match_all(index, q))
    assert got.count() == 300 + 300


def test_standing_queries_exchange_no_pairs(spark, monkeypatch):
    """Against plain sets: classes of equal queries, words of no document, repeated and missing ids; several small groups."""
    from quarry.operators import standing

    monkeypatch.setattr(standing, "GROUP_DOCS", 7)
    rng = random.Random(3)
    texts = [(i // 2 if i > 90 else i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 6)))) for i in range(100)] + [(None, "a b")]
    asked = {q: rng.choices("abcdefghz", k=rng.randint(1, 4)) for q in range(60)} | {60: ["a"], 61: ["a"], 62: ["z"]}
    index = ix.build_index("g", spark.createDataFrame(texts, "doc_id long, body string"), ("body",), "doc_id", attrs=[])
    q = spark.createDataFrame([(k, i, w) for k, ws in asked.items() for i, w in enumerate(ws)] + [(63, 0, "a"), (63, 1, None)],
                              "query_id int, qpos int, term string")
    got = mt.match_standing(index.lists_for(q), q)
    assert "MapInArrow" in _plan(got)  # was: pairs dealt by item and document
    held = {}
    for i, t in texts:
        held.setdefault(i, set()).update(t.split())
    want = {(k, i) for k, ws in asked.items() for i, w in held.items() if i is not None and set(ws) <= w}
    found = [(r["query_id"], r["doc_id"]) for r in got.collect()]
    assert len(found) == len(set(found)) and {f for f in found if f[1] is not None} == want
    assert {(60, None), (61, None)} <= set(found)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_expressions_are_matched_once_per_class_of_documents(spark):
    """Documents with the same words, one repeated and one without an id, against more expressions than conditions take."""
    texts = [(i, "cat dog" if i % 3 else "cat fox") for i in range(30)] + [(40, "dog"), (40, "fox"), (None, "cat fox"), (50, "ox")]
    index = ix.build_index("many", spark.createDataFrame(texts, "doc_id long, body string"), ("body",), "doc_id", attrs=[])
    exprs = {i: e for i, e in enumerate([term("cat") & ~term("fox"), term("dog") & term("fox"), term("cat") & (term("dog") | ~term("fox")),
                                         ~term("cat")] * (mt.CONDITIONS // 4 + 1))}
    got = mt.match_boolean(index, exprs)
    assert "BroadcastHashJoin [held" in _plan(got)  # was: every expression looked up for every document
    held = {i: set(t.split()) for i, t in texts if i is not None} | {40: {"dog", "fox"}}
    want = set()
    for q in exprs:
        for i, w in held.items():
            ok = [("cat" in w and "fox" not in w), {"dog", "fox"} <= w, "cat" in w and ("dog" in w or "fox" not in w), "cat" not in w][q % 4]
            want |= {(q, i)} if ok else set()
    found = [(r["query_id"], r["doc_id"]) for r in got.collect()]
    assert len(found) == len(set(found)) and {f for f in found if f[1] is not None} == want


def test_batched_bm25_sums_documents_without_a_second_exchange(spark, idx):
    q = Q(spark, [(i, p, w) for i in range(5) for p, w in enumerate(("the", "fox", "cat")[: i % 3 + 1])])
    got = rk.rank(idx, q, None, "bm25")
    assert not re.search(r"hashpartitioning\(query_id#\d+, doc_id", _plan(got))  # was: one shuffled row per query and document
    one = {(r["doc_id"], r["weight"]) for r in rk.rank(idx, Q(spark, [(2, 0, "the"), (2, 1, "fox"), (2, 2, "cat")]), None, "bm25").collect()}
    assert {(r["doc_id"], r["weight"]) for r in got.where("query_id = 2").collect()} == one


def test_written_lists_need_no_exchange_before_their_ranges(spark):
    """Repeated, missing and empty documents too: the stored tables equal the grouped ones."""
    from quarry.session import scratch_path
    from quarry.sources import index_io as io

    plain = spark.createDataFrame([(1, "b a", "a b a c"), (2, None, ""), (3, "z", "a a"), (4, "x y", None)], "doc_id long, title string, body string")
    more = spark.createDataFrame([(1, "a", "d a"), (None, "q", "q r"), (None, "q", "s")], "doc_id long, title string, body string")

    def table(df):
        return sorted(str((r["term"], r["doc_id"], r["tf"], r["dl"] if r["doc_id"] in (3, 4) else 0,
                           sorted((a["field"], sorted(a["pos"])) for a in r["at"]))) for r in df.collect())

    for docs in (plain, plain.unionByName(more)):
        index = ix.build_index("whole", docs, ("title", "body"), "doc_id", attrs=[])
        lists, words = index.whole()
        assert table(lists) == table(index.lists())
        assert docs is not plain or "Exchange" not in _plan(lists) + _plan(words)  # was: every occurrence, by word and document
        path = scratch_path(spark, "t-whole")
        io.write_index(index, path)
        stored = io.read_index(spark, path)
        assert table(stored.lists()) == table(index.lists())
        got = {r["doc_id"]: sorted((w["term"], w["tf"]) for w in r["words"]) for r in stored.words.collect()}
        want = {}
        for r in index.lists().collect():
            want.setdefault(r["doc_id"], []).append((r["term"], r["tf"]))
        assert got == {k: sorted(v) for k, v in want.items()}


def test_long_documents_are_listed_in_parts(monkeypatch):
    import pyarrow as pa

    from quarry.operators import doc_words as dw

    batch = pa.record_batch([pa.array([5, 6, 7, 8]), pa.array([3, 0, 2, 1]), pa.array([["b", "a", "b"], [], ["a", "a"], ["c"]])], ["doc_id", "dl", "toks0"])
    monkeypatch.setattr(dw, "WORDS_AT_ONCE", 2)
    parts = list(dw._slices(batch, 1))
    assert len(parts) > 1 and sum(p.num_rows for p in parts) == 4
    got = sorted((r["term"], r["doc_id"], r["tf"], r["at"][0]["pos"]) for p in parts for r in dw._list_rows(p, ("body",)).to_pylist())
    assert got == [("a", 5, 1, [1]), ("a", 7, 2, [0, 1]), ("b", 5, 2, [0, 2]), ("c", 8, 1, [0])]


def test_standing_classes_are_not_copied_to_every_group(spark, monkeypatch):
    """Texts as they are read, with a field's words in capitals and Cyrillic, repeated, missing and empty documents, against
    classes of several rows."""
    from quarry.operators import standing

    monkeypatch.setattr(standing, "GROUP_DOCS", 5)
    rng = random.Random(5)
    texts = [(i // 2 if i > 70 else i, rng.choice(["A-b", "Ж_1 b", None, ""]), " ".join(rng.choices("aBcdж", k=rng.randint(0, 5)))) for i in range(80)]
    texts += [(None, "a", "b"), (None, "c", "Ж")]
    docs = spark.createDataFrame(texts, "doc_id long, title string, body string").repartition(3)
    asked = {q: rng.choices(["a", "b", "c", "d", "ж", "ж_1", "z"], k=rng.randint(1, 3)) for q in range(40)}
    q = spark.createDataFrame([(k, i, w) for k, ws in asked.items() for i, w in enumerate(ws)] + [(40, 0, None), (None, 0, "a"), (None, 1, "c")],
                              "query_id int, qpos int, term string")
    for table in (docs, docs.where("doc_id <= 35")):
        index = ix.build_index("t", table, ("title", "body"), "doc_id", attrs=[])
        got = mt.match_standing(index.lists_for(q), q, index)
        plan = _plan(got.where("doc_id >= 0"))
        assert "sequence(0" not in plan and ("CartesianProduct" in plan or "NestedLoop" in plan)  # was: a copy for every group
        held = {}
        for i, *ts in (tuple(r) for r in table.collect()):
            held.setdefault(i, set()).update(w for t in ts for w in re.findall("[0-9a-z_а-я]+", (t or "").lower()))
        want = {(k, i) for k, ws in (asked | {None: ["a", "c"]}).items() for i, w in held.items() if i is not None and set(ws) <= w}
        found = [(r["query_id"], r["doc_id"]) for r in got.collect()]
        assert len(found) == len(set(found)) and {f for f in found if f[1] is not None} == want
        assert ((None, None) in found) == (None in held) == any(f[1] is None for f in found)


def test_words_of_whole_batches_are_those_of_the_text_column(spark):
    import pyarrow as pa

    from quarry.functions.text import words
    from quarry.operators import doc_words as dw

    rng = random.Random(1)
    texts = ["".join(rng.choices("abzAZ09_ -.АЯЁЪабяёўЀѐРПрп中é𝒳\n", k=rng.randint(0, 30))) for _ in range(500)] + ["", "я", "Я", "", "a"]
    want = [r["w"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(words("t").alias("w")).collect()]
    assert dw.word_lists(pa.array(texts)).to_pylist() == want
    assert dw.word_lists(pa.array(texts)[3:]).to_pylist() == want[3:]
    assert dw.word_lists(pa.array([], pa.string())).to_pylist() == []
