import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.operators import results as rs
from quarry.plans.search import IndexRegistry, search, search_indexes
from quarry.session import scratch_path
from quarry.sources import docset as ds
from quarry.sources import index_io as io
from quarry.sources import links as lk
from quarry.sources import scan as sc
from quarry.spec import IndexSpec, SearchSpec


def test_kwic(spark, idx):
    h = mt.match_all(idx, ix.queries_from_terms(spark, [(1, 0, "lazy")]))
    e = rs.excerpt_kwic(h, idx.texts, ["lazy"], ["body"], around=2)
    assert e.first()["excerpt"] == "over the <b>lazy</b> dog"
    h2 = mt.match_all(idx, ix.queries_from_terms(spark, [(1, 0, "the")])).where("doc_id = 2")
    e2 = rs.excerpt_kwic(h2, idx.texts, ["of", "the"], ["body"], around=1)
    assert e2.first()["excerpt"] == "songs <b>of</b> <b>the</b> sea"


def test_build_excerpts(spark):
    t = spark.createDataFrame([(1, "a b c x d e f g h i j k x m n")], "doc_id long, body string")
    e = rs.build_excerpts(t, "body", ["x"], around=1).first()["excerpt"]
    assert e == "c <b>x</b> d ... k <b>x</b> m"
    e1 = rs.build_excerpts(t, "body", ["x"], around=1, limit=12).first()["excerpt"]
    assert e1 == "c <b>x</b> d"
    e2 = rs.build_excerpts(t, "body", ["x"], around=4).first()["excerpt"]
    assert e2.count("...") == 0  # windows touch -> one passage


def test_hydrate_override_update_select(spark, idx):
    hits = spark.createDataFrame([(1, 3, 2.0), (1, 1, 5.0), (1, 99, 1.0)], "query_id int, doc_id long, weight double")
    src = spark.createDataFrame([(1, "one"), (3, "three")], "id long, name string")
    h = rs.hydrate(hits, src)
    assert rows(h, "result_index", "name") == [("0000", "one"), ("0001", "three")]
    ov = spark.createDataFrame([(1, 42)], "doc_id long, value long")
    o = rs.override_attr(idx.docs, "author_id", ov)
    assert rows(o.where("doc_id in (1, 2)"), "doc_id", "author_id") == [(1, 42), (2, 5)]
    ch = spark.createDataFrame([(1, 7), (77, 1)], "doc_id long, author_id long")
    new, n = rs.update_attributes(idx.docs, ch, ["author_id"])
    assert n.first()["updated"] == 1
    assert rows(new.where("doc_id = 1"), "author_id") == [(7,)]
    s = rs.select_list(hits, "doc_id, weight * 2 AS w2, concat('d', doc_id) AS k")
    assert s.columns == ["doc_id", "w2", "k"]


def test_search_fold_and_many_indexes(spark, idx):
    q = ix.queries_from_terms(spark, [(1, 0, "the")])
    r = search(idx, q, SearchSpec(limit=2, max_matches=3))
    assert r.hits.count() == 2
    assert rows(r.totals, "total_found", "total") == [(4, 3)]
    g = search(idx, q, SearchSpec(group_func="attr", group_by="source", group_sort="@count desc"))
    assert rows(g.hits, "group", "count")[0] == ("b1", 2)
    reg = IndexRegistry()
    reg.declare(idx)
    with pytest.raises(KeyError):
        reg.resolve("t, nope")
    u = search_indexes(reg.resolve(["t"]), q, "all", "wordcount", {"t": 3})
    assert u.where("doc_id = 1").first()["weight"] == 3 * 3.0


def test_links(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    other = spark.createDataFrame([(1, "R"), (1, "A"), (2, "R")], "k long, flag string")
    assert rows(lk.count_column(docs, other, "k", "n", where=F.col("flag") == "R")) == [(1, 1), (2, 1), (3, 0)]
    link = spark.createDataFrame([(1, 5), (1, 2), (1, 5), (3, 9)], "k long, v long")
    m = rows(lk.mva_attach(docs, link, ("k", "v"), "vals"))
    assert m == [(1, [2, 5]), (2, []), (3, [9])]
    c = spark.createDataFrame([(1, 10, 1, "ann"), (2, 10, 2, "bob"), (3, 10, 3, "ann"), (4, 10, 4, None)],
                              "comment_id long, entry_id long, created_on long, commenter_id string")
    assert rows(lk.response_to(c)) == [(2, "ann"), (3, "ann"), (3, "bob"), (4, "ann"), (4, "bob")]


def test_scan_delta_cap(spark, docs):
    spec = IndexSpec(name="e", id_col="doc_id", fields=("title",), uint_attrs=("author_id",),
                     select_values=(("lang", "en"),))
    assert sc.scan_source(docs, spec).columns == ["doc_id", "title", "author_id"]
    assert sc.scan_source(docs, spec).count() == 5
    d = sc.delta_source(docs, "created_on", "2024-01-07 00:00:00", hours=36)
    assert rows(d, "doc_id") == [(5,), (6,)]
    blogs = spark.createDataFrame([(1,)] * 5, "blog_id long")
    assert sc.max_matches_estimate(blogs).first()[0] == 1000
    big = spark.range(1500).select(F.lit(1).alias("blog_id"))
    assert sc.max_matches_estimate(big).first()[0] == 2250
    s = sc.select_columns(docs, "doc_id", include=["lang"], exclude=["lang"])
    assert s.columns == ["doc_id", "lang"]
    crc = sc.string_attr_crc(spark.createDataFrame([("abc",), ("",), ("0",)], "s string"), "s")
    import zlib
    assert [r["s_crc32"] for r in crc.collect()] == [zlib.crc32(b"abc"), None, None]


def test_docset_and_index_round_trip(spark, idx):
    path = scratch_path(spark, "t-docset")
    src = spark.createDataFrame([(1, "a <b>", [3, 1]), (2, "z", [])], "doc_id long, title string, tag array<long>")
    ds.write_docset(src, path)
    back = ds.read_docset(spark, path, src.schema, ("tag",))
    assert rows(back) == [(1, "a <b>", [1, 3]), (2, "z", [])]
    ipath = scratch_path(spark, "t-index")
    io.write_index(idx, ipath)
    stored = io.read_index(spark, ipath)
    assert rows(stored.postings, "term", "doc_id", "field", "pos") == rows(idx.postings, "term", "doc_id", "field", "pos")
    q = ix.queries_from_terms(spark, [(1, 0, "the"), (1, 1, "fox")])
    assert rows(mt.match_all(stored, q)) == rows(mt.match_all(idx, q))


@pytest.mark.parametrize("ranker", ["bm25", "wordcount", "proximity_bm25"])
def test_search_any_mode_equals_ranked_match_any(spark, idx, ranker):
    # search() ranks the any-word set straight from the scores; the page and totals must equal
    # ranking match_any's pairs explicitly
    from quarry.operators import order as od
    from quarry.operators import rank as rk

    q = ix.queries_from_terms(spark, [(1, 0, "the"), (1, 1, "fox"), (2, 0, "sea"), (2, 1, "dog")])
    spec = SearchSpec(mode="any", ranker=ranker, limit=3)
    r = search(idx, q, spec)
    eff = "matchany" if ranker == "proximity_bm25" else ranker
    h = rk.rank(idx, q, mt.match_any(idx, q), eff).join(idx.docs, "doc_id")
    want = od.top_per_query(h, od.sort_keys("relevance"), 0, 3)
    cols = ("query_id", "doc_id", "weight", "rank")
    assert rows(r.hits, *cols) == rows(want, *cols)
    assert rows(r.totals, "query_id", "total_found") == rows(od.result_totals(h, spec.max_matches),
                                                            "query_id", "total_found")


def test_excerpts_of_empty_texts_and_whole_words_at_the_limit(spark):
    t = spark.createDataFrame([(1, ""), (2, "..."), (3, None), (4, "of the sea"), (5, "x " * 40 + "of the end")],
                              "doc_id long, body string")
    got = {r["doc_id"]: r["excerpt"] for r in rs.build_excerpts(t, "body", ["the"], around=1).collect()}
    assert got == {1: None, 2: None, 3: None, 4: "of <b>the</b> sea", 5: "of <b>the</b> end"}
    cut = {r["doc_id"]: r["excerpt"] for r in rs.build_excerpts(t, "body", ["the"], around=1, limit=8).collect()}
    assert cut[4] == "of" and cut[5] == "of"  # never through a mark
    assert rs.build_excerpts(t, "body", ["of", "the"], exact_phrase=True).count() == 5
    kwic = rs.excerpt_kwic(t.select("doc_id"), t, ["of", "the"], ["body"]).select("doc_id", "excerpt").collect()
    assert {r["doc_id"]: r["excerpt"] for r in kwic}[1] == ""


def test_result_index_is_never_cut(spark):
    hits = spark.range(10050).selectExpr("1 AS query_id", "id AS doc_id", "cast(-id AS double) AS weight")
    got = rs.hydrate(hits, spark.range(10050), "id").where("doc_id IN (7, 9999, 10000, 10049)")
    assert rows(got, "doc_id", "result_index") == [(7, "0007"), (9999, "9999"), (10000, "10000"), (10049, "10049")]


def test_repeated_changes_update_once(spark):
    docs = spark.createDataFrame([(1, 1), (2, 2)], "doc_id long, author_id long")
    new, n = rs.update_attributes(docs, spark.createDataFrame([(1, 7), (1, 9), (5, 1)], "doc_id long, author_id long"), ["author_id"])
    assert rows(new, "doc_id", "author_id") == [(1, 9), (2, 2)] and n.first()["updated"] == 1
    over = rs.override_attr(docs, "author_id", spark.createDataFrame([(2, 4), (2, 3)], "doc_id long, value long"))
    assert rows(over, "doc_id", "author_id") == [(1, 1), (2, 4)]


def test_attribute_words_survive_a_missing_array(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, [4, 5], None)], "doc_id long, tag array<int>, lang string")
    got = rows(ix.attr_tokens(docs, "entry", ["tag", "lang"]), "doc_id", "term")
    assert got == [(1, "entry_lang_en"), (2, "entry_tag_4"), (2, "entry_tag_5")]


def test_search_settings(spark, docs):
    from quarry.plans.search import hydrate_indexes, search
    from quarry.spec import Filter, SearchSpec

    idx = ix.build_index("entry", docs, ("title", "body"), "doc_id", attrs=["lang", "author_id", "created_on"])
    idx = idx.with_docs(idx.docs.withColumn("authored_on", F.col("created_on")))
    q = ix.queries_from_terms(spark, [(1, 0, "fox")])
    base = SearchSpec(ranker="wordcount")
    heavy = search(idx, q, base.with_(index_weights=(("entry", 7),)))
    assert {r["doc_id"]: r["weight"] for r in heavy.hits.collect()} == {1: 7.0, 6: 28.0}
    first = search(idx, q, base.with_(sort_mode="attr_desc")).hits.orderBy("rank").select("doc_id").collect()
    assert [r["doc_id"] for r in first] == [6, 1]  # authored_on by default
    expr = search(idx, q, base.with_(sort_mode="expr", sort_by="0 - @weight", select="@id as i, @weight * 2 as w"))
    assert {(r["i"], r["w"]) for r in expr.hits.collect()} == {(1, 2.0), (6, 8.0)}
    assert search(idx, q, base.with_(max_matches=-1, limit=1)).totals.first()["total"] == 2
    assert search(idx, q, base.with_(filters=(Filter("range", "@weight", lo=2, hi=9),))).hits.count() == 1
    tags = spark.createDataFrame([(3, "rain", None, False)], "id long, name string, n8d_id long, is_private boolean")
    tagged = search(idx, q, base.with_(tags=(tags, "rain", "author_id"))).hits
    assert {r["doc_id"] for r in tagged.collect()} == {1, 3}  # the tag list replaced the search words
    stems = ix.build_index("s", docs, ("body",), "doc_id", attrs=["lang"], morphology="stem_en")
    assert {r["doc_id"] for r in search(stems, ix.queries_from_terms(spark, [(1, 0, "jumping")]), base).hits.collect()} == {1}
    other = ix.build_index("other", docs.where("doc_id IN (1, 2)"), ("body",), "doc_id", attrs=["lang"])
    both = search({"entry": idx, "other": other}, q, base.with_(index_weights=(("other", 5),)))
    got = {r["doc_id"]: (r["index_name"], r["weight"]) for r in both.hits.collect()}
    assert got == {1: ("other", 5.0), 6: ("entry", 4.0)}
    full = hydrate_indexes(both.hits, {"entry": docs.select("doc_id", F.lit("E").alias("kind")),
                                       "other": docs.select("doc_id", F.lit("O").alias("kind"))}, "doc_id")
    assert rows(full, "doc_id", "kind", "result_index") == [(1, "O", "0000"), (6, "E", "0001")]


def test_audited_sources_and_indexed_tag_attributes(spark):
    from quarry.spec import IndexSpec

    src = spark.createDataFrame([(1, 9, "2024-01-01 00:00:00", "2024-01-02 00:00:00")],
                                "id long, blog_id int, created_on string, modified_on string")
    spec = IndexSpec("entry", audit=True)
    got = sc.build_attributes(src.selectExpr("id", "blog_id", "timestamp(created_on) created_on", "timestamp(modified_on) modified_on"), spec)
    assert got.columns == ["doc_id", "blog_id", "created_on", "modified_on"] and spec.change_column == "modified_on"
    page = spark.createDataFrame([(1, '<p>text</p><img src="x" alt="a cat"><a title="link words" href="y">z</a>')], "doc_id long, html string")
    index = ix.build_index("p", page, ("html",), "doc_id", strip_html=("html",), html_attrs=ix.HTML_INDEX_ATTRS)
    assert [r["term"] for r in index.postings.orderBy("pos").collect()] == ["text", "z", "a", "cat", "link", "words"]


def test_hydrate_of_whole_tables_numbers_like_the_window(spark):
    """Ties, a null query, one hot query and empty input, over many partitions and without a window over a query."""
    hits = spark.range(0, 3000, numPartitions=7).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 < 9 THEN 1 ELSE id % 3 + 2 END AS query_id", "id AS doc_id", "id % 17 AS weight")
    table = spark.range(0, 2990).selectExpr("id", "id * 2 AS v")
    cols = ("query_id", "doc_id", "weight", "v", "result_index")
    key = lambda df: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    got = rs.hydrate(hits, table, whole=True)
    assert key(got) == key(rs.hydrate(hits, table))
    assert got.columns == rs.hydrate(hits, table).columns
    assert rs.hydrate(hits.limit(0), table, whole=True).count() == 0
    assert "row_number" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_excerpts_of_a_text_full_of_hits_are_linear(spark):
    import time

    took = {}
    for n in (20_000, 20_000, 100_000):
        t = spark.createDataFrame([(1, "x y " * n)], "doc_id long, body string")
        start = time.time()
        e = rs.build_excerpts(t, "body", ["x"], around=2, limit=10**9).first()["excerpt"]
        took[n] = time.time() - start
        assert e.count("x") == n and e.count("y") == n
    assert took[100_000] < 10 * max(took[20_000], 1.0)


def test_passages_stay_within_a_sentence(spark):
    t = spark.createDataFrame([(1, "a b x. c d e\n\nf x g? h x"), (2, "one of. the end"), (3, None), (4, "pi is 3.14 x"), (5, "")],
                              "doc_id long, body string")
    got = {r["doc_id"]: r["excerpt"] for r in rs.build_excerpts(t, "body", ["x"], around=2, use_boundaries=True).collect()}
    assert got == {1: "a b <b>x</b> ... f <b>x</b> g ... h <b>x</b>", 2: None, 3: None, 4: "3 14 <b>x</b>", 5: None}
    both = rs.build_excerpts(t, "body", ["of", "the"], exact_phrase=True, use_boundaries=True).where("doc_id = 2").first()
    assert both["excerpt"] is None  # a phrase does not cross the end of a sentence
    best = rs.build_excerpts(t, "body", ["x"], around=2, use_boundaries=True, single_passage=True).where("doc_id = 1").first()
    assert best["excerpt"] == "a b <b>x</b>"


def test_sql_functions_follow_the_rankers(spark, idx):
    from quarry.operators import index as ix
    from quarry.operators import match as mt
    from quarry.operators import rank as rk
    from quarry.plans.surface import register_sql

    register_sql(spark, idx)
    q = ix.queries_from_terms(spark, [(1, 0, "of"), (1, 1, "the")])
    for ranker in ("bm25", "proximity", "proximity_bm25"):
        asked = spark.sql(f"SELECT doc_id, weight FROM t_rank_{ranker}(array('of', 'the'))").collect()
        want = rk.rank(idx, q, None, ranker).collect()
        assert {r["doc_id"]: float(r["weight"]) for r in asked} == {r["doc_id"]: r["weight"] for r in want}
    near = spark.sql("SELECT doc_id FROM t_near(array('of', 'the'), 3)").collect()
    assert sorted(r["doc_id"] for r in near) == sorted(r["doc_id"] for r in mt.match_near(idx, q, 3).collect())
    some = spark.sql("SELECT doc_id FROM t_match_boolean(array('the'), array('cat', 'sea'), array('dog'))").collect()
    assert sorted(r["doc_id"] for r in some) == [2]


def test_sql_near_does_not_grow_with_the_span(spark):
    """an occurrence is one value, not one row per window; ids repeat and are null."""
    import random

    from quarry.operators.index import build_index
    from quarry.plans.surface import register_sql

    rnd = random.Random(3)
    texts = [(None if i % 10 == 9 else i % 35, " ".join(rnd.choices("a b c x y z of the".split(), k=rnd.randrange(12)))) for i in range(60)]
    register_sql(spark, build_index("w", spark.createDataFrame(texts, "doc_id long, body string"), ("body",), "doc_id"))
    held = {}
    for i, t in texts:
        for p, word in enumerate(t.split()):
            held.setdefault(i, {}).setdefault(word, set()).add(p)

    def plain(asked, w):
        ends = lambda h: sorted({p for x in asked for p in h.get(x, ())})
        return {i for i, h in held.items() if any(all(any(e - w < p <= e for p in h.get(x, ())) for x in asked) for e in ends(h))}

    for asked, w in ((("a", "b"), 2), (("of", "the", "of", "x"), 4), (("a", "b", "c"), 2_000_000_000)):
        got = [r["doc_id"] for r in spark.sql(f"SELECT doc_id FROM w_near(array{asked}, {w})").collect()]
        assert len(got) == len(set(got)) and set(got) == plain(asked, w)
