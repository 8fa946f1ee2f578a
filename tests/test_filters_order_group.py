import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import filters as fl
from quarry.operators import group as gr
from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.operators import order as od
from quarry.operators import rank as rk
from quarry.plans.search import search
from quarry.spec import Filter, SearchSpec


@pytest.fixture(scope="module")
def hits(idx):
    return idx.docs.select(F.lit(1).cast("int").alias("query_id"), F.lit(1.0).alias("weight"), "*") \
        .withColumn("tags", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(3))))


def ids(df):
    return [r[0] for r in rows(df, "doc_id")]


def test_values_exclude_null_and_mva(hits):
    assert ids(fl.filter_values(hits, "author_id", [3, 5])) == [1, 2, 3, 5]
    # NULL matches no filter, included or excluded
    assert ids(fl.filter_values(hits, "author_id", [3, 5], exclude=True)) == [4]
    assert ids(fl.filter_values(hits, "author_id", [])) == [1, 2, 3, 4, 5, 6]
    assert ids(fl.filter_values(hits, "tags", [2])) == [2, 4, 6]
    assert ids(fl.filter_values(hits, "tags", [2], exclude=True)) == [1, 3, 5]


def test_ranges(hits):
    assert ids(fl.filter_range(hits, "author_id", 4, 7)) == [2, 4, 5]
    assert ids(fl.filter_range(hits, "author_id", 4, 7, exclude=True)) == [1, 3]
    assert ids(fl.filter_range(hits, "tags", 3, 3)) == [1, 3, 5]
    assert ids(fl.filter_id_range(hits, 2, 3)) == [2, 3]
    with pytest.raises(ValueError):
        fl.filter_range(hits, "author_id", 5, 4)
    assert ids(fl.filter_float_range(hits, "weight", 0.5, 1.5)) == [1, 2, 3, 4, 5, 6]


def test_string_dates_geo(hits):
    assert ids(fl.filter_string(hits, "lang", ["ru"])) == [4]
    assert ids(fl.filter_string(hits, "lang", ["ru"], crc=True)) == [4]
    assert ids(fl.filter_date_range(hits, "2024010212", "2024010600")) == [3, 4, 5]
    assert ids(fl.filter_date_range(hits, None, "2024010200")) == [1, 2]
    assert ids(fl.filter_date_range(hits, None, None)) == [1, 2, 3, 4, 5, 6]
    d = hits.select(fl.geo_distance(F.lit(0.0), F.lit(0.0), 0.0, 0.001).alias("d")).first()["d"]
    assert d == pytest.approx(6371000.0 * 0.001, rel=1e-9)


def test_lookups(spark, hits):
    authors = spark.createDataFrame([(3, "Bob D"), (5, "Ann")], "id long, name string")
    assert ids(fl.filter_author(hits, authors, "Bob D")) == [1, 3]
    with pytest.raises(fl.LookupError_):
        fl.filter_author(hits, authors, "Nobody")
    tags = spark.createDataFrame([(1, "rain", None, False), (2, "Rain", 1, False), (3, "sun", None, False)],
                                 "id long, name string, n8d_id long, is_private boolean")
    # 'rain' finds tag 1, widened to tag 2 (same normalized id)
    assert rows(fl.tag_ids_for(tags, "rain")) == [(1,), (2,)]
    assert ids(fl.filter_tags(hits, tags, "sun", attr="tags")) == [1, 3, 5]
    assert ids(fl.filter_tags(hits, tags, "nothing", attr="tags")) == []
    cats = spark.createDataFrame([(1, 1, "foo", "Foo"), (3, 1, "subfoo", "Sub")], "id long, blog_id long, basename string, label string")
    assert ids(fl.filter_category(hits, cats, "subfoo, unknown", attr="tags")) == [1, 3, 5]
    fol = spark.createDataFrame([(9, 5)], "follower_id long, followee_id long")
    assert ids(fl.filter_following(hits, fol, 9)) == [2, 5]
    assert ids(fl.filter_following(hits, fol, 1)) == []


def test_text_filter_equals_attribute_filter(spark, docs):
    extra = ix.attr_tokens(docs.withColumnRenamed("doc_id", "doc_id"), "t", ["lang", "source"])
    idx = ix.build_index("t", docs, ("title", "body"), "doc_id", attrs=["lang", "source", "author_id"],
                         extra_postings=extra)
    q = ix.queries_from_terms(spark, [(1, 0, "the")])
    for flt in [(Filter("values", "lang", ("en",)),),
                (Filter("values", "lang", ("en",)), Filter("values", "source", ("b1", "b3")))]:
        spec = SearchSpec(mode="all", ranker="none", filters=flt, limit=100)
        base = rows(search(idx, q, spec, text_filter_level=0).matches, "doc_id")
        for level in (1, 2):
            assert rows(search(idx, q, spec, text_filter_level=level).matches, "doc_id") == base


def test_limits_and_pages(spark):
    assert od.limits(0, 20, 1000, page=3) == (40, 20, 1000)
    assert od.limits(990, 20, 1000) == (990, 20, 1030)
    t = spark.createDataFrame([(1, 51)], "query_id int, total_found long")
    p = rows(od.page_table(t, 25), "page", "offset", "rows", "prev_page", "next_page")
    assert p == [(1, 0, 25, 0, 2), (2, 25, 25, 1, 3), (3, 50, 1, 2, 0)]
    assert rows(od.page_table(t, 25, current=2, lastn=0), "page")[-1] == (3,)
    assert rows(od.page_table(t, 25, current=1, lastn=1), "page") == [(1,), (2,)]


def test_sorts_top_cutoff_totals(hits):
    top = od.top_per_query(hits, od.sort_keys("attr_desc", "created_on"), 1, 2)
    assert rows(top, "rank", "doc_id") == [(2, 5), (3, 4)]
    seg = od.top_per_query(hits, od.sort_keys("time_segments", "created_on", "2024-01-07 00:00:00"), 0, 6)
    assert [r["doc_id"] for r in seg.orderBy("rank").collect()] == [6, 1, 2, 3, 4, 5]  # 6 in the last day; the rest in the last week
    ext = od.top_per_query(hits, od.sort_keys("extended", "source desc, @id asc"), 0, 3)
    assert [r["doc_id"] for r in ext.orderBy("rank").collect()] == [5, 6, 3]
    ex = od.top_per_query(hits, od.sort_keys("expr", "doc_id % 3"), 0, 2)
    assert [r["doc_id"] for r in ex.orderBy("rank").collect()] == [2, 5]
    assert ids(od.cutoff(hits, 2)) == [1, 2]
    assert rows(od.result_totals(hits, 4), "total_found", "total") == [(6, 4)]


def test_group_best_count_and_invariant(spark, idx):
    q = ix.queries_from_terms(spark, [(1, 0, "the")])
    h = rk.rank(idx, q, mt.match_all(idx, q), "wordcount").join(idx.docs, "doc_id")
    g = gr.group_by(h, "attr", "source")
    got = rows(g, "group", "count", "doc_id")
    assert got == [("b1", 2, 1), ("b2", 1, 3), ("b3", 1, 6)]
    assert sum(r[1] for r in got) == h.count()  # sum(@count) = total_found for a single-value key
    assert rows(gr.group_totals(h, "attr", "source"), "total_found") == [(3,)]
    gd = gr.group_by(h, "attr", "lang", distinct="source")
    assert rows(gd, "group", "count", "distinct") == [("en", 4, 3)]
    gs = gr.grouped_search(h, "attr", "source", group_sort="@count desc", limit=2)
    assert [r["group"] for r in gs.orderBy("rank").collect()] == ["b1", "b2"]  # count tie -> group ascending


def test_calendar_keys(spark):
    df = spark.createDataFrame([("2024-01-03 10:00:00",), ("2024-12-31 00:00:00",)], "t string") \
        .select(F.to_timestamp("t").alias("t"))
    got = df.select(*[gr.group_key(f, "t").alias(f) for f in ("day", "week", "month", "year")]).collect()
    assert tuple(got[0]) == (20240103, 2023365, 202401, 2024)  # week starts Sunday 2023-12-31
    assert tuple(got[1]) == (20241231, 2024364, 202412, 2024)


def test_group_mva_and_facets(hits):
    g = gr.group_by(hits, "attr", "tags", "attr_asc", "doc_id")
    assert rows(g, "group", "count", "doc_id") == [(1, 3, 2), (2, 3, 2), (3, 3, 1)]
    f = gr.facets(hits, [("lang", "attr", "lang"), ("tags", "attr", "tags")])
    assert rows(f, "facet", "value", "count") == [("lang", "en", 5), ("lang", "ru", 1), ("tags", "1", 3),
                                                  ("tags", "2", 3), ("tags", "3", 3)]


def test_group_order_totals_and_facets_with_nulls(spark):
    rows_ = [(1, 1.0, 1, "a", None, None, "x"), (1, 2.0, 2, "a", 5, [1, 2], "yy"), (1, 3.0, 3, None, 7, [2], "y"),
             (1, 4.0, 4, None, None, None, None)]
    h = spark.createDataFrame(rows_, "query_id int, weight double, doc_id long, lang string, day int, tags array<int>, name string")
    best = {r["group"]: r["doc_id"] for r in gr.group_by(h, "attr", "lang", "attr_desc", "day").collect()}
    assert best == {"a": 2, None: 3}  # a NULL never beats a value when descending
    best = {r["group"]: r["doc_id"] for r in gr.group_by(h, "attr", "lang", "attr_asc", "day").collect()}
    assert best == {"a": 1, None: 4}  # and comes first when ascending, as in the sorts
    best = {r["group"]: r["doc_id"] for r in gr.group_by(h, "attr", "lang", "attr_desc", "name").collect()}
    assert best == {"a": 2, None: 3}  # text in descending order
    assert gr.group_totals(h, "attr", "lang").first()["total_found"] == 2
    pairs = gr.group_by(h, "attrpair", "lang", attr_order=["lang", "day"])
    assert gr.group_totals(h, "attrpair", "lang", ["lang", "day"]).first()["total_found"] == pairs.count() == 4
    got = {(r["facet"], r["value"]): r["count"] for r in gr.facets(h, [("lang", "attr", "lang"), ("tag", "attr", "tags")]).collect()}
    assert got == {("lang", "a"): 2, ("lang", None): 2, ("tag", "1"): 1, ("tag", "2"): 2}


def test_descending_text_keys_are_the_reverse_order(spark):
    words = ["", "a", "ab", "b", "é", "日本", "Z", "aa"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["w"] for r in df.orderBy(gr.ordering_struct(df, [(F.col("w"), False)])).collect()]
    assert got == [r["w"] for r in df.orderBy(F.col("w").desc()).collect()]


def test_limits_special_names_and_default_sort():
    assert od.limits(0, 20, 10) == (0, 20, 40)
    with pytest.raises(ValueError):
        od.limits(0, 20, -1)
    assert od.special_names("@weight * 2 + @id - price") == "weight * 2 + doc_id - price"
    assert [od.default_sort(n) for n in ("entry", "comment,entry", "tag", "comment", "entry_x")] == [
        "authored_on", "authored_on", "entry_count", "created_on", "created_on"]
