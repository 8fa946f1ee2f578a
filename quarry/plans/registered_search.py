"""Registered queries for ``search()`` settings, batches of expressions, long queries and inputs with
missing values. Each has its DuckDB twin; inputs derive from the driver's whole tables."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from quarry.operators import filters as fl
from quarry.operators import group as gr
from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.operators import rank as rk
from quarry.operators import results as rs
from quarry.plans import oracle as o
from quarry.plans import registered as R
from quarry.plans import surface as sfc
from quarry.plans.registered import QV, Q_TERMS, corpus_index, qtable, register
from quarry.plans.search import hydrate_indexes, search
from quarry.sources import standins as st
from quarry.spec import SearchSpec, phrase, term

# ---- fixed values: settings of the queries below ----
PAGE = SearchSpec(ranker="wordcount", limit=20)
BATCH_WORDS = ("of", "the", "and", "tion", "ble", "rer")
MANY_WORDS = ("of", "the", "and", "tion", "ble", "rer", "en", "in", "er", "on", "an", "re")
EXCERPT_LIMIT = 30
# ---- end of fixed values ----

_WC = f"WITH {o.INDEX}, {QV(Q_TERMS)}, {R._wc_sql()}"
_ranked = lambda weight, order: (f"{_WC}, s AS (SELECT query_id, doc_id, {weight} AS weight, author_id, created_on FROM wch), "  # noqa: E731
                                 f"r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank FROM s)")


def _hits(page):
    return page.select("query_id", "doc_id", "weight", F.col("rank").cast("long"))


@register("search_index_weights", f"{_ranked('weight * 7', 'weight DESC, doc_id')} SELECT query_id, doc_id, weight, rank FROM r WHERE rank <= 20")
def q_search_index_weights(spark, sf):
    return _hits(search(corpus_index(spark, sf), qtable(spark, Q_TERMS), PAGE.with_(index_weights=(("entry", 7),))).hits)


@register("search_default_sort", f"{_ranked('weight', 'created_on DESC, doc_id')} SELECT query_id, doc_id, weight, rank FROM r WHERE rank <= 20")
def q_search_default_sort(spark, sf):
    st.prep(spark)
    idx = ix.build_index("comment", st.corpus(spark, sf), ("title", "body"), "doc_id", attrs=["created_on"])
    return _hits(search(idx, qtable(spark, Q_TERMS), PAGE.with_(sort_mode="attr_desc")).hits)


@register("search_special_names", f"{_ranked('weight', 'weight * 2 + author_id DESC, doc_id')} "
          "SELECT query_id, doc_id AS i, weight * 3 AS w FROM r WHERE rank <= 20")
def q_search_special_names(spark, sf):
    spec = PAGE.with_(sort_mode="expr", sort_by="@weight * 2 + author_id", select="@id AS i, @weight * 3 AS w")
    return search(corpus_index(spark, sf), qtable(spark, Q_TERMS), spec).hits


@register("search_released_max", f"""{_WC} SELECT query_id, count(*) AS total_found,
 least(count(*), (SELECT count(*) FROM corpus)) AS total FROM wch GROUP BY query_id""")
def q_search_released_max(spark, sf):
    return search(corpus_index(spark, sf), qtable(spark, Q_TERMS), PAGE.with_(max_matches=-1)).totals


_EVEN = "CASE WHEN doc_id % 2 = 0 THEN weight * 3 ELSE weight END"


@register("search_several_indexes", f"""{_ranked(_EVEN, 'weight DESC, doc_id')}
SELECT query_id, doc_id, weight, rank, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'entry' END AS index_name FROM r WHERE rank <= 20""")
def q_search_several_indexes(spark, sf):
    return _several(spark, sf).select("query_id", "doc_id", "weight", F.col("rank").cast("long"), "index_name")


def _several(spark, sf):
    idx = corpus_index(spark, sf)
    even = ix.build_index("even", st.corpus(spark, sf).where("doc_id % 2 = 0"), ("title", "body"), "doc_id", attrs=["lang"])
    return search({"entry": idx, "even": even}, qtable(spark, Q_TERMS), PAGE.with_(index_weights=(("even", 3),))).hits


@register("hydrate_several_indexes", f"""{_ranked(_EVEN, 'weight DESC, doc_id')}
SELECT r.query_id, r.doc_id, lpad(CAST(rank - 1 AS VARCHAR), 4, '0') AS result_index, d.n_chars,
 CASE WHEN r.doc_id % 2 = 0 THEN d.source END AS source FROM r JOIN documents d USING (doc_id) WHERE rank <= 20""")
def q_hydrate_several_indexes(spark, sf):
    docs = st.table(spark, sf, "documents")
    page = _several(spark, sf).select("query_id", "doc_id", "weight", "index_name")
    full = hydrate_indexes(page, {"entry": docs.select("doc_id", "n_chars"), "even": docs.select("doc_id", "n_chars", "source")}, "doc_id")
    return full.select("query_id", "doc_id", "result_index", "n_chars", "source")


_PAIRS = list(permutations(BATCH_WORDS, 2))


@register("match_boolean_batch", f"""WITH {o.INDEX}, t AS (SELECT DISTINCT term, doc_id FROM postings WHERE term IN {BATCH_WORDS}),
e AS {o.values_sql([(i, a, b) for i, (a, b) in enumerate(_PAIRS)], 'query_id, a, b')},
ph AS (SELECT doc_id, field, term, pos FROM postings WHERE term IN ('of', 'the'))
SELECT query_id, t.doc_id FROM e JOIN t ON t.term = a LEFT JOIN t u ON u.term = b AND u.doc_id = t.doc_id WHERE u.doc_id IS NULL
UNION ALL SELECT {len(_PAIRS)}, doc_id FROM (SELECT DISTINCT a.doc_id FROM ph a JOIN ph b ON a.doc_id = b.doc_id
 AND a.field = b.field AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the')""")
def q_match_boolean_batch(spark, sf):
    exprs = {i: term(a) & ~term(b) for i, (a, b) in enumerate(_PAIRS)}
    return mt.match_boolean(corpus_index(spark, sf), exprs | {len(_PAIRS): phrase("of", "the")})


_TRIPLES = list(permutations(MANY_WORDS, 3))[:1000]


@register("match_boolean_thousand", f"""WITH {o.INDEX}, t AS (SELECT DISTINCT term, doc_id FROM postings WHERE term IN {MANY_WORDS}),
e AS {o.values_sql([(i, *w) for i, w in enumerate(_TRIPLES)], 'query_id, a, b, c')}
SELECT query_id, x.doc_id FROM e JOIN t x ON x.term = a JOIN t y ON y.term = b AND y.doc_id = x.doc_id
LEFT JOIN t z ON z.term = c AND z.doc_id = x.doc_id WHERE query_id % 2 = 0 AND z.doc_id IS NULL
UNION ALL SELECT query_id, x.doc_id FROM e JOIN t x ON x.term = a LEFT JOIN t y ON y.term = b AND y.doc_id = x.doc_id
LEFT JOIN t z ON z.term = c AND z.doc_id = x.doc_id WHERE query_id % 2 = 1 AND (y.doc_id IS NOT NULL OR z.doc_id IS NULL)""")
def q_match_boolean_thousand(spark, sf):
    """A thousand expressions at once: a and b but not c, or a with b or without c."""
    exprs = {i: (term(a) & term(b) & ~term(c)) if i % 2 == 0 else (term(a) & (term(b) | ~term(c)))
             for i, (a, b, c) in enumerate(_TRIPLES)}
    return mt.match_boolean(corpus_index(spark, sf), exprs)


@register("match_standing", f"""WITH {o.INDEX}, q AS (SELECT DISTINCT CAST(doc_id AS INTEGER) AS query_id, unnest(list_slice(t, 1, 4)) AS term
  FROM toks WHERE field = 'title'),
t AS (SELECT DISTINCT doc_id, unnest(t) AS term FROM toks), n AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id)
SELECT query_id, doc_id FROM q JOIN t USING (term) JOIN n USING (query_id) GROUP BY query_id, doc_id, n HAVING count(*) = n""")
def q_match_standing(spark, sf):
    """Every title's first four words as a standing query, against the whole corpus."""
    st.prep(spark)
    q = ix.queries_from_column(st.corpus(spark, sf), "doc_id", "title").where("qpos < 4")
    idx = corpus_index(spark, sf)
    return mt.match_standing(idx.lists_for(q), q, idx)


@register("rank_long_query", f"""WITH {o.INDEX},
qv AS (SELECT 1 AS query_id, pos AS qpos, term FROM postings WHERE doc_id = 0 AND field = 'body'), {o.lcs_ctes()},
nq AS (SELECT count(DISTINCT term) AS n FROM qv)
SELECT query_id, doc_id, CAST(sum(lcs * nq.n + n_words) AS DOUBLE) AS weight FROM pf, nq GROUP BY query_id, doc_id""")
def q_rank_long_query(spark, sf):
    """Every word of document 0 as one query (hundreds of positions), ranked by run length and distinct words."""
    body = st.table(spark, sf, "documents").where("doc_id = 0").select(F.lit(1).alias("query_id"), "text")
    return rk.rank(corpus_index(spark, sf), ix.queries_from_column(body, "query_id", "text"), None, "matchany")


@register("hydrate_all", """WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS n FROM orders)
SELECT o_orderkey AS doc_id, CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS result_index FROM r""")
def q_hydrate_all(spark, sf):
    """Running numbers past 9999 keep all their digits."""
    orders = st.table(spark, sf, "orders")
    hits = orders.select(F.lit(1).alias("query_id"), F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("weight"))
    return rs.hydrate(hits, orders.select(F.col("o_orderkey").alias("doc_id"), "o_orderstatus"), "doc_id", whole=True).select("doc_id", "result_index")


@register("build_excerpts_limit", R._excerpt_sql(["of", "the"], limit=EXCERPT_LIMIT))
def q_build_excerpts_limit(spark, sf):
    """A limit that falls inside marks."""
    st.prep(spark)
    return rs.build_excerpts(st.corpus(spark, sf), "body", ["of", "the"], limit=EXCERPT_LIMIT)


@register("build_excerpts_boundaries", R._excerpt_sql(["of", "the"], boundary=rs.SENTENCE_END))
def q_build_excerpts_boundaries(spark, sf):
    """Passages stay within a sentence or paragraph."""
    st.prep(spark)
    return rs.build_excerpts(st.corpus(spark, sf), "body", ["of", "the"], use_boundaries=True)


@register("build_excerpts_phrase_boundaries", R._excerpt_sql(["of", "the"], exact_phrase=True, around=3, boundary=rs.SENTENCE_END))
def q_build_excerpts_phrase_boundaries(spark, sf):
    st.prep(spark)
    return rs.build_excerpts(st.corpus(spark, sf), "body", ["of", "the"], exact_phrase=True, around=3, use_boundaries=True)


@register("build_excerpts_empty", f"""WITH e AS ({R._excerpt_sql(['tion'])})
SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN excerpt END AS excerpt FROM e""")
def q_build_excerpts_empty(spark, sf):
    """Every seventh text is empty."""
    st.prep(spark)
    texts = st.corpus(spark, sf).withColumn("body", F.when(F.col("doc_id") % 7 != 0, F.col("body")).otherwise(F.lit("")))
    return rs.build_excerpts(texts, "body", ["tion"])


@register("search_tag_mode", f"""WITH {o.CORPUS}, tg AS (SELECT p_partkey AS id FROM part
  WHERE p_name IN ({", ".join(repr(n) for n in R._tag_names())})
     OR regexp_replace(lower(p_name), '[^a-z0-9_]', '', 'g') IN ({", ".join(repr(fl.normalize_tag(n)) for n in R._tag_names())})),
h AS (SELECT doc_id, CAST(created_on AS TIMESTAMP) AS created_on FROM corpus WHERE doc_id IN (SELECT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT id FROM tg)))
SELECT 1 AS query_id, doc_id, row_number() OVER (ORDER BY created_on DESC, doc_id) AS rank, (SELECT count(*) FROM h) AS total_found
FROM h QUALIFY row_number() OVER (ORDER BY created_on DESC, doc_id) <= 50""")
def q_search_tag_mode(spark, sf):
    """The tag list replaces the search words: a document's tags are the parts of the order of its number."""
    st.prep(spark)
    tags = (st.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"))
            .agg(F.collect_set("l_partkey").alias("tag")))
    docs = st.corpus(spark, sf).join(tags, "doc_id", "left")
    idx = ix.build_index("entry", docs, ("title", "body"), "doc_id", attrs=["created_on", "tag"])
    found = search(idx, qtable(spark, Q_TERMS), SearchSpec(
        tags=(st.tags(spark, sf), R.TAG_NAMES, "tag"), sort_mode="attr_desc", sort_by="created_on", limit=50))
    return found.hits.join(found.totals, "query_id").select("query_id", "doc_id", F.col("rank").cast("long"), "total_found")


_HOLES = (f"{R.ENTRIES_SQL}, h AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN tag END AS tag, "
          "CASE WHEN doc_id % 4 <> 0 THEN o_orderstatus END AS status, CASE WHEN doc_id % 5 <> 0 THEN o_totalprice END AS price, "
          "author_id % 5 AS blog FROM entries)")


def _holes(spark, sf):
    """Entries with missing arrays, texts and numbers."""
    e = R.entry_hits(spark, sf)
    keep = lambda n, c: F.when(F.col("doc_id") % n != 0, F.col(c))
    return e.select("query_id", "weight", "doc_id", keep(3, "tag").alias("tag"), keep(4, "o_orderstatus").alias("status"),
                    keep(5, "o_totalprice").alias("price"), (F.col("author_id") % 5).alias("blog"))


@register("facets_missing_values", f"""WITH {_HOLES}
SELECT 1 AS query_id, 'tag' AS facet, CAST(t AS VARCHAR) AS value, count(*) AS count FROM (SELECT unnest(tag) AS t FROM h) GROUP BY ALL
UNION ALL SELECT 1, 'status', status, count(*) FROM h GROUP BY ALL""")
def q_facets_missing_values(spark, sf):
    return gr.facets(_holes(spark, sf), [("tag", "attr", "tag"), ("status", "attr", "status")])


@register("group_missing_values", f"""WITH {_HOLES}, g AS (SELECT *, count(*) OVER (PARTITION BY status) AS count,
 row_number() OVER (PARTITION BY status ORDER BY price DESC NULLS LAST, doc_id) AS rn FROM h)
SELECT 1 AS query_id, status AS "group", count, doc_id FROM g WHERE rn = 1""")
def q_group_missing_values(spark, sf):
    return gr.group_by(_holes(spark, sf), "attr", "status", "attr_desc", "price").select("query_id", "group", "count", "doc_id")


@register("group_by_text_order", f"""WITH {_HOLES}, g AS (SELECT *, row_number() OVER (PARTITION BY blog ORDER BY status DESC NULLS LAST, doc_id) AS rn FROM h)
SELECT 1 AS query_id, blog AS "group", status, doc_id FROM g WHERE rn = 1""")
def q_group_by_text_order(spark, sf):
    return gr.group_by(_holes(spark, sf), "attr", "blog", "attr_desc", "status").select("query_id", "group", "status", "doc_id")


@register("group_total_pairs", f"""WITH {_HOLES} SELECT 1 AS query_id, count(*) AS total_found FROM (SELECT DISTINCT status, blog FROM h)""")
def q_group_total_pairs(spark, sf):
    return gr.group_totals(_holes(spark, sf), "attrpair", "status", ["status", "blog"])


@register("attr_tokens_missing_values", f"""WITH {_HOLES}
SELECT doc_id, 'entry_tag_' || CAST(t AS VARCHAR) AS term FROM (SELECT doc_id, unnest(tag) AS t FROM h)
UNION ALL SELECT doc_id, lower('entry_status_' || status) FROM h WHERE status IS NOT NULL""")
def q_attr_tokens_missing_values(spark, sf):
    return ix.attr_tokens(_holes(spark, sf), "entry", ["tag", "status"]).select("doc_id", "term")


@register("update_attributes_repeated", f"""WITH {o.CORPUS}, c AS (SELECT doc_id % 50 AS doc_id, max(quality * 100 + toxic + doc_id) AS v FROM labels GROUP BY ALL)
SELECT corpus.doc_id, CAST(coalesce(v, author_id) AS BIGINT) AS author_id FROM corpus LEFT JOIN c USING (doc_id)""")
def q_update_attributes_repeated(spark, sf):
    st.prep(spark)
    changes = st.table(spark, sf, "labels").select((F.col("doc_id") % 50).alias("doc_id"), (
        F.col("quality") * 100 + F.col("toxic") + F.col("doc_id")).alias("author_id"))
    return rs.update_attributes(st.corpus(spark, sf).select("doc_id", "author_id"), changes, ["author_id"])[0]


@register("sql_surface_words", f"""WITH {o.INDEX}, {R._PHRASE_OF_THE},
ma AS (SELECT doc_id FROM postings WHERE term IN ('of', 'the', 'and') GROUP BY doc_id HAVING count(DISTINCT term) = 3),
wc AS (SELECT doc_id, count(*) AS weight FROM postings WHERE term IN ('of', 'the', 'and') GROUP BY doc_id)
SELECT doc_id, weight, doc_id IN (SELECT doc_id FROM ph) AS is_phrase FROM ma JOIN wc USING (doc_id) JOIN corpus c USING (doc_id) WHERE c.lang = 'en'""")
def q_sql_surface_words(spark, sf):
    sfc.register_sql(spark, corpus_index(spark, sf))
    return spark.sql("""SELECT m.doc_id, r.weight, m.doc_id IN (SELECT doc_id FROM entry_phrase(array('of', 'the'))) AS is_phrase
        FROM entry_match_all(array('of', 'the', 'and')) m JOIN entry_rank_wordcount(array('of', 'the', 'and')) r ON r.doc_id = m.doc_id
        JOIN entry_docs d ON d.doc_id = m.doc_id WHERE d.lang = 'en'""")


_SQL_WORDS = [(1, 0, "of"), (1, 1, "the"), (1, 2, "and")]


@register("sql_surface_rankers", f"""WITH {o.INDEX}, {QV(_SQL_WORDS)}, {o.bm25_ctes()}, {o.lcs_ctes()},
px AS (SELECT doc_id, sum(lcs) AS px FROM pf GROUP BY doc_id)
SELECT bm.doc_id, round(bm25, 6) AS bm25, CAST(px AS BIGINT) AS proximity,
 CAST(px * 1000 + floor(999 * round(bm25 / (2.2::DOUBLE * sum_idf), 6)) AS BIGINT) AS both_ways
FROM bm JOIN px USING (doc_id) JOIN sidf USING (query_id)""")
def q_sql_surface_rankers(spark, sf):
    sfc.register_sql(spark, corpus_index(spark, sf))
    return spark.sql("""SELECT b.doc_id, b.weight AS bm25, p.weight AS proximity, x.weight AS both_ways
        FROM entry_rank_bm25(array('of', 'the', 'and')) b JOIN entry_rank_proximity(array('of', 'the', 'and')) p ON p.doc_id = b.doc_id
        JOIN entry_rank_proximity_bm25(array('of', 'the', 'and')) x ON x.doc_id = b.doc_id""")


@register("sql_surface_matchers", f"""WITH {o.INDEX}, t AS (SELECT doc_id, term FROM postings WHERE term IN {BATCH_WORDS} GROUP BY ALL),
b AS (SELECT doc_id FROM t GROUP BY doc_id HAVING count(*) FILTER (WHERE term IN ('of', 'the')) = 2
  AND count(*) FILTER (WHERE term IN ('tion', 'ble')) > 0 AND count(*) FILTER (WHERE term = 'rer') = 0),
n AS (SELECT DISTINCT x.doc_id FROM postings x JOIN postings y ON y.doc_id = x.doc_id AND y.field = x.field AND abs(y.pos - x.pos) < 5
  WHERE x.term = 'of' AND y.term = 'the')
SELECT 'boolean' AS part, doc_id FROM b UNION ALL SELECT 'near', doc_id FROM n""")
def q_sql_surface_matchers(spark, sf):
    sfc.register_sql(spark, corpus_index(spark, sf))
    return spark.sql("""SELECT 'boolean' AS part, doc_id FROM entry_match_boolean(array('of', 'the'), array('tion', 'ble'), array('rer'))
        UNION ALL SELECT 'near', doc_id FROM entry_near(array('of', 'the'), 5)""")
