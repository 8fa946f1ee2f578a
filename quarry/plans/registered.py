"""Registered queries: one per operator of the inventory, each with its DuckDB oracle SQL.

Every query reads the driver's whole tables (through the stand-ins) and returns a DataFrame whose
column names equal the oracle's. Arrays are turned into sorted comma text and doubles rounded to
6 places in compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.operators import order as od
from quarry.operators import rank as rk
from quarry.plans import oracle as o
from quarry.session import local_table, scratch_path
from quarry.sources import docset as ds
from quarry.sources import index_io as io
from quarry.sources import standins as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# ---- fixed values: query words (they hit at sf0.01, see FIXTURES.md) ----
Q_TERMS = [
    (1, 0, "of"), (1, 1, "the"),
    (2, 0, "tion"), (2, 1, "ble"),
    (3, 0, "en"), (3, 1, "in"), (3, 2, "the"),
    (4, 0, "rer"),
    (5, 0, "ouoi"), (5, 1, "lement"),
    (6, 0, "of"), (6, 1, "the"), (6, 2, "and"),
]
Q_BM25 = [(1, 0, "of"), (1, 1, "tion"), (1, 2, "ble")]
Q_RUN = [(1, 0, "of"), (1, 1, "the"), (1, 2, "and")]
# ---- end of fixed values ----

QV = lambda rows: f"qv AS {o.values_sql(rows, 'query_id, qpos, term')}"


def corpus_index(spark: SparkSession, sf_dir: str, **kw) -> ix.Index:
    """The entry index over the corpus stand-in: fields title and body."""
    st.prep(spark)
    docs = st.corpus(spark, sf_dir)
    return ix.build_index("entry", docs, ("title", "body"), "doc_id",
                          attrs=["lang", "source", "author_id", "created_on", "lat", "long"], **kw)


def qtable(spark: SparkSession, rows) -> DataFrame:
    return ix.queries_from_terms(spark, rows)


# =============================================================================================
# 2.2 text preparation


@register("tokenize", f"""WITH {o.INDEX} SELECT doc_id, field, pos, term FROM postings""")
def q_tokenize(spark, sf):
    st.prep(spark)
    return ix.tokenize(st.corpus(spark, sf), ("title", "body")).select(
        "doc_id", "field", F.col("pos").cast("long").alias("pos"), "term")


@register("vocabulary", f"""WITH {o.INDEX} SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits
FROM postings GROUP BY term""")
def q_vocabulary(spark, sf):
    return corpus_index(spark, sf).vocabulary()


# =============================================================================================
# 2.3 matching


@register("match_all", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id)
SELECT q.query_id, p.doc_id FROM postings p JOIN q USING (term) JOIN nq USING (query_id)
GROUP BY q.query_id, p.doc_id HAVING count(DISTINCT p.term) = max(nq.n)""")
def q_match_all(spark, sf):
    return mt.match_all(corpus_index(spark, sf), qtable(spark, Q_TERMS))


@register("match_any", f"""WITH {o.INDEX}, {QV(Q_TERMS)}
SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term)""")
def q_match_any(spark, sf):
    return mt.match_any(corpus_index(spark, sf), qtable(spark, Q_TERMS))


@register("match_phrase", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
m AS (SELECT query_id, count(*) AS m FROM qv GROUP BY query_id)
SELECT DISTINCT query_id, doc_id FROM (
  SELECT q.query_id, p.doc_id, p.field, p.pos - q.qpos AS diag FROM postings p JOIN qv q USING (term)
  JOIN m USING (query_id) GROUP BY ALL HAVING count(DISTINCT q.qpos) = max(m.m))""")
def q_match_phrase(spark, sf):
    return mt.match_phrase(corpus_index(spark, sf), qtable(spark, Q_TERMS))


@register("match_extended_proximity", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
q AS (SELECT DISTINCT query_id, term FROM qv), m AS (SELECT query_id, count(*) AS m FROM q GROUP BY query_id),
h AS (SELECT q.query_id, p.doc_id, p.field, p.pos, p.term FROM postings p JOIN q USING (term))
SELECT DISTINCT query_id, doc_id FROM (
  SELECT h.query_id, h.doc_id, m.m, (SELECT count(DISTINCT h2.term) FROM h h2 WHERE h2.query_id = h.query_id
     AND h2.doc_id = h.doc_id AND h2.field = h.field AND h2.pos BETWEEN h.pos AND h.pos + 4) AS k
  FROM h JOIN m USING (query_id)) WHERE k = m""")
def q_match_near(spark, sf):
    return mt.match_near(corpus_index(spark, sf), qtable(spark, Q_TERMS), 5)


# =============================================================================================
# 2.4 ranking


@register("rank_bm25", f"""WITH {o.INDEX}, {QV(Q_BM25)}, {o.bm25_ctes()},
mt AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term))
SELECT mt.query_id, mt.doc_id, round(coalesce(bm.bm25, 0), 6) AS weight FROM mt LEFT JOIN bm USING (query_id, doc_id)""")
def q_rank_bm25(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_BM25)
    return rk.rank(idx, q, mt.match_any(idx, q), "bm25")


@register("rank_proximity", f"""WITH {o.INDEX}, {QV(Q_RUN)}, {o.lcs_ctes()},
q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
mt AS (SELECT q.query_id, p.doc_id FROM postings p JOIN q USING (term) JOIN nq USING (query_id)
       GROUP BY q.query_id, p.doc_id HAVING count(DISTINCT p.term) = max(nq.n))
SELECT mt.query_id, mt.doc_id, CAST(coalesce(s.w, 0) AS DOUBLE) AS weight FROM mt LEFT JOIN
 (SELECT query_id, doc_id, sum(lcs) AS w FROM pf GROUP BY ALL) s USING (query_id, doc_id)""")
def q_rank_proximity(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_RUN)
    return rk.rank(idx, q, mt.match_all(idx, q), "proximity")


# =============================================================================================
# 2.6 sorting


@register("sort_relevance", f"""WITH {o.INDEX}, {QV(Q_BM25)}, {o.bm25_ctes()},
mt AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term)),
w AS (SELECT mt.query_id, mt.doc_id, round(coalesce(bm.bm25, 0), 6) AS weight FROM mt LEFT JOIN bm USING (query_id, doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, doc_id) AS rank FROM w)
SELECT query_id, doc_id, weight, rank FROM r WHERE rank <= 20""")
def q_sort_relevance(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_BM25)
    h = rk.rank(idx, q, mt.match_any(idx, q), "bm25")
    return od.top_per_query(h, od.sort_keys("relevance"), 0, 20).select(
        "query_id", "doc_id", "weight", F.col("rank").cast("long"))


# =============================================================================================
# 2.8 the whole search


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """documents -> index -> match all "of the" -> BM25 -> lang = en -> relevance -> top 10."""
    from quarry.plans.search import search
    from quarry.spec import Filter, SearchSpec

    idx = corpus_index(spark, sf)
    spec = SearchSpec(mode="all", ranker="bm25", filters=(Filter("string", "lang", ("en",)),), limit=10)
    r = search(idx, qtable(spark, Q_TERMS[:2]), spec)
    return r.hits.select("query_id", "doc_id", "weight", "lang", "source", F.col("rank").cast("long"))


register("search", f"""WITH {o.INDEX}, {QV(Q_TERMS[:2])}, {o.bm25_ctes()},
q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
mt AS (SELECT q.query_id, p.doc_id FROM postings p JOIN q USING (term) JOIN nq USING (query_id)
       GROUP BY q.query_id, p.doc_id HAVING count(DISTINCT p.term) = max(nq.n)),
w AS (SELECT mt.query_id, mt.doc_id, round(coalesce(bm.bm25, 0), 6) AS weight, c.lang, c.source
      FROM mt LEFT JOIN bm USING (query_id, doc_id) JOIN corpus c USING (doc_id) WHERE c.lang IN ('en')),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, doc_id) AS rank FROM w)
SELECT query_id, doc_id, weight, lang, source, rank FROM r WHERE rank <= 10""")(flagship)


# =============================================================================================
# 2.1 sources, scans and sinks

from quarry.sources import links as lk  # noqa: E402
from quarry.sources import scan as sc  # noqa: E402
from quarry.spec import IndexSpec  # noqa: E402


def mva_text(c: str):
    """Compared form of a multi-value attribute: sorted values joined by commas."""
    return F.array_join(F.transform(F.sort_array(F.col(c)), lambda x: x.cast("string")), ",")


def mva_text_sql(expr: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct({expr})), ','), '')"


ENTRY_SPEC = IndexSpec(name="entry", id_col="doc_id", fields=("title", "body"), string_attrs=("lang",),
                       uint_attrs=("author_id",), select_values=(("lang", "en"),))
ORDER_SPEC = IndexSpec(name="orders", id_col="o_orderkey", uint_attrs=("o_custkey",),
                       float_attrs=("o_totalprice",), ts_attrs=("o_orderdate",),
                       rename=(("o_custkey", "author_id"), ("o_orderdate", "created_on")))
# ---- fixed values: metadata keys (the integer-typed keys of the meta stand-in) ----
META_KEYS = ["click", "error", "purchase", "signup", "view"]


@register("scan_source", f"""WITH {o.CORPUS} SELECT doc_id, title, body, lang, author_id FROM corpus WHERE lang = 'en'""")
def q_scan_source(spark, sf):
    st.prep(spark)
    return sc.scan_source(st.corpus(spark, sf), ENTRY_SPEC)


@register("select_columns", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def q_select_columns(spark, sf):
    return sc.select_columns(st.table(spark, sf, "orders"), "o_orderkey",
                             exclude=["o_orderdate", "o_orderpriority"])


@register("build_attributes", """SELECT o_orderkey AS doc_id, o_custkey AS author_id, o_totalprice,
 CAST(epoch(o_orderdate) AS BIGINT) AS created_on FROM orders""")
def q_build_attributes(spark, sf):
    st.prep(spark)
    return sc.build_attributes(st.table(spark, sf, "orders"), ORDER_SPEC)


@register("timestamp_attr", """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate_ts FROM orders""")
def q_timestamp_attr(spark, sf):
    st.prep(spark)
    o_ = st.table(spark, sf, "orders")
    return o_.select("o_orderkey", sc.timestamp_attr("o_orderdate").alias("o_orderdate_ts"))


@register("string_attr_crc", f"""SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IS NULL OR c_mktsegment IN ('', '0')
THEN NULL ELSE {o.crc32_sql('c_mktsegment')} END AS c_mktsegment_crc32 FROM customer""")
def q_string_attr_crc(spark, sf):
    c = st.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return sc.string_attr_crc(c, "c_mktsegment")


@register("count_column", """SELECT o.o_orderkey AS doc_id, CAST(count(l.l_orderkey) AS BIGINT) AS n_returned
FROM orders o LEFT JOIN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey""")
def q_count_column(spark, sf):
    docs = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return lk.count_column(docs, st.table(spark, sf, "lineitem"), "l_orderkey", "n_returned",
                           where=F.col("l_returnflag") == "R")


@register("mva_attach", f"""SELECT o.o_orderkey AS doc_id, {mva_text_sql('list(l.l_partkey) FILTER (WHERE l.l_partkey IS NOT NULL)')} AS tag
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""")
def q_mva_attach(spark, sf):
    docs = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    d = lk.mva_attach(docs, st.table(spark, sf, "lineitem"), ("l_orderkey", "l_partkey"), "tag")
    return d.select("doc_id", mva_text("tag").alias("tag"))


@register("mva_query", f"""SELECT o.o_orderkey AS doc_id, {mva_text_sql('list(l.l_suppkey) FILTER (WHERE l.l_suppkey IS NOT NULL)')} AS supplier
FROM orders o LEFT JOIN (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_quantity > 25) l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey""")
def q_mva_query(spark, sf):
    docs = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    pairs = st.table(spark, sf, "lineitem").where(F.col("l_quantity") > 25).select("l_orderkey", "l_suppkey")
    d = lk.mva_query(docs, pairs, "supplier")
    return d.select("doc_id", mva_text("supplier").alias("supplier"))


@register("mva_tags", f"""SELECT o.o_orderkey AS doc_id, {mva_text_sql('list(l.l_partkey) FILTER (WHERE l.l_partkey IS NOT NULL)')} AS tag
FROM orders o LEFT JOIN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'O') l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey""")
def q_mva_tags(spark, sf):
    docs = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    d = lk.mva_tags(docs, st.object_tags(spark, sf), "entry")
    return d.select("doc_id", mva_text("tag").alias("tag"))


def _meta_sql():
    cols = ", ".join(
        f"{mva_text_sql(f'list(m.value) FILTER (WHERE m.key = {chr(39)}{k}{chr(39)} AND m.value IS NOT NULL)')} AS meta_{k}"
        for k in META_KEYS)
    return f"""WITH m AS (SELECT user_id AS owner_id, event_type AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events)
SELECT c.c_custkey AS doc_id, {cols} FROM customer c LEFT JOIN m ON m.owner_id = c.c_custkey GROUP BY c.c_custkey"""


@register("mva_meta", _meta_sql())
def q_mva_meta(spark, sf):
    docs = st.table(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"))
    d = lk.mva_meta(docs, st.meta(spark, sf), META_KEYS)
    return d.select("doc_id", *[mva_text(f"meta_{k}").alias(f"meta_{k}") for k in META_KEYS])


@register("response_to", """WITH c AS (SELECT conv_id * 1000 + turn AS comment_id, conv_id AS entry_id, turn AS created_on,
 role AS commenter_id FROM conversations)
SELECT DISTINCT a.comment_id, b.commenter_id AS response_to FROM c a JOIN c b
 ON a.entry_id = b.entry_id AND a.created_on > b.created_on WHERE b.commenter_id IS NOT NULL""")
def q_response_to(spark, sf):
    return lk.response_to(st.comments(spark, sf))


_CATS_SQL = ("cats AS (SELECT row_number() OVER (ORDER BY c_mktsegment) AS id, 1 AS blog_id, lower(c_mktsegment) AS basename, "
             "c_mktsegment AS label FROM (SELECT DISTINCT c_mktsegment FROM customer))")


@register("tag_category_pairs", f"""WITH {_CATS_SQL}
SELECT DISTINCT l.l_partkey AS tag_id, CAST(cats.id AS BIGINT) AS category_id
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN cats ON cats.label = c.c_mktsegment""")
def q_tag_category_pairs(spark, sf):
    return lk.tag_category_pairs(st.tags(spark, sf), st.object_tags(spark, sf), st.placements(spark, sf))


@register("delta_source", f"""WITH {o.CORPUS} SELECT doc_id, CAST(epoch(created_on) AS BIGINT) AS created_on FROM corpus
WHERE created_on > TIMESTAMP '{st.DELTA_AS_OF}' - INTERVAL 36 HOUR""")
def q_delta_source(spark, sf):
    st.prep(spark)
    d = sc.delta_source(st.corpus(spark, sf), "created_on", st.DELTA_AS_OF)
    return d.select("doc_id", sc.timestamp_attr("created_on").alias("created_on"))


@register("fetch_by_id", f"""WITH {o.CORPUS} SELECT doc_id, title, lang, source FROM corpus
WHERE doc_id IN (SELECT doc_id FROM labels)""")
def q_fetch_by_id(spark, sf):
    st.prep(spark)
    c = st.corpus(spark, sf).select("doc_id", "title", "lang", "source")
    return sc.fetch_by_id(c, st.table(spark, sf, "labels"))


@register("max_matches_estimate", f"""WITH {o.CORPUS}
SELECT CAST(greatest(1000, floor(1.5 * max(n))) AS BIGINT) AS max_matches FROM (SELECT source, count(*) AS n FROM corpus GROUP BY source)""")
def q_max_matches_estimate(spark, sf):
    st.prep(spark)
    return sc.max_matches_estimate(st.corpus(spark, sf), "source")


# =============================================================================================
# 2.2 text preparation (rest)

from quarry.functions import text as tx  # noqa: E402


def _strip_sql(x: str) -> str:
    s = x
    for pat in (tx.SCRIPT_PATTERN, tx.STYLE_PATTERN, tx.COMMENT_PATTERN, tx.TAG_PATTERN):
        s = f"regexp_replace({s}, '{pat}', ' ', 'g')"
    for ent, ch in tx.ENTITIES:
        ch_sql = ch.replace("'", "''")
        s = f"replace({s}, '{ent}', '{ch_sql}')"
    return s


@register("html_strip", f"""SELECT page_id, {_strip_sql('html')} AS text FROM pages""")
def q_html_strip(spark, sf):
    p = st.table(spark, sf, "pages")
    return p.select("page_id", tx.html_strip("html").alias("text"))


HTML_ATTRS = {"a": ["href"]}


@register("html_index_attrs", f"""SELECT page_id, array_to_string(regexp_extract_all(html, '{tx.attr_pattern("a", "href")}', 1), ' ') AS attrs FROM pages""")
def q_html_index_attrs(spark, sf):
    p = st.table(spark, sf, "pages")
    return p.select("page_id", tx.html_attr_values(F.col("html"), HTML_ATTRS).alias("attrs"))


@register("min_word_len", f"""WITH {o.INDEX} SELECT doc_id, field, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM postings
WHERE length(term) >= 3 GROUP BY doc_id, field""")
def q_min_word_len(spark, sf):
    st.prep(spark)
    p = ix.min_word_len(ix.tokenize(st.corpus(spark, sf), ("title", "body")), 3)
    return p.groupBy("doc_id", "field").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").cast("long").alias("pos_sum"))


# ---- fixed values: a stop list ----
STOP = ["the", "of", "and", "in", "en"]


@register("stopwords", f"""WITH {o.INDEX} SELECT doc_id, field, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM postings
WHERE term NOT IN ({", ".join(repr(w) for w in STOP)}) GROUP BY doc_id, field""")
def q_stopwords(spark, sf):
    st.prep(spark)
    stop = local_table(spark, [(w,) for w in STOP], "term string")
    p = ix.stopwords(ix.tokenize(st.corpus(spark, sf), ("title", "body")), stop)
    return p.groupBy("doc_id", "field").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").cast("long").alias("pos_sum"))


def _norm_query(method):
    def fn(spark, sf):
        v = corpus_index(spark, sf).vocabulary()
        return ix.normalize_terms(v, method)

    return fn


register("morphology_stem_en")(_norm_query("stem_en"))
register("morphology_stem_ru")(_norm_query("stem_ru"))
register("morphology_stem_enru")(_norm_query("stem_enru"))
register("morphology_soundex", f"""WITH {o.INDEX}, v AS (SELECT DISTINCT term FROM postings)
SELECT term, {o.soundex_sql('term')} AS norm FROM v""")(_norm_query("soundex"))


@register("build_postings", f"""WITH toks AS (SELECT page_id AS doc_id, 'html' AS field, {o.words_sql(_strip_sql('html'))} AS t FROM pages)
SELECT unnest(t) AS term, doc_id, field, generate_subscripts(t, 1) - 1 AS pos FROM toks""")
def q_build_postings(spark, sf):
    p = st.table(spark, sf, "pages")
    idx = ix.build_index("pages", p, ("html",), "page_id", attrs=["url"], strip_html=("html",))
    return idx.postings.select("term", "doc_id", "field", F.col("pos").cast("long").alias("pos"))


BENCH_Q = f"""bq AS (SELECT CAST(item_id AS INTEGER) AS query_id, {o.words_sql('text')} AS t FROM benchmark),
qb AS (SELECT query_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS qpos, unnest(t) AS term FROM bq)"""


def bench_queries(spark, sf):
    return ix.queries_from_column(st.table(spark, sf, "benchmark"), "item_id", "text")


@register("query_word_stats", f"""WITH {o.INDEX}, {BENCH_Q},
v AS (SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM postings GROUP BY term)
SELECT DISTINCT qb.query_id, qb.term, CAST(coalesce(v.docs, 0) AS BIGINT) AS docs, CAST(coalesce(v.hits, 0) AS BIGINT) AS hits
FROM qb LEFT JOIN v USING (term)""")
def q_query_word_stats(spark, sf):
    idx = corpus_index(spark, sf)
    return ix.query_word_stats(bench_queries(spark, sf), idx.vocabulary())


@register("keywords", f"""WITH {o.INDEX}, {BENCH_Q},
v AS (SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM postings GROUP BY term)
SELECT qb.query_id, qb.qpos, qb.term AS tokenized, qb.term AS normalized, CAST(coalesce(v.docs, 0) AS BIGINT) AS docs,
 CAST(coalesce(v.hits, 0) AS BIGINT) AS hits FROM qb LEFT JOIN v USING (term)""")
def q_keywords(spark, sf):
    idx = corpus_index(spark, sf)
    return ix.keywords(st.table(spark, sf, "benchmark"), idx, id_col="item_id", text_col="text")


@register("attr_tokens", f"""WITH {o.CORPUS}
SELECT lower('entry_lang_' || lang) AS term, doc_id, '_attrs' AS field, 0 AS pos FROM corpus
UNION ALL SELECT lower('entry_source_' || source), doc_id, '_attrs', 0 FROM corpus
UNION ALL SELECT 'entry_author_id_' || CAST(author_id AS VARCHAR), doc_id, '_attrs', 0 FROM corpus""")
def q_attr_tokens(spark, sf):
    st.prep(spark)
    return ix.attr_tokens(st.corpus(spark, sf), "entry", ["lang", "source", "author_id"])


# =============================================================================================
# 2.5 filters and lookups

from quarry.operators import filters as fl  # noqa: E402
from quarry.spec import Filter, SearchSpec, near, phrase, term  # noqa: E402

ENTRIES_SQL = f"""{_CATS_SQL},
entries AS (SELECT o.o_orderkey AS doc_id, o.o_custkey AS author_id, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
  coalesce(t.tag, []) AS tag, CAST(coalesce(r.n, 0) AS BIGINT) AS n_returned, CASE WHEN cats.id IS NULL THEN [] ELSE [cats.id] END AS category
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS tag FROM lineitem GROUP BY l_orderkey) t ON t.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) r ON r.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN cats ON cats.label = c.c_mktsegment)"""

# ---- fixed values: filter arguments ----
AUTHORS_IN = [3, 7, 11, 100, 250]
TAGS_IN = [1, 2, 3, 50]
AUTHOR_NAMES = "Customer#000000003,Customer#000000010"
TAG_NAMES = "red widget, blue bolt"
CATEGORY_NAMES = "building, machinery"
DATE_START, DATE_END = "2024010812", "2024011023"
GEO_ANCHOR = (0.5, -1.1)
GEO_RADIUS_M = 2_000_000.0
# ---- end of fixed values ----


def entry_hits(spark, sf):
    """Full-scan hits over the entries stand-in (weight 1)."""
    st.prep(spark)
    return st.entries(spark, sf).select(F.lit(1).cast("int").alias("query_id"), F.lit(1.0).alias("weight"), "*")


def corpus_hits(spark, sf):
    st.prep(spark)
    return st.corpus(spark, sf).select(F.lit(1).cast("int").alias("query_id"), F.lit(1.0).alias("weight"), "*")


def _ids(df):
    return df.select("doc_id")


def _in(vals):
    return ", ".join(str(v) for v in vals)


@register("filter_values", f"""WITH {ENTRIES_SQL} SELECT doc_id, author_id FROM entries WHERE author_id IN ({_in(AUTHORS_IN)})""")
def q_filter_values(spark, sf):
    return fl.filter_values(entry_hits(spark, sf), "author_id", AUTHORS_IN).select("doc_id", "author_id")


@register("filter_values_mva", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE list_has_any(tag, [{_in(TAGS_IN)}])""")
def q_filter_values_mva(spark, sf):
    return _ids(fl.filter_values(entry_hits(spark, sf), "tag", TAGS_IN))


@register("filter_values_exclude", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id NOT IN ({_in(AUTHORS_IN)})
 AND NOT list_has_any(tag, [{_in(TAGS_IN)}])""")
def q_filter_values_exclude(spark, sf):
    h = fl.filter_values(entry_hits(spark, sf), "author_id", AUTHORS_IN, exclude=True)
    return _ids(fl.filter_values(h, "tag", TAGS_IN, exclude=True))


@register("filter_range", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id BETWEEN 100 AND 300
 AND len(list_filter(tag, lambda x: x BETWEEN 10 AND 400)) > 0""")
def q_filter_range(spark, sf):
    h = fl.filter_range(entry_hits(spark, sf), "author_id", 100, 300)
    return _ids(fl.filter_range(h, "tag", 10, 400))


@register("filter_range_exclude", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE NOT (author_id BETWEEN 100 AND 300)""")
def q_filter_range_exclude(spark, sf):
    return _ids(fl.filter_range(entry_hits(spark, sf), "author_id", 100, 300, exclude=True))


@register("filter_float_range", """SELECT p_partkey AS doc_id FROM part WHERE p_retailprice BETWEEN 920.5 AND 950.25
 AND p_size BETWEEN 10 AND 20""")
def q_filter_float_range(spark, sf):
    p = st.table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), "p_retailprice", "p_size")
    return _ids(fl.filter_range(fl.filter_float_range(p, "p_retailprice", 920.5, 950.25), "p_size", 10, 20))


@register("filter_id_range", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE doc_id BETWEEN 1000 AND 2000""")
def q_filter_id_range(spark, sf):
    return _ids(fl.filter_id_range(entry_hits(spark, sf), 1000, 2000))


@register("filter_string", f"""WITH {o.CORPUS} SELECT doc_id, lang FROM corpus WHERE lang IN ('fr', 'de')""")
def q_filter_string(spark, sf):
    return fl.filter_string(corpus_hits(spark, sf), "lang", ["fr", "de"]).select("doc_id", "lang")


@register("filter_lookup", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id IN
 (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000003')""")
def q_filter_lookup(spark, sf):
    return _ids(fl.filter_lookup(entry_hits(spark, sf), "author_id", st.authors(spark, sf), "name", "Customer#000000003"))


@register("filter_lookup_meta", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id IN
 (SELECT user_id FROM events WHERE event_type = 'click' AND CAST(json_extract_string(props, '$.k') AS BIGINT) = 69)""")
def q_filter_lookup_meta(spark, sf):
    return _ids(fl.filter_lookup_meta(entry_hits(spark, sf), "author_id", st.meta(spark, sf), "click", 69))


@register("filter_blogs", f"""WITH {o.CORPUS} SELECT doc_id FROM corpus WHERE source IN ('src1', 'src2')""")
def q_filter_blogs(spark, sf):
    return _ids(fl.filter_blogs(corpus_hits(spark, sf), ["src1", "src2"], "source"))


@register("filter_date_range", f"""WITH {o.CORPUS} SELECT doc_id FROM corpus WHERE epoch(created_on) BETWEEN
 epoch(strptime('{DATE_START}0000', '%Y%m%d%H%M%S')) AND epoch(strptime('{DATE_END}0000', '%Y%m%d%H%M%S'))""")
def q_filter_date_range(spark, sf):
    return _ids(fl.filter_date_range(corpus_hits(spark, sf), DATE_START, DATE_END, "created_on"))


def _tag_names():
    return [n.strip() for n in TAG_NAMES.split(",")]


@register("filter_tags", f"""WITH {ENTRIES_SQL}, tg AS (SELECT p_partkey AS id FROM part
  WHERE p_name IN ({", ".join(repr(n) for n in _tag_names())})
     OR regexp_replace(lower(p_name), '[^a-z0-9_]', '', 'g') IN ({", ".join(repr(fl.normalize_tag(n)) for n in _tag_names())}))
SELECT doc_id FROM entries WHERE list_has_any(tag, (SELECT list(id) FROM tg))""")
def q_filter_tags(spark, sf):
    return _ids(fl.filter_tags(entry_hits(spark, sf), st.tags(spark, sf), TAG_NAMES))


@register("filter_category", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE list_has_any(category,
 (SELECT list(id) FROM cats WHERE basename IN ('building', 'machinery')))""")
def q_filter_category(spark, sf):
    return _ids(fl.filter_category(entry_hits(spark, sf), st.categories(spark, sf), CATEGORY_NAMES))


@register("filter_author", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id IN
 (SELECT c_custkey FROM customer WHERE c_name IN ('Customer#000000003', 'Customer#000000010'))""")
def q_filter_author(spark, sf):
    return _ids(fl.filter_author(entry_hits(spark, sf), st.authors(spark, sf), AUTHOR_NAMES))


@register("filter_following", f"""WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE author_id IN
 (SELECT DISTINCT l.l_suppkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey = 3)""")
def q_filter_following(spark, sf):
    return _ids(fl.filter_following(entry_hits(spark, sf), st.follows(spark, sf), 3))


def _attr_index(spark, sf):
    st.prep(spark)
    docs = st.corpus(spark, sf)
    extra = ix.attr_tokens(docs, "entry", ["lang", "source"])
    return ix.build_index("entry", docs, ("title", "body"), "doc_id",
                          attrs=["lang", "source", "author_id", "created_on"], extra_postings=extra)


MATCH_THE = f"""mt AS (SELECT DISTINCT doc_id FROM postings WHERE term = 'the')"""


@register("filter_text_level1", f"""WITH {o.INDEX}, {MATCH_THE}
SELECT 1 AS query_id, doc_id FROM mt JOIN corpus USING (doc_id) WHERE lang = 'en'""")
def q_filter_text_level1(spark, sf):
    from quarry.plans.search import search

    idx = _attr_index(spark, sf)
    spec = SearchSpec(mode="all", ranker="none", filters=(Filter("values", "lang", ("en",)),), limit=100000,
                      max_matches=100000)
    return search(idx, qtable(spark, [(1, 0, "the")]), spec, text_filter_level=1).matches.select("query_id", "doc_id")


@register("filter_text_level2", f"""WITH {o.INDEX}, {MATCH_THE}
SELECT 1 AS query_id, doc_id FROM mt JOIN corpus USING (doc_id) WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3')""")
def q_filter_text_level2(spark, sf):
    from quarry.plans.search import search

    idx = _attr_index(spark, sf)
    spec = SearchSpec(mode="all", ranker="none", limit=100000, max_matches=100000,
                      filters=(Filter("values", "lang", ("en",)), Filter("values", "source", ("src1", "src2", "src3"))))
    return search(idx, qtable(spark, [(1, 0, "the")]), spec, text_filter_level=2).matches.select("query_id", "doc_id")


@register("filter_text_forced", f"""WITH {o.INDEX}, {MATCH_THE}
SELECT 1 AS query_id, doc_id FROM mt JOIN corpus USING (doc_id) WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3')""")
def q_filter_text_forced(spark, sf):
    from quarry.plans.search import search

    idx = _attr_index(spark, sf)
    spec = SearchSpec(mode="all", ranker="none", limit=100000, max_matches=100000,
                      filters=(Filter("values", "lang", ("en",)), Filter("values", "source", ("src1", "src2", "src3"))))
    return search(idx, qtable(spark, [(1, 0, "the")]), spec, text_filter_level=2,
                  forced=("source",)).matches.select("query_id", "doc_id")


def _geo_sql():
    la0, lo0 = GEO_ANCHOR
    a = (f"sin((lat - {la0}) / 2) * sin((lat - {la0}) / 2) + cos(lat) * cos({la0}) * sin((long - {lo0}) / 2) "
         f"* sin((long - {lo0}) / 2)")
    return f"{2 * fl.EARTH_RADIUS_M} * asin(sqrt(least(1.0, {a})))"


@register("geo_distance", f"""WITH {o.CORPUS} SELECT doc_id, round({_geo_sql()}, 3) AS geodist FROM corpus
WHERE {_geo_sql()} < {GEO_RADIUS_M}""")
def q_geo_distance(spark, sf):
    h = corpus_hits(spark, sf).withColumn("geodist", fl.geo_distance("lat", "long", *GEO_ANCHOR))
    return h.where(F.col("geodist") < GEO_RADIUS_M).select("doc_id", F.round("geodist", 3).alias("geodist"))


# =============================================================================================
# 2.3 matching (rest)

from quarry.plans import search as sr  # noqa: E402

BOOL_EXPR = (term("of") & term("the")) | (term("tion") & ~term("ble"))
FIELD_EXPR = term("of", field="title") & term("the")
PHRASE_EXPR = phrase("of", "the") & ~term("tion")
NOT_EXPR = ~term("the")
NEAR_EXPR = near("of", "the", n=5) | term("ouoi")

_FLAGS = """f AS (SELECT doc_id, bool_or(term = 'of') AS f_of, bool_or(term = 'the') AS f_the, bool_or(term = 'tion') AS f_tion,
 bool_or(term = 'ble') AS f_ble, bool_or(term = 'of' AND field = 'title') AS f_of_title, bool_or(term = 'ouoi') AS f_ouoi
 FROM postings WHERE term IN ('of', 'the', 'tion', 'ble', 'ouoi') GROUP BY doc_id)"""
_PHRASE_OF_THE = """ph AS (SELECT DISTINCT a.doc_id FROM postings a JOIN postings b ON a.doc_id = b.doc_id AND a.field = b.field
 AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the')"""
_NEAR_OF_THE = """nr AS (SELECT DISTINCT a.doc_id FROM postings a JOIN postings b ON a.doc_id = b.doc_id AND a.field = b.field
 AND abs(b.pos - a.pos) <= 4 WHERE a.term = 'of' AND b.term = 'the')"""


@register("match_boolean", f"""WITH {o.INDEX}, {_FLAGS}
SELECT 1 AS query_id, doc_id FROM f WHERE (f_of AND f_the) OR (f_tion AND NOT f_ble)""")
def q_match_boolean(spark, sf):
    return mt.match_boolean(corpus_index(spark, sf), BOOL_EXPR)


@register("match_boolean_not", f"""WITH {o.INDEX}, {_FLAGS}
SELECT 1 AS query_id, c.doc_id FROM corpus c LEFT JOIN f USING (doc_id) WHERE NOT coalesce(f.f_the, false)""")
def q_match_boolean_not(spark, sf):
    return mt.match_boolean(corpus_index(spark, sf), NOT_EXPR)


@register("match_extended_field", f"""WITH {o.INDEX}, {_FLAGS}
SELECT 1 AS query_id, doc_id FROM f WHERE f_of_title AND f_the""")
def q_match_extended_field(spark, sf):
    return mt.match_extended(corpus_index(spark, sf), FIELD_EXPR)


@register("match_extended_phrase", f"""WITH {o.INDEX}, {_FLAGS}, {_PHRASE_OF_THE}
SELECT 1 AS query_id, ph.doc_id FROM ph LEFT JOIN f USING (doc_id) WHERE NOT coalesce(f.f_tion, false)""")
def q_match_extended_phrase(spark, sf):
    return mt.match_extended(corpus_index(spark, sf), PHRASE_EXPR)


@register("match_extended_near", f"""WITH {o.INDEX}, {_FLAGS}, {_NEAR_OF_THE}
SELECT 1 AS query_id, doc_id FROM f FULL JOIN nr USING (doc_id) WHERE nr.doc_id IS NOT NULL OR coalesce(f.f_ouoi, false)""")
def q_match_extended_near(spark, sf):
    return mt.match_extended(corpus_index(spark, sf), NEAR_EXPR)


@register("match_fullscan", f"""WITH {o.CORPUS} SELECT 1 AS query_id, doc_id FROM corpus""")
def q_match_fullscan(spark, sf):
    return mt.match_fullscan(corpus_index(spark, sf))


def _wc_sql(corpus_cte: str = "corpus") -> str:
    return f"""q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
mt AS (SELECT q.query_id, p.doc_id FROM postings p JOIN q USING (term) JOIN nq USING (query_id)
       GROUP BY q.query_id, p.doc_id HAVING count(DISTINCT p.term) = max(nq.n)),
wc AS (SELECT q.query_id, p.doc_id, count(*) AS hits FROM postings p JOIN qv q USING (term) GROUP BY ALL),
wch AS (SELECT mt.query_id, mt.doc_id, CAST(wc.hits AS DOUBLE) AS weight, c.author_id, c.created_on, c.lang, c.source
        FROM mt JOIN wc USING (query_id, doc_id) JOIN {corpus_cte} c USING (doc_id))"""


LANGS_A, LANGS_B = ("en", "fr"), ("fr", "de", "es")
IDX_WEIGHTS = {"a": 2, "b": 3}


def _two_indexes(spark, sf):
    st.prep(spark)
    docs = st.corpus(spark, sf)
    mk = lambda n, langs: ix.build_index(n, docs.where(F.col("lang").isin(list(langs))), ("title", "body"),
                                         "doc_id", attrs=["lang", "source", "author_id", "created_on"])
    reg = sr.IndexRegistry()
    reg.declare(mk("a", LANGS_A))
    reg.declare(mk("b", LANGS_B))
    return reg


@register("search_many_indexes", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
u AS (SELECT query_id, doc_id, 'a' AS index_name, weight * 2 AS weight FROM wch WHERE lang IN ('en', 'fr')
      UNION ALL SELECT query_id, doc_id, 'b', weight * 3 FROM wch WHERE lang IN ('fr', 'de', 'es'))
SELECT query_id, doc_id, index_name, weight FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id
 ORDER BY weight DESC, index_name) AS rn FROM u) WHERE rn = 1""")
def q_search_many_indexes(spark, sf):
    reg = _two_indexes(spark, sf)
    r = sr.search_indexes(reg.resolve("a, b"), qtable(spark, Q_TERMS), "all", "wordcount", IDX_WEIGHTS)
    return r.select("query_id", "doc_id", "index_name", "weight")


@register("index_weights", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}
SELECT query_id, doc_id, 'a' AS index_name, weight * 2 AS weight FROM wch WHERE lang IN ('en', 'fr')
UNION ALL SELECT query_id, doc_id, 'b', weight * 3 FROM wch WHERE lang IN ('fr', 'de', 'es')""")
def q_index_weights(spark, sf):
    reg = _two_indexes(spark, sf)
    q = qtable(spark, Q_TERMS)
    parts = [rk.rank(i, q, mt.match_all(i, q), "wordcount").withColumn("index_name", F.lit(n)) for n, i in reg.items()]
    u = parts[0].unionByName(parts[1])
    return rk.apply_index_weights(u, IDX_WEIGHTS).select("query_id", "doc_id", "index_name", "weight")


_DELTA_CORPUS = f"""corpus2 AS (SELECT doc_id, title, CASE WHEN created_on > TIMESTAMP '{st.DELTA_AS_OF}' - INTERVAL 36 HOUR
 THEN body || ' ' || title ELSE body END AS body, lang, source, author_id, created_on FROM corpus)"""


def delta_docs(spark, sf):
    """Changed documents: those of the last 36 hours, their title appended to the body."""
    from quarry.sources.scan import delta_source

    d = delta_source(st.corpus(spark, sf), "created_on", st.DELTA_AS_OF)
    return d.withColumn("body", F.concat_ws(" ", "body", "title"))


@register("search_main_delta", f"""WITH {o.CORPUS}, {_DELTA_CORPUS},
fields AS (SELECT doc_id, 'title' AS field, title AS txt FROM corpus2 UNION ALL SELECT doc_id, 'body' AS field, body AS txt FROM corpus2),
{o.TOKS}, {o.POSTINGS}, {QV(Q_TERMS)}, {_wc_sql('corpus2')}
SELECT query_id, doc_id, weight FROM wch""")
def q_search_main_delta(spark, sf):
    st.prep(spark)
    attrs = ["lang", "source", "author_id", "created_on"]
    main = ix.build_index("entry", st.corpus(spark, sf), ("title", "body"), "doc_id", attrs=attrs)
    path = scratch_path(spark, "main-index")
    io.write_index(main, path)
    delta = ix.build_index("entry_delta", delta_docs(spark, sf), ("title", "body"), "doc_id", attrs=attrs)
    idx = mt.main_delta(io.read_index(spark, path), delta)  # as in production: a stored main, a fresh delta
    q = qtable(spark, Q_TERMS)
    return rk.rank(idx, q, mt.match_all(idx, q), "wordcount").select("query_id", "doc_id", "weight")


@register("search_batch", f"""WITH {o.INDEX}, {BENCH_Q}, {o.bm25_ctes('qb')},
mt AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qb q USING (term)),
w AS (SELECT mt.query_id, mt.doc_id, round(coalesce(bm.bm25, 0), 6) AS weight FROM mt LEFT JOIN bm USING (query_id, doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, doc_id) AS rank FROM w)
SELECT query_id, doc_id, weight, rank FROM r WHERE rank <= 10""")
def q_search_batch(spark, sf):
    idx = corpus_index(spark, sf)
    q = bench_queries(spark, sf)
    h = rk.rank(idx, q, None, "bm25")  # None: the any-word match set, scored directly
    return od.top_per_query(h, od.sort_keys("relevance"), 0, 10).select(
        "query_id", "doc_id", "weight", F.col("rank").cast("long"))


# =============================================================================================
# 2.4 ranking (rest)


@register("rank_proximity_bm25", f"""WITH {o.INDEX}, {QV(Q_RUN)}, {o.lcs_ctes()}, {o.bm25_ctes()},
q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
mt AS (SELECT q.query_id, p.doc_id FROM postings p JOIN q USING (term) JOIN nq USING (query_id)
       GROUP BY q.query_id, p.doc_id HAVING count(DISTINCT p.term) = max(nq.n)),
px AS (SELECT query_id, doc_id, sum(lcs) AS w FROM pf GROUP BY ALL)
SELECT mt.query_id, mt.doc_id, CAST(px.w * 1000 + floor(999 * round(bm.bm25 / (2.2::DOUBLE * sidf.sum_idf), 6)) AS DOUBLE) AS weight
FROM mt JOIN px USING (query_id, doc_id) JOIN bm USING (query_id, doc_id) JOIN sidf USING (query_id)""")
def q_rank_proximity_bm25(spark, sf):
    return rk.match_and_rank(corpus_index(spark, sf), qtable(spark, Q_RUN), "all", "proximity_bm25")


@register("rank_none", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()} SELECT query_id, doc_id, 1.0::DOUBLE AS weight FROM mt""")
def q_rank_none(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    return rk.rank(idx, q, mt.match_all(idx, q), "none")


@register("rank_wordcount", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()} SELECT query_id, doc_id, weight FROM wch""")
def q_rank_wordcount(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    return rk.rank(idx, q, mt.match_all(idx, q), "wordcount")


@register("rank_matchany", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {o.lcs_ctes()},
q AS (SELECT DISTINCT query_id, term FROM qv), nq AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
ma AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN q USING (term)),
s AS (SELECT pf.query_id, pf.doc_id, sum(pf.lcs * nq.n + pf.n_words) AS w FROM pf JOIN nq USING (query_id) GROUP BY ALL)
SELECT ma.query_id, ma.doc_id, CAST(coalesce(s.w, 0) AS DOUBLE) AS weight FROM ma LEFT JOIN s USING (query_id, doc_id)""")
def q_rank_matchany(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    return rk.rank(idx, q, mt.match_any(idx, q), "matchany")


FIELD_WEIGHTS = {"title": 5, "body": 1, "nosuchfield": 9}


@register("field_weights", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
fw AS (SELECT q.query_id, p.doc_id, sum(CASE WHEN p.field = 'title' THEN 5 ELSE 1 END) AS w FROM postings p JOIN qv q USING (term) GROUP BY ALL)
SELECT mt.query_id, mt.doc_id, CAST(fw.w AS DOUBLE) AS weight FROM mt JOIN fw USING (query_id, doc_id)""")
def q_field_weights(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    return rk.rank(idx, q, mt.match_all(idx, q), "wordcount", FIELD_WEIGHTS)


# =============================================================================================
# 2.6 sorting, limits, paging (rest)


def wc_hits(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    r = rk.rank(idx, q, mt.match_all(idx, q), "wordcount")
    return r.join(idx.docs.select("doc_id", "author_id", "created_on", "lang", "source"), "doc_id")


def _top_sql(order: str, offset: int = 0, limit: int = 20, extra: str = "") -> str:
    return f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}{extra},
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank FROM wch)
SELECT query_id, doc_id, weight, rank FROM r WHERE rank > {offset} AND rank <= {offset + limit}"""


def _top(spark, sf, mode, by="", offset=0, limit=20, as_of=None):
    h = wc_hits(spark, sf)
    return od.top_per_query(h, od.sort_keys(mode, by, as_of), offset, limit).select(
        "query_id", "doc_id", "weight", F.col("rank").cast("long"))


@register("sort_attr_desc", _top_sql("created_on DESC, doc_id"))
def q_sort_attr_desc(spark, sf):
    return _top(spark, sf, "attr_desc", "created_on")


@register("sort_attr_asc", _top_sql("author_id, doc_id"))
def q_sort_attr_asc(spark, sf):
    return _top(spark, sf, "attr_asc", "author_id")


_SEG_SQL = f"""CASE WHEN epoch(TIMESTAMP '{st.DELTA_AS_OF}') - epoch(created_on) < 3600 THEN 0
 WHEN epoch(TIMESTAMP '{st.DELTA_AS_OF}') - epoch(created_on) < 86400 THEN 1
 WHEN epoch(TIMESTAMP '{st.DELTA_AS_OF}') - epoch(created_on) < 604800 THEN 2
 WHEN epoch(TIMESTAMP '{st.DELTA_AS_OF}') - epoch(created_on) < 2592000 THEN 3 ELSE 4 END"""


@register("sort_time_segments", _top_sql(f"{_SEG_SQL}, weight DESC, doc_id", limit=50))
def q_sort_time_segments(spark, sf):
    return _top(spark, sf, "time_segments", "created_on", limit=50, as_of=st.DELTA_AS_OF)


@register("sort_extended", _top_sql("author_id DESC, weight DESC, doc_id"))
def q_sort_extended(spark, sf):
    return _top(spark, sf, "extended", "author_id desc, @weight desc")


@register("sort_expr", _top_sql("weight * 2 + author_id DESC, doc_id"))
def q_sort_expr(spark, sf):
    return _top(spark, sf, "expr", "weight * 2 + author_id")


LIMITS = od.limits(offset=0, limit=10, max_matches=1000, page=3)


@register("limit_offset_max", _top_sql("weight DESC, doc_id", offset=LIMITS[0], limit=LIMITS[1]))
def q_limit_offset_max(spark, sf):
    off, lim, _ = LIMITS
    return _top(spark, sf, "relevance", offset=off, limit=lim)


@register("cutoff", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
ma AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term))
SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS c FROM ma) WHERE c <= 50""")
def q_cutoff(spark, sf):
    return od.cutoff(mt.match_any(corpus_index(spark, sf), qtable(spark, Q_TERMS)), 50)


@register("result_totals", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
ma AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term))
SELECT query_id, count(*) AS total_found, least(count(*), 300) AS total FROM ma GROUP BY query_id""")
def q_result_totals(spark, sf):
    return od.result_totals(mt.match_any(corpus_index(spark, sf), qtable(spark, Q_TERMS)), 300)


@register("page_table", f"""WITH {o.INDEX}, {QV(Q_TERMS)},
ma AS (SELECT DISTINCT q.query_id, p.doc_id FROM postings p JOIN qv q USING (term)),
t AS (SELECT query_id, count(*) AS total_found, CAST(ceil(count(*) / 25) AS INTEGER) AS pages FROM ma GROUP BY query_id),
p AS (SELECT query_id, total_found, pages, unnest(range(1, pages + 1)) AS page FROM t)
SELECT query_id, CAST(page AS INTEGER) AS page, pages, CAST((page - 1) * 25 AS BIGINT) AS "offset",
 least(25, total_found - (page - 1) * 25) AS "rows", page = 1 AS is_first, page = pages AS is_last,
 CASE WHEN page > 1 THEN CAST(page - 1 AS INTEGER) ELSE 0 END AS prev_page, CASE WHEN page < pages THEN CAST(page + 1 AS INTEGER) ELSE 0 END AS next_page
FROM p""")
def q_page_table(spark, sf):
    t = od.result_totals(mt.match_any(corpus_index(spark, sf), qtable(spark, Q_TERMS)), 300)
    return od.page_table(t, 25)


# =============================================================================================
# 2.7 grouping and facets

from quarry.operators import group as gr  # noqa: E402


def _group_sql(key: str, order: str, cols: str = "doc_id", src: str = "wch") -> str:
    return f"""g AS (SELECT *, {key} AS "group", count(*) OVER (PARTITION BY query_id, {key}) AS count,
 row_number() OVER (PARTITION BY query_id, {key} ORDER BY {order}) AS rn FROM {src})
SELECT query_id, "group", count, {cols} FROM g WHERE rn = 1"""


@register("group_attr", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}, {_group_sql('author_id', 'weight DESC, doc_id', 'doc_id, weight')}""")
def q_group_attr(spark, sf):
    return gr.group_by(wc_hits(spark, sf), "attr", "author_id").select("query_id", "group", "count", "doc_id", "weight")


@register("group_attrpair", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
g AS (SELECT *, lang AS "group", source AS group2, count(*) OVER (PARTITION BY query_id, lang, source) AS count,
 row_number() OVER (PARTITION BY query_id, lang, source ORDER BY weight DESC, doc_id) AS rn FROM wch)
SELECT query_id, "group", group2, count, doc_id FROM g WHERE rn = 1""")
def q_group_attrpair(spark, sf):
    h = wc_hits(spark, sf)
    return gr.group_by(h, "attrpair", "lang").select("query_id", "group", "group2", "count", "doc_id")


_EH = "eh AS (SELECT 1 AS query_id, 1.0::DOUBLE AS weight, * FROM entries)"
_WEEK = "CAST(year(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER)) * 1000 + dayofyear(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER)) AS BIGINT)"
_CAL = {
    "day": "CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)",
    "week": _WEEK,
    "month": "CAST(strftime(o_orderdate, '%Y%m') AS BIGINT)",
    "year": "CAST(year(o_orderdate) AS BIGINT)",
}


def _cal_query(func):
    def fn(spark, sf):
        h = entry_hits(spark, sf)
        return gr.group_by(h, func, "o_orderdate", "attr_desc", "o_totalprice").select("query_id", "group", "count", "doc_id")

    return fn


for _f, _k in _CAL.items():
    register(f"group_{_f}", f"""WITH {ENTRIES_SQL}, {_EH}, {_group_sql(_k, 'o_totalprice DESC, doc_id', 'doc_id', 'eh')}""")(_cal_query(_f))


@register("group_mva", f"""WITH {ENTRIES_SQL}, {_EH}, ex AS (SELECT query_id, doc_id, o_totalprice, unnest(tag) AS t FROM eh),
{_group_sql('t', 'o_totalprice DESC, doc_id', 'doc_id', 'ex')}""")
def q_group_mva(spark, sf):
    h = entry_hits(spark, sf)
    return gr.group_by(h, "attr", "tag", "attr_desc", "o_totalprice").select("query_id", "group", "count", "doc_id")


@register("group_distinct", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
g AS (SELECT *, lang AS "group", count(*) OVER (PARTITION BY query_id, lang) AS count,
 row_number() OVER (PARTITION BY query_id, lang ORDER BY weight DESC, doc_id) AS rn FROM wch),
d AS (SELECT query_id, lang AS "group", count(DISTINCT source) AS "distinct" FROM wch GROUP BY ALL)
SELECT g.query_id, g."group", g.count, d."distinct", g.doc_id FROM g JOIN d USING (query_id, "group") WHERE rn = 1""")
def q_group_distinct(spark, sf):
    return gr.group_by(wc_hits(spark, sf), "attr", "lang", distinct="source").select(
        "query_id", "group", "count", "distinct", "doc_id")


@register("group_sort", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
g AS (SELECT *, author_id AS "group", count(*) OVER (PARTITION BY query_id, author_id) AS count,
 row_number() OVER (PARTITION BY query_id, author_id ORDER BY weight DESC, doc_id) AS rn FROM wch),
b AS (SELECT * FROM g WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY count DESC, "group", doc_id) AS rank FROM b)
SELECT query_id, "group", count, doc_id, rank FROM r WHERE rank <= 5""")
def q_group_sort(spark, sf):
    g = gr.grouped_search(wc_hits(spark, sf), "attr", "author_id", group_sort="@count desc", limit=5)
    return g.select("query_id", "group", "count", "doc_id", F.col("rank").cast("long"))


@register("group_total", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}
SELECT query_id, count(DISTINCT author_id) AS total_found FROM wch GROUP BY query_id""")
def q_group_total(spark, sf):
    return gr.group_totals(wc_hits(spark, sf), "attr", "author_id")


@register("facets", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}
SELECT query_id, 'lang' AS facet, lang AS value, count(*) AS count FROM wch GROUP BY ALL
UNION ALL SELECT query_id, 'source', source, count(*) FROM wch GROUP BY ALL
UNION ALL SELECT query_id, 'author', CAST(author_id AS VARCHAR), count(*) FROM wch GROUP BY ALL""")
def q_facets(spark, sf):
    return gr.facets(wc_hits(spark, sf), [("lang", "attr", "lang"), ("source", "attr", "source"),
                                         ("author", "attr", "author_id")])


@register("facets_mva", f"""WITH {ENTRIES_SQL}
SELECT 1 AS query_id, 'tag' AS facet, CAST(t AS VARCHAR) AS value, count(*) AS count FROM (SELECT unnest(tag) AS t FROM entries) GROUP BY ALL
UNION ALL SELECT 1, 'month', strftime(o_orderdate, '%Y%m'), count(*) FROM entries GROUP BY ALL""")
def q_facets_mva(spark, sf):
    return gr.facets(entry_hits(spark, sf), [("tag", "attr", "tag"), ("month", "month", "o_orderdate")])


@register("tag_cloud", """WITH c AS (SELECT l_partkey AS tag_id, count(DISTINCT l_orderkey) AS entry_count FROM lineitem
 WHERE l_linestatus = 'O' GROUP BY l_partkey),
t AS (SELECT p_partkey AS tag_id, p_name AS name, entry_count FROM part JOIN c ON c.tag_id = p.p_partkey)
SELECT tag_id, name, entry_count, rank FROM (SELECT *, row_number() OVER (ORDER BY entry_count DESC, name, tag_id) AS rank FROM t)
WHERE rank <= 50""".replace("FROM part JOIN", "FROM part p JOIN"))
def q_tag_cloud(spark, sf):
    c = gr.tag_cloud(st.tags(spark, sf), st.object_tags(spark, sf), "entry", limit=50)
    return c.select("tag_id", "name", "entry_count", F.col("rank").cast("long"))


@register("tag_cloud_category", f"""WITH {_CATS_SQL},
pairs AS (SELECT DISTINCT l.l_partkey AS tag_id, cats.id AS category_id FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN cats ON cats.label = c.c_mktsegment),
ok AS (SELECT DISTINCT tag_id FROM pairs WHERE category_id IN (SELECT id FROM cats WHERE basename = 'building')),
c AS (SELECT l_partkey AS tag_id, count(DISTINCT l_orderkey) AS entry_count FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_partkey)
SELECT p.p_partkey AS tag_id, p.p_name AS name, c.entry_count FROM part p JOIN c ON c.tag_id = p.p_partkey
WHERE p.p_partkey IN (SELECT tag_id FROM ok)""")
def q_tag_cloud_category(spark, sf):
    cats = st.categories(spark, sf)
    pairs = lk.tag_category_pairs(st.tags(spark, sf), st.object_tags(spark, sf), st.placements(spark, sf))
    ids = cats.where(F.col("basename") == "building").select(F.col("id").alias("category_id"))
    return gr.tag_cloud(st.tags(spark, sf), st.object_tags(spark, sf), "entry", pairs=pairs, category_ids=ids).select(
        "tag_id", "name", "entry_count")


# =============================================================================================
# 2.8 projection, overrides, results

from quarry.operators import results as rs  # noqa: E402


@register("select_list", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}
SELECT query_id, doc_id, weight * 2 AS w2, author_id FROM wch""")
def q_select_list(spark, sf):
    h = wc_hits(spark, sf)
    return rs.select_list(h, "query_id, doc_id, weight * 2 AS w2, author_id")


_LABEL_OVR = "lbl AS (SELECT doc_id, CAST(quality * 100 + toxic AS BIGINT) AS value FROM labels)"


@register("override_attr", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()}, {_LABEL_OVR}
SELECT query_id, doc_id, coalesce(lbl.value, author_id) AS author_id FROM wch LEFT JOIN lbl USING (doc_id)
WHERE coalesce(lbl.value, author_id) IN (100, 101, 5)""")
def q_override_attr(spark, sf):
    idx = corpus_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    ov = st.table(spark, sf, "labels").select("doc_id", (F.col("quality") * 100 + F.col("toxic")).alias("value"))
    docs = rs.override_attr(idx.docs, "author_id", ov)
    h = rk.rank(idx, q, mt.match_all(idx, q), "wordcount").join(docs, "doc_id")
    return fl.filter_values(h, "author_id", [100, 101, 5]).select("query_id", "doc_id", "author_id")


@register("update_attributes", f"""WITH {o.CORPUS}, {_LABEL_OVR}
SELECT c.doc_id, CASE WHEN lbl.doc_id IS NOT NULL THEN lbl.value ELSE c.author_id END AS author_id FROM corpus c LEFT JOIN lbl USING (doc_id)""")
def q_update_attributes(spark, sf):
    st.prep(spark)
    docs = st.corpus(spark, sf).select("doc_id", "author_id")
    ch = st.table(spark, sf, "labels").select("doc_id", (F.col("quality") * 100 + F.col("toxic")).alias("author_id"))
    new, _ = rs.update_attributes(docs, ch, ["author_id"])
    return new


@register("update_attributes_count", f"""WITH {o.CORPUS} SELECT count(*) AS updated FROM corpus WHERE doc_id IN (SELECT doc_id FROM labels)""")
def q_update_attributes_count(spark, sf):
    st.prep(spark)
    docs = st.corpus(spark, sf).select("doc_id", "author_id")
    ch = st.table(spark, sf, "labels").select("doc_id", (F.col("quality") * 100 + F.col("toxic")).alias("author_id"))
    return rs.update_attributes(docs, ch, ["author_id"])[1]


@register("hydrate", f"""WITH {o.INDEX}, {QV(Q_TERMS)}, {_wc_sql()},
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, doc_id) AS rank FROM wch),
pg AS (SELECT query_id, doc_id, weight FROM r WHERE rank <= 20)
SELECT pg.query_id, pg.doc_id, d.n_chars, lpad(CAST(row_number() OVER (PARTITION BY pg.query_id ORDER BY pg.weight DESC, pg.doc_id) - 1 AS VARCHAR), 4, '0') AS result_index
FROM pg JOIN documents d USING (doc_id)""")
def q_hydrate(spark, sf):
    page = _top(spark, sf, "relevance", limit=20)
    rows = st.table(spark, sf, "documents").select("doc_id", "n_chars")
    return rs.hydrate(page, rows, "doc_id").select("query_id", "doc_id", "n_chars", "result_index")


@register("search_categories", f"""WITH {_CATS_SQL} SELECT id, basename, label FROM cats WHERE basename IN ('building', 'machinery')""")
def q_search_categories(spark, sf):
    return rs.search_categories(st.categories(spark, sf), CATEGORY_NAMES).select("id", "basename", "label")


_KW = "tion"


@register("excerpt_kwic", f"""WITH {o.INDEX},
mt AS (SELECT DISTINCT doc_id FROM postings WHERE term = '{_KW}'),
tk AS (SELECT c.doc_id, {o.words_sql('c.body')} AS t FROM corpus c JOIN mt USING (doc_id))
SELECT doc_id, CASE WHEN list_contains(t, '{_KW}') THEN array_to_string(list_transform(
   list_slice(t, greatest(list_position(t, '{_KW}') - 9, 1), list_position(t, '{_KW}') + 9),
   lambda x: CASE WHEN x = '{_KW}' THEN '<b>' || x || '</b>' ELSE x END), ' ')
 ELSE array_to_string(list_slice(t, 1, 19), ' ') END AS excerpt FROM tk""")
def q_excerpt_kwic(spark, sf):
    idx = corpus_index(spark, sf)
    m = mt.match_all(idx, qtable(spark, [(1, 0, _KW)])).select("doc_id")
    return rs.excerpt_kwic(m, idx.texts, [_KW], ["body"]).select("doc_id", "excerpt")


@register("excerpt_kwic_phrase")
def q_excerpt_kwic_phrase(spark, sf):
    idx = corpus_index(spark, sf)
    m = mt.match_phrase(idx, qtable(spark, [(1, 0, "of"), (1, 1, "the")])).select("doc_id")
    return rs.excerpt_kwic(m, idx.texts, ["of", "the"], ["body"]).select("doc_id", "excerpt")


@register("build_excerpts")
def q_build_excerpts(spark, sf):
    st.prep(spark)
    t = st.corpus(spark, sf).select("doc_id", "body")
    return rs.build_excerpts(t, "body", ["of", "the"])


@register("build_excerpts_options")
def q_build_excerpts_options(spark, sf):
    st.prep(spark)
    t = st.corpus(spark, sf).select("doc_id", "body")
    return rs.build_excerpts(t, "body", ["of", "the"], exact_phrase=True, single_passage=True, around=3,
                             before="[", after="]", limit=120)


# =============================================================================================
# 1.14-1.17 docsets and index files



@register("write_docset", f"""WITH {ENTRIES_SQL} SELECT doc_id, author_id, o_orderstatus, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate,
 array_to_string(tag, ',') AS tag FROM entries""")
def q_write_docset(spark, sf):
    e = st.entries(spark, sf).select(
        "doc_id", "author_id", "o_orderstatus", "o_orderdate", "tag")
    st.prep(spark)
    path = scratch_path(spark, "docset-main")
    ds.write_docset(e, path)
    # what was written, read back as text fields
    sch = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("author_id", T.LongType()),
                        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderdate", T.LongType()),
                        T.StructField("tag", T.StringType())])
    return spark.read.schema(sch).format("xml").option("rowTag", ds.ROW_TAG).load(path).select(
        "doc_id", "author_id", "o_orderstatus", "o_orderdate", F.coalesce("tag", F.lit("")).alias("tag"))


@register("read_docset", f"""WITH {ENTRIES_SQL} SELECT doc_id, author_id, o_orderstatus, {mva_text_sql('tag')} AS tag FROM entries""")
def q_read_docset(spark, sf):
    st.prep(spark)
    e = st.entries(spark, sf).select("doc_id", "author_id", "o_orderstatus", "tag")
    path = scratch_path(spark, "docset-read")
    ds.write_docset(e, path)
    sch = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("author_id", T.LongType()),
                        T.StructField("o_orderstatus", T.StringType()),
                        T.StructField("tag", T.ArrayType(T.LongType()))])
    back = ds.read_docset(spark, path, sch, mva_cols=("tag",))
    return back.select("doc_id", "author_id", "o_orderstatus", mva_text("tag").alias("tag"))


def _stored_index(spark, sf):
    idx = corpus_index(spark, sf)
    path = scratch_path(spark, "index-entry")
    io.write_index(idx, path)
    return io.read_index(spark, path)


@register("write_index", f"""WITH {o.INDEX} SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM postings GROUP BY term""")
def q_write_index(spark, sf):
    return _stored_index(spark, sf).vocabulary()


@register("read_index", SQL["match_all"])
def q_read_index(spark, sf):
    stored = _stored_index(spark, sf)
    q = qtable(spark, Q_TERMS)
    return mt.match_all(stored, q)


# =============================================================================================
# 2.9 streaming

from quarry.streaming import delta as sd  # noqa: E402
from quarry.streaming import latest as sl  # noqa: E402


def _corpus_from_batch(batch: DataFrame) -> DataFrame:
    """Stand-in columns for a micro-batch of ``documents`` rows (same as ``standins.corpus``)."""
    return batch.select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body"), "lang", "source",
        (F.col("doc_id") % st.N_AUTHORS).alias("author_id"))


@register("stream_delta_index", f"""WITH {o.INDEX} SELECT term, doc_id, field, pos FROM postings""")
def q_stream_delta_index(spark, sf):
    st.prep(spark)
    schema = st.table(spark, sf, "documents").schema
    out = scratch_path(spark, "stream-delta")
    s = sd.read_table_stream(spark, sf, "documents", schema)
    q = sd.stream_delta_index(s, ("title", "body"), out, scratch_path(spark, "stream-delta-ckpt"),
                              prepare=_corpus_from_batch, available_now=True)
    q.awaitTermination()
    idx = sd.read_stream_index(spark, out, ("title", "body"))
    return idx.postings.select("term", "doc_id", "field", F.col("pos").cast("long").alias("pos"))


@register("stream_compact", f"""WITH {o.CORPUS}, {_DELTA_CORPUS},
fields AS (SELECT doc_id, 'title' AS field, title AS txt FROM corpus2 UNION ALL SELECT doc_id, 'body' AS field, body AS txt FROM corpus2),
{o.TOKS}, {o.POSTINGS}
SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM postings GROUP BY term""")
def q_stream_compact(spark, sf):
    st.prep(spark)
    attrs = ["lang", "source", "author_id", "created_on"]
    main = ix.build_index("entry", st.corpus(spark, sf), ("title", "body"), "doc_id", attrs=attrs)
    delta = ix.build_index("entry_delta", delta_docs(spark, sf), ("title", "body"), "doc_id", attrs=attrs)
    once = sd.compact(main, delta, scratch_path(spark, "compact"))
    return sd.compact(once, delta, scratch_path(spark, "compact-again")).vocabulary()  # main is a stored index now


@register("stream_dedup", """SELECT user_id, event_type, epoch_us(ts) AS ts_us, event_id, value, props FROM (SELECT *, row_number() OVER (
 PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC, props DESC) AS r FROM events) WHERE r = 1""")
def q_stream_dedup(spark, sf):
    """Three parts: the first and second half of the events, then the oldest day again, too late. Every part arrives as
    all its files in one run of the query, and the runs share the checkpoint."""
    st.prep(spark)
    ev = st.table(spark, sf, "events")
    src, out, ckpt = (scratch_path(spark, f"dedup-{n}") for n in ("source", "out", "ckpt"))
    lo, hi = (ev.agg(f("ts")).scalar() for f in (F.min, F.max))
    mid = F.timestamp_seconds((F.unix_timestamp(lo) + F.unix_timestamp(hi)) / 2).cast("timestamp_ntz")
    day = F.make_dt_interval(F.lit(1))
    for part in (F.col("ts") < mid, F.col("ts") >= mid, F.col("ts") < lo + day):
        ev.where(part).write.mode("append").parquet(src)
        sd.run_versions(sd.stream_dedup(sd.read_stream(spark, src, ev.schema), ["user_id", "event_type"], "ts"), out, ckpt,
                        available_now=True).awaitTermination()
    r = sd.latest_versions(spark.read.parquet(out), ["user_id", "event_type"], "ts")
    return r.select("user_id", "event_type", F.unix_micros("ts").alias("ts_us"), "event_id", "value", "props")


@register("stream_latest", SQL["stream_dedup"])
def q_stream_latest(spark, sf):
    """As ``stream_dedup`` with one state row per key. Every part arrives as all its files in one run of the query, and the
    runs share the checkpoint."""
    st.prep(spark)
    ev = st.table(spark, sf, "events")
    src, out, ckpt = (scratch_path(spark, f"latest-{n}") for n in ("source", "out", "ckpt"))
    lo, hi = (ev.agg(f("ts")).scalar() for f in (F.min, F.max))
    mid = F.timestamp_seconds((F.unix_timestamp(lo) + F.unix_timestamp(hi)) / 2).cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    for part in (F.col("ts") < mid, F.col("ts") >= mid, F.col("ts") < lo + F.make_dt_interval(F.lit(1))):
        ev.where(part).write.mode("append").parquet(src)
        sd.run_versions(sl.stream_latest(sd.read_stream(spark, src, ev.schema), keys, "ts"), out, ckpt,
                        available_now=True).awaitTermination()
    r = sd.latest_versions(spark.read.parquet(out), keys, "ts")
    return r.select(*keys, F.unix_micros("ts").alias("ts_us"), "event_id", "value", "props")


@register("stream_facets", """SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start,
 CAST(epoch(date_trunc('day', ts) + INTERVAL 1 DAY) AS BIGINT) AS window_end, event_type, count(*) AS count
FROM events GROUP BY ALL""")
def q_stream_facets(spark, sf):
    st.prep(spark)
    schema = st.table(spark, sf, "events").schema
    s = sd.read_table_stream(spark, sf, "events", schema)
    f = sd.stream_facets(s, "ts", ["event_type"], window="1 day")
    return spark.read.parquet(sd.run_to_sink(f, "facets"))


@register("stream_facets_session")
def q_stream_facets_session(spark, sf):
    st.prep(spark)
    schema = st.table(spark, sf, "events").schema
    s = sd.read_table_stream(spark, sf, "events", schema)
    f = sd.stream_facets(s, "ts", ["user_id"], session_gap="2 hours")
    return spark.read.parquet(sd.run_to_sink(f, "facets-session"))


@register("stream_alerts", SQL["match_all"])
def q_stream_alerts(spark, sf):
    st.prep(spark)
    schema = st.table(spark, sf, "documents").schema
    out = scratch_path(spark, "alerts")
    s = sd.read_table_stream(spark, sf, "documents", schema)
    q = sd.stream_alerts(s, qtable(spark, Q_TERMS), ("title", "body"), out, scratch_path(spark, "alerts-ckpt"),
                         prepare=_corpus_from_batch, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).select("query_id", "doc_id")


# =============================================================================================
# 2.10 extension surface

from quarry.plans import surface as sfc  # noqa: E402


@register("filter_hooks", f"""WITH {o.CORPUS} SELECT doc_id FROM corpus WHERE lang = 'en' AND epoch(created_on) BETWEEN
 epoch(strptime('{DATE_START}0000', '%Y%m%d%H%M%S')) AND epoch(strptime('{DATE_END}0000', '%Y%m%d%H%M%S')) AND author_id <> 0""")
def q_filter_hooks(spark, sf):
    hooks = sfc.FilterHooks()
    hooks.register("lang", lambda d, v: fl.filter_string(d, "lang", [v]), when="lang")
    hooks.register("date", lambda d, v: fl.filter_date_range(d, v[0], v[1]), when="date")
    hooks.register("no_author_zero", lambda d: fl.filter_values(d, "author_id", [0], exclude=True))
    return _ids(hooks.apply(corpus_hits(spark, sf), {"lang": "en", "date": (DATE_START, DATE_END)}))


@register("sql_surface", f"""WITH {o.INDEX}, {_PHRASE_OF_THE},
ma AS (SELECT doc_id FROM postings WHERE term IN ('of', 'the') GROUP BY doc_id HAVING count(DISTINCT term) = 2)
SELECT doc_id, doc_id IN (SELECT doc_id FROM ph) AS is_phrase FROM ma""")
def q_sql_surface(spark, sf):
    idx = corpus_index(spark, sf)
    sfc.register_sql(spark, idx)
    return spark.sql("""SELECT m.doc_id, m.doc_id IN (SELECT doc_id FROM entry_phrase2('of', 'the')) AS is_phrase
                        FROM entry_match_all2('of', 'the') m""")


# extended2 is the same matcher as extended (engine version only)
register("match_extended2", SQL["match_extended_field"])(q_match_extended_field)


def _excerpt_sql(words: list[str], around: int = 5, limit: int = 256, before: str = "<b>", after: str = "</b>",
                 separator: str = " ... ", exact_phrase: bool = False, single_passage: bool = False, boundary: str = "") -> str:
    kw = "[" + ", ".join(repr(w) for w in words) + "]"
    if exact_phrase:
        m = len(words)
        at = " AND ".join([f"t[i + {k}] = {w!r}" for k, w in enumerate(words)] + ([f"g[i] = g[i + {m - 1}]"] if boundary else []))
        hits = (f"list_sort(list_distinct(flatten(list_transform(list_filter(range(1, len(t) - {m - 2}), lambda i: {at}), "
                f"lambda s0: range(s0, s0 + {m})))))")
    else:
        hits = f"list_filter(range(1, len(t) + 1), lambda i: list_contains({kw}, t[i]))"
    # best passage first: most hits, then earliest
    pick = ("list_transform(list_slice(list_sort(list_transform(spans, lambda x: {'k': -x.n, 's': x.s, 'e': x.e})), 1, 1), "
            "lambda x: {'s': x.s, 'e': x.e, 'n': -x.k})") if single_passage else "spans"
    # g: the sentence or paragraph of every word
    split = (f"tk AS (SELECT doc_id, flatten(ws) AS t, flatten(list_transform(range(1, len(ws) + 1), lambda i: list_transform(ws[i], lambda w: i))) AS g "
             f"FROM (SELECT doc_id, list_transform(regexp_split_to_array(body, '{boundary}'), lambda s: {o.words_sql('s')}) AS ws FROM corpus))"
             if boundary else f"tk AS (SELECT doc_id, {o.words_sql('body')} AS t, CAST([] AS BIGINT[]) AS g FROM corpus)")
    apart = f" OR g[p] <> g[acc[len(acc)].e - {around}]" if boundary else ""
    window = "range(greatest(sp.s, 1), least(sp.e, len(t)) + 1)"
    if boundary:
        window = f"list_filter({window}, lambda i: g[i] = g[sp.e - {around}])"
    return f"""WITH {o.CORPUS},
{split},
hp AS (SELECT doc_id, t, g, {hits} AS h FROM tk),
sp0 AS (SELECT doc_id, t, g, h, list_reduce(h, lambda acc, p:
   CASE WHEN len(acc) = 0 OR p - {around} > acc[len(acc)].e + 1{apart}
        THEN list_append(acc, {{'s': p - {around}, 'e': p + {around}, 'n': 1}})
        ELSE list_append(list_slice(acc, 1, len(acc) - 1), {{'s': acc[len(acc)].s, 'e': p + {around}, 'n': acc[len(acc)].n + 1}}) END,
   CAST([] AS STRUCT(s BIGINT, e BIGINT, n BIGINT)[])) AS spans FROM hp),
sp AS (SELECT doc_id, t, g, h, {pick} AS spans FROM sp0),
pa AS (SELECT doc_id, spans, list_transform(spans, lambda sp: list_transform(
   {window},
   lambda i: CASE WHEN list_contains(h, i) THEN '{before}' || t[i] || '{after}' ELSE t[i] END)) AS ws FROM sp),
fi AS (SELECT doc_id, spans, ws, list_reduce(list_transform(ws[1], lambda w: {{'s': w, 'o': length(w) <= {limit}}}), lambda a, x:
   CASE WHEN a.o AND length(a.s) + 1 + length(x.s) <= {limit} THEN {{'s': a.s || ' ' || x.s, 'o': true}} ELSE {{'s': a.s, 'o': false}} END) AS f FROM pa)
SELECT doc_id, CASE WHEN len(spans) > 0 THEN list_reduce(list_slice(ws, 2, len(ws)), lambda acc, p:
   CASE WHEN length(acc) + {len(separator)} + length(p) <= {limit} THEN acc || '{separator}' || p ELSE acc END,
   CASE WHEN length(f.s) <= {limit} THEN f.s ELSE '' END) END AS excerpt FROM (SELECT doc_id, spans, f, list_transform(ws, lambda w: array_to_string(w, ' ')) AS ws FROM fi)"""


SQL["build_excerpts"] = _excerpt_sql(["of", "the"])
SQL["build_excerpts_options"] = _excerpt_sql(["of", "the"], exact_phrase=True, single_passage=True, around=3,
                                                before="[", after="]", limit=120)


SQL["excerpt_kwic_phrase"] = f"""WITH {o.INDEX},
m AS (SELECT DISTINCT a.doc_id FROM postings a JOIN postings b ON a.doc_id = b.doc_id AND a.field = b.field
      AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the'),
tk AS (SELECT c.doc_id, {o.words_sql('c.body')} AS t FROM corpus c JOIN m USING (doc_id)),
st AS (SELECT doc_id, t, list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the') AS starts FROM tk),
fw AS (SELECT doc_id, t, starts, starts[1] AS first, greatest(starts[1] - 9, 1) AS s FROM st)
SELECT doc_id, CASE WHEN first IS NOT NULL THEN array_to_string(list_transform(range(s, least(first + 10, len(t)) + 1),
   lambda i: CASE WHEN list_contains(starts, i) OR list_contains(starts, i - 1) THEN '<b>' || t[i] || '</b>' ELSE t[i] END), ' ')
 ELSE array_to_string(list_slice(t, 1, 19), ' ') END AS excerpt FROM fw"""


SQL["stream_facets_session"] = """WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
    OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS new_s FROM events),
s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS window_start, CAST(floor(epoch(max(ts) + INTERVAL 2 HOUR)) AS BIGINT) AS window_end,
 user_id, count(*) AS count FROM s GROUP BY user_id, sid"""
