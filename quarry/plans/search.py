"""``search()``: the whole query as one lazy plan (match -> rank -> filter -> group/sort -> limit).

Returns three DataFrames: ``hits`` (one page of matches per query: doc_id, weight, attributes,
rank; in group mode one row per group with ``group`` and ``count``), ``totals`` (query_id,
total_found, total) and ``words`` (query_id, term, docs, hits). Nothing is collected between
stages; Catalyst pushes attribute filters below the join with the match set.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import filters as flt
from quarry.operators import group as grp
from quarry.operators import match as mt
from quarry.operators import order as od
from quarry.operators import rank as rk
from quarry.operators.index import Index, normalize_queries, query_word_stats
from quarry.operators.results import RESULT_INDEX_FORMAT, override_attr
from quarry.session import local_table
from quarry.spec import SearchSpec


@dataclass
class SearchResult:
    hits: DataFrame
    totals: DataFrame
    words: DataFrame | None
    matches: DataFrame  # all ranked, filtered matches before the page limit (lazy)


def matched_docs(idx: Index, queries: DataFrame | None, spec: SearchSpec, query_id: int = 1) -> DataFrame:
    if spec.expr is not None or spec.mode in ("boolean", "extended", "extended2"):
        return mt.match_boolean(idx, spec.expr, query_id)
    return mt.match(idx, queries, spec.mode, query_id)


def ranked_hits(idx: Index, queries: DataFrame | None, spec: SearchSpec, query_id: int = 1, text_filter_level: int = 0,
                forced: tuple = (), hooks: list | None = None) -> DataFrame:
    """All matches of one index with weight and attributes, filtered. Attribute filters cut the match set
    before it is ranked, or the ranked documents where matching and ranking are one pass."""
    filters = list(spec.filters)
    ranker = "none" if (spec.mode == "fullscan" or queries is None) else spec.ranker
    if spec.mode == "any" and ranker == "proximity_bm25":
        ranker = "matchany"
    # words matched and ranked by one read of their lists, unless the match set itself is cut first
    at_once = (queries is not None and spec.mode in ("all", "any", "phrase") and spec.expr is None and not spec.cutoff
               and not text_filter_level and ranker != "none")
    m = None
    if not at_once:
        m = matched_docs(idx, queries, spec, query_id)
        if spec.cutoff:
            m = od.cutoff(m, spec.cutoff)
        if text_filter_level:
            asked = flt.filter_words(idx.name, filters, text_filter_level, forced)
            held = idx.lists_for(local_table(m.sparkSession, [(w,) for w in asked], "term string")) if asked else idx.term_docs()
            m, filters = flt.filter_text(held, m, idx.name, filters, text_filter_level, forced)
    docs = idx.docs
    for attr, values in spec.overrides:
        docs = override_attr(docs, attr, values)
    if spec.geo_anchor is not None:
        la, lo, la0, lo0 = spec.geo_anchor
        docs = docs.withColumn("geodist", flt.geo_distance(la, lo, la0, lo0))
    late = [f for f in filters if f.attr in od.SPECIAL or f.attr == "weight"]  # on the weight itself
    filters = [f for f in filters if f not in late]
    for f in filters:
        docs = flt.apply_filter(docs, f)
    if at_once:
        ranked = rk.match_and_rank(idx, queries, spec.mode, ranker, dict(spec.field_weights) or None)
    else:
        if filters:
            m = m.join(docs.select("doc_id"), "doc_id", "left_semi")
        ranked = rk.rank(idx, queries, m, ranker, dict(spec.field_weights) or None)
    hits = ranked.join(docs, "doc_id")
    for f in late:
        hits = flt.apply_filter(hits, replace(f, attr=od.SPECIAL.get(f.attr, f.attr)))
    for hook in hooks or []:
        hits = hits.transform(hook)
    weight = dict(spec.index_weights).get(idx.name)
    return hits if weight is None else hits.withColumn("weight", F.col("weight") * F.lit(weight))


def search(idx: Index | dict[str, Index], queries: DataFrame | None, spec: SearchSpec = SearchSpec(), query_id: int = 1,
           text_filter_level: int = 0, forced: tuple = (), hooks: list | None = None) -> SearchResult:
    """One search over one index, or over several (a dict of named indexes): there a document keeps its best
    weight, then its first index, and ``index_name`` says which. Query words are normalized as the index's
    words were. An attribute sort without ``sort_by`` uses the default attribute of the index (name); a negative
    ``max_matches`` stands for the number of documents that can match at all; ``tags`` replaces the search words by a
    filter on tag names."""
    several = idx if isinstance(idx, dict) else {idx.name: idx}
    if spec.tags is not None:
        tag_table, names, attr = spec.tags
        queries, spec = None, spec.with_(mode="fullscan", expr=None)
        hooks = [lambda h: flt.filter_tags(h, tag_table, names, attr), *(hooks or [])]
    if spec.sort_mode in ("attr_desc", "attr_asc", "desc", "asc") and not spec.sort_by:
        spec = spec.with_(sort_by=od.default_sort(",".join(several)))

    def normalized(x: Index):
        return None if queries is None else normalize_queries(queries, x.morphology)

    parts = [ranked_hits(x, normalized(x), spec, query_id, text_filter_level, forced, hooks) for x in several.values()]
    if len(parts) == 1:
        hits = parts[0]
    else:
        tagged = [h.withColumn("index_name", F.lit(n)) for n, h in zip(several, parts, strict=True)]
        hits = best_of_indexes(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged))
    released = None
    if spec.max_matches < 0:
        released = reduce(lambda a, b: a + b, [x.docs.agg(F.count(F.lit(1))).scalar() for x in several.values()])
    offset, limit, mx = od.limits(spec.offset, spec.limit, spec.max_matches, released=released)
    if spec.group_func:
        page = grp.grouped_search(hits, spec.group_func, spec.group_by, spec.sort_mode, spec.sort_by,
                                  spec.group_sort, spec.group_distinct, offset, limit, spec.as_of)
        totals = grp.group_totals(hits, spec.group_func, spec.group_by).withColumn("total", od.capped("total_found", mx))
    else:
        keys = od.sort_keys(spec.sort_mode, spec.sort_by, spec.as_of)
        page = od.top_per_query(hits, keys, offset, limit)
        totals = od.result_totals(hits, mx)
    if spec.select and spec.select.strip() != "*":
        page = page.selectExpr("query_id", *od.split_select(od.special_names(spec.select)))
    words = None if queries is None else reduce(lambda a, b: a.unionByName(b), [
        query_word_stats(normalized(x), x.word_counts(normalized(x))) for x in several.values()])
    if words is not None and len(several) > 1:  # a word's counts are summed over the indexes
        words = words.groupBy("query_id", "term").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))
    return SearchResult(page, totals, words, hits)


def best_of_indexes(hits: DataFrame) -> DataFrame:
    """One row per (query, document) of hits tagged with ``index_name``: the best weight, then the first name (at
    most one row per index to choose from)."""
    w = Window.partitionBy("query_id", "doc_id").orderBy(F.col("weight").desc(), F.col("index_name").asc())
    return hits.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def hydrate_indexes(page: DataFrame, rows: dict[str, DataFrame], rows_id: str = "id") -> DataFrame:
    """Full source rows of a several-index page: each index's hits meet that index's own table."""
    w = Window.partitionBy("query_id").orderBy(F.col("weight").desc(), F.col("doc_id").asc())
    page = page.withColumn("result_index", F.format_string(RESULT_INDEX_FORMAT, F.row_number().over(w) - 1))
    parts = []
    for name, table in rows.items():
        own = page.where(F.col("index_name") == name)
        table = table.withColumnRenamed(rows_id, "doc_id") if rows_id != "doc_id" else table
        parts.append(own.join(table.drop(*(c for c in table.columns if c in own.columns and c != "doc_id")), "doc_id"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---------------------------------------------------------------------------------------------
# several indexes


class IndexRegistry(dict):
    """Named indexes; the first declaration of a name wins, an unknown name is an error."""

    def declare(self, idx: Index) -> Index:
        return self.setdefault(idx.name, idx)

    def resolve(self, names) -> dict[str, Index]:
        if isinstance(names, str):
            names = [n.strip() for n in names.split(",") if n.strip()]
        missing = [n for n in names if n not in self]
        if missing:
            raise KeyError(f"unknown index {missing}")
        return {n: self[n] for n in names}


def search_indexes(indexes: dict[str, Index], queries: DataFrame, mode: str = "all", ranker: str = "wordcount",
                   index_weights: dict | None = None, field_weights: dict | None = None) -> DataFrame:
    """Match and rank in every index, tag rows with ``index_name``, weight by index, and keep one
    row per (query, document): the best weight, then the first index name."""
    parts = []
    for name, idx in indexes.items():
        m = mt.match(idx, queries, mode)
        parts.append(rk.rank(idx, queries, m, ranker, field_weights).withColumn("index_name", F.lit(name)))
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return best_of_indexes(rk.apply_index_weights(u, index_weights))
