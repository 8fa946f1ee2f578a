"""Ranking: a ``weight`` for every matched (query_id, doc_id).

Signals are expressions over a document's position lists of the query words (one read of the lists, one exchange
that moves position arrays):

* BM25 (k1=1.2, b=0.75, idf ``ln(1 + (N - n + 0.5) / (n + 0.5))``), per document over all fields,
  rounded to 6 places.
* proximity: per field, the longest run of query words in query order (on one diagonal ``pos - qpos``), times the field
  weight, summed over fields.
* wordcount: occurrences per field times the field weight.
* matchany: per field ``lcs * n_terms + distinct words``, times the field weight.
* proximity_bm25: ``proximity * 1000 + floor(999 * bm25 / (2.2 * sum idf))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import positions as ps
from quarry.operators.index import Index
from quarry.session import fits_broadcast
from quarry.spec import BM25_B, BM25_K1


def field_weight_col(field_weights: dict | None, field: str | Column = "field") -> Column:
    """Integer weight per field name; missing names weigh 1, unknown names are ignored."""
    if not field_weights:
        return F.lit(1)
    m = F.create_map(*[x for k, v in field_weights.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(F.element_at(m, F.col(field) if isinstance(field, str) else field), F.lit(1))


def _idf(idx: Index, n: Column) -> Column:
    n_docs, _ = idx.stats()
    return F.log(1 + (n_docs - n + 0.5) / (n + 0.5))


def idf_table(idx: Index, queries: DataFrame) -> DataFrame:
    """``term, idf`` for the distinct words of the queries (document counts of those words only)."""
    return idx.word_counts(queries).select("term", _idf(idx, F.col("docs")).alias("idf"))


def _bm25_part(idf: Column, tf: Column, dl: Column, avgdl: Column) -> Column:
    """A word's share of a document's score; a document with no text words (only attribute words) scores 0."""
    k1, b = BM25_K1, BM25_B
    return F.when(dl.isNull(), F.lit(0.0)).otherwise(idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)))


def _idf_maps(idx: Index, words: DataFrame, g: DataFrame) -> DataFrame:
    """``query_id, idf`` (word number -> idf), ``sum_idf`` and ``avgdl``. Document counts come from the vocabulary; an index without one
    counts them in the gathered rows ``g``, whose exchange the plan reuses, so the lists are read once."""
    if idx._vocab is not None:
        n = words.select("query_id", "term", "w").join(idx.word_counts(words), "term").select("query_id", "w", F.col("docs").alias("n"))
    else:
        n = (g.select("query_id", F.explode(F.transform("words", lambda x: x["w"])).alias("w"))
             .groupBy("query_id", "w").agg(F.count(F.lit(1)).alias("n")))
    n = n.select("query_id", "w", _idf(idx, F.col("n")).alias("idf"))
    return n.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "idf"))).alias("idf"),
                                     F.sum("idf").alias("sum_idf")).withColumn("avgdl", idx.stats()[1])


def lcs_per_field(idx: Index, queries: DataFrame) -> DataFrame:
    """``query_id, doc_id, field, lcs, n_words, hits``: longest in-order run of query words per field.

    Every occurrence lies on the diagonal ``pos - qpos``; a phrase run is a run of consecutive query
    positions on one diagonal."""
    g = ps.gathered(idx.lists(queries), ps.word_table(queries))
    return g.select("query_id", "doc_id", F.inline(ps.field_signals(F.col("words"))))


def _sums(idx: Index, queries: DataFrame, ranker: str, mode: str) -> DataFrame:
    """BM25 or occurrence counts as one plain aggregation over the document lists."""
    words = ps.word_table(queries)
    rows = idx.lists_for(words)
    small = fits_broadcast(queries)
    if small:  # a document's list rows meet before the queries multiply them, so its sums need no further exchange
        rows = rows.repartition("doc_id")
    if ranker == "bm25":
        words = words.join(idf_table(idx, words), "term", "left")
        rows = rows.join(F.broadcast(words) if small else words, "term")
        part = _bm25_part(F.col("idf"), F.col("tf"), F.col("dl"), idx.stats()[1])
    else:
        rows = rows.join(F.broadcast(words) if small else words, "term")
        part = F.col("tf") * F.size("qpos")
    s = rows.groupBy("query_id", "doc_id").agg(F.sum(part).alias("s"), F.count(F.lit(1)).alias("k"), F.first("m").alias("m"))
    s = s.where(F.col("k") == F.col("m")) if mode == "all" else s
    weight = F.round("s", 6) if ranker == "bm25" else F.col("s").cast("double")
    return s.select("query_id", "doc_id", weight.alias("weight"))


def scores(idx: Index, queries: DataFrame, ranker: str, field_weights: dict | None = None, mode: str = "any") -> DataFrame:
    """``query_id, doc_id, weight`` of the documents that match (``mode`` any, all or phrase): match and rank in one read of
    the position lists."""
    if mode != "phrase" and (ranker == "bm25" or (ranker == "wordcount" and not field_weights)):
        return _sums(idx, queries, ranker, mode)
    words = ps.word_table(queries)
    g = ps.gathered(idx.lists(words), words)
    w = F.col("words")
    bm25 = ranker in ("bm25", "proximity_bm25")
    if bm25:  # at most one entry per word of the queries, so their size bounds the table's
        maps = _idf_maps(idx, words, g)
        g = g.join(F.broadcast(maps) if fits_broadcast(queries) else maps, "query_id")
    rows = g
    if mode == "all":
        rows = rows.where(F.size(w) == F.col("m"))
    elif mode == "phrase":
        rows = rows.where(ps.in_some_field(w, lambda fw: ps.holds_phrase(fw, F.col("m"))))
    fw = lambda f: field_weight_col(field_weights, f["field"])
    zero = F.lit(0).cast("long")
    if ranker == "wordcount":
        value = F.aggregate(w, zero, lambda acc, x: acc + F.size(x["qpos"]) * F.aggregate(
            x["at"], zero, lambda a, f: a + F.size(f["pos"]) * fw(f)))
    elif ranker in ("proximity", "matchany", "proximity_bm25"):
        of = (lambda f: f["lcs"] * F.col("m") + f["n_words"]) if ranker == "matchany" else (lambda f: f["lcs"])
        value = F.aggregate(ps.field_signals(w), zero, lambda acc, f: acc + of(f) * fw(f))
    elif ranker != "bm25":
        raise ValueError(f"unknown ranker {ranker!r}")
    if bm25:
        raw = F.aggregate(w, F.lit(0.0), lambda acc, x: acc + _bm25_part(
            F.element_at(F.col("idf"), x["w"]), x["tf"], F.col("dl"), F.col("avgdl")))
        if ranker == "bm25":
            value = F.round(raw, 6)
        else:
            value = value * 1000 + F.floor(999 * F.round(raw / (F.lit(BM25_K1 + 1) * F.col("sum_idf")), 6))
    return rows.select("query_id", "doc_id", value.cast("double").alias("weight"))


def rank(idx: Index, queries: DataFrame | None, matched: DataFrame | None, ranker: str = "proximity_bm25",
         field_weights: dict | None = None) -> DataFrame:
    """``matched`` (query_id, doc_id, ...) plus a ``weight`` column (double).

    ``matched=None`` stands for the any-word match set. Every ranker scores exactly the (query, document) pairs holding
    at least one query word, so that set is the score table itself: no separate match pass and no join back."""
    if matched is None:
        return match_and_rank(idx, queries, "any", ranker, field_weights)
    if queries is None or ranker == "none":
        return matched.withColumn("weight", F.lit(1.0))
    s = scores(idx, queries, ranker, field_weights)
    return matched.join(s, ["query_id", "doc_id"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def match_and_rank(idx: Index, queries: DataFrame, mode: str = "all", ranker: str = "proximity_bm25",
                   field_weights: dict | None = None) -> DataFrame:
    """``query_id, doc_id, weight`` of the documents that match all words, any word or the phrase of each query."""
    if ranker == "none":
        from quarry.operators.match import match

        return match(idx, queries, mode).withColumn("weight", F.lit(1.0))
    return scores(idx, queries, ranker, field_weights, mode)


def apply_index_weights(hits: DataFrame, index_weights: dict | None, index_col: str = "index_name") -> DataFrame:
    """Multiply weights by an integer per index name (missing = 1)."""
    if not index_weights:
        return hits
    m = F.create_map(*[x for k, v in index_weights.items() for x in (F.lit(k), F.lit(int(v)))])
    return hits.withColumn("weight", F.col("weight") * F.coalesce(F.element_at(m, F.col(index_col)), F.lit(1)))
