"""Extension surface: user filter steps and the SQL face of an index.

* Filter hooks: named DataFrame -> DataFrame steps run in registration order after the built-in
  filters (the reference's tag, category, date and author callbacks are the built-in four).
* SQL: an index registered as temp views plus SQL table functions, so the same operators run from
  ``spark.sql``. Catalyst plans them like the DataFrame forms.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.index import Index
from quarry.spec import BM25_B, BM25_K1


class FilterHooks:
    """Ordered filter steps; ``when`` names the request parameter that switches a step on."""

    def __init__(self):
        self._steps: list[tuple[str, str | None, Callable[..., DataFrame]]] = []

    def register(self, name: str, fn: Callable[..., DataFrame], when: str | None = None) -> None:
        if any(n == name for n, _, _ in self._steps):
            return  # first registration of a name wins
        self._steps.append((name, when, fn))

    def apply(self, hits: DataFrame, params: dict | None = None) -> DataFrame:
        params = params or {}
        for _name, when, fn in self._steps:
            if when is None:
                hits = hits.transform(fn)
            elif params.get(when):
                hits = hits.transform(lambda d, fn=fn, v=params[when]: fn(d, v))
        return hits

    @property
    def names(self) -> list[str]:
        return [n for n, _, _ in self._steps]


def register_sql(spark: SparkSession, idx: Index) -> list[str]:
    """Expose ``idx`` to SQL: views ``<name>_docs``, ``<name>_postings``, ``<name>_vocab`` and table
    functions ``<name>_match_any(w)``, ``<name>_match_all2(w1, w2)``, ``<name>_phrase2(w1, w2)``, and over an
    array of words ``<name>_match_all``, ``<name>_match_words`` (any), ``<name>_phrase``, ``<name>_near(ws, n)`` (all words within n
    words of a field), ``<name>_match_boolean(every, some, no)`` (an empty array asks nothing) and the rankers
    ``<name>_rank_wordcount``, ``_rank_bm25``, ``_rank_proximity`` and ``_rank_proximity_bm25`` of ``operators.rank``.
    Filters, grouping and limits are plain SQL over the results joined to ``<name>_docs``."""
    n = idx.name
    idx.docs.createOrReplaceTempView(f"{n}_docs")
    idx.postings.createOrReplaceTempView(f"{n}_postings")
    idx.vocabulary().createOrReplaceTempView(f"{n}_vocab")
    idx.lists().select("term", "doc_id", "tf", "dl").createOrReplaceTempView(f"{n}_lists")
    count, mean = idx.stats()
    spark.range(1).select(count.alias("n_docs"), mean.alias("avgdl")).createOrReplaceTempView(f"{n}_stats")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_match_any(w STRING)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT DISTINCT doc_id FROM {n}_postings WHERE term = w""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_match_all2(w1 STRING, w2 STRING)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT doc_id FROM {n}_postings WHERE term IN (w1, w2)
               GROUP BY doc_id HAVING count(DISTINCT term) = 2""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_phrase2(w1 STRING, w2 STRING)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT DISTINCT a.doc_id FROM {n}_postings a JOIN {n}_postings b
               ON a.doc_id = b.doc_id AND a.field = b.field AND b.pos = a.pos + 1
               WHERE a.term = w1 AND b.term = w2""")
    # words as an array: any number of them
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_match_all(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT doc_id FROM {n}_postings WHERE array_contains(ws, term)
               GROUP BY doc_id HAVING count(DISTINCT term) = max(size(array_distinct(ws)))""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_match_words(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT DISTINCT doc_id FROM {n}_postings WHERE array_contains(ws, term)""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_phrase(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT DISTINCT doc_id FROM (
               SELECT doc_id, field, pos - q AS diag, q, size(ws) AS m FROM (
                 SELECT doc_id, field, pos, explode(filter(sequence(0, size(ws) - 1), i -> ws[i] = term)) AS q
                 FROM {n}_postings WHERE array_contains(ws, term)))
               GROUP BY doc_id, field, diag HAVING count(DISTINCT q) = max(m)""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_rank_wordcount(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT, weight BIGINT)
        RETURN SELECT doc_id, count(*) AS weight FROM {n}_postings WHERE array_contains(ws, term) GROUP BY doc_id""")
    # a field's occurrences as one array of numbers (position, then word), read in order of position: a word stands last at
    # ``last``, and where all words stand last within w words of an occurrence, they lie in one window
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_near(ws ARRAY<STRING>, w INT)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT DISTINCT doc_id FROM (
               SELECT doc_id, max(m) AS m, max(w) AS w, array_sort(collect_set(pos * m + k)) AS occ FROM (
                 SELECT doc_id, field, CAST(pos AS BIGINT) AS pos, size(array_distinct(ws)) AS m, w,
                        array_position(array_distinct(ws), term) - 1 AS k
                 FROM {n}_postings WHERE array_contains(ws, term))
               GROUP BY doc_id, field)
               WHERE aggregate(occ, named_struct('last', array_repeat(CAST(NULL AS BIGINT), m), 'found', false), (a, o) ->
                 CASE WHEN a.found THEN a ELSE named_struct(
                   'last', transform(a.last, (l, i) -> CASE WHEN i = o % m THEN o div m ELSE l END),
                   'found', forall(sequence(0, m - 1), i -> i = o % m OR coalesce(a.last[i] > o div m - w, false))) END, a -> a.found)""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_match_boolean(every ARRAY<STRING>, some ARRAY<STRING>, no ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT)
        RETURN SELECT doc_id FROM (
               SELECT doc_id, size(array_distinct(every)) AS m, size(some) AS k, array_contains(every, term) AS is_all,
                      array_contains(some, term) AS is_some, array_contains(no, term) AS is_no
               FROM {n}_lists WHERE array_contains(concat(every, some, no), term))
               GROUP BY doc_id HAVING count_if(is_all) = max(m) AND (max(k) = 0 OR bool_or(is_some)) AND NOT bool_or(is_no)""")
    idf = f"ln(1 + ((SELECT n_docs FROM {n}_stats) - v.docs + 0.5D) / (v.docs + 0.5D))"
    bm25 = (f"{idf} * l.tf * {BM25_K1 + 1}D / (l.tf + {BM25_K1}D * ({1 - BM25_B}D + {BM25_B}D * l.dl / (SELECT avgdl FROM {n}_stats)))")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_rank_bm25(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT, weight DOUBLE)
        RETURN SELECT l.doc_id, round(sum(coalesce({bm25}, 0)), 6) AS weight
               FROM {n}_lists l JOIN {n}_vocab v ON v.term = l.term WHERE array_contains(ws, l.term) GROUP BY l.doc_id""")
    runs = f"""SELECT doc_id, max(run) AS lcs FROM (
                 SELECT doc_id, field, count(*) AS run FROM (
                   SELECT doc_id, field, pos - q AS diag, q - row_number() OVER (PARTITION BY doc_id, field, pos - q ORDER BY q) AS island
                   FROM (SELECT doc_id, field, pos, explode(filter(sequence(0, size(ws) - 1), i -> ws[i] = term)) AS q
                         FROM {n}_postings WHERE array_contains(ws, term)))
                 GROUP BY doc_id, field, diag, island) GROUP BY doc_id, field"""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_rank_proximity(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT, weight BIGINT)
        RETURN SELECT doc_id, sum(lcs) AS weight FROM ({runs}) GROUP BY doc_id""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {n}_rank_proximity_bm25(ws ARRAY<STRING>)
        RETURNS TABLE (doc_id BIGINT, weight BIGINT)
        RETURN SELECT p.doc_id, p.px * 1000 + floor(999 * round(b.s / ({BM25_K1 + 1}D * i.sum_idf), 6)) AS weight
               FROM (SELECT doc_id, sum(lcs) AS px FROM ({runs}) GROUP BY doc_id) p
               JOIN (SELECT l.doc_id, 1 AS one, sum(coalesce({bm25}, 0)) AS s FROM {n}_lists l JOIN {n}_vocab v ON v.term = l.term
                     WHERE array_contains(ws, l.term) GROUP BY l.doc_id) b ON b.doc_id = p.doc_id
               JOIN (SELECT 1 AS one, sum({idf}) AS sum_idf FROM {n}_vocab v WHERE array_contains(ws, v.term)) i ON i.one = b.one""")
    words = ["match_all", "match_words", "phrase", "near", "match_boolean", "rank_wordcount", "rank_bm25", "rank_proximity",
             "rank_proximity_bm25", "lists", "stats"]
    return [*(f"{n}_{w}" for w in words), f"{n}_docs", f"{n}_postings", f"{n}_vocab", f"{n}_match_any", f"{n}_match_all2", f"{n}_phrase2"]
