"""Position lists: what the words of one query say about one document, in one row.

A list row is ``term, doc_id, tf, dl, at`` where ``at`` holds per field the sorted positions of the word and ``dl`` the
document's words over all fields. ``gathered`` joins the lists to the words of the queries and brings a document's
rows together: position arrays move, never single occurrences, and matching, BM25, phrases, runs and spans are all
expressions over that row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_field(occurrences: Column) -> Column:
    """``array<struct<field, pos array>>`` of an array of (field, pos) structs; positions sorted."""
    names = F.array_distinct(F.transform(occurrences, lambda x: x["field"]))
    return F.transform(names, lambda f: F.struct(f.alias("field"), F.array_sort(F.transform(
        F.filter(occurrences, lambda x: x["field"] == f), lambda x: x["pos"])).alias("pos")))


def occurrences(lists: DataFrame) -> DataFrame:
    """``term, doc_id, field, pos``: the lists as one row per occurrence."""
    rows = lists.select("term", "doc_id", F.inline("at"))
    return rows.select("term", "doc_id", "field", F.explode("pos").alias("pos"))


def word_table(queries: DataFrame, key: str = "query_id") -> DataFrame:
    """The distinct words of every query: ``key, term, w`` (first position), ``qpos`` (all positions), ``m`` (words)."""
    t = queries.groupBy(key, "term").agg(F.min("qpos").alias("w"), F.array_sort(F.collect_set("qpos")).alias("qpos"))
    return t.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy(key)))


def gathered(lists: DataFrame, words: DataFrame, key: str = "query_id") -> DataFrame:
    """``key, doc_id, m, dl, words``: one row per query and document holding any of its words. All values lie in the one
    array, so that two uses of the rows (scores, document counts) share the exchange."""
    g = lists.join(words, "term").groupBy(key, "doc_id").agg(
        F.collect_list(F.struct("w", "qpos", "tf", "at", "dl", "m")).alias("words"))
    return g.select(key, "doc_id", F.col("words")[0]["m"].alias("m"), F.col("words")[0]["dl"].alias("dl"), "words")


def field_words(words: Column, field: Column) -> Column:
    """``w, qpos, pos`` of the words that ``field`` holds."""
    at = F.transform(words, lambda x: F.struct(x["w"].alias("w"), x["qpos"].alias("qpos"), F.get(F.filter(
        x["at"], lambda a: a["field"] == field), F.lit(0))["pos"].alias("pos")))
    return F.filter(at, lambda x: x["pos"].isNotNull())


def fields(words: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(words, lambda x: F.transform(x["at"], lambda a: a["field"]))))


def in_some_field(words: Column, test: Callable[[Column], Column], field: Column | None = None) -> Column:
    """Whether ``test`` (of a field's words) holds in one of the fields, or in ``field`` where that is not null."""
    names = fields(words) if field is None else F.when(field.isNull(), fields(words)).otherwise(F.array(field))
    return F.exists(names, lambda f: test(field_words(words, f)))


def holds_phrase(words: Column, m: Column) -> Column:
    """Every word on one diagonal: the starts (position - query position) of all words have one in common."""
    starts = F.flatten(F.transform(words, lambda x: F.transform(x["qpos"], lambda q: F.transform(x["pos"], lambda p: p - q))))
    common = F.aggregate(starts, F.get(starts, F.lit(0)), lambda acc, s: F.array_intersect(acc, s))
    return (F.size(words) == m) & (F.coalesce(F.size(common), F.lit(0)) > 0)


def within_span(words: Column, m: Column, n: Column) -> Column:
    """All m words inside n neighbouring positions. A counting sweep: every occurrence covers the n positions after it, cut
    where the word's next one begins, so a word counts once at any position; a place that m words cover is a match."""

    def cover(x):
        return F.flatten(F.transform(x["pos"], lambda p, i: F.array(
            F.struct(p.alias("at"), F.lit(1).alias("d")),
            F.struct(F.least(p + n, F.coalesce(F.get(x["pos"], i + 1), p + n)).alias("at"), F.lit(-1).alias("d")))))

    events = F.array_sort(F.flatten(F.transform(words, cover)))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    most = F.aggregate(events, start, lambda acc, e: F.struct(
        (acc["now"] + e["d"]).alias("now"), F.greatest(acc["most"], acc["now"] + e["d"]).alias("most")), lambda acc: acc["most"])
    return F.when(F.size(words) == m, most >= m).otherwise(F.lit(False))


def longest_run(words: Column) -> Column:
    """Longest run of query positions in order on one diagonal ``pos - qpos``."""
    marks = F.array_sort(F.flatten(F.flatten(F.transform(words, lambda x: F.transform(x["qpos"], lambda q: F.transform(
        x["pos"], lambda p: F.struct((p - q).alias("diag"), q.alias("qpos"))))))))
    start = F.struct(F.lit(None).cast("int").alias("d"), F.lit(-1).alias("q"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, x):
        run = F.when((acc["d"] == x["diag"]) & (x["qpos"] == acc["q"] + 1), acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x["diag"].alias("d"), x["qpos"].alias("q"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(marks, start, step, lambda acc: acc["best"])


def field_signals(words: Column) -> Column:
    """``array<struct<field, lcs, n_words, hits>>``: the longest run, distinct words and occurrences (once per query
    position of the word) of every field."""

    def of(f):
        w = field_words(words, f)
        hits = F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.size(x["qpos"]) * F.size(x["pos"]))
        return F.struct(f.alias("field"), longest_run(w).cast("long").alias("lcs"),
                        F.size(w).cast("long").alias("n_words"), hits.alias("hits"))

    return F.transform(fields(words), of)
