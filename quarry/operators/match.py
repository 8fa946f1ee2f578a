"""Matching: which documents satisfy each query of a queries table ``query_id, qpos, term``.

Every function returns ``query_id, doc_id`` (one row per matching document). The queries table is
joined to the postings by ``term``: broadcast when Spark knows its size in bytes to be small, otherwise
a shuffle join on ``term`` that AQE splits where a frequent word makes a partition skewed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from itertools import batched

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import bitmap as bm
from quarry.operators import doc_words as dw
from quarry.operators import positions as ps
from quarry.operators.index import Index, Source
from quarry.operators.standing import asked, match_sets
from quarry.session import local_table
from quarry.spec import And, Expr, Near, Not, Or, Phrase, Term


# ---- fixed values: expressions matched as conditions, alternatives of one expression, the leaf every document has, numbers
# of a broadcast answer table at most ----
CONDITIONS, CLAUSES, ANY_DOC, ANSWERS = 64, 64, -1, 2 ** 22
# ---- end of fixed values ----


def term_hits(idx: Index, queries: DataFrame) -> DataFrame:
    """``query_id, qpos, term, doc_id, field, pos``: every occurrence of every query word."""
    return idx.postings_for(queries).join(queries.select("query_id", "qpos", "term"), "term")


def match_all(idx: Index, queries: DataFrame) -> DataFrame:
    """Documents holding every distinct word of the query (in any field)."""
    q = queries.select("query_id", "term").distinct()
    q = q.withColumn("n_terms", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
    # document lists are unique per (term, doc) and q per (query, term): a plain count suffices
    h = idx.lists_for(q).select("term", "doc_id").join(q, "term")
    return (h.groupBy("query_id", "doc_id", "n_terms")
            .agg(F.count(F.lit(1)).alias("matched"))
            .where(F.col("matched") == F.col("n_terms"))
            .select("query_id", "doc_id"))


def match_any(idx: Index, queries: DataFrame) -> DataFrame:
    """Documents holding at least one word of the query."""
    q = queries.select("query_id", "term").distinct()
    return idx.lists_for(q).select("term", "doc_id").join(q, "term").select("query_id", "doc_id").distinct()


def match_phrase(idx: Index, queries: DataFrame, field: str | None = None) -> DataFrame:
    """Words adjacent and in query order inside one field: a word at query position q and position p starts the phrase
    at ``p - q``; a start that all words share is an occurrence."""
    return _in_field(idx, queries, field, lambda w: ps.holds_phrase(w, F.col("m")))


def match_near(idx: Index, queries: DataFrame, n: int, field: str | None = None) -> DataFrame:
    """All distinct query words inside a span of ``n`` consecutive positions of one field, any order."""
    return _in_field(idx, queries, field, lambda w: ps.within_span(w, F.col("m"), F.lit(n)))


def _in_field(idx: Index, queries: DataFrame, field: str | None, test) -> DataFrame:
    words = ps.word_table(queries)
    g = ps.gathered(idx.lists(words), words).where(F.size("words") == F.col("m"))
    where = ps.in_some_field(F.col("words"), test, None if field is None else F.lit(field))
    return g.where(where).select("query_id", "doc_id")


def match_fullscan(idx: Index, query_id: int = 1) -> DataFrame:
    """Empty query: every document matches (filters and sorting still apply)."""
    return idx.docs.select(F.lit(query_id).cast("int").alias("query_id"), "doc_id")


def match(idx: Index, queries: DataFrame | None, mode: str = "all", query_id: int = 1, **kw) -> DataFrame:
    if mode == "fullscan" or queries is None:
        return match_fullscan(idx, query_id)
    if mode == "all":
        return match_all(idx, queries)
    if mode == "any":
        return match_any(idx, queries)
    if mode == "phrase":
        return match_phrase(idx, queries)
    raise ValueError(f"mode {mode!r} needs an expression: use match_boolean / match_extended")


# ---------------------------------------------------------------------------------------------
# boolean / extended


def _leaf_hits(idx: Index, leaves: list, spark: SparkSession) -> DataFrame | None:
    """``doc_id, leaf`` for every document that satisfies leaf number ``leaf`` (a word, phrase or
    proximity group): one job per kind of leaf, whatever the number of leaves."""
    words = local_table(spark, [(i, p, w, lf.field) for i, lf in enumerate(leaves) for p, w in enumerate(
        (lf.word,) if isinstance(lf, Term) else lf.words)], "leaf int, qpos int, term string, want string")
    parts = []

    def of(kind):
        at = [i for i, lf in enumerate(leaves) if isinstance(lf, kind)]
        return at, words.where(F.col("leaf").isin(at))

    at, q = of(Term)
    plain = q.where("want IS NULL").select("leaf", "term")
    if any(leaves[i].field is None for i in at):
        parts.append(idx.lists_for(plain).select("term", "doc_id").join(plain, "term").select("doc_id", "leaf"))
    if any(leaves[i].field is not None for i in at):
        limited = q.where("want IS NOT NULL")
        h = idx.postings_for(limited).join(limited, "term").where(F.col("field") == F.col("want"))
        parts.append(h.select("doc_id", "leaf").distinct())
    for kind in (Phrase, Near):
        at, q = of(kind)
        if not at:
            continue
        spans = local_table(spark, [(i, leaves[i].field, getattr(leaves[i], "n", None)) for i in at], "leaf int, want string, n int")
        w = ps.word_table(q, "leaf")
        g = ps.gathered(idx.lists(w), w, "leaf").where(F.size("words") == F.col("m")).join(spans, "leaf")
        test = ((lambda x: ps.holds_phrase(x, F.col("m"))) if kind is Phrase else
                (lambda x: ps.within_span(x, F.col("m"), F.col("n"))))
        parts.append(g.where(ps.in_some_field(F.col("words"), test, F.col("want"))).select("doc_id", "leaf"))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def held_clauses(hits: DataFrame, clauses: DataFrame) -> DataFrame:
    """``clause, doc_id`` where the document has every item a clause wants and none that it forbids. ``hits``: distinct
    ``item, doc_id``; ``clauses``: ``clause, item, wanted``, with one wanted item at least.

    An inverted index over the clauses: each is filed under its rarest wanted item, so a document meets only the clauses
    filed under an item it has, whatever their number; the other items are then looked up for these pairs."""
    n = hits.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    filed = (clauses.where("wanted").join(n, "item", "left").groupBy("clause")
             .agg(F.min_by("item", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "item")).alias("key")))
    rest = clauses.join(filed, "clause").where("NOT (wanted AND item = key)").select("clause", "item", "wanted")
    pairs = hits.join(filed, F.col("item") == F.col("key")).select("clause", "doc_id")
    seen = pairs.join(rest, "clause", "left").join(hits.withColumn("held", F.lit(True)), ["item", "doc_id"], "left")
    ok = F.col("item").isNull() | (F.coalesce("held", F.lit(False)) == F.col("wanted"))
    return seen.groupBy("clause", "doc_id").agg(F.bool_and(ok).alias("ok")).where("ok").select("clause", "doc_id")


def match_standing(lists: DataFrame, queries: DataFrame, idx: Index | None = None) -> DataFrame:
    """All-words matching of very many queries: ``lists`` (term, doc_id, ...) against a queries table, both in groups
    (``standing.match_sets``; writes both). Equals ``match_all``; rows without an id by ``held_clauses``. ``idx`` is the index
    whose ``lists_for`` the lists are: where it has its texts, no word is exchanged."""
    words = asked(queries)
    hits = lists.where("doc_id IS NULL").join(words.select("term").distinct(), "term", "left_semi").select(
        F.col("term").alias("item"), "doc_id")
    clauses = words.select(F.col("query_id").alias("clause"), F.col("term").alias("item"), F.lit(True).alias("wanted"))
    nameless = held_clauses(hits, clauses).select(F.col("clause").alias("query_id"), "doc_id")
    return match_sets(lists, words, idx).unionByName(nameless)


def _clauses(e: Expr, number: dict, negated: bool = False) -> set[frozenset] | None:
    """``e`` as alternatives, each a set of (leaf number, wanted); None beyond ``CLAUSES`` of them."""
    if isinstance(e, Not):
        return _clauses(e.part, number, not negated)
    if not isinstance(e, (And, Or)):
        return {frozenset([(number[e], not negated)])}
    parts = [_clauses(p, number, negated) for p in e.parts]
    if any(p is None for p in parts):
        return None
    if isinstance(e, Or) != negated:
        out = set().union(*parts)
    else:
        out = {frozenset()}
        for p in parts:
            out = {a | b for a in out for b in p}
            if len(out) > CLAUSES:
                return None
        out = {c for c in out if len({i for i, _ in c}) == len(c)}  # a leaf both wanted and forbidden
    return out if len(out) <= CLAUSES else None


def _match_many(idx: Index, exprs: dict[int, Expr], clauses: dict[int, set], hits: DataFrame) -> DataFrame:
    """Expressions as rows of a clause table instead of conditions in the plan."""
    spark = hits.sparkSession
    rows, owner, wants_all = [], [], False
    for qid, alternatives in clauses.items():
        for c in alternatives:
            if not any(w for _, w in c):  # true without any leaf: wants a document, forbids its leaves
                c, wants_all = c | {(ANY_DOC, True)}, True
            rows += [(len(owner), i, w) for i, w in c]
            owner.append((len(owner), qid))
    hits = hits.select(F.col("leaf").alias("item"), "doc_id")
    if wants_all:
        hits = hits.unionByName(idx.docs.select(F.lit(ANY_DOC).alias("item"), "doc_id"))
    table = local_table(spark, rows, "clause int, item int, wanted boolean")
    owners = local_table(spark, owner, "clause int, query_id int")
    # documents with the same leaves have the same answers: one document of each such class is matched for all
    docs = hits.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("held"))
    classes = docs.groupBy("held").agg(F.min("doc_id").alias("doc_id"))
    found = held_clauses(classes.select(F.explode("held").alias("item"), "doc_id"), table).join(owners, "clause")
    answers = (found.groupBy("doc_id").agg(F.collect_set("query_id").alias("query_ids"))
               .join(classes, "doc_id").select("held", "query_ids"))
    leaves = len({i for _, i, _ in rows})
    if leaves < 24 and len(exprs) * 2 ** leaves <= ANSWERS:  # no more than that many numbers, however many documents
        answers = F.broadcast(answers)
    out = docs.join(answers, "held").select(F.explode("query_ids").alias("query_id"), "doc_id")
    nameless = held_clauses(hits.where("doc_id IS NULL").distinct(), table).join(owners, "clause")
    return out.unionByName(nameless.select("query_id", "doc_id").distinct())


def match_boolean(idx: Index, expr: Expr | dict[int, Expr], query_id: int = 1) -> DataFrame:
    """AND / OR / NOT over words (optionally field-limited), phrases and proximity groups.

    One plan for any number of expressions: the distinct leaves of all of them are matched together
    (``_leaf_hits``). A few expressions are conditions over a document's array of leaves; more than ``CONDITIONS``
    become a table of clauses, each filed under its rarest leaf (``held_clauses``), so the plan does not grow with
    them. An expression that is true without any leaf (NOT only) also takes the documents that hold none, so
    those join in from the attribute table.
    """
    spark = idx.postings.sparkSession
    exprs = expr if isinstance(expr, dict) else {query_id: expr}
    leaves = list(dict.fromkeys(lf for e in exprs.values() for lf in e.leaves()))
    number = {lf: i for i, lf in enumerate(leaves)}
    hits = _leaf_hits(idx, leaves, spark)
    if len(exprs) > CONDITIONS and hits is not None:
        clauses = {qid: _clauses(e, number) for qid, e in exprs.items()}
        few = {qid: e for qid, e in exprs.items() if clauses[qid] is None}  # too many alternatives: a condition
        many = _match_many(idx, exprs, {qid: c for qid, c in clauses.items() if c is not None}, hits)
        parts = [many] + [match_boolean(idx, dict(p)) for p in batched(few.items(), CONDITIONS)]
        return reduce(lambda a, b: a.unionByName(b), parts)
    empty = F.array().cast("array<int>")
    docs = (idx.docs.select("doc_id", empty.alias("held")) if hits is None else
            hits.groupBy("doc_id").agg(F.collect_set("leaf").alias("held")))
    if hits is not None and any(e.evaluate({lf: False for lf in leaves}) for e in exprs.values()):
        docs = (idx.docs.select("doc_id").join(docs, "doc_id", "left")
                .select("doc_id", F.coalesce("held", empty).alias("held")))

    def holds(e: Expr):
        if isinstance(e, (Term, Phrase, Near)):
            return F.array_contains("held", number[e])
        if isinstance(e, And):
            return reduce(lambda a, b: a & b, [holds(p) for p in e.parts])
        if isinstance(e, Or):
            return reduce(lambda a, b: a | b, [holds(p) for p in e.parts])
        if isinstance(e, Not):
            return ~holds(e.part)
        raise TypeError(e)

    true = F.array_compact(F.array(*[F.when(holds(e), F.lit(qid).cast("int")) for qid, e in exprs.items()]))
    return docs.select(F.explode(true).alias("query_id"), "doc_id")


match_extended = match_boolean


# ---------------------------------------------------------------------------------------------
# several indexes, main + delta


def union_indexes(indexes: list[Index]) -> Index:
    """Main + delta replace: documents present in a later index replace those in earlier ones."""
    out = indexes[0]
    for nxt in indexes[1:]:
        out = main_delta(out, nxt)
    return out


def main_delta(main: Index, delta: Index) -> Index:
    """Searchable view of main + delta: a document in delta is taken from delta only.

    The delta's ids become a bitmap (4 KB for every 32,768 neighbouring ids that hold one) that is applied to main's rows as
    they are read: nothing of main is joined by document or regrouped."""
    replaced = bm.id_bitmap(delta.docs.select("doc_id"))
    texts = None
    if main.texts is not None and delta.texts is not None:
        texts = bm.without(main.texts, replaced).unionByName(delta.texts)
    merged = MergedIndex(
        name=main.name,
        docs=bm.without(main.docs, replaced).unionByName(delta.docs, allowMissingColumns=True),
        postings=main.postings,
        lengths=bm.without(main.lengths, replaced).unionByName(delta.lengths),
        fields=main.fields,
        texts=texts,
        morphology=main.morphology,
        parts=(main, delta),
        replaced=replaced,
    )
    merged.postings = merged.both(lambda part: part.postings.select("term", "doc_id", "field", "pos"))
    return merged


@dataclass
class MergedIndex(Index):
    """Main + delta. A search narrows each part to its words (a stored main reads only their files), then drops the
    documents that the delta replaces. Counts are main's, less those of the replaced documents, plus the delta's."""

    parts: tuple[Index, ...] = ()
    replaced: DataFrame | None = None

    def both(self, table) -> DataFrame:
        main, delta = self.parts
        return bm.without(table(main), self.replaced).unionByName(table(delta))

    def lists(self, terms: DataFrame | None = None) -> DataFrame:
        return self.both(lambda part: part.lists(terms))

    def sources(self) -> list[Source]:
        """Main's documents are left out before their words are listed."""
        main, delta = self.parts
        ids = bm.known(self.replaced)
        return [s.each(lambda t: bm.without(t, ids)) for s in main.sources()] + delta.sources()

    def sized(self) -> DataFrame:
        main, delta = self.parts
        if main._words is None or main._lists is not None:
            return bm.without(main.sized(), self.replaced).unionByName(delta.sized())
        return dw.doc_lengths(bm.without(main._words, self.replaced), main.fields).unionByName(delta.sized())

    def settled(self) -> "MergedIndex":
        """The same for writing: the replaced ids are counted, so that where they are few no document or text is exchanged."""
        main, delta = self.parts
        ids = bm.known(self.replaced)
        texts = None if self.texts is None else bm.without(main.texts, ids).unionByName(delta.texts)
        return replace(self, docs=bm.without(main.docs, ids).unionByName(delta.docs, allowMissingColumns=True),
                       lengths=bm.without(main.lengths, ids).unionByName(delta.lengths), texts=texts, replaced=ids)

    def lists_for(self, terms: DataFrame) -> DataFrame:
        return self.both(lambda part: part.lists_for(terms))

    def postings_for(self, terms: DataFrame) -> DataFrame:
        return self.both(lambda part: part.postings_for(terms))

    def term_docs(self) -> DataFrame:
        return self.both(lambda part: part.term_docs())

    def vocabulary(self) -> DataFrame:
        """``term, docs, hits``. With a main that keeps the words of each document, only the replaced documents' words are
        read of it; else its lists are counted without them."""
        main, delta = self.parts
        words = main.words_of(self.replaced)
        if words is None:
            old = bm.without(main.term_docs(), self.replaced).groupBy("term").agg(
                F.count(F.lit(1)).alias("docs"), F.sum("tf").alias("hits"))
        else:
            gone = words.select(F.inline("words")).select("term", F.lit(-1).cast("long").alias("docs"), (-F.col("tf")).alias("hits"))
            old = main.vocabulary().unionByName(gone)
        counts = old.unionByName(delta.vocabulary()).groupBy("term").agg(
            F.sum("docs").alias("docs"), F.sum("hits").cast("long").alias("hits"))
        return counts.where("docs > 0")

    def stats(self):
        main, delta = self.parts
        words = main.words_of(self.replaced)
        if words is None or main._stats is None:
            return super().stats()
        n, mean = main._stats
        gone = bm.within(main.docs, self.replaced).agg(F.count(F.lit(1)).cast("double")).scalar()
        less = words.agg(F.coalesce(F.sum("dl"), F.lit(0)).cast("double")).scalar()
        new, new_mean = delta.stats()
        docs = F.lit(float(n)) - gone + new
        total = F.round(F.lit(float(n)) * F.lit(float(mean))) - less + F.round(new * new_mean)
        return docs, F.when(docs > 0, total / F.greatest(docs, F.lit(1.0))).otherwise(F.lit(0.0))
