"""Result shaping: select lists, per-query overrides, attribute updates, hydration, excerpts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.numbering import numbered
from pyspark.sql import types as T

from quarry.functions.text import words as word_array
from quarry.operators.order import special_names, split_select

# ---- fixed values: excerpt defaults (reference client and plugin settings) ----
KWIC_AROUND = 9
EXCERPT_BEFORE = "<b>"
EXCERPT_AFTER = "</b>"
EXCERPT_SEPARATOR = " ... "
EXCERPT_LIMIT = 256
EXCERPT_AROUND = 5
SENTENCE_END = "[.?!\u2026][ \t\r\n]|\n[ \t\r]*\n"  # the end of a sentence or paragraph
RESULT_INDEX_FORMAT = "%04d"


def select_list(hits: DataFrame, clause: str = "*") -> DataFrame:
    """SQL-like list of attributes and expressions, e.g. ``'doc_id, weight * 2 AS w2'``."""
    if not clause or clause.strip() == "*":
        return hits
    return hits.selectExpr(*split_select(special_names(clause)))


def override_attr(hits: DataFrame, attr: str, values: DataFrame) -> DataFrame:
    """Replace ``attr`` for the documents listed in ``values`` (doc_id, value); others unchanged.

    Apply before filters and sorting so both see the overridden value. An id listed twice takes its
    largest value.
    """
    v = values.groupBy("doc_id").agg(F.max("value").alias("_ov"))
    dt = hits.schema[attr].dataType
    return (hits.join(v, "doc_id", "left")
            .withColumn(attr, F.coalesce(F.col("_ov").cast(dt), F.col(attr))).drop("_ov"))


def update_attributes(docs: DataFrame, changes: DataFrame, attrs: list[str]) -> tuple[DataFrame, DataFrame]:
    """Apply ``changes`` (doc_id + new values of ``attrs``) to the attribute table.

    Returns (new docs, one-row DataFrame ``updated`` = number of documents really changed). Arrays
    are replaced whole. Unknown ids are ignored, as the reference does. An id listed twice is one
    change, the largest of its rows.
    """
    one = changes.groupBy("doc_id").agg(F.max(F.struct(*attrs)).alias("_new"))
    ch = one.select("doc_id", *[F.col(f"_new.{a}").alias(f"_new_{a}") for a in attrs]).withColumn("_hit", F.lit(True))
    j = docs.join(ch, "doc_id", "left")
    out = j
    for a in attrs:
        out = out.withColumn(a, F.when(F.col("_hit"), F.col(f"_new_{a}").cast(docs.schema[a].dataType))
                             .otherwise(F.col(a)))
    out = out.select(*docs.columns)
    n = docs.join(changes.select("doc_id").distinct(), "doc_id", "inner").agg(F.count(F.lit(1)).alias("updated"))
    return out, n


def hydrate(hits: DataFrame, rows: DataFrame, rows_id: str = "id", order: list[Column] | None = None, whole: bool = False) -> DataFrame:
    """Match ids -> full source rows, in rank order; ids without a row are dropped.

    ``result_index`` is the running number within each query, padded with zeros to four digits and never
    cut (the key to restore the match order later). Run it after the page limit: the join is then on a bounded page.
    ``whole=True`` numbers results of any size (``numbering.numbered``: no task holds a whole query; writes them once).
    """
    order = order or [F.col("weight").desc(), F.col("doc_id").asc()]
    r = rows.withColumnRenamed(rows_id, "doc_id") if rows_id != "doc_id" else rows
    dup = [c for c in r.columns if c in hits.columns and c != "doc_id"]
    r = r.drop(*dup)
    j = hits.join(r, "doc_id", "inner")
    if whole:
        n = numbered(j, ["query_id"], order, "_n")
        return n.withColumn("result_index", F.format_string(RESULT_INDEX_FORMAT, F.col("_n"))).drop("_n")
    w = Window.partitionBy("query_id").orderBy(*order)
    return j.withColumn("result_index", F.format_string(RESULT_INDEX_FORMAT, F.row_number().over(w) - 1))


# ---------------------------------------------------------------------------------------------
# excerpts


def _positions(toks: Column) -> Column:
    """1, 2, ... up to the number of words; no position for a text without words."""
    return F.transform(toks, lambda _, i: i + 1)


def _phrase_starts(toks: Column, phrase: list[str]) -> Column:
    """1-based start positions of the phrase in a token array column (a plain column reference:
    inside lambdas an expression would be evaluated again for every element)."""
    m = len(phrase)
    target = F.array(*[F.lit(w) for w in phrase])
    if m == 1:
        return F.filter(_positions(toks), lambda i: F.element_at(toks, i) == F.lit(phrase[0]))
    return F.filter(_positions(toks), lambda i: F.slice(toks, i, m) == target)


def with_kwic(df: DataFrame, text_col: str, phrase: list[str], out_col: str, around: int = KWIC_AROUND,
              before: str = EXCERPT_BEFORE, after: str = EXCERPT_AFTER) -> DataFrame:
    """Add ``out_col``: keyword in context on the word array of ``text_col`` -- up to ``around``
    words either side of the first occurrence of ``phrase``, every word of a phrase occurrence in
    the window marked; NULL when the text does not hold the phrase.

    The word array and the start positions are columns of their own, so the per-element lambdas
    read them instead of evaluating the split again (linear, not quadratic, in the text length).
    """
    m = len(phrase)
    t, st_, fi = f"_{out_col}_toks", f"_{out_col}_starts", f"_{out_col}_first"
    d = df.withColumn(t, word_array(F.col(text_col)))
    d = d.withColumn(st_, _phrase_starts(F.col(t), phrase))
    d = d.withColumn(fi, F.array_min(F.col(st_)))
    s = F.greatest(F.col(fi) - around, F.lit(1))
    win = F.slice(F.col(t), s, F.col(fi) - s + m + around)
    starts = F.col(st_)
    in_occ = lambda j: F.exists(F.sequence(F.lit(0), F.lit(m - 1)),
                                lambda k: F.array_contains(starts, s + j - k))
    marked = F.transform(win, lambda x, j: F.when(in_occ(j), F.concat(F.lit(before), x, F.lit(after))).otherwise(x))
    d = d.withColumn(out_col, F.when(F.col(fi).isNotNull(), F.array_join(marked, " ")))
    return d.drop(t, st_, fi)


def excerpt_kwic(hits: DataFrame, texts: DataFrame, phrase: list[str], fields: list[str],
                 around: int = KWIC_AROUND, plain_words: int | None = None) -> DataFrame:
    """``hits`` + ``excerpt``: the keyword-in-context excerpt of the first field holding the
    phrase; otherwise a plain excerpt (first ``2*around+1`` words of the first field).
    Runs on the documents of ``hits`` only (a semi join first), so excerpts cost nothing for the
    documents outside the result page."""
    plain_words = plain_words or 2 * around + 1
    t = texts.select("doc_id", *fields).join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    outs = []
    for i, f in enumerate(fields):
        t = with_kwic(t, f, phrase, f"_kw{i}", around)
        outs.append(F.col(f"_kw{i}"))
    plain = F.array_join(F.slice(word_array(F.col(fields[0])), 1, plain_words), " ")
    t = t.select("doc_id", F.coalesce(*outs, plain).alias("excerpt"),
                 F.coalesce(*[F.when(k.isNotNull(), F.lit(True)) for k in outs], F.lit(False)).alias("matched"))
    return hits.join(t, "doc_id", "inner")


def with_excerpt(df: DataFrame, text_col: str, keywords: list[str], out_col: str = "excerpt",
                 before: str = EXCERPT_BEFORE, after: str = EXCERPT_AFTER, separator: str = EXCERPT_SEPARATOR,
                 limit: int = EXCERPT_LIMIT, around: int = EXCERPT_AROUND, exact_phrase: bool = False,
                 single_passage: bool = False, weight_order: bool = False, use_boundaries: bool = False,
                 boundary: str = SENTENCE_END) -> DataFrame:
    """Add snippets built from the word array of ``text_col``.

    Hits are the positions of keyword words (or of whole phrase occurrences when
    ``exact_phrase``); each hit opens a window of ``around`` words either side; overlapping or
    touching windows merge into one passage. Passages are joined by ``separator`` in text order
    (or by number of hits with ``weight_order``; ``single_passage`` keeps the best one) and added
    while the result stays within ``limit`` characters; a first passage that is too long loses whole words
    from its end. NULL when there is no hit (an empty text has none). With ``use_boundaries`` no passage and no phrase
    crosses a place where ``boundary`` (a pattern without word characters) matches: sentence and paragraph ends.

    Passages are islands of the sorted hit positions: a hit opens one when it is further than two
    windows from the hit before. Words are marked once for the whole text by merging the sorted hits with the word
    positions, and passages are slices of the marked words: the work is linear in words and hits.
    """
    mk, t, hp, at = f"_{out_col}_marked", f"_{out_col}_toks", f"_{out_col}_hits", f"_{out_col}_at"
    sg, pt = f"_{out_col}_segment", f"_{out_col}_parts"
    if use_boundaries:
        d = df.withColumn(pt, F.transform(F.split(F.col(text_col), boundary), word_array))
        d = d.withColumns({t: F.flatten(pt), sg: F.flatten(F.transform(F.col(pt), lambda ws, i: F.array_repeat(i, F.size(ws))))})
    else:
        d = df.withColumn(t, word_array(F.col(text_col)))
    toks = F.col(t)
    apart = lambda i, j: F.element_at(F.col(sg), i) != F.element_at(F.col(sg), j) if use_boundaries else F.lit(False)
    kws = F.array(*[F.lit(w) for w in keywords])
    if exact_phrase:
        m = len(keywords)
        d = d.withColumn(hp, _phrase_starts(toks, keywords))
        d = d.withColumn(hp, F.filter(F.col(hp), lambda i: ~apart(i, i + (m - 1))))
        d = d.withColumn(hp, F.flatten(F.transform(F.col(hp), lambda s0: F.sequence(s0, s0 + (m - 1)))))
    else:
        d = d.withColumn(hp, F.filter(_positions(toks), lambda i: F.array_contains(kws, F.element_at(toks, i))))
    d = d.withColumn(hp, F.array_sort(F.array_distinct(F.col(hp))))
    hits = F.col(hp)
    # indexes (from 1) of the hits that open a passage, and one past the last hit
    before_it = lambda i: F.element_at(hits, F.greatest(i - 1, F.lit(1)))
    opens = F.filter(_positions(hits), lambda i: (i == 1) | (
        F.element_at(hits, i) - before_it(i) > 2 * around + 1) | apart(F.element_at(hits, i), before_it(i)))
    d = d.withColumn(at, F.concat(opens, F.array(F.size(hits) + 1)))
    ends = F.col(at)
    spans = F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda i, k: F.struct(
        (i - F.element_at(ends, k + 2)).alias("k"), F.element_at(hits, i).alias("first"),
        F.slice(hits, i, F.element_at(ends, k + 2) - i).alias("own")))  # k: minus the number of hits
    if weight_order or single_passage:
        spans = F.array_sort(spans)
    if single_passage:
        spans = F.slice(spans, 1, 1)

    # true at every hit: the gap before a hit, the hit, and the words after the last one
    last = F.coalesce(F.array_max(hits), F.lit(0))
    gaps = F.transform(hits, lambda h, k: F.concat(F.array_repeat(F.lit(False), h - F.when(
        k == 0, F.lit(0)).otherwise(F.get(hits, k - 1)) - 1), F.array(F.lit(True))))
    flags = F.concat(F.flatten(gaps), F.array_repeat(F.lit(False), F.size(toks) - last))
    d = d.withColumn(mk, F.zip_with(toks, flags, lambda x, f: F.when(
        f, F.concat(F.lit(before), x, F.lit(after))).otherwise(x)))

    def marked(span):
        lo = F.greatest(span["first"] - around, F.lit(1))
        end = F.element_at(span["own"], -1)
        hi = F.least(end + around, F.size(mk))
        if use_boundaries:  # words of the window that stand in the hits' own part
            lo = F.array_min(F.filter(F.sequence(lo, span["first"]), lambda i: ~apart(i, end)))
            hi = F.array_max(F.filter(F.sequence(end, hi), lambda i: ~apart(i, end)))
        return F.slice(F.col(mk), lo, hi - lo + 1)

    def fit(words):
        """The longest head of the words that fits the limit."""
        start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("chars"), F.lit(True).alias("open"))

        def step(acc, w):
            chars = acc["chars"] + 1 + F.length(w)
            ok = acc["open"] & (chars <= limit)
            return F.struct((acc["n"] + ok.cast("int")).alias("n"), chars.alias("chars"), ok.alias("open"))

        return F.array_join(F.slice(words, 1, F.aggregate(words, start, step, lambda acc: acc["n"])), " ")

    pw = f"_{out_col}_words"
    d = d.withColumn(pw, F.transform(spans, marked))
    rest = F.transform(F.slice(F.col(pw), 2, F.greatest(F.size(pw) - 1, F.lit(0))), lambda w: F.array_join(w, " "))
    joined = F.aggregate(rest, fit(F.try_element_at(F.col(pw), F.lit(1))), lambda acc, p: F.when(
        F.length(acc) + len(separator) + F.length(p) <= limit, F.concat(acc, F.lit(separator), p)).otherwise(acc))
    d = d.withColumn(out_col, F.when(F.size(hits) > 0, joined))
    return d.drop(mk, t, hp, at, pw, sg, pt)


def build_excerpts(texts: DataFrame, field: str, keywords: list[str], **opts) -> DataFrame:
    """``doc_id, excerpt`` for every document of ``texts`` (NULL excerpt when no keyword occurs)."""
    return with_excerpt(texts.select("doc_id", field), field, keywords, "excerpt", **opts).select("doc_id", "excerpt")


def search_categories(cats: DataFrame, names, blog_ids=None) -> DataFrame:
    """Categories that took part in a category filter, ordered by label."""
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    c = cats.where(F.col("basename").isin(names))
    if blog_ids:
        c = c.where(F.col("blog_id").isin(list(blog_ids)))
    return c.orderBy("label", "id")
