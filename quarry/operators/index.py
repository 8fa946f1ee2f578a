"""Index build: tokenize, postings, lengths, vocabulary, word filters, morphology, query tables.

An :class:`Index` is a handful of lazy DataFrames:

* ``docs``      ``doc_id`` + typed attributes (one row per document)
* ``postings``  ``term, doc_id, field, pos`` (one row per word occurrence; ``pos`` from 0 per field), with the document's
  number of words ``dl`` where tokenizing knows it
* ``lists``     ``term, doc_id, tf, dl, at`` (one row per word and document, see ``positions``), kept by persisted and
  stored indexes, else made of the postings of the words asked for
* ``lengths``   ``doc_id, field, len`` (words per field)
* ``texts``     ``doc_id`` + the text fields after markup removal (for excerpts)

Everything else (per-document term counts, vocabulary, statistics) derives from these.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import html_attr_values, html_strip, words
from quarry.operators import doc_words as dw
from quarry.operators import positions as ps
from quarry.session import local_table

# Repeated document ids that are listed apart.
REPEATED = 100_000

# The tag attributes the reference indexes with a page's text.
HTML_INDEX_ATTRS = {"img": ["alt", "title"], "a": ["title"]}

QUERY_SCHEMA = T.StructType([
    T.StructField("query_id", T.IntegerType(), False),
    T.StructField("qpos", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
])


@dataclass
class Source:
    """Part of an index for writing: either texts (``doc_id`` and one per field of ``names``) or lists, with the words by document
    where they are known."""

    names: tuple[str, ...]
    texts: DataFrame | None = None
    lists: DataFrame | None = None
    words: DataFrame | None = None

    @property
    def frame(self) -> DataFrame:
        return self.texts if self.lists is None else self.lists

    def each(self, change) -> "Source":
        return Source(self.names, *(None if t is None else change(t) for t in (self.texts, self.lists, self.words)))


@dataclass
class Index:
    name: str
    docs: DataFrame
    postings: DataFrame
    lengths: DataFrame
    fields: tuple[str, ...]
    texts: DataFrame | None = None
    morphology: str = "none"
    _stats: tuple | None = field(default=None, repr=False)
    _lists: DataFrame | None = field(default=None, repr=False)
    _doc_lengths: DataFrame | None = field(default=None, repr=False)
    _vocab: DataFrame | None = field(default=None, repr=False)
    _words: DataFrame | None = field(default=None, repr=False)  # doc_id, a text per field: where just their words are indexed

    # -- derived tables ------------------------------------------------------------------
    def lists(self, terms: DataFrame | None = None) -> DataFrame:
        """The position lists ``term, doc_id, tf, dl, at`` of all words, or of those in ``terms`` (a ``term`` column).

        Kept lists are filtered. Otherwise the postings are cut to the words first (a semi join, broadcast when Spark
        knows ``terms`` to be small) and a document's occurrences move once, as one array."""
        if self._lists is not None:
            return self._lists if terms is None else self._lists.join(terms.select("term").distinct(), "term", "left_semi")
        if terms is None:
            rows = self.postings
        else:
            whole = [F.first("dl").alias("dl")] if "dl" in self.postings.columns else []
            rows = (self._cut(terms).groupBy("doc_id").agg(F.collect_list(F.struct("term", "field", "pos")).alias("occ"), *whole)
                    .select("doc_id", *(["dl"] if whole else []), F.inline("occ")))
        return self._listed(rows, F.collect_list(F.struct("field", "pos")).alias("occ")).select(
            "term", "doc_id", "tf", "dl", ps.by_field(F.col("occ")).alias("at"))

    def sources(self) -> list["Source"]:
        """What a stored index keeps of every word, by part: documents whose id stands once as texts, the others as lists."""
        found = self.texts_once()
        if found is None:
            return [Source(self.fields, lists=self.lists())]
        once, many = found
        if many is None:
            return [Source(self.fields, texts=once)]
        same = F.col("doc_id").eqNullSafe(F.col("many"))
        grouped = self._listed(self.postings.join(many, same, "left_semi"), F.collect_list(F.struct("field", "pos")).alias("occ"))
        grouped = grouped.select("term", "doc_id", "tf", "dl", ps.by_field(F.col("occ")).alias("at"))
        return [Source(self.fields, texts=once), Source(self.fields, lists=grouped, words=words_by_doc(grouped))]

    def whole(self) -> tuple[DataFrame, DataFrame | None]:
        """What a stored index keeps of every word: ``lists()``, and ``doc_id, dl, words`` by document (None: to be made of the
        lists). Documents whose id stands once are listed as they are read, without an exchange."""
        parts = self.sources()
        lists = [dw.doc_lists(s.texts, s.names) if s.lists is None else s.lists for s in parts]
        return reduce(DataFrame.unionByName, lists), words_of_sources(parts)

    def sized(self) -> DataFrame:
        """``lengths`` for writing: of the texts as they are read, where there are any."""
        return self.lengths if self._words is None or self._lists is not None else dw.doc_lengths(self._words, self.fields)

    def texts_once(self) -> tuple[DataFrame, DataFrame | None] | None:
        """``doc_id`` and a text per field of the documents whose id stands once, and the other ids (``many``; None: there are
        none). None where an index keeps no texts that are indexed word by word, or too many ids repeat."""
        if self._lists is not None or self._words is None:
            return None
        again = self._words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
        ids = [r["doc_id"] for r in again.limit(REPEATED + 1).collect()]
        if len(ids) > REPEATED:
            return None
        if not ids:
            return self._words, None
        many = F.broadcast(local_table(self.docs.sparkSession, [(i,) for i in ids], "many bigint"))
        return self._words.join(many, F.col("doc_id").eqNullSafe(F.col("many")), "left_anti"), many

    def lists_for(self, terms: DataFrame) -> DataFrame:
        """``term, doc_id, tf, dl`` for the words in ``terms`` only: the document lists that matching and BM25 read (a
        frequent word costs one row per document holding it, not one per occurrence)."""
        rows = self.lists(terms) if self._lists is not None else self._listed(self._cut(terms))
        return rows.select("term", "doc_id", "tf", "dl")

    def _cut(self, terms: DataFrame) -> DataFrame:
        return self.postings.join(terms.select("term").distinct(), "term", "left_semi")

    def _listed(self, rows: DataFrame, *more: Column) -> DataFrame:
        """One row per word and document of ``rows`` (postings), with the document's length."""
        known = [F.first("dl").alias("dl")] if "dl" in rows.columns else []
        out = rows.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("tf"), *known, *more)
        return out if known else out.join(self.doc_lengths(), "doc_id", "left")

    def term_docs(self) -> DataFrame:
        """``term, doc_id, tf``: one row per word per document."""
        rows = self.lists() if self._lists is not None else self._listed(self.postings)
        return rows.select("term", "doc_id", "tf")

    def postings_for(self, terms: DataFrame) -> DataFrame:
        """``term, doc_id, field, pos`` of the words in ``terms``."""
        return self._cut(terms).select("term", "doc_id", "field", "pos")

    def word_counts(self, terms: DataFrame) -> DataFrame:
        """``term, docs, hits`` of the words in ``terms``: a lookup in a kept vocabulary, else their lists counted."""
        t = terms.select("term").distinct()
        if self._vocab is not None:
            return self.vocabulary().join(t, "term", "left_semi")
        return self.lists_for(t).groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("tf").cast("long").alias("hits"))

    def words_of(self, ids: DataFrame) -> DataFrame | None:
        """``doc_id, dl, words`` (array of term, tf) of the documents in the bitmap ``ids``; None where an index does not
        keep its words by document."""
        return None

    def vocabulary(self) -> DataFrame:
        """``term, docs, hits`` from the document lists (no distinct count needed); the stored or
        persisted table when the index has one."""
        if self._vocab is not None:
            return self._vocab
        return self.term_docs().groupBy("term").agg(
            F.count(F.lit(1)).alias("docs"), F.sum("tf").cast("long").alias("hits"))

    def doc_lengths(self) -> DataFrame:
        """``doc_id, dl``: words per document over all fields."""
        if self._doc_lengths is None:
            self._doc_lengths = self.lengths.groupBy("doc_id").agg(F.sum("len").cast("long").alias("dl"))
        return self._doc_lengths

    def stats(self) -> tuple[Column, Column]:
        """Number of documents and mean words per document, as columns: the stored numbers of an index
        that has them, else scalar subqueries that run with the query that uses them."""
        if self._stats is None:
            n = self.docs.agg(F.count(F.lit(1)).cast("double")).scalar()
            total = self.lengths.agg(F.coalesce(F.sum("len"), F.lit(0)).cast("double")).scalar()
            return n, F.when(n > 0, total / F.greatest(n, F.lit(1.0))).otherwise(F.lit(0.0))
        return F.lit(float(self._stats[0])), F.lit(float(self._stats[1]))

    def with_docs(self, docs: DataFrame) -> "Index":
        return replace(self, docs=docs)

    def persist(self, level=None) -> "Index":
        """Keep the index tables in executor memory (spilling to disk) for repeated searches."""
        from pyspark import StorageLevel

        lvl = level or StorageLevel.MEMORY_AND_DISK
        self._lists = self.lists().persist(lvl)
        self.postings = ps.occurrences(self._lists)
        self.docs = self.docs.persist(lvl)
        self.lengths = self.lengths.persist(lvl)
        if self.texts is not None:
            self.texts = self.texts.persist(lvl)
        self._doc_lengths = self.doc_lengths().persist(lvl)
        self._vocab = self.vocabulary().persist(lvl)
        if self._stats is None:
            n, mean = self.stats()
            row = self.docs.sparkSession.range(1).select(n.alias("n"), mean.alias("mean")).first()
            self._stats = (row["n"], row["mean"])
        return self


# ---------------------------------------------------------------------------------------------
# tokenize / postings


def _field_texts(df: DataFrame, fields, id_col: str, strip_html: tuple = ()) -> DataFrame:
    """``doc_id`` and per field its text without markup."""
    txt = [html_strip(t) if f in strip_html else t for f, t in ((f, F.coalesce(F.col(f), F.lit(""))) for f in fields)]
    return df.select(F.col(id_col).cast("long").alias("doc_id"), *(t.alias(f"text{i}") for i, t in enumerate(txt)))


def _stack_fields(df: DataFrame, fields, id_col: str, strip_html: tuple = (), min_len: int = 1) -> DataFrame:
    """One row per (doc_id, field) with the field's word array, and ``dl``, the words of ``min_len`` or more of all fields."""
    cols, items, size = [], [], F.lit(0).cast("long")
    for i, f in enumerate(fields):
        txt = F.coalesce(F.col(f), F.lit(""))
        if f in strip_html:
            txt = html_strip(txt)
        toks = F.col(f"toks{i}")
        cols.append(words(txt).alias(f"toks{i}"))
        items.append(F.struct(F.lit(f).alias("field"), toks.alias("toks")))
        size = size + F.size(toks if min_len <= 1 else F.filter(toks, lambda t: F.char_length(t) >= min_len))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), *cols).select(
        "doc_id", size.alias("dl"), F.inline(F.array(*items)))


def tokenize(df: DataFrame, fields, id_col: str = "doc_id", strip_html: tuple = ()) -> DataFrame:
    """``doc_id, field, pos, term`` for every word of every field (pos from 0 within a field)."""
    if isinstance(fields, str):
        fields = (fields,)
    return _tokens(df, fields, id_col, strip_html).select("doc_id", "field", "pos", "term")


def _tokens(df: DataFrame, fields, id_col: str, strip_html: tuple = (), min_len: int = 1) -> DataFrame:
    st = _stack_fields(df, fields, id_col, strip_html, min_len)
    return st.select("doc_id", "dl", "field", F.posexplode("toks").alias("pos", "term"))


def field_lengths(df: DataFrame, fields, id_col: str = "doc_id", strip_html: tuple = (), min_len: int = 1) -> DataFrame:
    st = _stack_fields(df, fields, id_col, strip_html)
    toks = F.col("toks") if min_len <= 1 else F.filter("toks", lambda t: F.char_length(t) >= min_len)
    return st.select("doc_id", "field", F.size(toks).cast("long").alias("len"))


def min_word_len(postings: DataFrame, n: int = 1) -> DataFrame:
    """Drop words shorter than ``n`` characters; positions of the others stay as they were."""
    if n <= 1:
        return postings
    return postings.where(F.char_length("term") >= n)


def stopwords(postings: DataFrame, stop: DataFrame | None) -> DataFrame:
    """Drop listed words (``stop`` has a ``term`` column). Positions of the others are kept."""
    if stop is None:
        return postings
    s = stop.select("term").distinct()
    return postings.join(s, "term", "left_anti")


def normalize_terms(terms: DataFrame, method: str = "none") -> DataFrame:
    """``term, norm`` for distinct terms under a morphology (none, stem_en, stem_ru, stem_enru, soundex)."""
    from quarry.functions import morphology

    t = terms.select("term").distinct()
    return t.withColumn("norm", morphology.normalize_column(F.col("term"), method))


def apply_morphology(postings: DataFrame, method: str = "none") -> DataFrame:
    """Replace each word by its normal form. Python (stemmers) runs once per distinct word only; soundex is an
    expression and is applied in place."""
    if method in (None, "none"):
        return postings
    if method == "soundex":
        from quarry.functions import morphology

        return postings.withColumn("term", morphology.normalize_column(F.col("term"), method))
    norm = normalize_terms(postings, method)
    return postings.join(norm, "term").select(F.col("norm").alias("term"), *(c for c in postings.columns if c != "term"))


def build_index(name: str, docs: DataFrame, fields, id_col: str = "doc_id", attrs: list[str] | None = None,
                min_len: int = 1, stop: DataFrame | None = None, morphology: str = "none",
                strip_html: tuple = (), extra_postings: DataFrame | None = None,
                html_attrs: dict[str, list[str]] | None = None) -> Index:
    """Build the searchable tables of one index from a document DataFrame.

    ``attrs`` are the attribute columns kept in ``idx.docs`` (default: every non-field column).
    ``html_attrs`` names tag attributes of the ``strip_html`` fields whose text is indexed too, after the
    field's own (``HTML_INDEX_ATTRS``: image and link texts).
    """
    fields = tuple([fields] if isinstance(fields, str) else fields)
    for f in strip_html if html_attrs else ():
        docs = docs.withColumn(f, F.concat_ws(" ", F.col(f), html_attr_values(F.coalesce(F.col(f), F.lit("")), html_attrs)))
    if attrs is None:
        attrs = [c for c in docs.columns if c not in fields and c != id_col]
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), *attrs)
    texts_cols = [F.col(id_col).cast("long").alias("doc_id")]
    for f in fields:
        c = F.coalesce(F.col(f), F.lit(""))
        texts_cols.append((html_strip(c) if f in strip_html else c).alias(f))
    texts = docs.select(*texts_cols)
    p = _tokens(docs, fields, id_col, strip_html, min_len)
    counted = stop is not None or extra_postings is not None
    if counted:
        p = p.drop("dl")  # words go or come after tokenizing: the lengths are counted from the postings
    p = min_word_len(p, min_len)
    p = stopwords(p, stop)
    p = apply_morphology(p, morphology)
    if extra_postings is not None:
        p = p.unionByName(extra_postings.select("doc_id", "field", "pos", "term"))
    p = p.select("term", "doc_id", "field", "pos", *(c for c in p.columns if c == "dl"))
    # fields without words have no row, which neither the document count nor the mean changes
    lengths = postings_lengths(p) if counted else field_lengths(docs, fields, id_col, strip_html, min_len).where("len > 0")
    plain = not counted and min_len <= 1 and morphology in (None, "none")
    return Index(name=name, docs=d, postings=p, lengths=lengths, fields=fields, texts=texts,
                 morphology=morphology, _words=_field_texts(docs, fields, id_col, strip_html) if plain else None)


def words_of_sources(parts: list[Source]) -> DataFrame | None:
    """``doc_id, dl, words`` of all parts; None where a part does not know its own."""
    found = [dw.doc_words(s.texts, s.names) if s.lists is None else s.words for s in parts]
    return None if any(w is None for w in found) else reduce(DataFrame.unionByName, found)


def words_by_doc(lists: DataFrame) -> DataFrame:
    """``doc_id, dl, words`` of the lists."""
    return lists.groupBy("doc_id").agg(F.first("dl").alias("dl"), F.collect_list(F.struct("term", "tf")).alias("words"))


def postings_lengths(postings: DataFrame) -> DataFrame:
    """``doc_id, field, len``: words per field, attribute words left out."""
    return postings.where(F.col("field") != "_attrs").groupBy("doc_id", "field").agg(
        F.count(F.lit(1)).cast("long").alias("len"))


def build_postings(docs: DataFrame, fields, id_col: str = "doc_id", **kw) -> DataFrame:
    return build_index("idx", docs, fields, id_col, **kw).postings.select("term", "doc_id", "field", "pos")


def vocabulary(postings: DataFrame) -> DataFrame:
    """``term, docs, hits`` straight from a postings table (see ``Index.vocabulary`` for the
    cheaper form over document lists). Hot words are safe: the distinct count aggregates
    partially on (term, doc_id) first."""
    return postings.groupBy("term").agg(
        F.count_distinct("doc_id").alias("docs"), F.count(F.lit(1)).alias("hits"))


# ---------------------------------------------------------------------------------------------
# query tables


def queries_from_column(df: DataFrame, id_col: str, text_col: str, morphology: str = "none") -> DataFrame:
    """Queries table ``query_id, qpos, term`` from a text column (one query per row)."""
    q = (df.select(F.col(id_col).cast("int").alias("query_id"), words(F.col(text_col)).alias("toks"))
         .select("query_id", F.posexplode("toks").alias("qpos", "term")))
    q = q.select("query_id", F.col("qpos").cast("int"), "term")
    return normalize_queries(q, morphology)


def queries_from_texts(spark: SparkSession, texts: dict[int, str] | list[tuple[int, str]],
                       morphology: str = "none") -> DataFrame:
    rows = list(texts.items()) if isinstance(texts, dict) else list(texts)
    df = local_table(spark, rows, "query_id int, text string")
    return queries_from_column(df, "query_id", "text", morphology)


def queries_from_terms(spark: SparkSession, rows: list[tuple[int, int, str]]) -> DataFrame:
    return local_table(spark, rows, QUERY_SCHEMA)


def normalize_queries(queries: DataFrame, morphology: str = "none") -> DataFrame:
    if morphology in (None, "none"):
        return queries
    from quarry.functions import morphology as m

    return queries.withColumn("term", m.normalize_column(F.col("term"), morphology))


def query_word_stats(queries: DataFrame, vocab: DataFrame) -> DataFrame:
    """``query_id, term, docs, hits`` for the distinct words of every query (0 when unknown)."""
    q = queries.select("query_id", "term").distinct()
    return (q.join(vocab, "term", "left")
            .select("query_id", "term", F.coalesce("docs", F.lit(0)).cast("long").alias("docs"),
                    F.coalesce("hits", F.lit(0)).cast("long").alias("hits")))


def keywords(query_texts: DataFrame, idx: Index | None = None, id_col: str = "query_id",
             text_col: str = "text", morphology: str = "none", hits: bool = True) -> DataFrame:
    """Split query text into words: ``query_id, qpos, tokenized, normalized[, docs, hits]``."""
    q = (query_texts.select(F.col(id_col).cast("int").alias("query_id"), words(F.col(text_col)).alias("toks"))
         .select("query_id", F.posexplode("toks").alias("qpos", "tokenized")))
    from quarry.functions import morphology as m

    q = q.select("query_id", F.col("qpos").cast("int"), "tokenized",
                 m.normalize_column(F.col("tokenized"), morphology).alias("normalized"))
    if hits and idx is not None:
        v = idx.vocabulary().withColumnRenamed("term", "normalized")
        q = (q.join(v, "normalized", "left")
             .withColumn("docs", F.coalesce("docs", F.lit(0)).cast("long"))
             .withColumn("hits", F.coalesce("hits", F.lit(0)).cast("long")))
    return q


# ---------------------------------------------------------------------------------------------
# attribute filter words


def attr_token(index: str, attr: str, value) -> str:
    return f"{index}_{attr}_{value}".lower()


def _attr_word_fn(index: str, attr: str):
    # one-argument lambda: Spark reads a second argument as the element index
    return lambda v: F.lower(F.concat_ws("_", F.lit(index), F.lit(attr), v.cast("string")))


def attr_tokens(docs: DataFrame, index: str, attrs: list[str], field_name: str = "_attrs") -> DataFrame:
    """Postings rows for the words ``<index>_<attr>_<value>`` (multi-value attributes: one per value)."""
    items = []
    for a in attrs:
        dt = docs.schema[a].dataType
        vals = F.col(a) if isinstance(dt, T.ArrayType) else F.array(F.col(a))
        vals = F.filter(vals, lambda v: v.isNotNull())  # a missing value gives no word
        # a missing multi-value attribute gives no word, and takes none from the others
        items.append(F.coalesce(F.transform(vals, _attr_word_fn(index, a)), F.array().cast("array<string>")))
    return (docs.select(F.col("doc_id"), F.explode(F.flatten(F.array(*items))).alias("term"))
            .where(F.col("term").isNotNull())
            .select("term", "doc_id", F.lit(field_name).alias("field"), F.lit(0).cast("int").alias("pos")))
