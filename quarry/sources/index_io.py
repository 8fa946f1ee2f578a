"""Persist and reload the searchable tables of one index (main or delta).

Layout under ``path``:

* ``lists/``       the position lists (term, doc_id, tf, dl, at), range-partitioned and sorted by (term, doc_id): one file
  per range of words, a frequent word split over as many files as it needs.
* ``vocabulary/``  (term, docs, hits), sorted by term.
* ``directory/``   sparse term directory: first and last word of every file of the two tables above.
* ``words/``       the words of each document (doc_id, dl, words), every file sorted by doc_id, so that counts can be corrected when
  documents are replaced.
* ``docs/``, ``lengths/``, ``texts/``  plain Parquet.
* ``meta/``        one row: name, fields, morphology, n_docs, avg_len, has_texts.

A search on a reloaded index looks its words up in the directory and reads only the files that can hold them, with
the words pushed to the scan (``PushedFilters: [In(term, ...)]``), where sorted rows let Parquet skip all other row groups
and pages. The number of files follows the data: the ranges of the shuffle, cut at ``ROWS_PER_FILE`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import bitmap as bm
from quarry.operators import positions as ps
from quarry.operators.index import Index, Source, words_by_doc, words_of_sources
from quarry.operators.list_ranges import lists_in_ranges
from quarry.session import local_table

# ---- fixed values: rows of a file at most; words resolved on the driver at most; resolved searches kept ----
ROWS_PER_FILE = 4_000_000
PUSHED_WORDS = 1000
KEPT = 16
CODEC = "zstd"  # of all files of an index
# ---- end of fixed values ----

DIRECTORY = "tab string, file string, first string, last string"


def write_index(idx: Index, path: str, rows_per_file: int = ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """Write the index. Lists and words by document come from ``Index.sources`` and only the lists are exchanged, once, packed by
    range; vocabulary, directory and statistics are derived from what was written."""
    spark = idx.docs.sparkSession

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("compression", CODEC).parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    parts = idx.sources()
    lists = save(lists_in_ranges(parts, idx.docs.count()), "lists")
    vocab = save(lists.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("tf").cast("long").alias("hits"))
                 .repartitionByRange("term").sortWithinPartitions("term"), "vocabulary")
    words = words_of_sources(parts)
    words = save((words_by_doc(lists) if words is None else words).sortWithinPartitions("doc_id"), "words")
    # a file's distinct words first: hashing finds them, and only they are compared (the count keeps Spark from merging both steps)
    ranges = [t.groupBy(F.input_file_name().alias("path"), "term").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
              .groupBy(F.element_at(F.split("path", "/"), -1).alias("file")).agg(F.min("term").alias("first"), F.max("term").alias("last"))
              .select(F.lit(n).alias("tab"), "file", "first", "last")
              for n, t in (("lists", lists), ("vocabulary", vocab))]
    ranges[0].unionByName(ranges[1]).write.mode(mode).option("compression", CODEC).parquet(f"{path}/directory")
    idx.docs.write.mode(mode).option("compression", CODEC).parquet(f"{path}/docs")
    idx.sized().select("doc_id", "field", "len").write.mode(mode).option("compression", CODEC).parquet(f"{path}/lengths")
    if idx.texts is not None:
        idx.texts.write.mode(mode).option("compression", CODEC).parquet(f"{path}/texts")
    n = spark.read.parquet(f"{path}/docs").count()
    total = words.agg(F.sum("dl")).first()[0] or 0
    meta = local_table(
        spark, [(idx.name, ",".join(idx.fields), idx.morphology, n, total / n if n else 0.0, idx.texts is not None)],
        "name string, fields string, morphology string, n_docs long, avg_len double, has_texts boolean")
    meta.write.mode(mode).parquet(f"{path}/meta")


def read_index(spark: SparkSession, path: str) -> StoredIndex:
    m = spark.read.parquet(f"{path}/meta").first()
    lists, vocab = (spark.read.parquet(f"{path}/{n}") for n in ("lists", "vocabulary"))
    return StoredIndex(
        name=m["name"],
        docs=spark.read.parquet(f"{path}/docs"),
        postings=ps.occurrences(lists),
        lengths=spark.read.parquet(f"{path}/lengths"),
        fields=tuple(m["fields"].split(",")),
        texts=spark.read.parquet(f"{path}/texts") if m["has_texts"] else None,
        morphology=m["morphology"],
        _stats=(m["n_docs"], m["avg_len"]),
        _lists=lists,
        _vocab=vocab,
        path=path,
        words=spark.read.parquet(f"{path}/words"),
        directory=spark.read.schema(DIRECTORY).parquet(f"{path}/directory"),
    )


@dataclass
class StoredIndex(Index):
    """An index read back from files. A search's words are resolved once (two small jobs: the distinct words, the files
    that can hold them) and shared by all its reads. A search of more than ``PUSHED_WORDS`` words joins the whole
    tables with its words instead; the result is the same."""

    path: str = ""
    words: DataFrame | None = None
    directory: DataFrame | None = None
    _resolved: dict = field(default_factory=dict, repr=False)

    def resolve(self, terms: DataFrame) -> tuple[list[str], dict[str, list[str]]] | None:
        """The distinct words of ``terms`` and per table the files whose range holds one of them."""
        distinct = terms.select("term").where("term IS NOT NULL").distinct()
        key = distinct.semanticHash()
        if key not in self._resolved:
            words = sorted(r["term"] for r in distinct.limit(PUSHED_WORDS + 1).collect())
            files: dict[str, list[str]] = {"lists": [], "vocabulary": []}
            if 0 < len(words) <= PUSHED_WORDS:
                asked = F.array(*map(F.lit, words))
                hit = self.directory.where(F.exists(asked, lambda w: (F.col("first") <= w) & (w <= F.col("last"))))
                for r in hit.select("tab", "file").collect():
                    files[r["tab"]].append(f"{self.path}/{r['tab']}/{r['file']}")
            while len(self._resolved) >= KEPT:
                self._resolved.pop(next(iter(self._resolved)))
            self._resolved[key] = (words, files) if len(words) <= PUSHED_WORDS else None
        return self._resolved[key]

    def _pruned(self, table: str, whole: DataFrame, terms: DataFrame) -> DataFrame:
        found = self.resolve(terms)
        if found is None:
            return whole.join(terms.select("term").distinct(), "term", "left_semi")
        words, files = found
        if not files[table]:
            return whole.where(F.lit(False))
        rows = whole.sparkSession.read.schema(whole.schema).parquet(*sorted(files[table]))
        return rows.where(F.col("term").isin(words))

    def lists(self, terms: DataFrame | None = None) -> DataFrame:
        return self._lists if terms is None else self._pruned("lists", self._lists, terms)

    def sources(self) -> list[Source]:
        return [Source(self.fields, lists=self._lists, words=self.words)]

    def postings_for(self, terms: DataFrame) -> DataFrame:
        return ps.occurrences(self.lists(terms))

    def word_counts(self, terms: DataFrame) -> DataFrame:
        return self._pruned("vocabulary", self._vocab, terms)

    def words_of(self, ids: DataFrame) -> DataFrame | None:
        return bm.within(self.words, ids)
