"""Source divergence audit: which sources of a language differ, and by which terms.

Each language keeps the ``V`` terms found in at least ``MIN_DOCS`` of its documents. A (language, source) group, and the
language as a whole, gives a kept term with ``count`` occurrences the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
N being its occurrences of all kept terms. Two terms with equal counts in the group and in the language have equal
shares, so terms are ranked by cells:

1. Terms are counted per group in the tasks that read the texts, then summed (no row per word leaves a task).
2. Part ``term``: the terms of a group fall into cells by (group count, language count). The divergence f = p - q is evaluated
   once per cell, cells of equal f are merged, and the running sum of their multiplicities gives every value its first
   rank. Only values that start within the ranks asked for are expanded into terms, in UTF-8 order.
3. Part ``pair``: sources are dealt to blocks and a language's terms to chunks; a task holds two blocks of one chunk as
   a dense matrix of shares and returns the sums of absolute differences. Terms that neither block holds are not
   sent: all of them differ by the same amount, which is added by their number.

Shares are exact (decimal arithmetic). Every group, even without terms, is paired with every other source of its language.

Edge cases: null text, lang and source count as ''; a group without terms has only ``pair`` rows; a language without
kept terms gives value 0; repeated rows are documents of their own; ties rank by UTF-8 order of the item; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import terms
from quarry.llm.common import stored

MIN_DOCS, TOP = 30, 50
#: (group, term) entries a task gathers before it hands them on; sources in a block and terms in a chunk.
ENTRIES = 500_000
SOURCES, CHUNK = 64, 8192
COUNTED = "lang binary, source binary, term binary, n long, docs long"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts per (lang, source, term); a row with a null term stands for the group itself."""
    names = ["lang", "source", "term", "n", "docs"]
    groups: dict = {}
    entries = 0

    def flush():
        for (lang, source), (n, docs) in groups.items():
            cols = ([None, *n], [0, *n.values()], [0, *(docs[t] for t in n)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(n) + 1), pa.binary()), pa.array([source] * (len(n) + 1), pa.binary()),
                 pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names)
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*(terms.column(batch, c) for c in ("lang", "source", "text")), strict=True):
            found = terms.split(text, terms.LETTERS)
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            entries -= len(n)
            n.update(found)
            docs.update(set(found))
            entries += len(n)
            if entries > ENTRIES:
                yield from flush()
                entries = 0
    yield from flush()


def share(n: str, total: str, v: str):
    """p of a term with ``n`` occurrences among ``total`` of ``v`` kept terms, exact; null without kept terms."""
    return F.expr(f"1 + cast(1000000000 as decimal(10,0)) * cast({n} + 5 as decimal(19,0)) "
                  f"div nullif(cast({total} + 5 * {v} as decimal(20,0)), 0)")


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``kept`` (lang, source, term, n, lang_n), ``groups`` (lang, source, total) and ``langs`` (lang, lang_total, v),
    written tables."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")]
    counts = docs.select(*blank).mapInArrow(_count_terms, COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    counts = (counts.withColumns({"lang_n": F.sum("n").over(w), "lang_docs": F.sum("docs").over(w)})
              .where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)))
    counts = stored(counts.select("lang", "source", "term", "n", "lang_n"), "divergence-counts")
    kept = counts.where("term IS NOT NULL")
    groups = stored(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), "divergence-groups")
    sizes = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count("*").alias("v"))
    none = F.lit(0).cast("long")
    langs = stored(groups.select("lang").distinct().join(sizes, "lang", "left").select(
        "lang", F.coalesce("lang_total", none).alias("lang_total"), F.coalesce("v", none).alias("v")), "divergence-langs")
    return kept, groups, langs


def term_ranks(kept: DataFrame, groups: DataFrame, langs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the kept terms with p > q of every group, to rank ``top``."""
    keys = ["lang", "source"]
    cells = (kept.groupBy(*keys, "n", "lang_n").agg(F.count("*").alias("terms"))
             .join(groups, keys).join(langs, "lang")
             .withColumn("value", share("n", "total", "v") - share("lang_n", "lang_total", "v")).where("value > 0"))
    # every value holds one term at least, so the first ranks lie in as many values
    by_value = Window.partitionBy(*keys).orderBy(F.desc("value"))
    values = (cells.groupBy(*keys, "value").agg(F.sum("terms").alias("terms"))
              .withColumn("_r", F.row_number().over(by_value)).where(F.col("_r") <= top)
              .withColumn("before", F.coalesce(F.sum("terms").over(by_value.rowsBetween(Window.unboundedPreceding, -1)),
                                               F.lit(0)))
              .where(F.col("before") < top).select(*keys, "value", "before"))
    chosen = cells.join(values, [*keys, "value"]).select(*keys, "n", "lang_n", "value", "before")
    in_value = Window.partitionBy(*keys, "value").orderBy("term")
    return (kept.join(chosen, [*keys, "n", "lang_n"]).withColumn("_r", F.row_number().over(in_value))
            .where(F.col("_r") <= top).withColumn("rank", (F.col("before") + F.col("_r")).cast("int"))
            .where(F.col("rank") <= top).select(*keys, F.col("term").alias("item"), "value", "rank"))


def _block_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the terms that two blocks of sources hold, for every pair of their sources."""
    lang, bi, bj = (pdf[c].iloc[0] for c in ("lang", "bi", "bj"))
    head = pdf["term"].isna().to_numpy()
    heads, held = pdf[head], pdf[~head]
    source = pd.Index(heads["source"])
    base, block = heads["p"].to_numpy(np.int64), heads["block"].to_numpy(np.int64)
    code, seen = pd.factorize(held["term"])
    p = np.repeat(base[:, None], len(seen), axis=1)
    p[source.get_indexer(held["source"]), code] = held["p"].to_numpy(np.int64)
    out = []
    right = np.flatnonzero(block == bj)
    for i in np.flatnonzero(block == bi):
        at = right[right > i] if bi == bj else right
        for j, s in zip(at, np.abs(p[at] - p[i]).sum(axis=1), strict=True):
            out.append((lang, source[i], source[j], int(s), len(seen), abs(int(base[i]) - int(base[j]))))
    return pd.DataFrame(out, columns=["lang", "a", "b", "part", "seen", "gap"])


def pair_ranks(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: every other source of the language by the sum of |p - q|."""
    sizes = stored(groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"))
                   .join(langs, "lang").withColumn("chunks", F.greatest(F.ceil(F.col("v") / CHUNK), F.lit(1)).cast("int")),
                   "divergence-sizes")
    held = (kept.join(groups, ["lang", "source"]).join(sizes, "lang")
            .select("lang", "source", "term", "blocks", F.pmod(F.xxhash64("term"), "chunks").cast("int").alias("chunk"),
                    share("n", "total", "v").alias("p")))
    head = groups.join(sizes, "lang").select(
        "lang", "source", F.lit(None).cast("binary").alias("term"), "blocks",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.coalesce(share("0", "total", "v"), F.lit(0)).alias("p"))
    dealt = (held.unionByName(head).withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", "chunk", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                     "block", "source", "term", "p"))
    sums = (dealt.groupBy("lang", "chunk", "bi", "bj")
            .applyInPandas(_block_sums, "lang binary, a binary, b binary, part long, seen long, gap long")
            .groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"), F.max("gap").alias("gap"))
            .join(langs, "lang").withColumn("value", F.col("part") + (F.col("v") - F.col("seen")) * F.col("gap")))
    ways = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                            F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.select("lang", "value", ways).select("lang", "source", "item", "value", F.row_number().over(w).alias("rank"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of both parts."""
    tables = term_counts(docs, min_docs)
    parts = [("pair", pair_ranks(*tables)), ("term", term_ranks(*tables, top))]
    both = [df.select(F.col("lang").cast("string"), F.col("source").cast("string"), F.lit(name).alias("part"),
                      F.col("item").cast("string"), F.col("value").cast("long"), "rank") for name, df in parts]
    return both[0].unionByName(both[1])
