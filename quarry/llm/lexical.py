"""Ranked lexical search: the best documents of every item by the Best Position Algorithm.

1. One pass over the corpus counts each document's terms. Only terms that an item may hold are kept (a bit table of
   ``FILTER_BITS`` bits over the items' terms says so; a false "maybe" costs a row, never a result).
2. Document counts, the number of documents and of all terms give the weights, over all documents.
3. Documents are dealt to shards of about ``SHARD`` postings by hash; every block of items meets every shard. A shard
   holds an impact list per term: its postings by falling impact.
4. Per item the lists are read from the top in step (sorted access). A document met for the first time is looked up in all
   lists of the item (direct access), which gives its whole score and its positions there. The best position of a list
   is the last one before its first unseen position; the impacts at the best positions bound the score of
   every document not met yet. Reading stops once that bound is strictly below the k-th best score, so a tie is never cut.
5. The best ``k`` of every shard are merged: in salted parts first, then per item.

Memory is bounded by a shard and a block of items; nothing of the corpus reaches the driver but three sums.

Edge cases: null and empty texts have no terms and are never returned; an item without known terms has no rows; rows with
one item id are one item with all their terms; repeated documents are ranked one by one; equal scores go by
ascending doc_id, null ids first; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import terms
from quarry.llm.common import stored

TOP = 10
FILTER_BITS = 1 << 23
SHARD, ITEMS = 500_000, 512
FIRST_DEPTH = 32
SALTS = 16
KNOWN = 1_000_000
POSTINGS = "doc_id long, n long, terms array<binary>, tfs array<long>"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        item, term = [], []
        for i, text in zip(terms.column(batch, "item_id"), terms.column(batch, "text"), strict=True):
            found = set(terms.split(text, terms.LETTERS_DIGITS))
            item += [i] * len(found)
            term += found
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(term, pa.binary())], ["item_id", "term"])


def term_filter(item_terms: DataFrame) -> np.ndarray:
    """Bit table (one byte per 8 bits, ``FILTER_BITS`` bits whatever the number of terms) with two bits per term set."""
    h = F.xxhash64("term")
    mask = F.lit(FILTER_BITS - 1)
    bit = item_terms.select(F.explode(F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))).alias("b"))
    rows = bit.groupBy(F.floor(F.col("b") / 32768).alias("part")).agg(
        F.bitmap_construct_agg(F.col("b") % 32768).alias("bits")).collect()
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        table[r["part"] * 4096: (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return table


class _Wanted(dict):
    """Whether an item may hold a term; answers are remembered up to a bound."""

    def __init__(self, table: np.ndarray):
        self.table = table.tobytes()

    def __missing__(self, term: bytes) -> bool:
        h = xxhash.xxh64_intdigest(term, 42)
        if len(self) > KNOWN:
            self.clear()
        out = self[term] = all(self.table[b >> 3] >> (b & 7) & 1 for b in (h & FILTER_BITS - 1, h >> 32 & FILTER_BITS - 1))
        return out


def _postings(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(table)
        for batch in batches:
            n, ends, term, tf = [], [0], [], []
            for text in terms.column(batch, "text"):
                found = terms.split(text, terms.LETTERS_DIGITS)
                count = Counter(found)
                mine = [t for t in count if wanted[t]]
                n.append(len(found))
                term += mine
                tf += [count[t] for t in mine]
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(term, pa.binary())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return run


def _flat(col: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column end to end, and the length of every row."""
    col = col.combine_chunks()
    return col.flatten(), pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)


class ImpactLists:
    """The postings of a shard as one impact list per term, and every document's postings for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.term, self.impact = doc[order], term[order], impact[order]
        self.start = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.ends = np.searchsorted(self.doc[self.by_doc], np.arange(n_docs + 1))
        self.seen = np.zeros(len(doc), bool)
        self.met = np.zeros(n_docs, bool)
        self.weight = np.zeros(n_terms, np.int64)

    def of_documents(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: the postings of ``docs``, and where each document's begin."""
        n = self.ends[docs + 1] - self.ends[docs]
        first = np.cumsum(n) - n
        return self.by_doc[np.repeat(self.ends[docs] - first, n) + np.arange(n.sum())], first

    def best(self, codes: np.ndarray, weights: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best documents (score, then ``rank``) over the lists ``codes``, their scores, and how many
        documents were looked up."""
        start, stop = self.start[codes], self.start[codes + 1]
        some = (stop > start) & (weights > 0)
        codes, weights, start, stop = codes[some], weights[some], start[some], stop[some]
        self.weight[codes] = weights
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        position, before, depth = start.copy(), 0, FIRST_DEPTH
        marked, looked_up = [], []
        while len(codes):
            new = np.concatenate([self.doc[min(a + before, b): min(a + depth, b)] for a, b in zip(start, stop, strict=True)])
            new = np.unique(new[~self.met[new]])
            self.met[new] = True
            looked_up.append(new)
            if len(new):
                at, first = self.of_documents(new)
                w = self.weight[self.term[at]]
                self.seen[at[w > 0]] = True
                marked.append(at[w > 0])
                docs = np.concatenate([docs, new])
                scores = np.concatenate([scores, np.add.reduceat(w * self.impact[at], first)])
                top = np.lexsort((rank[docs], -scores))[:k]
                docs, scores = docs[top], scores[top]
            bound = 0
            for i, b in enumerate(stop):
                if position[i] < b:
                    unseen = ~self.seen[position[i]: b]
                    step = int(unseen.argmax())
                    position[i] = position[i] + step if unseen[step] else b
                if position[i] < b:
                    bound += int(weights[i]) * int(self.impact[position[i] - 1])
            if (position == stop).all() or (len(docs) == k and bound < scores[-1]):
                break
            before, depth = depth, 2 * depth
        self.weight[codes] = 0
        for at in marked:
            self.seen[at] = False
        for new in looked_up:
            self.met[new] = False
        return docs[scores > 0], scores[scores > 0], sum(map(len, looked_up))


def _search(n_docs: int, n_terms: int, k: int):
    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        out = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
        if not docs.num_rows or not items.num_rows:
            return out.empty_table()
        item_term, item_size = _flat(items["terms"])
        item_weight = _flat(items["weights"])[0].to_numpy(zero_copy_only=False)
        words = pc.unique(item_term)
        item_code = pc.index_in(item_term, words).to_numpy(zero_copy_only=False)
        term, size = _flat(docs["terms"])
        tf = _flat(docs["tfs"])[0].to_numpy(zero_copy_only=False)
        code = pc.fill_null(pc.index_in(term, words), -1).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(docs.num_rows), size)
        keep = code >= 0
        doc, code, tf = doc[keep], code[keep], tf[keep]
        m = 100 - 90 + 90 * docs["n"].to_numpy()[doc] * n_docs // n_terms
        lists = ImpactLists(doc, code, 1_000_000_000 * tf // (1000 * tf + 8 * m), docs.num_rows, len(words))
        ids = docs["doc_id"].combine_chunks()
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
        found, scores, owner = [], [], []
        ends = np.cumsum(item_size)
        for i, (a, b) in enumerate(zip(ends - item_size, ends, strict=True)):
            best, score, _ = lists.best(item_code[a:b], item_weight[a:b], rank, k)
            found.append(best)
            scores.append(score)
            owner.append(np.full(len(best), i))
        return pa.table([items["item_id"].combine_chunks().take(pa.array(np.concatenate(owner))),
                         ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(scores))], schema=out)

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, shard: int = SHARD, block: int = ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (doc_id, text) of every item (item_id, text)."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    item_terms = stored(asked.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "lexical-items")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    postings = stored(plain.mapInArrow(_postings(term_filter(item_terms)), POSTINGS).where("n > 0"), "lexical-postings")
    total = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
                         F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000) * F.log((2 * F.lit(total["docs"]) + 2).cast("double") / (2 * F.col("df") + 1)))
    weighted = stored(item_terms.join(holding, "term").select("item_id", "term", weight.alias("weight"))
                      .groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
                      .select("item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "lexical-weights")
    shards, blocks = -(-total["postings"] // shard) or 1, -(-weighted.count() // block) or 1
    key = F.pmod(F.xxhash64("doc_id", "n", "tfs"), F.lit(shards)).alias("shard")
    left = postings.where(F.size("terms") > 0).select(key, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                                      "doc_id", "n", "terms", "tfs")
    right = weighted.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                            F.pmod(F.xxhash64("item_id", F.size("terms")), F.lit(blocks)).cast("int").alias("block"),
                            "item_id", "terms", "weights")
    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInArrow(_search(total["docs"], total["terms"], k), "item_id long, doc_id long, score long"))
    order = (F.desc("score"), F.asc_nulls_first("doc_id"))
    part = Window.partitionBy("item_id", "salt").orderBy(*order)
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn(
        "r", F.row_number().over(part)).where(F.col("r") <= k)
    whole = Window.partitionBy("item_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")
