"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of all words over the whole corpus, in ``2**CELL_BITS`` hashed cells (a fixed size,
   summed block by block), give the IDF weights.
2. The benchmark items are cut into overlapping passages of at most a window's length, ``2 * STEP`` words. Their TF-IDF
   matrix gets a randomised SVD: a Gaussian sketch with one power iteration, each product summed over Spark partitions;
   only a block's matrices reach the driver. The latent space keeps the fewest singular directions that hold
   ``ENERGY`` of all weight and ``FLOOR`` of every passage's own, at most ``RANK``.
3. Every document is cut into overlapping windows of ``2 * STEP`` words, which are projected into the latent space
   and compared with every passage. An item is a candidate where its passage's cosine shows that the window holds
   ``SHARE`` of the passage's weight: the bound follows from the passage's and the window's weight and from how much of
   the passage the latent space kept. A window whose words of the benchmark weigh less than that share of the lightest
   passage is skipped.
4. A candidate is verified on the words themselves: longest common subsequence of the item with the words
   around the window, and a check of the item's answer (its last words, or a given answer column) in order.

``SHARE`` is half of the smallest share of words that step 4 accepts (``LIKELY``), so that a copy spread over twice its
length is still found. Retrieval is approximate: the tests measure its recall against step 4 over all windows and items.
Items are handled in blocks of about ``PASSAGES`` passages, whole items, so that what is sent to workers stays
bounded by a block's words times ``RANK``, however many items there are.

Edge cases: null or empty documents are clean; null or wordless items match nothing; repeated items or rows give
repeated results; an empty benchmark leaves every document clean; empty tables give no rows; an item shorter
than four words must be found whole; other columns pass through ``decontaminate`` and are not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import mix64, stored, text_bytes
from quarry.llm.words import byte_tables, slabs, word_hashes

CELL_BITS, BLOCK_BITS = 20, 14
STEP = 16
RANK, PASSAGES = 256, 512
ENERGY, FLOOR = 0.8, 0.25
SURE, LIKELY = 0.7, 0.5
SHARE = LIKELY / 2
ANSWER_WORDS = 5


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Words here are runs of letters and digits: every other ASCII byte separates."""
    values, space = byte_tables()
    for b in range(128):
        space[b] = not chr(b).isalnum()
    return values, space


def _cells(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values, space = _tables()
    total, rows = np.zeros(1 << CELL_BITS, np.int64), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        rows += batch.num_rows
        for a, b in slabs(offsets):
            words, ends = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], values, space)
            row = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(ends))
            key = np.unique(row << CELL_BITS | _cells(words))
            total += np.bincount(key & ((1 << CELL_BITS) - 1), minlength=1 << CELL_BITS)
    out = [(-1, np.empty(0, np.int32).tobytes(), np.array([rows], np.int64).tobytes())]
    for block in range(1 << (CELL_BITS - BLOCK_BITS)):
        part = total[block << BLOCK_BITS: (block + 1) << BLOCK_BITS]
        at = np.flatnonzero(part)
        if len(at):
            out.append((block, at.astype(np.int32).tobytes(), part[at].tobytes()))
    yield pa.RecordBatch.from_pydict(dict(zip(("block", "cells", "n"), map(list, zip(*out, strict=True)), strict=True)),
                                     pa.schema([("block", pa.int32()), ("cells", pa.binary()), ("n", pa.binary())]))


def _sum_df(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << BLOCK_BITS, np.int64)
    block = int(pdf["block"].iloc[0])
    for r in pdf.itertuples(index=False):
        at, n = np.frombuffer(r.cells, np.int32), np.frombuffer(r.n, np.int64)
        total[at if block >= 0 else [0]] += n
    return pd.DataFrame({"block": [block], "n": [total.tobytes()]})


def idf_weights(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """IDF per hashed cell over all rows of ``docs`` (a fixed 2**CELL_BITS floats)."""
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(_df, "block int, cells binary, n binary")
    df, rows = np.zeros(1 << CELL_BITS, np.float64), 0
    for r in parts.groupBy("block").applyInPandas(_sum_df, "block int, n binary").collect():
        n = np.frombuffer(r["n"], np.int64)
        if r["block"] < 0:
            rows = int(n[0])
        else:
            df[r["block"] << BLOCK_BITS: (r["block"] + 1) << BLOCK_BITS] = n
    return np.log((rows + 2) / (df + 1)).astype(np.float32)


def passage_starts(n: int) -> list[int]:
    """First words of the passages of ``n`` words: every ``STEP`` words, the last one ends with the text."""
    return [*range(0, n - 2 * STEP, STEP), max(0, n - 2 * STEP)]


def _item_words(idf: np.ndarray):
    """Items as (item_id, words, answer words, and of every passage: distinct words, TF-IDF weights, weight of its words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, space = _tables()
        for batch in batches:
            words, ends = word_hashes(*text_bytes(batch.column("text")), values, space)
            answer, answer_ends = word_hashes(*text_bytes(batch.column("answer")), values, space)
            out = []
            for i in range(batch.num_rows):
                w, a = words[ends[i]:ends[i + 1]], answer[answer_ends[i]:answer_ends[i + 1]]
                terms, weights, mass = [], [], []
                for start in passage_starts(len(w)) if len(w) else ():
                    term, n = np.unique(w[start: start + 2 * STEP], return_counts=True)
                    one = idf[_cells(term)].astype(np.float64)
                    terms.append(term.tobytes())
                    weights.append((n * one).tobytes())
                    mass.append(float((n * one ** 2).sum()))
                out.append((w.tobytes(), (a if len(a) else w[-ANSWER_WORDS:]).tobytes(), terms, weights, mass))
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                (pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), *columns],
                                             ["item_id", "words", "answer", "terms", "weights", "mass"])

    return run


ITEM = "item_id long, words binary, answer binary, terms array<binary>, weights array<binary>, mass array<double>"


def _vectors(rows: list[bytes], kind: type) -> list[np.ndarray]:
    return [np.frombuffer(r, kind) for r in rows]


def _gauss(terms: np.ndarray, width: int) -> np.ndarray:
    """Rows of a random normal matrix, named by the word hash (Box-Muller on hashed uniforms)."""
    col = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u, v = (((mix64(mix64(terms + np.uint64(s))[:, None] + col[None, :]) >> np.uint64(11)).astype(np.float64) + 0.5) / 2 ** 53
            for s in (1, 2))
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def _power(width: int):
    """Partial sums of A' (A G) by word, for the rows of A in this partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            terms = _vectors([t for row in batch.column("terms").to_pylist() for t in row], np.uint64)
            weights = _vectors([w for row in batch.column("weights").to_pylist() for w in row], np.float64)
            used, col = np.unique(np.concatenate(terms), return_inverse=True)
            total, at = np.zeros((len(used), width)), 0
            for t, w in zip(terms, weights, strict=True):
                unit = w / np.linalg.norm(w)
                total[col[at: at + len(t)]] += unit[:, None] * (unit @ _gauss(t, width))
                at += len(t)
            yield pa.RecordBatch.from_arrays([pa.array(used.view(np.int64)), pa.array([r.tobytes() for r in total], pa.binary())],
                                             ["term", "vec"])

    return run


def _sum_vectors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums the partial vectors of each word of one slice of words."""
    used, row = np.unique(pdf["term"].to_numpy(np.int64), return_inverse=True)
    vecs = np.stack([np.frombuffer(v, np.float64) for v in pdf["vec"]])
    total = np.zeros((len(used), vecs.shape[1]))
    np.add.at(total, row, vecs)
    return pd.DataFrame({"term": used, "vec": [v.tobytes() for v in total]})


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for batch in batches:
        z = np.stack([np.frombuffer(v, np.float64) for v in batch.column("vec").to_pylist()]) if batch.num_rows else None
        total = total if z is None else total + z.T @ z
    if not np.isscalar(total):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])


def _range_basis(items: DataFrame, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Words (sorted hashes) of the passages and their rows of an orthonormal basis of the sketch."""
    slices = 16
    width = rank + 8
    z = stored(items.coalesce(slices).mapInArrow(_power(width), "term long, vec binary")
               .groupBy(F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice"))
               .applyInPandas(_sum_vectors, "term long, vec binary"), "decontam-basis")
    grams = [np.frombuffer(r["g"], np.float64).reshape(width, width)
             for r in z.coalesce(slices).mapInArrow(_gram, "g binary").collect()]
    if not grams:
        return np.empty(0, np.uint64), np.empty((0, 1), np.float32)
    value, turn = np.linalg.eigh(sum(grams))
    keep = np.flatnonzero(value > value.max() * 1e-12)
    turn = turn[:, keep] / np.sqrt(value[keep])
    rows = z.collect()  # one block of items: bounded by its words times rank
    terms = np.array([r["term"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(terms)
    return terms[order], np.stack([np.frombuffer(rows[i]["vec"], np.float64) for i in order]) @ turn


def latent_space(items: DataFrame, terms_of: list[np.ndarray], weights_of: list[np.ndarray],
                 rank: int = RANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Randomised SVD of the passages' TF-IDF matrix (rows of unit length): words (sorted hashes), their rows of the right
    singular vectors, and the passages in the latent space. The space has as few directions as keep
    ``ENERGY`` of all weight and ``FLOOR`` of every passage's, ``rank`` at most."""
    terms, basis = _range_basis(items, rank)
    latent = np.zeros((len(terms_of), basis.shape[1]))
    for i, (t, w) in enumerate(zip(terms_of, weights_of, strict=True)):
        latent[i] = (w / np.linalg.norm(w)) @ basis[np.searchsorted(terms, t)]
    value, turn = np.linalg.eigh(latent.T @ latent)
    turn = turn[:, np.argsort(-value)][:, :rank]
    latent = latent @ turn
    kept = np.cumsum(latent ** 2, axis=1)
    enough = (kept.sum(axis=0) >= ENERGY * len(kept)) & (kept.min(axis=0, initial=1) >= FLOOR)
    r = int(np.argmax(enough)) + 1 if enough.any() else latent.shape[1]
    return terms, basis @ turn[:, :r], latent[:, :r]


def common_subsequence(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one big-integer step per word of ``text``."""
    where: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    v = full
    for w in text.tolist():
        m = where.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(pattern) - v.bit_count()


def verdict(item: np.ndarray, answer: np.ndarray, around: np.ndarray) -> tuple[float, bool, bool]:
    """(share of the item's words found in order, answer found, contaminated)."""
    share = common_subsequence(item, around) / len(item)
    said = len(answer) > 0 and common_subsequence(answer, around) == len(answer)
    if len(item) < 4:
        return share, said, share == 1
    return share, said, share >= SURE or (share >= LIKELY and said)


def _search(text: str, idf: np.ndarray, terms: np.ndarray, basis: np.ndarray, ids: list, items: list[np.ndarray],
            answers: list[np.ndarray], owner: np.ndarray, latent: np.ndarray, size: np.ndarray, mass: np.ndarray, share: float):
    """Adds _hit to every row: the best verified or best candidate item. Of every passage: ``owner`` its item,
    ``latent`` its unit vector's projection, ``size`` its vector's length, ``mass`` the weight of its words."""
    weight2 = (idf.astype(np.float64) ** 2).astype(np.float32)
    holds = np.zeros(1 << CELL_BITS, bool)
    holds[_cells(terms)] = True
    kept = np.sqrt((latent ** 2).sum(axis=1))
    rows32, latent32 = basis.astype(np.float32), (latent / np.maximum(kept, 1e-9)[:, None]).astype(np.float32)
    bound = (share * kept * mass / size).astype(np.float32)  # of cosine times the window's length
    least = share * float(mass.min(initial=np.inf))
    kind = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()),
                      ("answer_found", pa.bool_()), ("contaminated", pa.bool_())])

    def known(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that the items have, and their terms."""
        at = np.flatnonzero(holds[_cells(words)])
        pos = np.searchsorted(terms, words[at])
        pos[pos == len(terms)] = 0
        good = terms[pos] == words[at]
        return at[good], pos[good]

    def candidates(words: np.ndarray, ends: np.ndarray, at: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, first word, last word, item, cosine) of the windows that reach the bound of one of the item's passages."""
        n_words = np.diff(ends)
        n_steps = -(-n_words // STEP)
        first = np.concatenate([[0], np.cumsum(n_steps)])
        if first[-1] == 0:
            return
        row = np.repeat(np.arange(len(n_words)), n_steps)
        begin = ends[:-1][row] + STEP * (np.arange(first[-1]) - first[:-1][row])
        cell = _cells(words)
        w2 = weight2[cell]
        inside = np.zeros(len(words), np.float32)
        inside[at] = w2[at]
        e_all, e_in = np.add.reduceat(w2, begin), np.add.reduceat(inside, begin)
        # a window is a step and the next one of the same row (alone at the end of a row)
        nxt = np.append(row[1:] == row[:-1], False)
        alone = n_steps[row] == 1
        both_all, both_in = e_all + np.where(nxt, np.append(e_all[1:], 0), 0), e_in + np.where(nxt, np.append(e_in[1:], 0), 0)
        win = np.flatnonzero((nxt | alone) & (both_in >= least * (1 - 1e-5)) & (both_in > 0))
        if not len(win):
            return
        # steps of the surviving windows
        need = np.unique(np.concatenate([win, win[nxt[win]] + 1]))
        step_of = np.searchsorted(begin, at, "right") - 1
        pick = np.isin(step_of, need)
        vec = np.zeros((len(need), rows32.shape[1]), np.float32)
        which, own, scale = np.searchsorted(need, step_of[pick]), pos[pick], idf[cell[at[pick]]]
        heads = np.flatnonzero(np.append(True, which[1:] != which[:-1]))  # words come step by step
        for k in range(0, len(heads), 256):
            a, b = heads[k], heads[k + 256] if k + 256 < len(heads) else len(which)
            part = rows32[own[a:b]]
            part *= scale[a:b, None]
            vec[which[heads[k:k + 256]]] = np.add.reduceat(part, heads[k:k + 256] - a, axis=0)
        for k in range(0, len(win), 4096):
            w = win[k: k + 4096]
            v = vec[np.searchsorted(need, w)]
            more = np.flatnonzero(nxt[w])
            v[more] += vec[np.searchsorted(need, w[more] + 1)]
            dot = v @ latent32.T
            x, passage = np.nonzero(dot >= bound)
            if not len(x):
                continue
            cosine = dot[x, passage] / np.sqrt(both_all[w[x]])
            pair, at_ = np.unique(x * len(items) + owner[passage], return_inverse=True)
            best = np.zeros(len(pair), np.float32)
            np.maximum.at(best, at_, cosine)
            for x, item, c in zip(pair // len(items), pair % len(items), best, strict=True):
                s = w[x]
                end = min(begin[s] + 2 * STEP, ends[row[s] + 1])
                yield int(row[s]), int(begin[s]), int(end), int(item), float(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, space = _tables()
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            hits: list[dict | None] = [None] * batch.num_rows
            ranks: list[tuple] = [()] * batch.num_rows
            for a, b in slabs(offsets) if len(terms) else ():
                words, ends = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], values, space)
                at, pos = known(words)
                for row, lo, hi, item, cosine in candidates(words, ends, at, pos):
                    m = len(items[item])
                    around = words[max(ends[row], lo - m): min(ends[row + 1], hi + m)]
                    share, said, bad = verdict(items[item], answers[item], around)
                    rank = (bad, share, cosine, -ids[item])
                    if not ranks[a + row] or rank > ranks[a + row]:
                        ranks[a + row] = rank
                        hits[a + row] = {"item_id": ids[item], "cosine": cosine, "lcs_share": share,
                                         "answer_found": said, "contaminated": bad}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, kind)], [*batch.schema.names, "_hit"])

    return run


HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
                    T.StructField("lcs_share", T.DoubleType()), T.StructField("answer_found", T.BooleanType()),
                    T.StructField("contaminated", T.BooleanType())])


def _dealt(parsed: DataFrame) -> tuple[DataFrame, int]:
    """Items with their block: passages are numbered by (hash, id) of their item, and an item goes to the block of its first
    passage, so a block holds ``PASSAGES`` and what its last item has beyond."""
    total = parsed.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // PASSAGES))
    if blocks == 1:
        return parsed.withColumn("block", F.lit(0).cast("long")), 1
    hashed = parsed.withColumn("_hash", F.xxhash64("item_id", "words")).withColumn("_part", F.pmod("_hash", F.lit(blocks)))
    starts, upto = [], 0
    for r in hashed.groupBy("_part").agg(F.sum(F.size("terms")).alias("n")).orderBy("_part").collect():  # a row per block
        starts.append((r["_part"], upto))
        upto += r["n"]
    starts = parsed.sparkSession.createDataFrame(starts, "_part long, _start long")
    w = Window.partitionBy("_part").orderBy("_hash", "item_id", "words").rowsBetween(Window.unboundedPreceding, -1)
    dealt = hashed.withColumn("_before", F.coalesce(F.sum(F.size("terms")).over(w), F.lit(0))).join(starts, "_part")
    block = F.floor((F.col("_start") + F.col("_before")) / F.lit(PASSAGES)).cast("long")
    return stored(dealt.select(*parsed.columns, block.alias("block")), "decontam-blocks"), blocks


def _searches(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str,
              answer: str | None, share: float) -> list:
    """One search per block of items."""
    idf = idf_weights(docs, text_col)
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"),
                            (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"))
    parsed = stored(rows.where("item_id IS NOT NULL").mapInArrow(_item_words(idf), ITEM)
                    .where("length(words) > 0"), "decontam-items")
    parsed, blocks = _dealt(parsed)
    out = []
    for k in range(blocks):
        items = parsed.where(F.col("block") == k)
        held = sorted(items.collect(), key=lambda r: (r["item_id"], r["words"]))
        weights = _vectors([w for r in held for w in r["weights"]], np.float64)
        terms, basis, latent = latent_space(items, _vectors([t for r in held for t in r["terms"]], np.uint64), weights, RANK)
        out.append(_search("_text", idf, terms, basis, [r["item_id"] for r in held],
                           _vectors([r["words"] for r in held], np.uint64), _vectors([r["answer"] for r in held], np.uint64),
                           np.repeat(np.arange(len(held)), [len(r["terms"]) for r in held]), latent,
                           np.array([np.linalg.norm(w) for w in weights]),
                           np.array([m for r in held for m in r["mass"]], np.float64), share))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", answer: str | None = None,
                  share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: id, contaminated, and of the item that matches best (null without a
    candidate): item_id, cosine, lcs_share, answer_found."""
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = found.schema["_id"].dataType
    searches = _searches(docs, benchmark, text_col, item_id, item_text, answer, share)
    best = None
    for i, search in enumerate(searches):
        schema = T.StructType([T.StructField("_id", kind), T.StructField("_text", T.StringType()),
                               *(T.StructField(f"_h{j}", HIT) for j in range(i)), T.StructField("_hit", HIT)])
        found = found.mapInArrow(search, schema).withColumnRenamed("_hit", f"_h{i}")
        order = F.struct(F.coalesce(F.col(f"_h{i}.contaminated"), F.lit(False)), F.col(f"_h{i}.lcs_share"),
                         F.col(f"_h{i}.cosine"), F.col(f"_h{i}").alias("hit"))
        best = order if best is None else F.greatest(best, order)
    hit = best.getField("hit")
    return found.select(F.col("_id").alias(id_col), F.coalesce(hit["contaminated"], F.lit(False)).alias("contaminated"),
                        *(hit[n].alias(n) for n in ("item_id", "cosine", "lcs_share", "answer_found")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, same columns, rows in place."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    args = {"item_id": "item_id", "item_text": "text", "answer": None, "share": SHARE} | options
    rows = docs.toDF(*names).withColumn("_text", F.col(names[docs.columns.index(text_col)]))
    for search in _searches(docs, benchmark, text_col, **args):
        schema = T.StructType([*rows.schema.fields, T.StructField("_hit", HIT)])
        rows = rows.mapInArrow(search, schema).where("NOT coalesce(_hit.contaminated, false)").drop("_hit")
    return rows.drop("_text").toDF(*docs.columns)
