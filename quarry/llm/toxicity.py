"""Toxicity score: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct 3- to 5-character grams of the lower-cased text, hashed to ``2**FEATURE_BITS``
cells. Two aggregations over the training rows give each cell its log-count ratio r = log of
(share of toxic rows with it / share of clean rows with it); cells whose ratio is within ``MIN_Z`` standard
errors of zero carry no signal and go. A logistic regression is then fitted on presence * r.

The fit uses at most about ``FIT_ROWS`` labelled rows (chosen by a hash of the id, so any run takes the same
ones) of at most ``FIT_CHARS`` characters each; both are parameters. Scoring covers every row and every whole
text. The only things sent to the workers are the sampled labels (bounded by ``fit_rows``) and the weight vector
(at most ``2**FEATURE_BITS`` floats).

Edge cases: null text is empty, and an empty text gets the score of a text without any known gram; rows
without a label or id are scored but never learned from; several labels of one id count as toxic if any is;
without labelled rows of both kinds every score is the smoothed share of toxic rows; repeated rows get
one result each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import stored

FEATURE_BITS = 20
ORDERS = (3, 4, 5)
FIT_ROWS, FIT_CHARS = 12_000, 50_000
MIN_ROWS, MIN_Z = 3, 2.5
BLOCK_BITS = 14
SLAB_CHARS = 1 << 16


def _slabs(texts: list[str], most: int = SLAB_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters (a longer text stands alone)."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def _cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Row of every character of the joined texts, where each text ends, and (order, cell of the gram that
    starts at each character)."""
    joined = "\x00".join(f" {t.replace(chr(0), ' ')} " for t in texts).lower()
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.append(np.flatnonzero(chars == 0), len(chars))
    poly, out = chars.copy(), []
    for n in range(2, min(max(ORDERS), len(chars)) + 1):
        poly = poly[:-1] * np.uint32(0x01000193) + chars[n - 1:]
        if n in ORDERS:
            cell = poly * np.uint32(0x9E3779B1) ^ (poly >> np.uint32(15)) * np.uint32(0x85EBCA77 + 2 * n)
            out.append((n, cell >> np.uint32(32 - FEATURE_BITS)))
    return chars, ends, out


def distinct_cells(texts: list[str]) -> Iterator[np.ndarray]:
    """Distinct cells of the grams of each text."""
    _, ends, grams = _cells(texts)
    last, begin = np.zeros(1 << FEATURE_BITS, np.int32), 0
    for end in ends:
        own = np.concatenate([c[begin: max(end - n + 1, begin)] for n, c in grams]) if grams else np.empty(0, np.uint32)
        at = np.arange(len(own), dtype=np.int32)
        last[own] = at  # a cell remembers one of its positions, so one position of each cell stays
        yield own[last[own] == at]
        begin = end + 1


def wanted_cells(texts: list[str], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, cell) pairs of the grams of ``texts`` in the ``wanted`` cells, rows ascending."""
    chars, ends, grams = _cells(texts)
    keys = []
    for n, cell in grams:
        at = np.flatnonzero(wanted[cell])
        row = np.searchsorted(ends, at, "left")
        inside = at + n <= ends[row]  # not across the end of a text
        keys.append(row[inside] << FEATURE_BITS | cell[at[inside]])
    flat = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    return flat >> FEATURE_BITS, flat & ((1 << FEATURE_BITS) - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each kind that hold each cell, in blocks of cells: (block, cells, toxic, clean)."""
    both = np.zeros((2, 1 << FEATURE_BITS), np.int32)
    for batch in batches:
        texts, label = batch.column("text").to_pylist(), np.asarray(batch.column("label").to_pylist(), np.int64)
        for a, b in _slabs(texts):
            for kind, cells in zip(label[a:b], distinct_cells(texts[a:b]), strict=True):
                both[kind][cells] += 1
    out = []
    for block in range(1 << (FEATURE_BITS - BLOCK_BITS)):
        part = both[:, block << BLOCK_BITS: (block + 1) << BLOCK_BITS]
        at = np.flatnonzero(part.any(axis=0)).astype(np.int32)
        if len(at):
            out.append((block, at.tobytes(), part[1][at].tobytes(), part[0][at].tobytes()))
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(("block", "cells", "toxic", "clean"), map(list, zip(*out, strict=True)),
                                                  strict=True)),
                                         pa.schema([("block", pa.int32()), *((n, pa.binary()) for n in ("cells", "toxic", "clean"))]))


def _ratios(n_toxic: int, n_clean: int):
    """Selects cells and their log-count ratio from the summed counts of one block."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block, total = int(pdf["block"].iloc[0]), np.zeros((2, 1 << BLOCK_BITS))
        for r in pdf.itertuples(index=False):
            at = np.frombuffer(r.cells, np.int32)
            total[1][at] += np.frombuffer(r.toxic, np.int32)
            total[0][at] += np.frombuffer(r.clean, np.int32)
        pos, neg = total[1] + 0.5, total[0] + 0.5
        ratio = np.log(pos / (n_toxic + 1)) - np.log(neg / (n_clean + 1))
        z = np.abs(ratio) / np.sqrt(1 / pos + 1 / neg)
        at = np.flatnonzero((total.sum(axis=0) >= MIN_ROWS) & (z >= MIN_Z))
        return pd.DataFrame({"cells": [(at + (block << BLOCK_BITS)).astype(np.int32).tobytes()],
                             "ratio": [ratio[at].astype(np.float32).tobytes()]})

    return run


def _present(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column("text").to_pylist(), []
            for a, b in _slabs(texts):
                row, cell = wanted_cells(texts[a:b], wanted)
                ends = np.searchsorted(row, np.arange(b - a + 1))
                out += [cell[x:y].astype(np.int32).tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())],
                                             ["doc_id", "label", "cells"])

    return run


def fit_logistic(ratio: np.ndarray, cells: list[np.ndarray], label: np.ndarray, l1: float = 3e-4,
                 steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights per cell (already times the ratio) and the bias, by adaptive proximal gradient steps. The L1
    term leaves weights on few cells, so that scoring looks at few grams."""
    flat = np.concatenate(cells) if cells else np.empty(0, np.int64)
    used, col = np.unique(flat, return_inverse=True)
    value, row = ratio[used][col], np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    n, rate = len(label), label.mean()
    w, b = np.zeros(len(used)), float(np.log(rate / (1 - rate)))
    grad2, gb2 = np.full(len(used), 1e-8), 1e-8
    for _ in range(steps):
        s = np.bincount(row, value * w[col], minlength=n) + b
        e = 1 / (1 + np.exp(-np.clip(s, -30, 30))) - label
        g = np.bincount(col, value * e[row], minlength=len(used)) / n
        gb = e.mean()
        grad2 += g * g
        gb2 += gb * gb
        rate = 0.3 / np.sqrt(grad2)
        w -= rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        b -= 0.3 * gb / np.sqrt(gb2)
    out = np.zeros(len(ratio), np.float32)
    out[used] = w * ratio[used]
    return out, b


def _train(ratio: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "label", "cells"], kind="stable")
        w, b = fit_logistic(ratio, [np.frombuffer(c, np.int32) for c in pdf["cells"]],
                            pdf["label"].to_numpy(np.float64))
        return pd.DataFrame({"weights": [w.tobytes()], "bias": [b]})

    return run


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> tuple[np.ndarray, float]:
    """Weights and bias from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1)."""
    known = stored(labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label")), "toxicity-labels")
    total = known.count()
    share = min(1.0, fit_rows / max(total, 1))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # at most about fit_rows small rows: the bound of this broadcast
    sample = stored(docs.join(F.broadcast(some), "doc_id")
                    .select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text"))
                    .where(F.char_length("text") <= fit_chars), "toxicity-sample")
    kinds = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    zero = np.zeros(1 << FEATURE_BITS, np.float32)
    if len(kinds) < 2:
        share = (kinds.get(1, 0) + 1) / (sum(kinds.values()) + 2)
        return zero, float(np.log(share / (1 - share)))
    counts = sample.select("label", "text").mapInArrow(_count, "block int, cells binary, toxic binary, clean binary")
    ratio = zero.copy()
    for r in counts.groupBy("block").applyInPandas(_ratios(kinds[1], kinds[0]), "cells binary, ratio binary").collect():
        ratio[np.frombuffer(r["cells"], np.int32)] = np.frombuffer(r["ratio"], np.float32)
    rows = sample.mapInArrow(_present(ratio != 0), "doc_id long, label int, cells binary")
    model = rows.groupBy(F.lit("all")).applyInPandas(_train(ratio), "weights binary, bias double").first()
    return np.frombuffer(model["weights"], np.float32), float(model["bias"])


def _score(weights: np.ndarray, bias: float, text: str):
    used = weights != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            total = np.full(len(texts), bias)
            for a, b in _slabs(texts):
                row, cell = wanted_cells(texts[a:b], used)
                total[a:b] += np.bincount(row, weights[cell], minlength=b - a)
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())],
                                             [*batch.schema.names, "_score"])

    return run


def score(docs: DataFrame, weights: np.ndarray, bias: float, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and _score, one row per row, in place."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)]
                          + [T.StructField("_score", T.DoubleType())])
    out = docs.toDF(*names).mapInArrow(_score(weights, bias, names[docs.columns.index(text_col)]), schema)
    return out.toDF(*docs.columns, "_score")


def held_out(doc_id: str = "doc_id"):
    """Rows kept out of training: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", **limits) -> DataFrame:
    """Scores of every row of ``docs``, learned from the rows of ``labels`` that are not held out:
    id, held_out, score, predicted."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = score(plain, *fit(plain, _training(labels, id_col, label_col), **limits))
    return scored.select(F.col("doc_id").alias(id_col), held_out().alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def _training(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where(~held_out())


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", **limits) -> DataFrame:
    """``docs`` without the rows that the classifier calls toxic, same columns."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(plain, _training(labels, id_col, label_col), **limits)
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    kept = score(docs.toDF(*names), *model, names[docs.columns.index(text_col)]).where("_score < 0.5")
    return kept.drop("_score").toDF(*docs.columns)
