"""Line dedup by winnowing over line hashes.

The non-empty lines of a document are hashed; of every window of ``WINDOW`` consecutive lines the smallest hash
is selected, so any run of ``WINDOW`` or more lines that two documents share has a common fingerprint.
Positions whose fingerprint occurs once are dropped; the rest are joined on it with the hashes of the lines
around them, and each match is extended both ways over every window the fingerprint was selected for. A line
goes when it lies in a window that also occurs earlier (smaller id, then earlier line). Matches are judged on
the input, each window against its first occurrence, so a run found in a third of all documents costs one
row per occurrence.

With ``window`` 1 every line that occurs earlier goes: runs of any length, inside documents of any length, so a
one-line text is also found within a longer document.

Edge cases: a document with fewer than ``window`` lines is one run of all its lines; null and empty texts have
no lines and stay as they are (null stays null); rows with a null id are neither changed nor compared; rows that
share an id are one document (a window of theirs has one position); repeated lines of one document follow the
same rule; empty tables give no rows; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import mix64, stored, text_bytes
from quarry.llm.id_filter import maybe_among
from quarry.llm.words import slabs, word_hashes

WINDOW = 3


def _tables() -> tuple[np.ndarray, np.ndarray]:
    newline = np.zeros(256, bool)
    newline[0x0A] = True
    return mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D)), newline


def selected_runs(lines: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Fingerprints of one document's line hashes: (position, first window, last window) for each selected
    line; a short document has one window of all its lines."""
    n = len(lines)
    if n <= window:
        return [(int(np.argmin(lines)), 0, 0)] if n else []
    view = np.lib.stride_tricks.sliding_window_view(lines, window)
    at = np.argmin(view, axis=1) + np.arange(n - window + 1)
    cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return [(int(at[a]), int(a), int(b) - 1) for a, b in zip(cut, np.append(cut[1:], len(at)), strict=True)]


def _fingerprints(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, newline = _tables()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            doc, fp, first, around, ends = [], [], [], [], [0]
            for a, b in slabs(offsets):
                lines, line_ends = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], values, newline)
                lines = lines.view(np.int64)
                if window == 1:  # every line is a run of its own
                    counts = np.diff(line_ends)
                    doc.extend(np.repeat(np.array(ids[a:b], np.int64), counts).tolist())
                    fp.extend(lines.tolist())
                    first.extend((np.arange(len(lines)) - np.repeat(line_ends[:-1], counts)).tolist())
                    around.append(lines)
                    ends.extend(range(ends[-1] + 1, ends[-1] + 1 + len(lines)))
                    continue
                for i in range(b - a):
                    own = lines[line_ends[i]:line_ends[i + 1]]
                    for at, lo, hi in selected_runs(own, window):
                        part = own[lo: hi + window]
                        doc.append(ids[a + i])
                        fp.append(int(own[at]))
                        first.append(lo)
                        around.append(part)
                        ends.append(ends[-1] + len(part))
            flat = np.concatenate(around) if around else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(fp, pa.int64()), pa.array(first, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                ["doc_id", "fp", "first", "around"])

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of ``docs`` (doc_id, text) that occur earlier too: (doc_id, line, size)."""
    rows = docs.where("doc_id IS NOT NULL").mapInArrow(
        _fingerprints(window), "doc_id long, fp long, first int, around array<long>")
    marks = stored(rows, "line-fingerprints")
    again = stored(marks.groupBy("fp").count().where("count > 1").select("fp"), "line-repeats")
    windows = stored(
        marks.join(again, "fp").withColumn("size", F.least(F.lit(window), F.size("around")))
        .select("doc_id", "first", "size", "around", F.explode(F.sequence(F.lit(0), F.size("around") - F.col("size"))).alias("i"))
        .select("doc_id", (F.col("first") + F.col("i")).alias("line"), "size",
                F.xxhash64(F.slice("around", F.col("i") + 1, F.col("size"))).alias("k1"),
                F.xxhash64(F.lit(1), F.slice("around", F.col("i") + 1, F.col("size"))).alias("k2")), "line-windows")
    first = stored(windows.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "line")).alias("at"), F.count("*").alias("n"))
                   .where("n > 1").select("k1", "k2", "at"), "line-first")
    return (windows.join(first, ["k1", "k2"]).where(F.struct("doc_id", "line") > F.col("at"))
            .select("doc_id", "line", "size"))


def _cut(text: str, starts: str, size: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out, counts = batch.column(text).to_pylist(), [], ([], [], [])
            for t, at, n in zip(texts, batch.column(starts).to_pylist(), batch.column(size).to_pylist(), strict=True):
                parts = (t or "").split("\n")
                line = np.cumsum([p != "" for p in parts]) - 1
                total = int(line[-1]) + 1
                gone = np.zeros(total + 1, np.int64)
                for a in at or ():
                    gone[a] += 1
                    gone[min(a + n, total)] -= 1
                gone = np.cumsum(gone)[:total] > 0
                counts[0].append(total)
                counts[1].append(int(gone.sum()))
                counts[2].append(int((gone & ~np.append(False, gone[:-1])).sum()) if total else 0)
                out.append(t if not at else "\n".join(p for p, i in zip(parts, line, strict=True) if p == "" or not gone[i]))
            cols = [pa.array(out, pa.string()) if n == text else c
                    for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in (starts, size)]
            names = [n for n in batch.schema.names if n not in (starts, size)]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(c, pa.int64()) for c in counts)],
                                             [*names, "n_lines", "n_removed", "n_runs"])

    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with later repeated runs of lines removed from the text, plus n_lines (non-empty lines
    before), n_removed and n_runs (maximal removed runs). The three are added as the last columns: rename input columns of
    these names first, else the result holds two of a name."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(repeated_windows(plain, window).groupBy("doc_id").agg(
        F.collect_set("line").alias("_starts"), F.max("size").alias("_size")), "line-removed")
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    key, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    # only rows that may have lines to lose meet the marks; the others stay in their partition
    rows = maybe_among(docs.toDF(*names), F.col(key).cast("long"), found.select("doc_id"))
    hit = rows.where("_maybe").join(found, F.col("_key") == found["doc_id"], "left").select(*names, "_starts", "_size")
    rows = rows.where("NOT _maybe").select(*names, F.lit(None).cast("array<int>").alias("_starts"),
                                           F.lit(None).cast("int").alias("_size")).union(hit)
    schema = T.StructType([*rows.schema.fields[:len(names)], *(T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed", "n_runs"))])
    return rows.mapInArrow(_cut(text, "_starts", "_size"), schema).toDF(*docs.columns, "n_lines", "n_removed", "n_runs")
