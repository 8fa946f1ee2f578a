"""Position lists dealt out by ranges of (term, doc_id), every range in order.

The ranges are cut from the words of some documents, so the lists of all documents are made once. Rows of a range travel packed, some
thousand to a value, and are brought in order where the range arrives. The choice of documents decides only where ranges begin: every row is
in exactly one range whatever the cuts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import doc_words as dw

# ---- fixed values: documents the cuts follow, keys looked at, rows of lists packed together; a row counts as so many numbers
# besides its positions; numbers of a range and of a small range ----
CUT_DOCS, CUT_KEYS, PACK_ROWS = 2000, 40_000, 500_000
ROW_NUMBERS, RANGE_NUMBERS, SMALL_NUMBERS = 12, 14_000_000, 700_000
# ---- end of fixed values ----

_PACKED = "part int, size long, rows binary"
_ROWS = pa.schema([("term", pa.string()), ("doc_id", pa.int64()), ("tf", pa.int64()), ("dl", pa.int64()),
                   ("at", pa.list_(pa.struct([("field", pa.string()), ("pos", pa.list_(pa.int32()))])))])
_CODEC = "zstd"
_NO_ID = np.iinfo(np.int64).min  # ids that are missing come first


def _ids(col: pa.Array) -> np.ndarray:
    return col.fill_null(_NO_ID).to_numpy()


def _ranked(col: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct words in order (a missing one as if empty), and the number of every row's word."""
    coded = col.cast(pa.string()).fill_null("").dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)).to_pylist(), rank[coded.indices.to_numpy()]


def _range_of(batch: pa.RecordBatch, cuts: list[tuple[str, int]]) -> np.ndarray:
    """Of every list row the number of cuts at or before its key."""
    terms, word = _ranked(batch.column(0))
    at = np.arange(len(terms))
    below = np.searchsorted([bisect_right(terms, t) for t, _ in cuts], at, "right")  # cuts at lesser words
    upto = np.searchsorted([bisect_left(terms, t) for t, _ in cuts], at, "right")
    out = below[word]
    some = np.flatnonzero(upto[word] > out)
    if len(some):
        ids, firsts = _ids(batch.column(1))[some], np.array([d for _, d in cuts], np.int64)
        order = np.argsort(word[some], kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(word[some][order])) + 1):
            w = word[some[rows[0]]]
            out[some[rows]] += np.searchsorted(firsts[below[w]: upto[w]], ids[rows], "right")
    return out


def _pack(batch: pa.RecordBatch) -> tuple[int, bytes]:
    """Size and bytes of the batch, compressed: the first bytes of all its four-byte units before the second ones and so on: most numbers are small."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    units = np.frombuffer(sink.getvalue(), np.uint8).reshape(-1, 4)  # a stream is a multiple of eight bytes long
    return units.size, pa.compress(pa.py_buffer(np.ascontiguousarray(units.T)), _CODEC, asbytes=True)


def _unpack(rows: pa.Buffer, size: int) -> pa.RecordBatch:
    units = np.frombuffer(pa.decompress(rows, size, _CODEC), np.uint8).reshape(4, -1)
    return pa.ipc.open_stream(pa.py_buffer(np.ascontiguousarray(units.T))).read_next_batch()


def _packs(batch: pa.RecordBatch, cuts: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, _ROWS.types)], schema=_ROWS)
    part = _range_of(batch, cuts)
    if (np.diff(part) < 0).any():
        order = np.argsort(part, kind="stable")
        batch, part = batch.take(pa.array(order)), part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    found = []
    for a, b in zip(edges[:-1], edges[1:]):
        found.append((int(part[a]), *_pack(batch.slice(a, b - a))))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.binary()))],
                                         ["part", "size", "rows"])


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each range, sorted."""
    held: dict[int, list] = {}
    for batch in batches:
        for part, size, rows in zip(*(batch.column(c) for c in ("part", "size", "rows"))):
            held.setdefault(part.as_py(), []).append((size.as_py(), rows.as_buffer()))
    for part in sorted(held):
        rows = pa.Table.from_batches([_unpack(b, n) for n, b in held.pop(part)])
        rows = rows.combine_chunks()
        _, word = _ranked(rows.column(0).combine_chunks())
        order = np.lexsort((_ids(rows.column(1).combine_chunks()), word))
        for at in range(0, len(order), dw.ROWS_OUT):
            yield from rows.take(pa.array(order[at: at + dw.ROWS_OUT])).combine_chunks().to_batches()


def _cuts(sources: list, n_docs: int, at_once: int) -> list[tuple[str, int]]:
    """Where ranges begin, by the rows of about ``CUT_DOCS`` documents; those of least hash are looked at."""
    every = max(1, n_docs // CUT_DOCS)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0
    keys = reduce(DataFrame.union, ((dw.doc_lists(s.texts.where(chosen), s.names) if s.lists is None else s.lists.where(chosen))
                                    .select("term", "doc_id", "tf") for s in sources))
    found = keys.withColumn("h", F.xxhash64("term", "doc_id")).orderBy("h").limit(CUT_KEYS).collect()
    if not found:
        return []
    # the greatest of so many least hashes says how many rows there are
    seen = (found[-1]["h"] + (1 << 63)) / (1 << 64) if len(found) == CUT_KEYS else 1.0
    order = sorted((r["term"] or "", _NO_ID if r["doc_id"] is None else r["doc_id"], r["tf"]) for r in found)
    upto = np.cumsum([ROW_NUMBERS + tf for _, _, tf in order])
    numbers = upto[-1] * every / max(seen, 1e-9)
    ranges = int(max(-(-numbers // RANGE_NUMBERS), min(at_once, -(-numbers // SMALL_NUMBERS)), 1))
    firsts = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges, "right")
    return sorted({order[min(i, len(order) - 1)][:2] for i in firsts})


def lists_in_ranges(sources: list, n_docs: int) -> DataFrame:
    """The lists (``term, doc_id, tf, dl, at``) of ``index.Source`` rows, a partition for each range of (term, doc_id)."""
    spark = sources[0].frame.sparkSession
    cuts = _cuts(sources, n_docs, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def packed(s) -> DataFrame:
        def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in dw.parts(batches, len(names)):
                yield from _packs(dw._list_rows(part, names), cuts)

        def of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held += [batch] if batch.num_rows else []
                if sum(b.num_rows for b in held) >= PACK_ROWS or sum(b.nbytes for b in held) >= dw.BYTES_AT_ONCE * 8:
                    yield from _packs(_one(held), cuts)
                    held = []
            if held:
                yield from _packs(_one(held), cuts)

        names = s.names
        if s.lists is None:
            return s.texts.mapInArrow(of_texts, _PACKED)
        return s.lists.select("term", "doc_id", "tf", "dl", "at").mapInArrow(of_lists, _PACKED)

    rows = reduce(DataFrame.union, map(packed, sources))
    return rows.repartitionById(len(cuts) + 1, "part").mapInArrow(_in_order, dw.LISTS)
