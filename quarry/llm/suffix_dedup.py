"""Suffix-array dedup: removes every byte covered by a 50-byte string that also starts in a document with a
smaller id.

Suffixes are dealt to independent buckets by their content, so that equal strings always meet, and each bucket
is sorted by the difference-cover algorithm: sort sampled triples, recurse on their names, merge the remaining
suffixes, compare adjacent prefixes. Only suffixes that can repeat are dealt:

1. Exact copies of a text of a smaller id lose every byte at once. The other whole texts are packed into chunks of about ``CHUNK_BYTES``, written once (texts are never split).
2. Of every 50-byte window the 25-byte gram with the smallest hash is its anchor: equal windows have equal anchors.
   Each chunk sends its distinct anchor hashes (4 bytes each) to buckets, which answer with one bit per anchor:
   does it occur in another chunk? A very common passage costs one entry per chunk, not one per document.
3. Each chunk sends the distinct segments around repeated anchors (the windows that share an anchor overlap, so they
   form one segment of at most 75 bytes) with the smallest id that holds them. A bucket builds the suffix array
   of its distinct segments and answers, for every window, whether a smaller id has it.
4. Each chunk marks the bytes covered and cuts them out.

Edge cases: null text is empty; texts under 50 bytes stay whole; rows with a null id stay whole and remove
nothing; rows that share an id do not remove each other; overlaps count, and strings are judged on the input; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix64, shuffle_partitions, stored, text_bytes
from quarry.llm.id_filter import maybe_among

LENGTH, GRAM = 50, 25
CHUNK_BYTES = 4 << 20
PIECE = 1 << 18
BUCKET_BYTES = 1 << 19  # text per bucket: bounds what one suffix array is built over
CHUNKS = "chunk_id long, doc_ids array<long>, sizes array<long>, blob binary"


def _pack_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    ids: list = []
    sizes: list[int] = []
    parts: list[np.ndarray] = []
    held = 0
    press = zstandard.ZstdCompressor(level=1)

    def close():
        nonlocal number, held
        row = pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([press.compress(np.concatenate(parts).tobytes())], pa.binary())],
            ["chunk_id", "doc_ids", "sizes", "blob"])
        number, held = number + 1, 0
        for x in (ids, sizes, parts):
            x.clear()
        return row

    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        doc = batch.column("doc_id").to_pylist()
        a = 0
        while a < len(doc):
            room = offsets[a] + CHUNK_BYTES - held
            b = min(len(doc), max(a + 1, int(np.searchsorted(offsets, room, "left"))))
            ids += doc[a:b]
            sizes += np.diff(offsets[a:b + 1]).tolist()
            parts.append(data[offsets[a]:offsets[b]].copy())
            held += int(offsets[b] - offsets[a])
            a = b
            if held >= CHUNK_BYTES:
                yield close()
    if ids:
        yield close()


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets, ids and null flags of a chunk."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["blob"]), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.array(row["sizes"], np.int64))]).astype(np.int64)
    null = np.array([x is None for x in row["doc_ids"]], bool)
    return data, offsets, np.array([0 if x is None else x for x in row["doc_ids"]], np.int64), null


def _grams(v: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position, by doubling (25 = 16 + 8 + 1)."""
    base = 0x9E3779B97F4A7C15 | 1
    power = {n: np.uint64(pow(base, n, 1 << 64)) for n in (1, 2, 4, 8)}
    held = {1: v}
    for n in (1, 2, 4, 8):
        h = held[n]
        held[2 * n] = h[:-n] * power[n] + h[n:]
    h = held[16][: len(v) - 23] * power[8] + held[8][16:]
    return mix64(h[:-1] * power[1] + v[GRAM - 1:])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, null: np.ndarray):
    """Maximal runs of windows of one document with the same anchor: anchor hash, hash of the segment
    they cover, first window, last window, document index."""
    table = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))
    out = []
    first = np.where(null, offsets[1:], offsets[:-1])
    last = np.maximum(offsets[1:] - LENGTH + 1, first)  # one past the last window
    for a in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        piece = data[a: a + PIECE + LENGTH - 1]
        gram = _grams(table[piece])
        n = len(piece) - LENGTH + 1
        key = gram & np.uint64(0xFFFFFFFF00000000) | np.arange(len(gram), dtype=np.uint64)
        for k in (1, 2, 4, 8):  # minimum over 16 grams, then over 26
            key = np.minimum(key[:-k], key[k:])
        key = np.minimum(key[:n], key[10:10 + n])
        i, j = np.searchsorted(offsets, [a, a + n], "right")
        lo, hi = np.clip(first[i - 1: j] - a, 0, n), np.clip(last[i - 1: j] - a, 0, n)
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, lo, 1)
        np.add.at(step, hi, -1)
        start = np.flatnonzero(np.cumsum(step[:n]) > 0)
        if not len(start):
            continue
        at = (key[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
        s0, s1 = start[cut], start[np.append(cut[1:], len(start)) - 1]
        seg = gram[s0] * np.uint64(0xA0761D6478BD642F) + gram[s0 + GRAM] * np.uint64(0xE7037ED1A0B428DB) + gram[s1 + GRAM]
        out.append((gram[at[cut]], mix64(seg + (s1 - s0).astype(np.uint64)), s0 + a, s1 + a))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    anchor, seg, s0, s1 = (np.concatenate(x) for x in zip(*out, strict=True))
    return anchor, seg, s0, s1, np.searchsorted(offsets, s0, "right") - 1


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _spans(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted anchors fall in, and where each one's anchors begin (with the end of the last)."""
    held, first = np.unique(_bucket(anchor, buckets), return_index=True)
    return held, np.append(first, len(anchor))


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets, _, null = _unpack(row)
                anchor = np.unique(anchored_runs(data, offsets, null)[0])
                held, ends = _spans(anchor, buckets)
                low = anchor.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.int32()), pa.array([row["chunk_id"]] * len(held), pa.int64()),
                     pa.array([low[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                    ["bucket", "chunk_id", "anchors"])

    return run


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's anchors of a bucket, one bit: held by another chunk too."""
    parts = [np.frombuffer(x, np.uint32) for x in pdf["anchors"]]
    every = np.sort(np.concatenate(parts))
    again = every[1:][every[1:] == every[:-1]]

    def bits(x):
        if not len(again):
            return np.packbits(np.zeros(len(x), bool)).tobytes()
        at = np.minimum(np.searchsorted(again, x), len(again) - 1)
        return np.packbits(again[at] == x).tobytes()

    return pd.DataFrame({"chunk_id": pdf["chunk_id"], "bucket": pdf["bucket"], "bits": [bits(x) for x in parts]})


def _flags(anchor: np.ndarray, buckets: int, answers: list[dict] | None) -> np.ndarray:
    """Per distinct anchor (sorted), whether its bucket said it repeats."""
    out = np.zeros(len(anchor), bool)
    held, ends = _spans(anchor, buckets)
    for x in answers or ():
        k = np.searchsorted(held, x["bucket"])
        a, b = ends[k], ends[k + 1]
        out[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=b - a)
    return out


def _candidates(row: dict, buckets: int):
    """The runs of a chunk whose anchor repeats, in segment order: data, offsets, ids, first window,
    last window, document, anchor, segment hash, and where each distinct segment begins (its first
    run has the smallest id)."""
    data, offsets, ids, null = _unpack(row)
    anchor, seg, s0, s1, doc = anchored_runs(data, offsets, null)
    distinct, at, times = np.unique(anchor, return_inverse=True, return_counts=True)
    keep = np.flatnonzero((_flags(distinct, buckets, row["answers"]) | (times > 1))[at])
    order = keep[np.lexsort((s0[keep], ids[doc[keep]], s1[keep] - s0[keep], seg[keep], anchor[keep]))]
    anchor, seg, s0, s1, doc = (x[order] for x in (anchor, seg, s0, s1, doc))
    size = s1 - s0
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1]) | (size[1:] != size[:-1])]) if len(
        anchor) else np.empty(0, bool)
    return data, offsets, ids, s0, s1, doc, anchor, seg, np.flatnonzero(new)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + size), in order."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)


def _send_segments(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, _, ids, s0, s1, doc, anchor, seg, new = _candidates(row, buckets)
                held, ends = _spans(anchor[new], buckets)
                out: list[list] = [[] for _ in range(6)]
                for k, a, b in zip(held.tolist(), ends[:-1], ends[1:], strict=True):
                    at = new[a:b]
                    n = s1[at] - s0[at]
                    for x, y in zip(out, (k, row["chunk_id"], ids[doc[at]].tobytes(), seg[at].tobytes(),
                                          n.astype(np.uint8).tobytes(), data[_ranges(s0[at], n + LENGTH)].tobytes()),
                                    strict=True):
                        x.append(y)
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)],
                                                 ["bucket", "chunk_id", "docs", "segs", "sizes", "bytes"])

    return run


def _names(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Rank of each triple among the distinct triples."""
    top = int(max(a.max(initial=0), b.max(initial=0), c.max(initial=0))) + 1
    if top < 1 << 21:
        return np.unique((a << 42) | (b << 21) | c, return_inverse=True)[1]
    pair = np.unique(a * top + b, return_inverse=True)[1]
    return np.unique(pair * top + c, return_inverse=True)[1]


def _order(rank: np.ndarray, below: int) -> np.ndarray:
    """Positions in the order of their ranks (less than ``below``), those of equal rank in any order. Distinct ranks, the usual
    case, are put in their places without a sort."""
    at = np.full(below, -1, np.int64)
    at[rank] = np.arange(len(rank))
    out = at[at >= 0]
    return out if len(out) == len(rank) else np.argsort(rank)


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix of ``s`` (integers > 0) in the order of its first ``depth`` or more symbols, by the
    difference cover {1, 2} modulo 3. Suffixes equal that far are in any order."""
    n = len(s)
    text = np.concatenate([s, np.zeros(3, np.int64)]).astype(np.int64)
    if depth <= 3 or n < 3:
        return _names(text[:n], text[1: n + 1], text[2: n + 2])
    ones, twos, zeros = (np.arange(k, n, 3) for k in (1, 2, 0))
    sample = np.concatenate([ones, twos])
    name = _names(text[sample], text[sample + 1], text[sample + 2])
    if name.max(initial=0) + 1 < len(sample):  # a zero between the halves keeps them apart
        reduced = np.concatenate([name[: len(ones)] + 2, [1], name[len(ones):] + 2])
        deep = suffix_ranks(reduced, -(-depth // 3))
        name = np.concatenate([deep[: len(ones)], deep[len(ones) + 1:]])
    order = sample[_order(name, len(sample) + 1)]
    rank = np.zeros(n + 3, np.int64)  # of sampled suffixes, from 1; past the end 0
    rank[order] = np.arange(1, len(order) + 1)
    wide = np.int64(n + 3)

    def pair(i):
        return text[i] * wide + rank[i + 1]

    def triple(i):
        return (text[i] * (text.max() + 1) + text[i + 1]) * wide + rank[i + 2]

    rest = zeros[np.argsort(pair(zeros))]
    by1, by2 = order[order % 3 == 1], order[order % 3 == 2]
    # sampled suffixes before each remaining one
    before = np.searchsorted(pair(by1), pair(rest)) + np.searchsorted(triple(by2), triple(rest))
    before = np.maximum.accumulate(before) if len(before) else before
    out = np.empty(n, np.int64)
    out[rest] = before + np.arange(len(rest))
    out[order] = np.arange(len(order)) + np.searchsorted(before, np.arange(len(order)), "right")
    return out


def smallest_holder(blob: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For every window of every segment (laid end to end, ``sizes`` + 1 windows each), the smallest owner of
    a segment with the same window."""
    lengths = sizes + LENGTH
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # with a separator after each segment
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    text[_ranges(begin, lengths)] = blob.astype(np.int64) + 1
    rank = suffix_ranks(text, LENGTH)
    start = _ranges(begin, sizes + 1)
    who = np.repeat(owner, sizes + 1)
    order = _order(rank[start], len(text))
    pos = start[order]
    word = text.astype(np.uint64)  # nine bits a symbol: seven symbols a word
    word = np.concatenate([word, np.zeros(8, np.uint64)])
    two = word[:-1] << np.uint64(9) | word[1:]
    four = two[:-2] << np.uint64(18) | two[2:]
    seven = four[:-3] << np.uint64(27) | (two[:-1] << np.uint64(9) | word[2:])[4: 4 + len(four) - 3]
    same = np.ones(max(len(pos) - 1, 0), bool)
    for k in (*range(0, LENGTH - 7, 7), LENGTH - 7):
        x = seven[pos + k]
        same &= x[1:] == x[:-1]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(pos) else np.empty(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(pos) else np.empty(0, np.int64)
    least = np.minimum.reduceat(who[order], heads) if len(pos) else who
    out = np.empty(len(start), np.int64)
    out[order] = least[group] if len(pos) else least
    return out


def _match(pdf: pd.DataFrame) -> pd.DataFrame:
    """Suffix array of one bucket: for each chunk, one bit per window of its segments: a smaller id has it."""
    docs = [np.frombuffer(x, np.int64) for x in pdf["docs"]]
    every, seg = np.concatenate(docs), np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["segs"]])
    sizes = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["sizes"]]).astype(np.int64)
    blob = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
    # equal segments of several chunks are sorted once, with their smallest id
    order = np.lexsort((every, sizes, seg))
    new = np.concatenate([[True], (seg[order][1:] != seg[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    one = order[new]
    begin = np.cumsum(sizes + LENGTH) - (sizes + LENGTH)
    least = smallest_holder(blob[_ranges(begin[one], sizes[one] + LENGTH)], sizes[one], every[one])
    first = np.cumsum(sizes[one] + 1) - (sizes[one] + 1)
    smaller = least[_ranges(first[which], sizes + 1)] < np.repeat(every, sizes + 1)
    ends = np.cumsum([0, *(len(x) for x in docs)])
    window = np.concatenate([[0], np.cumsum(sizes + 1)])
    return pd.DataFrame({"chunk_id": pdf["chunk_id"], "bucket": pdf["bucket"], "bits": [
        np.packbits(smaller[window[a]:window[b]]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]})


def _cut(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets, ids, s0, s1, doc, anchor, _, new = _candidates(row, buckets)
                step = np.zeros(len(data) + 1, np.int32)
                if len(new):
                    size = s1 - s0 + 1
                    bits = np.zeros(int(size[new].sum()), bool)
                    held, ends = _spans(anchor[new], buckets)
                    first = np.concatenate([[0], np.cumsum(size[new])])
                    for x in row["found"] or ():
                        k = np.searchsorted(held, x["bucket"])
                        a, b = first[ends[k]], first[ends[k + 1]]
                        bits[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=b - a)
                    which = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(s0))))
                    later = ids[doc] > ids[doc[new]][which]
                    gone = np.repeat(later, size) | bits[_ranges(first[which], size)]
                    start = _ranges(s0, size)[gone]
                    step += np.bincount(start, minlength=len(step)).astype(np.int32)
                    step -= np.bincount(start + LENGTH, minlength=len(step)).astype(np.int32)
                covered = np.cumsum(step[:-1]) > 0
                opens = covered.copy()
                opens[1:] &= ~covered[:-1]
                heads = offsets[:-1][offsets[:-1] < offsets[1:]]
                opens[heads] = covered[heads]
                some = np.concatenate([[0], np.cumsum(covered)])
                runs = np.concatenate([[0], np.cumsum(opens)])
                kept = data[~covered]
                left = offsets - some[offsets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(np.diff(offsets)), pa.array(np.diff(some[offsets])),
                     pa.array(np.diff(runs[offsets])),
                     pa.array([kept[a:b].tobytes() for a, b in zip(left[:-1], left[1:], strict=True)], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _without_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` without the exact copies of a text of a smaller id, and the results of those copies: every byte
    of theirs is covered. What a copy holds starts in its original too, so it need not be indexed."""
    key = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    keys = stored(rows.where("doc_id IS NOT NULL").select("doc_id", key.alias("_key"), F.octet_length("text").cast("long").alias("n"))
                  .where(F.col("n") >= LENGTH), "suffix-texts")
    first = stored(keys.groupBy("_key").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
                   .select("_key", "_first"), "suffix-first")
    flagged = maybe_among(rows, key, first.select("_key"))
    held = flagged.where("_maybe").join(first, "_key", "left").where(
        "_first IS NULL OR doc_id IS NULL OR doc_id <= _first").select("doc_id", "text")
    copies = keys.join(first, "_key").where("doc_id > _first").select(
        "doc_id", F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(b"").alias("kept"))
    return flagged.where("NOT _maybe").select("doc_id", "text").union(held), copies


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the
    remaining UTF-8 bytes, which a cut may leave in the middle of a character)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rest, copies = _without_copies(rows)
    chunks = stored(rest.mapInArrow(_pack_chunks, CHUNKS), "suffix-chunks")

    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(4 * shuffle_partitions(docs.sparkSession), -(-total // BUCKET_BYTES))

    def per_chunk(df: DataFrame, name: str) -> DataFrame:
        return stored(df.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "bits")).alias(name)), f"suffix-{name}")

    anchors = chunks.mapInArrow(_send_anchors(buckets), "bucket int, chunk_id long, anchors binary")
    answers = per_chunk(anchors.groupBy("bucket").applyInPandas(_repeated, "chunk_id long, bucket int, bits binary"), "answers")
    known = chunks.join(answers, "chunk_id", "left").select("chunk_id", "doc_ids", "sizes", "blob", "answers")
    segments = known.mapInArrow(_send_segments(buckets),
                                "bucket int, chunk_id long, docs binary, segs binary, sizes binary, bytes binary")
    found = per_chunk(segments.groupBy("bucket").applyInPandas(_match, "chunk_id long, bucket int, bits binary"), "found")
    out = known.join(found, "chunk_id", "left").mapInArrow(
        _cut(buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.union(copies).withColumnRenamed("doc_id", id_col)
