"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

1. Each text becomes its set of word shingles (64-bit hashes). Texts with equal sets form a class at once; only
   the class's smallest id goes on.
2. Sketch: in round i every shingle lands in a hashed bin with the value i + v; a bin keeps its minimum. After
   as many random rounds as bins, further rounds visit the bins one by one, so every bin fills whatever the
   size of the set, and the agreement of two sketches concentrates around their similarity.
3. Bands of ``BAND_ROWS`` bins: equal bands link a class to the smallest id of its bucket. With 32 bands of 4 a
   pair at 0.85 similarity shares no band with probability 6e-11 (3e-8 at 0.8). Connected components of
   these links are the candidate groups; a linked pair never lies in two groups.
4. Only the texts of group members are read again (a Bloom filter of their ids lets the others pass
   unshuffled). Inside a group all pairs are verified on full sets, without emitting them: members are dealt to blocks of
   about ``BLOCK`` by hash, a task gets two blocks, counts all common shingles by matrix products, and
   returns only a spanning forest of the true links. A group of any size is so spread over many tasks.
5. Components of the true links give the result; classes bring the copies back.

Edge cases: null and empty texts, or texts without words, have no shingle and link with nothing; a text with
fewer words than a shingle is one shingle; ties are broken by the smallest id; repeated rows get one result
row each, and an id naming several texts links them; empty tables give no rows; columns other than the id and
the text are not read by ``near_duplicates`` and pass through ``near_dedup`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import connected_components, mix64, stored, text_bytes
from quarry.llm.id_filter import maybe_among
from quarry.llm.words import byte_tables, row_shingles, slabs, word_hashes

BINS, BAND_ROWS = 128, 4
BLOCK = 256
COLUMNS = 4096
SIGNATURE = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: one row of ``bins`` values per set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), bins), FULL)
    row, x = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    flat = out.reshape(-1)
    low = np.uint64((1 << 48) - 1)
    for i in range(2 * bins):
        if not len(x):
            break
        h = mix64(x + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (h & low) | np.uint64(i << 48)
        bin_ = (h >> np.uint64(48)).astype(np.int64) % bins if i < bins else i - bins
        np.minimum.at(flat, row * bins + bin_, value)
        open_ = (out == FULL).any(axis=1)
        keep = open_[row]
        if not keep.all():
            row, x = row[keep], x[keep]
    return out


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` bins."""
    parts = sketch.reshape(len(sketch), -1, rows)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k])
    return key


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """128 order-free bits that name a set."""
    a = mix64(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(s))
    b = mix64(s ^ np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(np.int64(a.view(np.int64) if hasattr(a, "view") else a)), int(b.view(np.int64))


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, space = byte_tables()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            count, k1, k2, bands, ends = [], [], [], [], [0]
            for a, b in slabs(offsets):
                sets = row_shingles(*word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                                 values, space), shingle)
                full = [s for s in sets if len(s)]
                keys = band_keys(sketches(full)).view(np.int64) if full else np.empty((0, 0), np.int64)
                bands.append(keys.reshape(-1))
                for s in sets:
                    count.append(len(s))
                    key = _set_key(s) if len(s) else (None, None)
                    k1.append(key[0])
                    k2.append(key[1])
                    ends.append(ends[-1] + (keys.shape[1] if len(s) else 0))
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                ["doc_id", "n_shingles", "k1", "k2", "bands"])

    return run


def _sets(shingle: int):
    """Full sets of the members, dropping rows whose text is not the class's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, space = byte_tables()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slabs(offsets):
                sets = row_shingles(*word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                                 values, space), shingle)
                part = batch.slice(a, b - a)
                want = zip(part.column("k1").to_pylist(), part.column("k2").to_pylist(), strict=True)
                ok = pa.array([len(s) > 0 and _set_key(s) == k for s, k in zip(sets, want, strict=True)])
                cols = [part.column(n) for n in ("doc_id", "grp", "blocks")] + [
                    pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "grp", "blocks", "shingles"]).filter(ok)

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted distinct sets."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], np.int64)
    flat = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[col] > 1  # a shingle that one set holds adds to no intersection
    rank = np.cumsum(times > 1) - 1
    col, owner = rank[col[keep]], owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for c in range(0, int(rank[-1]) + 1 if len(rank) else 0, COLUMNS):
        a, b = np.searchsorted(col, [c, c + COLUMNS])
        dense = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        dense[owner[a:b], col[a:b] - c] = 1
        out += (dense[: len(left)] @ dense[len(left):].T).astype(np.int64)
    return out


def spanning_links(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions of the links (a, b) that join two parts not joined before."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(i)
    return out


def _verify(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
        pdf = pdf.sort_values("doc_id", kind="stable")
        first = pdf if same else pdf[pdf["block"] == pdf["bi"]]
        second = pdf if same else pdf[pdf["block"] == pdf["bj"]]
        sets = [[np.frombuffer(x, np.uint64) for x in part["shingles"]] for part in (first, second)]
        ids = [part["doc_id"].to_numpy(np.int64) for part in (first, second)]
        if not len(ids[0]) or not len(ids[1]):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        n = [np.array([len(s) for s in part]) for part in sets]
        inter = common_counts(*sets)
        union = n[0][:, None] + n[1][None, :] - inter
        x, y = np.nonzero(100 * inter >= percent * union)
        a, b = ids[0][x], ids[1][y]
        a, b = (v[a != b] for v in (a, b))
        at = spanning_links(a, b)
        return pd.DataFrame({"a": a[at], "b": b[at]})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept. Texts are linked when
    100 * intersection >= percent * union of their sets of ``shingle``-word shingles."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sigs = stored(plain.mapInArrow(_signatures(shingle), SIGNATURE), "near-signatures")
    classes = stored(sigs.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "near-classes")

    band = classes.select("rep", F.explode("bands").alias("band"))
    hubs = stored(band.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
                  .select("band", "hub"), "near-hubs")
    links = band.join(hubs, "band").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    groups = stored(connected_components(links, "near-candidates"), "near-groups")

    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = (groups.join(stored(sizes, "near-sizes"), "component")
              .join(classes.select(F.col("rep").alias("id"), "k1", "k2"), "id")
              .select(F.col("id").alias("doc_id"), F.col("component").alias("grp"), "blocks", "k1", "k2"))
    member = stored(member, "near-members")
    maybe = maybe_among(plain, F.col("doc_id"), member.select("doc_id")).where("_maybe").select("doc_id", "text")
    sets = maybe.join(member, "doc_id").mapInArrow(
        _sets(shingle), "doc_id long, grp long, blocks int, shingles binary")
    dealt = (sets.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("doc_id", "grp", "block", F.least("block", "other").alias("bi"),
                     F.greatest("block", "other").alias("bj"), "shingles"))
    true = dealt.groupBy("grp", "bi", "bj").applyInPandas(_verify(percent), "a long, b long")
    found = connected_components(stored(true, "near-links"), "near-linked")
    named = stored(classes.select("k1", "k2", "rep").join(found, classes["rep"] == found["id"], "left")
                   .select("k1", "k2", F.coalesce("component", "rep").alias("component_id")), "near-named")
    return (sigs.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles",
                    F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
               percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group left (the smallest id), same columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    plain = docs.toDF(*names)
    key, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    gone = stored(near_duplicates(plain, key, text, shingle, percent).where("NOT kept")
                  .select(F.col(key).alias("_gone")).distinct(), "near-gone")
    rows = maybe_among(plain, F.col(key).cast("long"), gone)
    stays = rows.where("_maybe").join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    return rows.where("NOT _maybe").select(*names).union(stays.select(*names)).toDF(*docs.columns)
