"""SimHash near-dedup with deletion-variant signatures.

1. Each text's word shingles, repeats included, are hashed (XXH64); a fingerprint bit is 1 where more than half of the
   hashes have it set. Equal fingerprints form a class at once.
2. A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints that differ in three bits at most, one
   segment differs by one bit at most. Each segment is filed under its 32 one-wildcard variants (the segment with
   one bit left out), so such segments share a variant and meet in an equality join: a bucket.
3. In a bucket, sorted by fingerprint, every member is verified against the first one and its neighbour. Components of
   these links are contracted: buckets of three members are done, so are buckets whose members are all linked.
4. What is still apart in a larger bucket is verified in blocks of ``BLOCK`` members; a task gets two blocks, compares
   members of different components only and returns a spanning forest of the true links.
5. Components of all links give the result.

No pair of linked fingerprints is lost, whatever the size of a bucket; pairs are never emitted.

Edge cases: null, empty and blank texts have fingerprint zero and are linked like any other; a text of fewer words than a
shingle is one shingle; a component is named by its smallest id; a row is linked by its own text, so repeated ids
with different texts stay apart; null ids are linked but never name a component that has another id; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import terms
from quarry.llm.common import connected_components, stored
from quarry.llm.near_dedup import spanning_links

SEED = 42
SHINGLE, DISTANCE = 3, 3
SEGMENT = 32
SLAB, BLOCK = 1 << 16, 1024


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as a signed integer."""
    words = terms.split(text, terms.WORDS)
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for a in range(0, n, SLAB):
        part = words[a: a + SLAB + shingle - 1]
        runs = part if shingle == 1 else map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        digests = b"".join([xxhash.xxh64_digest(r, SEED) for r in runs])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in terms.column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return run


def near(a: Column, b: Column) -> Column:
    return (a != b) & (F.bit_count(a.bitwiseXOR(b)) <= DISTANCE)


def variants(fps: DataFrame) -> DataFrame:
    """``key, fp``: every segment of every fingerprint with one of its bits left out; the bit's number is in the key."""
    at = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at"))
    return at.select(F.expr(
        f"(shiftrightunsigned(fp, cast({SEGMENT} * (at div {SEGMENT}) as int)) & 4294967295L & ~shiftleft(1L, at % {SEGMENT}))"
        f" | shiftleft(cast(at as bigint), {SEGMENT})").alias("key"), "fp")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """True links between two blocks of one bucket, members of one component left out."""
    for batch in batches:
        x, y = [], []
        for one, two in zip(terms.column(batch, "one"), terms.column(batch, "two"), strict=True):
            (a, pa_), (b, pb) = (([m["fp"] for m in side], np.array([m["part"] for m in side])) for side in (one, two))
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            differ = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64))
            i, j = np.nonzero((differ <= DISTANCE) & (pa_[:, None] != pb[None, :]))
            at = spanning_links(pa_[i], pb[j])  # one link joins two components
            x.append(a[i][at])
            y.append(b[j][at])
        cols = [np.concatenate(v) if v else np.empty(0, np.int64) for v in (x, y)]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in cols], ["a", "b"])


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that join every two fingerprints (column fp, distinct) at ``DISTANCE`` or less."""
    w = Window.partitionBy("key").orderBy("fp")
    rows = variants(fps).select("key", "fp", F.first("fp").over(w).alias("hub"), F.lag("fp").over(w).alias("prev"),
                                F.lead("fp").over(w).alias("next"))
    rows = stored(rows.where("prev IS NOT NULL OR next IS NOT NULL").drop("next"), "simhash-buckets")
    fp = F.col("fp")
    first = stored(rows.where(near(fp, F.col("hub"))).select(fp.alias("a"), F.col("hub").alias("b"))
                   .union(rows.where(near(fp, F.col("prev"))).select(fp.alias("a"), F.col("prev").alias("b")))
                   .distinct(), "simhash-links")
    parts = stored(connected_components(first, "simhash-first"), "simhash-parts")
    named = (rows.select("key", "fp").join(parts.withColumnRenamed("id", "fp"), "fp", "left")
             .select("key", "fp", F.coalesce("component", "fp").alias("part")))
    apart = (named.groupBy("key").agg(F.count("*").alias("n"), F.min("part").alias("x"), F.max("part").alias("y"))
             .where("n > 3 AND x <> y").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = stored(named.join(apart, "key").groupBy("key", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("block"))
                   .agg(F.collect_list(F.struct("fp", "part")).alias("members")), "simhash-blocks")
    two = dealt.select(F.col("key").alias("k2"), F.col("block").alias("b2"), F.col("members").alias("two"))
    meet = dealt.join(two, (F.col("key") == F.col("k2")) & (F.col("block") <= F.col("b2"))).select(
        F.col("members").alias("one"), "two")
    return first.union(meet.mapInArrow(_verify, "a long, b long")).distinct()


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    fps = stored(plain.mapInArrow(_fingerprints(shingle), "doc_id long, fp long"), "simhash-fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = connected_components(stored(links(classes.select("fp")), "simhash-linked"), "simhash-components")
    named = classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(named.join(least, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")
