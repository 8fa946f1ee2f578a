"""Best-fit packing under conflicts.

Texts longer than a bin are cut into full pieces and a rest; every piece is kept. Pieces are dealt to shards of
about ``SHARD_ROWS`` by a hash of id and piece (lengths, sources and clusters only, never texts), and a
shard is packed on its own, longest piece first: the tightest open bin that has room and no conflict takes
it, else a new bin opens. Two pieces conflict when they share a source or a duplicate cluster.

Every shard leaves some bins with much room. The pieces of all bins with more than ``capacity / SLACK`` of room are dealt to
new shards and packed again, so they meet pieces of other shards. Rounds go on until one shard holds what is left or a
round settles less than half of its pieces (then conflicts, not shards, keep the bins open); its result stands.

Bins are ordered by residual. Each carries a bitmap of its sources and clusters, and a tree over the residuals
holds the AND of the bitmaps below: a subtree whose every bin has one of the piece's bits is skipped whole,
so the successor search reaches the tightest compatible bin without walking the incompatible ones (a hot
source fills most of them).

Edge cases: null source or cluster never conflicts; null, zero or negative lengths count as 1; ties go to the
smaller id, then the earlier bin; repeated rows are packed each; an empty table gives no rows; null ids pack
like others and are dealt by a row number, so that they fill no shard of their own; columns other than the four named ones are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

CAPACITY = 2048
SHARD_ROWS = 8192
SLACK = 8
PIECE = ["id", "piece", "length", "source", "cluster", "salt"]


class OpenBins:
    """Open bins by residual room, with the AND of the bitmaps under every node of a tree over residuals."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.common = [-1] * (2 * self.leaves)  # an empty leaf has every bit, so that any search skips it
        self.at: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def _refresh(self, room: int) -> None:
        value = -1
        for mask in self.at[room]:
            value &= mask
        node = room + self.leaves
        while node:
            if self.common[node] == value:
                break
            self.common[node] = value
            node >>= 1
            value = self.common[2 * node] & self.common[2 * node + 1] if node else 0

    def add(self, bin_: int, room: int, mask: int) -> None:
        held = self.at[room].setdefault(mask, [])
        held.append(bin_)
        held.sort(reverse=True)  # almost sorted already; the earliest bin is taken first
        if len(held) == 1:
            self._refresh(room)

    def take(self, length: int, bits: int) -> tuple[int, int, int] | None:
        """Removes and returns (bin, room, mask) of the tightest bin with ``room >= length`` and
        none of ``bits``; bit 0 stands for an empty leaf."""
        bits |= 1
        node, last = length + self.leaves, 2 * self.leaves - 1
        while True:
            if not self.common[node] & bits:
                if node >= self.leaves:
                    room = node - self.leaves
                    found = min(((b[-1], m) for m, b in self.at[room].items() if not m & bits), default=None)
                    if found:
                        bin_, mask = found
                        self.at[room][mask].pop()
                        if not self.at[room][mask]:
                            del self.at[room][mask]
                            self._refresh(room)
                        return bin_, room, mask
                else:
                    node *= 2
                    continue
            while node & 1:  # up past finished right children
                if node == last or node & (node + 1) == 0:
                    return None
                node >>= 1
            node += 1


def best_fit(lengths: list[int], bits: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the given order."""
    open_, bins, offsets, count = OpenBins(capacity), [], [], 0
    for length, own in zip(lengths, bits, strict=True):
        hit = open_.take(length, own) if length < capacity else None
        if hit is None:
            hit, count = (count, capacity, 0), count + 1
        bin_, room, mask = hit
        bins.append(bin_)
        offsets.append(capacity - room)
        if room > length:
            open_.add(bin_, room - length, mask | own)
    return bins, offsets


def _pack(capacity: int, round_: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece", "source", "cluster"], ascending=[False, True, True, True, True],
                              kind="stable").reset_index(drop=True)
        source = pd.factorize(pdf["source"])[0]
        cluster = pd.factorize(pdf["cluster"])[0]
        seen = np.bincount(cluster[cluster >= 0], minlength=1)
        base, number = 1 + int(source.max(initial=-1)) + 1, np.cumsum(seen > 1) - 1
        bits = [(1 << (int(s) + 1) if s >= 0 else 0) | (1 << (base + int(number[c])) if c >= 0 and seen[c] > 1 else 0)
                for s, c in zip(source, cluster, strict=True)]
        bins, offsets = best_fit(pdf["length"].tolist(), bits, capacity)
        room = capacity - np.bincount(bins, pdf["length"]).astype(np.int32)
        first = np.int64(round_ << 56 | int(pdf["shard"].iloc[0]) << 32)
        return pdf[PIECE].assign(bin_id=first + np.array(bins, np.int64), bin_offset=np.array(offsets, np.int32), room=room[bins])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", length_col: str = "length", source_col: str = "source",
         cluster_col: str = "cluster", capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces (id, piece, length, bin_id, bin_offset) of all rows of ``docs``, one row per piece."""
    length = F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(1)), F.lit(1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), length.alias("n"), F.col(source_col).cast("string").alias("source"),
                       F.col(cluster_col).cast("string").alias("cluster"))
    pieces = stored(rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / capacity) - 1)))
                    .withColumn("length", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int"))
                    .withColumn("salt", F.when(F.col("id").isNull(), F.monotonically_increasing_id())).select(*PIECE), "packing-pieces")
    schema = "id long, piece long, length int, source string, cluster string, salt long, bin_id long, bin_offset int, room int"
    count, round_, settled = pieces.count(), 0, []
    while True:
        shards = max(1, -(-count // shard_rows))
        shard = F.pmod(F.xxhash64(F.lit(round_), "id", "piece", "salt"), F.lit(shards)).cast("int")
        out = pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(_pack(capacity, round_), schema)
        if shards == 1:
            break
        out = stored(out, "packing-round")
        loose = F.col("room") * SLACK > capacity
        left = out.where(loose).count()
        if 2 * left > count:
            break
        settled.append(out.where(~loose))
        pieces, count, round_ = out.where(loose).select(*PIECE), left, round_ + 1
    return (reduce(DataFrame.union, settled, out)
            .select(F.col("id").alias(id_col), "piece", "length", "bin_id", "bin_offset"))
