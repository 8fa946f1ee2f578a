"""Bloom filters over keys as packed bit tables, in DataFrame functions only.

A key sets two cells of a bit table. The table is the only broadcast: its size is bounded before it is built,
``cells / 8`` bytes, where ``cells`` follows the number of keys up to ``MAX_CELLS`` (128 MB). Beyond that
bound a filter says "maybe" more often, never "no" wrongly, so what follows does more work and gives the
same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 30
CELLS_PER_KEY = 16


def cells_for(keys: int) -> int:
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (CELLS_PER_KEY * max(keys, 1) - 1).bit_length()))


def cell(key: Column, k: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), key), F.lit(cells)) + 1


def both_cells(keys: DataFrame, cells: int) -> DataFrame:
    """The two cells (c) of every ``_key``."""
    return keys.select(F.explode(F.array(cell(F.col("_key"), 0, cells), cell(F.col("_key"), 1, cells))).alias("c"))


def pack_bits(cells: DataFrame) -> DataFrame:
    """Bitmaps (_bucket, _bits) of 4 KB over the given cells (c)."""
    bits = cells.groupBy(F.bitmap_bucket_number("c").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("_bits"))
    return stored(bits, "filter-bits")


def flag(rows: DataFrame, bits: DataFrame, cells: int) -> DataFrame:
    """``rows`` (with _key) plus _maybe, true where both cells of the key are set."""
    for k in (0, 1):
        c = cell(F.col("_key"), k, cells)
        one = F.broadcast(bits.select(F.col("_bucket").alias(f"_bucket{k}"), F.col("_bits").alias(f"_bits{k}")))
        rows = (rows.withColumns({f"_bucket{k}": F.bitmap_bucket_number(c), f"_at{k}": F.bitmap_bit_position(c)})
                .join(one, f"_bucket{k}", "left"))
    hit = [F.coalesce(F.expr(f"getbit(cast(conv(hex(substring(_bits{k}, cast(_at{k} div 8 as int) + 1, 1)), 16, 10) "
                             f"as int), cast(_at{k} % 8 as int)) = 1"), F.lit(False)) for k in (0, 1)]
    return rows.withColumn("_maybe", hit[0] & hit[1]).drop(
        *(f"{c}{k}" for c in ("_bucket", "_bits", "_at") for k in (0, 1)))


def maybe_among(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` plus _key and _maybe: false only where ``key`` is not among the single column of ``keys``, a
    written table. A join that follows then shuffles the rows that may match, not all of them."""
    keys = keys.toDF("_key")
    cells = cells_for(keys.count())
    return flag(rows.withColumn("_key", key), pack_bits(both_cells(keys, cells)), cells)
