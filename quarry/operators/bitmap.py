"""Sets of document ids as bitmaps, and tests of a row's id against them.

One bitmap row stands for 32,768 neighbouring ids (4 KB), so a set of millions of ids is some hundred rows, and a test is a
join on the row number. Spark broadcasts the bitmaps while it knows them to be small and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: bitmap rows (4 KB each) that are broadcast ----
FEW = 2000
# ---- end of fixed values ----


def id_bitmap(ids: DataFrame) -> DataFrame:
    """``_part, _bits`` over the single column of ``ids`` (nulls are left out)."""
    one = ids.toDF("id").where("id IS NOT NULL")
    return one.groupBy(F.bitmap_bucket_number("id").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("_bits"))


def known(ids: DataFrame) -> DataFrame:
    """The bitmaps, marked for broadcast if counting finds them few: the rows tested against them then stay where they are."""
    return F.broadcast(ids) if ids.limit(FEW + 1).count() <= FEW else ids


def _tested(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    at = F.bitmap_bit_position(F.col(id_col))
    value = lambda i: F.conv(F.hex(F.substring(F.col("_bits"), i + 1, F.lit(1))), 16, 10).cast("int")
    signed = lambda i: (F.pmod(value(i) + 128, F.lit(256)) - 128).cast("byte")
    # an array of bytes: reading one byte of a joined binary copies all of it
    ids = ids.select("_part", F.transform(F.sequence(F.lit(0), F.length("_bits") - 1), signed).alias("_bytes"))
    bit = F.getbit(F.get(F.col("_bytes"), F.floor(at / 8).cast("int")), (at % 8).cast("int"))
    return (rows.withColumn("_part", F.bitmap_bucket_number(F.col(id_col))).join(ids, "_part", "left")
            .withColumn("_held", F.coalesce(bit == 1, F.lit(False))))


def without(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` whose id is not in the bitmap."""
    return _tested(rows, ids, id_col).where("NOT _held").select(*rows.columns)


def within(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` whose id is in the bitmap."""
    return _tested(rows, ids, id_col).where("_held").select(*rows.columns)
