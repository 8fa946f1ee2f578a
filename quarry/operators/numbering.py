"""Running numbers over whole tables without a task that holds a whole group.

Rows are range-partitioned and sorted by (group, order) and written once; a row's number is its place in its partition plus
the rows of its group in the partitions before, which come from one count per (group, partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path

_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: partition number above, row number below


def numbered(df: DataFrame, group: list[str], order: list[Column], out_col: str = "number") -> DataFrame:
    """``df`` plus ``out_col`` (long, from 0 within ``group``) by ``order``. Writes the rows to the shared folder, which also
    cuts the lineage: a lost executor rereads them."""
    spark = df.sparkSession
    keys = [F.col(g) for g in group]
    path = scratch_path(spark, "numbered")
    sorted_ = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    sorted_.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_row", 33)).withColumn(
        "_row", F.col("_row").bitwiseAND(_IN_PARTITION))
    counts = rows.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        *(F.col(g).alias(f"_{g}_of") for g in group), F.col("_part").alias("_part_of"), "_first", "_before")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}_of")) for g in group] + [F.col("_part") == F.col("_part_of")]
    number = F.col("_row") - F.col("_first") + F.col("_before")
    return rows.join(offsets, same).select(*df.columns, number.alias(out_col))
