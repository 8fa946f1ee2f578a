"""Helpers shared by the operators: written tables, Arrow text buffers, connected components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back. Cuts the lineage (a lost executor
    rereads files, it does not recompute) and keeps costly columns from being computed again."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and the offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a 64-bit word (the public splitmix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest id reachable from every node of undirected ``edges`` (a, b): rows (id, component).

    Rounds of large-star and small-star linking: each node hands its larger (then its smaller)
    neighbours to the smallest one it knows. A hot node costs one aggregated row and a join that adaptive
    execution splits; nothing is collected. Every round is written to the shared folder, and the rounds
    end when the edge set, compared by count and order-free checksums, no longer changes.
    """
    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), name)
    last = None
    while True:
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = stored(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .where("a <> b").distinct(), name)
        # small star: rows now point from the larger node to a smaller one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        cur = stored(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                     .union(low.select("a", F.col("m").alias("b"))).distinct(), name)
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("b", "a"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    nodes = cur.groupBy("a").agg(F.min("b").alias("component"))
    return nodes.select(F.col("a").alias("id"), "component").union(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
