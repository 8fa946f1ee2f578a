"""XML document sets (the reference's XML pipe feed): one ``document`` element per row.

Multi-value attributes travel as comma-joined text and come back as sorted integer arrays.
Element names must not contain a colon (Spark's XML writer rejects them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT_TAG = "docset"
ROW_TAG = "document"


def write_docset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write documents as an XML docset; array columns become comma-joined text, timestamps
    epoch seconds."""
    cols = []
    for f in df.schema.fields:
        if ":" in f.name:
            raise ValueError(f"XML element names cannot contain ':' ({f.name})")
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_timestamp(c.cast("timestamp"))
        cols.append(c.alias(f.name))
    (df.select(*cols).write.mode(mode).format("xml").option("rootTag", ROOT_TAG).option("rowTag", ROW_TAG)
     .save(path))


def read_docset(spark: SparkSession, path: str, schema: T.StructType, mva_cols: tuple[str, ...] = ()) -> DataFrame:
    """Read an XML docset with an explicit schema (never inferred); ``mva_cols`` are split back into
    sorted ``array<bigint>``."""
    read_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in mva_cols else f.dataType, True) for f in schema.fields])
    df = (spark.read.schema(read_schema).format("xml").option("rowTag", ROW_TAG)
          .option("ignoreSurroundingSpaces", "false").load(path))
    for c in mva_cols:
        df = df.withColumn(c, F.sort_array(F.transform(
            F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: x != ""), lambda x: x.cast("long"))))
    return df
