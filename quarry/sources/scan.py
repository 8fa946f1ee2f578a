"""Source scans: what the index feed selects from a table, and the typed attribute table.

Written as plain ``where`` + ``select`` so Catalyst pushes the row filter and the column list into
the Parquet (or JDBC) scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.spec import DELTA_HOURS, IndexSpec

# ---- fixed values: result cap rule ----
MIN_MAX_MATCHES = 1000
MAX_MATCHES_FACTOR = 1.5


def read_jdbc(spark: SparkSession, url: str, query: str, props: dict | None = None,
              partition_col: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """SQL source query (the reference's database source) through Spark's JDBC reader.

    With ``partition_col`` and bounds the read is split into ``num_partitions`` range queries."""
    r = spark.read.format("jdbc").option("url", url).options(**(props or {}))
    if partition_col:
        r = (r.option("dbtable", f"({query}) src").option("partitionColumn", partition_col)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def select_columns(df: DataFrame, key: str, include: list[str] | None = None,
                   exclude: list[str] | None = None) -> DataFrame:
    """Key plus all non-key columns, or only ``include``, or all but ``exclude`` (include wins)."""
    if include:
        cols = [c for c in include if c != key]
    else:
        ex = set(exclude or [])
        cols = [c for c in df.columns if c != key and c not in ex]
    return df.select(key, *cols)


def scan_source(df: DataFrame, spec: IndexSpec) -> DataFrame:
    """``doc_id`` + the index's columns, keeping rows equal to every ``select_values`` pair."""
    for c, v in spec.select_values:
        df = df.where(F.col(c) == F.lit(v))
    cols = list(dict.fromkeys([*spec.fields, *spec.uint_attrs, *spec.float_attrs, *spec.ts_attrs,
                               *spec.string_attrs, *spec.bool_attrs, *spec.mva_attrs]))
    return df.select(F.col(spec.id_col).cast("long").alias("doc_id"), *cols)


def timestamp_attr(c: str | Column) -> Column:
    """A date/timestamp column as epoch seconds (session time zone UTC)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.unix_timestamp(col.cast("timestamp"))


def string_attr_crc(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    """Keep the string (as a text field) and add its CRC32 as an integer attribute.

    An empty string or ``'0'`` gives NULL, as on the reference's XML path."""
    name = name or f"{c}_crc32"
    val = F.when((F.col(c).isNull()) | (F.col(c) == "") | (F.col(c) == "0"), F.lit(None)).otherwise(
        F.crc32(F.col(c).cast("binary")))
    return df.withColumn(name, val)


def build_attributes(df: DataFrame, spec: IndexSpec) -> DataFrame:
    """Typed attribute table: uint -> long, float -> double, bool, timestamp -> epoch seconds,
    string -> kept + CRC32; renamed where the spec says so. ``blog_id`` is kept wherever the source has
    it, and an audited table keeps its creation and change times."""
    out = [F.col(spec.id_col).cast("long").alias("doc_id")]
    blog = ("blog_id",) if "blog_id" in df.columns and "blog_id" not in spec.uint_attrs else ()
    audit = tuple(c for c in ("created_on", "modified_on") if spec.audit and c not in spec.ts_attrs)
    for c in (*spec.uint_attrs, *blog):
        out.append(F.col(c).cast("long").alias(spec.attr_name(c)))
    for c in spec.float_attrs:
        out.append(F.col(c).cast("double").alias(spec.attr_name(c)))
    for c in spec.bool_attrs:
        out.append(F.col(c).cast("boolean").alias(spec.attr_name(c)))
    for c in (*spec.ts_attrs, *audit):
        out.append(timestamp_attr(c).alias(spec.attr_name(c)))
    for c in spec.string_attrs:
        n = spec.attr_name(c)
        out.append(F.col(c).cast("string").alias(n))
        out.append(F.crc32(F.col(c).cast("binary")).alias(f"{n}_crc32"))
    for c in spec.mva_attrs:
        out.append(F.col(c).cast(T.ArrayType(T.LongType())).alias(spec.attr_name(c)))
    for c, v in spec.select_values:
        df = df.where(F.col(c) == F.lit(v))
    return df.select(*out)


def delta_source(df: DataFrame, col: str, as_of: str, hours: int = DELTA_HOURS) -> DataFrame:
    """Rows whose change time lies within the last ``hours`` before ``as_of`` (strict ``>``)."""
    bound = F.lit(as_of).cast("timestamp") - F.make_interval(hours=F.lit(hours))
    return df.where(F.col(col).cast("timestamp") > bound)


def fetch_by_id(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Full source rows for the given ids (``ids`` has an ``id_col`` column)."""
    i = ids.select(id_col).distinct()
    return df.join(i, id_col, "left_semi")


def max_matches_estimate(docs: DataFrame, blog_col: str = "blog_id") -> DataFrame:
    """Result cap: ``max(1000, int(1.5 * largest per-blog document count))`` as a one-row DataFrame."""
    per = docs.groupBy(blog_col).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.greatest(F.lit(MIN_MAX_MATCHES).cast("long"),
                              F.floor(F.lit(MAX_MATCHES_FACTOR) * F.coalesce(F.max("n"), F.lit(0))).cast("long"))
                   .alias("max_matches"))
