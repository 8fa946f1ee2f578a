"""Per-document values from link tables: count columns, multi-value attributes, response_to,
tag-category pairs. All are aggregations with map-side combine followed by one left join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_column(docs: DataFrame, other: DataFrame, on: str, name: str, where: Column | None = None,
                 doc_key: str = "doc_id") -> DataFrame:
    """Per-document count of ``other`` rows (optionally filtered) whose ``on`` equals the doc id; 0 where none."""
    o = other if where is None else other.where(where)
    c = o.groupBy(F.col(on).alias(doc_key)).agg(F.count(F.lit(1)).alias(name))
    return docs.join(c, doc_key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))


def mva_attach(docs: DataFrame, link: DataFrame, by: tuple[str, str], name: str, where: Column | None = None,
               doc_key: str = "doc_id") -> DataFrame:
    """Multi-value attribute: ``link`` rows (``by`` = (doc key, value)) collected into a sorted,
    distinct integer array per document; an empty array where there is no link."""
    k, v = by
    lk = link if where is None else link.where(where)
    agg = (lk.select(F.col(k).alias(doc_key), F.col(v).cast("long").alias("_v")).distinct()
           .groupBy(doc_key).agg(F.sort_array(F.collect_list("_v")).alias(name)))
    return (docs.join(agg, doc_key, "left")
            .withColumn(name, F.coalesce(F.col(name), F.array().cast(T.ArrayType(T.LongType())))))


def mva_query(docs: DataFrame, pairs: DataFrame, name: str, doc_key: str = "doc_id") -> DataFrame:
    """Multi-value attribute from any two-column (doc id, value) DataFrame."""
    c0, c1 = pairs.columns[:2]
    return mva_attach(docs, pairs, (c0, c1), name, doc_key=doc_key)


def mva_tags(docs: DataFrame, object_tag: DataFrame, datasource: str, name: str = "tag",
             doc_key: str = "doc_id") -> DataFrame:
    """The automatic ``tag`` attribute: link rows whose ``object_datasource`` is the table's own name."""
    return mva_attach(docs, object_tag, ("object_id", "tag_id"), name,
                      where=F.col("object_datasource") == F.lit(datasource), doc_key=doc_key)


def mva_meta(docs: DataFrame, meta_kv: DataFrame, keys: list[str], doc_key: str = "doc_id",
             owner_col: str = "owner_id", key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Every integer metadata key becomes an attribute ``meta_<key>`` (sorted distinct values).

    ``keys`` are listed explicitly so the pivot is one aggregation pass; non-integer values are
    skipped (cast to long fails -> NULL -> dropped)."""
    m = (meta_kv.select(F.col(owner_col).alias(doc_key), F.col(key_col).alias("_k"),
                        F.col(value_col).cast("long").alias("_v"))
         .where(F.col("_v").isNotNull() & F.col("_k").isin(keys)).distinct())
    p = m.groupBy(doc_key).pivot("_k", keys).agg(F.sort_array(F.collect_list("_v")))
    p = p.select(doc_key, *[F.col(k).alias(f"meta_{k}") for k in keys])
    out = docs.join(p, doc_key, "left")
    for k in keys:
        out = out.withColumn(f"meta_{k}", F.coalesce(F.col(f"meta_{k}"), F.array().cast(T.ArrayType(T.LongType()))))
    return out


def response_to(comments: DataFrame, entry_col: str = "entry_id", id_col: str = "comment_id",
                who_col: str = "commenter_id", ts_col: str = "created_on") -> DataFrame:
    """For each comment, the distinct known commenters who wrote earlier on the same entry.

    Rewritten for scale: first the earliest time of each (entry, commenter) (one row per pair,
    aggregated map-side), then an equi-join on the entry with a ``>`` residual. Same pairs as the
    plain self-join, with a build side bounded by distinct commenters per entry.
    """
    c = comments.where(F.col(who_col).isNotNull())
    first = c.groupBy(entry_col, who_col).agg(F.min(ts_col).alias("_first"))
    me = comments.select(F.col(id_col), F.col(entry_col), F.col(ts_col).alias("_ts"))
    return (me.join(first, entry_col)
            .where(F.col("_ts") > F.col("_first"))
            .select(id_col, F.col(who_col).alias("response_to")))


def tag_category_pairs(tags: DataFrame, object_tag: DataFrame, placement: DataFrame,
                       datasource: str | None = None) -> DataFrame:
    """Distinct (tag_id, category_id): tag -> tagged entry -> placement.

    ``datasource=None`` keeps the reference's behaviour (no datasource check on the link rows)."""
    ot = object_tag if datasource is None else object_tag.where(F.col("object_datasource") == datasource)
    t = tags.where(~F.coalesce(F.col("is_private"), F.lit(False))).select(F.col("id").alias("tag_id"))
    return (t.join(ot.select("tag_id", "object_id"), "tag_id")
            .join(placement, F.col("object_id") == F.col("entry_id"))
            .select("tag_id", "category_id").distinct())
