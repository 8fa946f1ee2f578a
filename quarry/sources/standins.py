"""The driver's tables shaped as the reference's inputs (see FIXTURES.md §2).

Each function reads whole tables and derives the stand-in with plain column expressions; the SQL
oracle defines the same stand-ins the same way (``quarry.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: stand-in constants ----
CORPUS_EPOCH = "2024-01-01 00:00:00"
DELTA_AS_OF = "2024-02-11 16:00:00"
N_AUTHORS = 17
# ---- end of fixed values ----


def prep(spark: SparkSession) -> SparkSession:
    """Settings the stand-ins depend on (UTC for epoch seconds and calendar keys)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries: doc_id, title, body, lang, source, author_id, created_on, lat, long."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        "lang", "source",
        (F.col("doc_id") % N_AUTHORS).alias("author_id"),
        (F.lit(CORPUS_EPOCH).cast("timestamp_ntz")
         + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.col("doc_id").cast("int"), F.lit(0), F.lit(0))
         ).alias("created_on"),
        F.radians(F.col("doc_id") % 180 - 90).alias("lat"),
        F.radians(F.col("doc_id") % 360 - 180).alias("long"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with multi-value attributes: orders + tag (distinct l_partkey), category (segment id),
    count column n_returned (lineitems with l_returnflag = 'R')."""
    from quarry.sources.links import count_column, mva_attach

    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer")
    docs = o.select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("author_id"),
                    "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    docs = mva_attach(docs, li, ("l_orderkey", "l_partkey"), "tag")
    docs = count_column(docs, li, "l_orderkey", "n_returned", where=F.col("l_returnflag") == "R")
    cat = (o.join(c, o.o_custkey == c.c_custkey)
           .join(categories(spark, sf_dir).select(F.col("label").alias("c_mktsegment"), F.col("id").alias("cat_id")),
                 "c_mktsegment")
           .select(F.col("o_orderkey").alias("doc_id"), "cat_id"))
    return mva_attach(docs, cat, ("doc_id", "cat_id"), "category")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, blog_id, basename, label from the distinct market segments (ids in label order)."""
    c = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    from pyspark.sql import Window

    w = Window.orderBy("c_mktsegment")
    return c.select(F.row_number().over(w).cast("long").alias("id"), F.lit(1).cast("long").alias("blog_id"),
                    F.lower("c_mktsegment").alias("basename"), F.col("c_mktsegment").alias("label"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, n8d_id, is_private from part."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.lit(None).cast("long").alias("n8d_id"), F.lit(False).alias("is_private"))


def object_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tag_id, object_id, object_datasource from lineitem (datasource from the line status)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("tag_id"), F.col("l_orderkey").alias("object_id"),
                     F.when(F.col("l_linestatus") == "O", F.lit("entry")).otherwise(F.lit("asset"))
                     .alias("object_datasource"))


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry_id, category_id: each order placed in its customer's segment."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    cats = categories(spark, sf_dir)
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(cats, F.col("c_mktsegment") == F.col("label"))
            .select(F.col("o_orderkey").alias("entry_id"), F.col("id").alias("category_id")))


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """follower_id, followee_id = distinct (o_custkey, l_suppkey)."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .select(F.col("o_custkey").alias("follower_id"), F.col("l_suppkey").alias("followee_id")).distinct())


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comment_id, entry_id, commenter (role), created_on order (turn), text."""
    cv = table(spark, sf_dir, "conversations")
    return cv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("comment_id"),
                     F.col("conv_id").alias("entry_id"), F.col("turn").alias("created_on"),
                     F.col("role").alias("commenter_id"), "text")


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """owner_id, key, value from events (event_type as key, integer props.k as value)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("owner_id"), F.col("event_type").alias("key"),
                    F.get_json_object("props", "$.k").cast("long").alias("value"))
