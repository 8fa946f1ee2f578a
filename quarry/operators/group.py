"""Grouping and facets: one best match per group, with ``group``, ``count`` and optional ``distinct``.

The best row is a ``min_by`` over an ordering struct inside a normal ``groupBy``: partial
aggregation combines map-side, so a group holding a third of all rows costs one small record per
map task, never one task that buffers the whole group. Exact, where the reference is approximate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.order import parse_sort_clause, sort_pairs, top_per_query


def week_start(ts: Column) -> Column:
    d = F.to_date(ts)
    return F.date_sub(d, F.dayofweek(d) - 1)


def group_key(func: str, attr: str) -> Column:
    """Calendar keys: day YYYYMMDD, week YYYYNNN (Sunday start, day of year), month YYYYMM, year YYYY."""
    c = F.col(attr)
    if func == "day":
        return F.date_format(c, "yyyyMMdd").cast("long")
    if func == "week":
        w = week_start(c)
        return (F.year(w) * 1000 + F.dayofyear(w)).cast("long")
    if func == "month":
        return F.date_format(c, "yyyyMM").cast("long")
    if func == "year":
        return F.year(c).cast("long")
    if func in ("attr", "attrpair"):
        return c
    raise ValueError(f"unknown group function {func!r}")


def _neg(c: Column, dt: T.DataType) -> Column:
    """A key whose ascending order is the descending order of ``c``."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.BooleanType):
        return -c.cast("int")
    if isinstance(dt, T.NumericType):
        return -c
    if isinstance(dt, T.StringType):  # complemented bytes; the end mark puts a longer text first
        return F.concat(F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    raise TypeError(f"descending order on {dt.simpleString()} is not supported in grouping")


def ordering_struct(df: DataFrame, pairs: list[tuple[Column, bool]]) -> Column:
    """A struct whose natural (ascending) order is the requested order, NULLs as in ``sort_keys``: first
    when ascending, last when descending."""
    parts = []
    for i, (c, asc) in enumerate(pairs):
        dt = df.select(c).schema.fields[0].dataType
        key = F.struct(c.isNotNull().alias("n"), c.alias("v")) if asc else F.struct(c.isNull().alias("n"), _neg(c, dt).alias("v"))
        parts.append(key.alias(f"k{i}"))
    return F.struct(*parts)


def _next_attr(df: DataFrame, attr: str) -> str:
    cols = [c for c in df.columns]
    i = cols.index(attr)
    if i + 1 >= len(cols):
        raise ValueError("attrpair: no attribute after the last one")
    return cols[i + 1]


def with_groups(hits: DataFrame, func: str, attr: str, attr_order: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``hits`` with its group column(s), one row per group a hit is in, and the grouping keys."""
    if isinstance(hits.schema[attr].dataType, T.ArrayType):
        h = hits.withColumn("group", F.explode(F.array_distinct(F.col(attr))))
    else:
        h = hits.withColumn("group", group_key(func, attr))
    if func != "attrpair":
        return h, ["query_id", "group"]
    nxt = attr_order[attr_order.index(attr) + 1] if attr_order else _next_attr(hits, attr)
    return h.withColumn("group2", F.col(nxt)), ["query_id", "group", "group2"]


def group_by(hits: DataFrame, func: str, attr: str, sort_mode: str = "relevance", sort_by: str = "",
             distinct: str | None = None, approx: bool = False, as_of: str | None = None,
             attr_order: list[str] | None = None) -> DataFrame:
    """One row per (query_id, group): the best match by the current sort, plus ``group``, ``count``
    (matches in the group) and, with ``distinct``, the number of distinct values of that attribute.

    A multi-value attribute puts a document in one group per value. ``attrpair`` groups by the
    attribute and the next one in schema order (``attr_order`` overrides that order).
    """
    h, keys = with_groups(hits, func, attr, attr_order)
    pairs = sort_pairs(sort_mode, sort_by, as_of)
    order = ordering_struct(h, pairs)
    row_cols = [c for c in hits.columns if c != "query_id"]
    aggs = [F.count(F.lit(1)).alias("count"),
            F.min_by(F.struct(*[F.col(c) for c in row_cols]), order).alias("_best")]
    if distinct:
        aggs.append((F.approx_count_distinct(distinct) if approx else F.count_distinct(distinct)).alias("distinct"))
    g = h.groupBy(*keys).agg(*aggs)
    return g.select(*keys, "count", *(["distinct"] if distinct else []), "_best.*")


def group_sort_keys(clause: str = "@group desc") -> list[Column]:
    keys = parse_sort_clause(clause or "@group desc")
    cols = [F.col(n).asc() if a else F.col(n).desc() for n, a in keys]
    return cols + [F.col("group").asc_nulls_first(), F.col("doc_id").asc()]


def grouped_search(hits: DataFrame, func: str, attr: str, sort_mode: str = "relevance", sort_by: str = "",
                   group_sort: str = "@group desc", distinct: str | None = None, offset: int = 0,
                   limit: int = 20, as_of: str | None = None) -> DataFrame:
    """Group, then order the groups (default ``@group desc``) and keep one page of them per query."""
    g = group_by(hits, func, attr, sort_mode, sort_by, distinct, as_of=as_of)
    return top_per_query(g, group_sort_keys(group_sort), offset, limit, rank_col="rank")


def group_totals(hits: DataFrame, func: str, attr: str, attr_order: list[str] | None = None) -> DataFrame:
    """``total_found`` in group mode: the number of groups per query, a NULL group included."""
    h, keys = with_groups(hits, func, attr, attr_order)
    return h.select(*keys).distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("total_found"))


def _facet_item_fn(name: str):
    return lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value"))


def facets(hits: DataFrame, groupings: list[tuple[str, str, str]]) -> DataFrame:
    """Several groupings of one match set in one pass: ``query_id, facet, value, count``.

    ``groupings`` = [(facet name, group function, attribute)]. Every hit is expanded into one
    (facet, value) item per grouping (one per value for a multi-value attribute), then a single
    aggregation with map-side combine counts them: one shuffle for all facets.
    """
    items = []
    for name, func, attr in groupings:
        if isinstance(hits.schema[attr].dataType, T.ArrayType):
            vals = F.coalesce(F.transform(F.array_distinct(F.col(attr)), lambda x: x.cast("string")),
                              F.array().cast("array<string>"))  # a missing array has no value of this facet
        else:
            vals = F.array(group_key(func, attr).cast("string"))
        items.append(F.transform(vals, _facet_item_fn(name)))
    ex = hits.select("query_id", F.inline(F.flatten(F.array(*items))))
    return ex.groupBy("query_id", "facet", "value").agg(F.count(F.lit(1)).alias("count"))


def tag_cloud(tags: DataFrame, object_tag: DataFrame, datasource: str = "entry", pairs: DataFrame | None = None,
              category_ids: DataFrame | list | None = None, limit: int | None = None) -> DataFrame:
    """Public tags with the number of tagged objects of ``datasource``, most used first.

    With ``pairs`` (tag_id, category_id) and ``category_ids`` (values, or a DataFrame with a category_id
    column) only tags seen in those categories count. ``limit`` keeps the top tags (the cloud size); ``rank`` numbers them.
    """
    from pyspark.sql import Window

    t = tags.where(~F.coalesce(F.col("is_private"), F.lit(False))).select(F.col("id").alias("tag_id"), "name")
    if pairs is not None and category_ids is not None:
        ok = (pairs.join(category_ids.select("category_id").distinct(), "category_id", "left_semi")
              if isinstance(category_ids, DataFrame) else pairs.where(F.col("category_id").isin(list(category_ids))))
        ok = ok.select("tag_id").distinct()
        t = t.join(ok, "tag_id", "left_semi")
    cnt = (object_tag.where(F.col("object_datasource") == datasource)
           .select("tag_id", "object_id").distinct()
           .groupBy("tag_id").agg(F.count(F.lit(1)).alias("entry_count")))
    c = t.join(cnt, "tag_id")
    order = [F.col("entry_count").desc(), F.col("name").asc(), F.col("tag_id").asc()]
    if limit:
        # top-k: the planner keeps `limit` rows per partition before the single ordering step
        top = c.orderBy(*order).limit(limit)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return c
