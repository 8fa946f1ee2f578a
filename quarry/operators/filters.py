"""Attribute filters and name lookups. Each is DataFrame -> DataFrame.

A NULL attribute matches no filter, included or excluded. Scalar filters are plain predicates, so
Catalyst pushes them into the Parquet scan of the attribute table; multi-value attributes use
array predicates. Lookups by name are lazy semi joins, never driver-side id lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.spec import Filter

# ---- fixed values: open date-range ends and earth radius ----
DATE_END_OPEN = 2147483647
EARTH_RADIUS_M = 6371000.0


class LookupError_(ValueError):
    """A name filter found nothing (the reference reports an error)."""


def _is_array(df: DataFrame, attr: str) -> bool:
    return isinstance(df.schema[attr].dataType, T.ArrayType)


def _apply(df: DataFrame, pred: Column, exclude: bool) -> DataFrame:
    # NULL stays NULL under ~, so rows with a missing attribute drop out either way.
    return df.where(~pred if exclude else pred)


def filter_values(df: DataFrame, attr: str, values, exclude: bool = False) -> DataFrame:
    """Attribute in a value list (multi-value: any element). Empty list = no filter."""
    values = list(values or [])
    if not values:
        return df
    if _is_array(df, attr):
        pred = F.arrays_overlap(F.col(attr), F.array(*[F.lit(v) for v in values]))
    else:
        pred = F.col(attr).isin(values)
    return _apply(df, pred, exclude)


def filter_range(df: DataFrame, attr: str, lo, hi, exclude: bool = False) -> DataFrame:
    """``lo <= attr <= hi`` (multi-value: any element); ``lo <= hi`` required."""
    if lo > hi:
        raise ValueError("filter_range: min must not exceed max")
    if _is_array(df, attr):
        pred = F.exists(F.col(attr), lambda x: x.between(F.lit(lo), F.lit(hi)))
    else:
        pred = F.col(attr).between(F.lit(lo), F.lit(hi))
    return _apply(df, pred, exclude)


def filter_float_range(df: DataFrame, attr: str, lo: float, hi: float, exclude: bool = False) -> DataFrame:
    if lo > hi:
        raise ValueError("filter_float_range: min must not exceed max")
    return _apply(df, F.col(attr).cast("double").between(float(lo), float(hi)), exclude)


def filter_id_range(df: DataFrame, lo: int, hi: int, id_col: str = "doc_id") -> DataFrame:
    if lo > hi:
        raise ValueError("filter_id_range: min must not exceed max")
    return df.where(F.col(id_col).between(lo, hi))


def filter_string(df: DataFrame, attr: str, values, exclude: bool = False, crc: bool = False) -> DataFrame:
    """String attribute equals any value. ``crc=True`` compares CRC32 as the reference does."""
    values = list(values or [])
    if not values:
        return df
    if crc:
        import zlib

        crcs = [zlib.crc32(str(v).encode("utf-8")) for v in values]
        pred = F.crc32(F.col(attr).cast("binary")).isin(crcs)
    else:
        pred = F.col(attr).isin(values)
    return _apply(df, pred, exclude)


def filter_blogs(df: DataFrame, blog_ids, attr: str = "blog_id") -> DataFrame:
    """Only the chosen blogs; none chosen = all."""
    return filter_values(df, attr, blog_ids)


def _ensure_found(target: DataFrame, what: str) -> None:
    """An unknown name is an error of the request, so it is looked up when the filter is built (pass
    ``check=False`` to skip this one-row read)."""
    if target.limit(1).count() == 0:
        raise LookupError_(f"no {what} found")


def filter_lookup(df: DataFrame, attr: str, target: DataFrame, column: str, value, id_col: str = "id",
                  blog_ids=None, blog_col: str = "blog_id", check: bool = True) -> DataFrame:
    """Filter value is a name: rows of ``target`` whose ``column`` equals ``value`` (within the
    blogs), then keep documents whose ``attr`` (scalar or multi-value) is one of their ids."""
    t = target.where(F.col(column) == F.lit(value))
    if blog_ids:
        t = t.where(F.col(blog_col).isin(list(blog_ids)))
    t = t.select(F.col(id_col).alias("_lk")).distinct()
    if check:
        _ensure_found(t, f"{column}={value!r}")
    return semi_on_attr(df, attr, t, "_lk")


def semi_on_attr(df: DataFrame, attr: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Documents whose attribute (scalar or any element of a multi-value one) is in ``ids``."""
    ids = ids.select(F.col(id_col).alias("_v")).distinct()
    if _is_array(df, attr):
        ex = df.select("doc_id", F.explode(attr).alias("_v")).join(ids, "_v").select("doc_id").distinct()
        return df.join(ex, "doc_id", "left_semi")
    return df.join(ids, F.col(attr) == F.col("_v"), "left_semi")


def filter_lookup_meta(df: DataFrame, attr: str, meta: DataFrame, key: str, value, blogs: DataFrame | None = None,
                       blog_ids=None, owner_col: str = "owner_id", key_col: str = "key",
                       value_col: str = "value", check: bool = True) -> DataFrame:
    """Same as filter_lookup, the targets found through a metadata (owner, key, value) table."""
    t = meta.where((F.col(key_col) == F.lit(key)) & (F.col(value_col) == F.lit(value))).select(
        F.col(owner_col).alias("_lk")).distinct()
    if blog_ids and blogs is not None:
        allowed = blogs.where(F.col("blog_id").isin(list(blog_ids))).select(F.col("id").alias("_lk"))
        t = t.join(allowed, "_lk", "left_semi")
    if check:
        _ensure_found(t, f"meta {key}={value!r}")
    return semi_on_attr(df, attr, t, "_lk")


def date_bound(yyyymmddhh: str | None, end: bool) -> Column:
    """YYYYMMDDHH -> epoch seconds; open ends are 0 and 2147483647."""
    if not yyyymmddhh:
        return F.lit(DATE_END_OPEN if end else 0).cast("long")
    return F.unix_timestamp(F.to_timestamp(F.lit(str(yyyymmddhh) + "0000"), "yyyyMMddHHmmss"))


def filter_date_range(df: DataFrame, start: str | None = None, end: str | None = None,
                      attr: str = "created_on") -> DataFrame:
    """``date_start``/``date_end`` inclusive on a timestamp attribute; neither given = no filter."""
    if not start and not end:
        return df
    secs = F.unix_timestamp(F.col(attr).cast("timestamp"))
    return df.where(secs.between(date_bound(start, False), date_bound(end, True)))


def tag_ids_for(tags: DataFrame, names: str | list[str]) -> DataFrame:
    """Tag ids for a comma list of names: by name or normalized name, widened to every tag sharing
    the normalized id. Unknown names match nothing."""
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    norms = [normalize_tag(n) for n in names]
    t = tags.select("id", "name", F.coalesce("n8d_id", "id").alias("grp"))
    hit = (t.where(F.col("name").isin(names) | normalize_tag_col(F.col("name")).isin(norms))
           .select("grp").distinct())
    # Unknown names match nothing: the semi join on an empty id set keeps no rows (the reference
    # pushes id 0 for that, which would hit a real row where 0 is a valid id).
    return t.join(hit, "grp", "left_semi").select(F.col("id").cast("long").alias("tag_id")).distinct()


def normalize_tag(name: str) -> str:
    """Normalized tag name: lower case, no spaces or punctuation."""
    return "".join(ch for ch in name.lower() if ch.isalnum() or ch == "_")


def normalize_tag_col(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]", "")


def filter_tags(df: DataFrame, tags: DataFrame, names, attr: str = "tag") -> DataFrame:
    return semi_on_attr(df, attr, tag_ids_for(tags, names), "tag_id")


def filter_category(df: DataFrame, cats: DataFrame, names, blog_ids=None, attr: str = "category",
                    check: bool = True) -> DataFrame:
    """Comma list of category basenames within the blogs; unknown ones ignored, all unknown an error."""
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    c = cats.where(F.col("basename").isin(names))
    if blog_ids:
        c = c.where(F.col("blog_id").isin(list(blog_ids)))
    c = c.select(F.col("id").alias("_c")).distinct()
    if check:
        _ensure_found(c, f"category {names!r}")
    return semi_on_attr(df, attr, c, "_c")


def filter_author(df: DataFrame, authors: DataFrame, names, attr: str = "author_id", check: bool = True) -> DataFrame:
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    a = authors.where(F.col("name").isin(names)).select(F.col("id").alias("_a")).distinct()
    if check:
        _ensure_found(a, f"author {names!r}")
    return semi_on_attr(df, attr, a, "_a")


def filter_following(df: DataFrame, follows: DataFrame, author_id, attr: str = "author_id") -> DataFrame:
    """Documents by people ``author_id`` follows (``follows``: follower_id, followee_id); nobody = nothing."""
    f = follows.where(F.col("follower_id") == F.lit(author_id)).select(F.col("followee_id").alias("_f"))
    return semi_on_attr(df, attr, f, "_f")


def geo_distance(lat: str | Column, long: str | Column, lat0: float, long0: float) -> Column:
    """Great-circle distance in metres (haversine), all angles in radians."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(long) if isinstance(long, str) else long
    dlat = (la - F.lit(lat0)) / 2
    dlon = (lo - F.lit(long0)) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(la) * F.cos(F.lit(lat0)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def apply_filter(df: DataFrame, f: Filter) -> DataFrame:
    if f.kind == "values":
        return filter_values(df, f.attr, f.values, f.exclude)
    if f.kind == "range":
        return filter_range(df, f.attr, f.lo, f.hi, f.exclude)
    if f.kind == "float_range":
        return filter_float_range(df, f.attr, f.lo, f.hi, f.exclude)
    if f.kind == "id_range":
        return filter_id_range(df, f.lo, f.hi)
    if f.kind == "string":
        return filter_string(df, f.attr, f.values, f.exclude)
    raise ValueError(f"unknown filter kind {f.kind!r}")


# ---------------------------------------------------------------------------------------------
# text filters: attribute filters answered by the inverted table through words <index>_<attr>_<value>


def _split_filters(index: str, filters: list[Filter], level: int, forced: tuple) -> tuple[list, list, list]:
    """Filters that stay, words every document must hold, and groups of words of which it must hold one."""
    from quarry.operators.index import attr_token

    keep, and_words, groups = [], [], []
    for f in filters:
        is_forced = "all" in forced or f.attr in forced
        if level == 0 or is_forced or f.kind != "values" or f.exclude or not f.values:
            keep.append(f)
        elif len(f.values) == 1:
            and_words.append(attr_token(index, f.attr, list(f.values)[0]))
        elif level >= 2:
            groups.append([attr_token(index, f.attr, v) for v in f.values])
        else:
            keep.append(f)
    return keep, and_words, groups


def filter_words(index: str, filters: list[Filter], level: int = 1, forced: tuple = ()) -> list[str]:
    """The words that ``filter_text`` looks up."""
    _, and_words, groups = _split_filters(index, filters, level, forced)
    return sorted({*and_words, *(w for g in groups for w in g)})


def filter_text(postings: DataFrame, matched: DataFrame, index: str, filters: list[Filter],
                level: int = 1, forced: tuple = ()) -> tuple[DataFrame, list[Filter]]:
    """Answer attribute filters through filter words in the postings (see ``attr_tokens``).

    Level 1: single-value filters become words that every document must hold (AND). Level 2: a
    multi-value filter becomes an OR group of words too. Level 0, excluded filters, non-value
    filters and attributes in ``forced`` (or ``'all'``) stay attribute filters, returned to the
    caller. The filter is always ANDed to the match, whatever the match mode.
    """
    keep, and_words, groups = _split_filters(index, filters, level, forced)
    if and_words:
        need = len(set(and_words))
        ok = (postings.where(F.col("term").isin(and_words)).groupBy("doc_id")
              .agg(F.count_distinct("term").alias("_k")).where(F.col("_k") == need).select("doc_id"))
        matched = matched.join(ok, "doc_id", "left_semi")
    for g in groups:
        ok = postings.where(F.col("term").isin(g)).select("doc_id").distinct()
        matched = matched.join(ok, "doc_id", "left_semi")
    return matched, keep
