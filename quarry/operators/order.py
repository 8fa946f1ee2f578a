"""Sorting, limits and paging, always per query (``query_id``) and always with a ``doc_id`` tie-break.

Top-k is a ``row_number()`` over ``partitionBy(query_id)`` filtered to the page, which Spark plans
as WindowGroupLimit (a per-partition top-k before the shuffle). Never a full global sort.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.spec import DEFAULT_LIMIT, DEFAULT_MAX_MATCHES

# ---- fixed values: time segments (seconds) and special sort names ----
SEGMENTS = (3600, 86400, 7 * 86400, 30 * 86400)
SPECIAL = {"@id": "doc_id", "@weight": "weight", "@rank": "weight", "@relevance": "weight",
           "@group": "group", "@count": "count", "@distinct": "distinct"}


# ---- fixed values: sort attribute when none is given, by index name ----
DEFAULT_SORT = (("entry", "authored_on"), ("tag", "entry_count"))
OTHER_SORT = "created_on"


def default_sort(index: str) -> str:
    """The attribute an attribute sort falls back to: the first listed word found in the index name(s)."""
    return next((attr for word, attr in DEFAULT_SORT if re.search(rf"\b{word}\b", index)), OTHER_SORT)


def special_names(clause: str) -> str:
    """``@weight``, ``@id`` and the like in an expression as the columns they stand for."""
    return re.sub(r"@\w+", lambda m: SPECIAL.get(m[0].lower(), m[0]), clause)


def relevance_keys() -> list[Column]:
    return [F.col("weight").desc(), F.col("doc_id").asc()]


def parse_sort_clause(clause: str) -> list[tuple[str, bool]]:
    """``'attr1 desc, @weight asc'`` -> [(column, ascending)]. A bare key sorts ascending."""
    out = []
    for part in [p.strip() for p in clause.split(",") if p.strip()]:
        toks = part.split()
        name = SPECIAL.get(toks[0].lower(), toks[0])
        asc = not (len(toks) > 1 and toks[1].lower() == "desc")
        out.append((name, asc))
    return out


def sort_pairs(mode: str = "relevance", by: str = "", as_of: str | None = None) -> list[tuple[Column, bool]]:
    """Ordering (column, ascending) pairs of a sort mode: relevance, attr_desc, attr_asc,
    time_segments, extended, expr. ``doc_id`` ascending always breaks ties."""
    if mode == "relevance":
        pairs = [(F.col("weight"), False)]
    elif mode in ("attr_desc", "desc"):
        pairs = [(F.col(by), False)]
    elif mode in ("attr_asc", "asc"):
        pairs = [(F.col(by), True)]
    elif mode in ("time_segments", "segments"):
        pairs = [(segment_col(by, as_of), True), (F.col("weight"), False)]
    elif mode == "extended":
        keys = parse_sort_clause(by) if by.strip() else [("weight", False)]
        pairs = [(F.col(n), a) for n, a in keys]
        if any(n == "doc_id" for n, _ in keys):
            return pairs
    elif mode == "expr":
        pairs = [(F.expr(special_names(by)), False)]
    else:
        raise ValueError(f"unknown sort mode {mode!r}")
    return pairs + [(F.col("doc_id"), True)]


def sort_keys(mode: str = "relevance", by: str = "", as_of: str | None = None) -> list[Column]:
    return [c.asc() if a else c.desc() for c, a in sort_pairs(mode, by, as_of)]


def segment_col(attr: str, as_of: str | None) -> Column:
    """0 = last hour, 1 = day, 2 = week, 3 = month, 4 = older (newest first)."""
    now = F.unix_timestamp(F.lit(as_of).cast("timestamp")) if as_of else F.unix_timestamp()
    age = now - F.unix_timestamp(F.col(attr).cast("timestamp"))
    c = F.lit(4)
    for i, lim in reversed(list(enumerate(SEGMENTS))):
        c = F.when(age < lim, F.lit(i)).otherwise(c)
    return c


def limits(offset: int = 0, limit: int = DEFAULT_LIMIT, max_matches: int | None = None,
           page: int | None = None, released: Column | None = None) -> tuple[int, int, int | Column]:
    """Effective (offset, limit, max): offset from page when only a page is given; a window that
    reaches past max widens max to offset + 2 * limit. A negative max stands for ``released``, the number
    of released documents (a column, counted with the query)."""
    if page and not offset:
        offset = limit * (int(page) - 1)
    mx = DEFAULT_MAX_MATCHES if max_matches is None else max_matches
    if mx < 0:
        if released is None:
            raise ValueError("a negative max_matches needs the number of released documents")
        return offset, limit, F.when(released <= offset + limit, F.lit(offset + 2 * limit)).otherwise(released)
    if offset + limit >= mx:
        mx = offset + 2 * limit
    return offset, limit, mx


def top_per_query(hits: DataFrame, keys: list[Column], offset: int = 0, limit: int = DEFAULT_LIMIT,
                  rank_col: str = "rank") -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` of each query in ``keys`` order, numbered in ``rank_col``."""
    w = Window.partitionBy("query_id").orderBy(*keys)
    return (hits.withColumn(rank_col, F.row_number().over(w))
            .where((F.col(rank_col) > offset) & (F.col(rank_col) <= offset + limit)))


def cutoff(hits: DataFrame, n: int) -> DataFrame:
    """Stop after ``n`` matches per query (0 = off); the first ``n`` by doc id so results repeat."""
    if not n:
        return hits
    w = Window.partitionBy("query_id").orderBy("doc_id")
    return hits.withColumn("_c", F.row_number().over(w)).where(F.col("_c") <= n).drop("_c")


def capped(total: str, max_matches: int | Column) -> Column:
    mx = max_matches if isinstance(max_matches, Column) else F.lit(max_matches)
    return F.least(F.col(total), mx.cast("long"))


def result_totals(hits: DataFrame, max_matches: int | Column = DEFAULT_MAX_MATCHES) -> DataFrame:
    """``query_id, total_found, total``: all matches, and matches kept (at most ``max_matches``)."""
    return (hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_found"))
            .withColumn("total", capped("total_found", max_matches)))


def page_table(totals: DataFrame, limit: int, current: int | None = None, lastn: int = 0) -> DataFrame:
    """One row per result page per query: number, offset, rows, first/last, previous/next.

    Pages are ``ceil(total_found / limit)``, generated per totals row with ``sequence`` (no window
    over all pages); ``lastn`` keeps only pages within +-lastn of ``current``.
    """
    n_pages = F.ceil(F.col("total_found") / F.lit(limit)).cast("int")
    p = (totals.select("query_id", "total_found", n_pages.alias("pages"))
         .where(F.col("pages") > 0)
         .select("query_id", "total_found", "pages", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page")))
    p = p.select(
        "query_id", "page", "pages",
        ((F.col("page") - 1) * limit).cast("long").alias("offset"),
        F.least(F.lit(limit).cast("long"), F.col("total_found") - (F.col("page") - 1) * limit).alias("rows"),
        (F.col("page") == 1).alias("is_first"),
        (F.col("page") == F.col("pages")).alias("is_last"),
        # 0 = no previous / next page
        F.when(F.col("page") > 1, F.col("page") - 1).otherwise(F.lit(0)).alias("prev_page"),
        F.when(F.col("page") < F.col("pages"), F.col("page") + 1).otherwise(F.lit(0)).alias("next_page"),
    )
    if current is not None:
        p = p.withColumn("is_current", F.col("page") == F.lit(current))
        if lastn:
            p = p.where(F.col("page").between(current - lastn, current + lastn))
    return p


def split_select(clause: str) -> list[str]:
    """Split a select list on top-level commas (commas inside parentheses stay)."""
    out, depth, cur = [], 0, []
    for ch in clause:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out
