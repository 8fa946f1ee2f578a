"""Declarations: index spec, search spec and the match-expression tree.

Specs are immutable dataclasses; every operator reads what it needs from them and returns a new
DataFrame. Nothing here touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: names of match modes, rankers, sort modes, group modes ----
RANKERS = ("proximity_bm25", "bm25", "none", "wordcount", "proximity", "matchany")
SORT_MODES = ("relevance", "attr_desc", "attr_asc", "time_segments", "extended", "expr")
GROUP_FUNCS = ("day", "week", "month", "year", "attr", "attrpair")
# Result cap and page size defaults of the reference.
DEFAULT_MAX_MATCHES = 1000
DEFAULT_LIMIT = 200
# Delta look-back.
DELTA_HOURS = 36
# BM25 constants (own choice where the reference is silent).
BM25_K1 = 1.2
BM25_B = 0.75
# ---- end of fixed values ----


@dataclass(frozen=True)
class IndexSpec:
    """What one index holds: id column, text fields, typed attributes, multi-value attributes.

    ``uint_attrs``/``float_attrs``/``ts_attrs``/``string_attrs``/``bool_attrs`` are source column
    names; ``rename`` maps a source name to its attribute name; ``select_values`` keeps rows whose
    column equals the value (e.g. released entries); ``delta_col`` is the change-time column.
    """

    name: str
    id_col: str = "id"
    fields: tuple[str, ...] = ()
    uint_attrs: tuple[str, ...] = ()
    float_attrs: tuple[str, ...] = ()
    ts_attrs: tuple[str, ...] = ()
    string_attrs: tuple[str, ...] = ()
    bool_attrs: tuple[str, ...] = ()
    mva_attrs: tuple[str, ...] = ()
    rename: tuple[tuple[str, str], ...] = ()
    select_values: tuple[tuple[str, object], ...] = ()
    delta_col: str | None = None
    html_fields: tuple[str, ...] = ()
    audit: bool = False  # the table records created_on and modified_on

    @property
    def change_column(self) -> str | None:
        """The delta's change-time column; audited tables fall back to ``modified_on``."""
        return self.delta_col or ("modified_on" if self.audit else None)

    def attr_name(self, c: str) -> str:
        return dict(self.rename).get(c, c)

    def __post_init__(self):
        if self.delta_col is not None and not self.delta_col:
            raise ValueError("delta index needs a date column")


# ---------------------------------------------------------------------------------------------
# Match expressions (boolean / extended mode). Users build the tree in Python; no query strings
# are parsed.


class Expr:
    def __and__(self, other: "Expr") -> "Expr":
        return And((self, other))

    def __or__(self, other: "Expr") -> "Expr":
        return Or((self, other))

    def __invert__(self) -> "Expr":
        return Not(self)

    def leaves(self) -> list["Expr"]:
        raise NotImplementedError

    def evaluate(self, truth: dict) -> bool:
        raise NotImplementedError


@dataclass(frozen=True)
class Term(Expr):
    word: str
    field: str | None = None

    def leaves(self):
        return [self]

    def evaluate(self, truth):
        return truth[self]


@dataclass(frozen=True)
class Phrase(Expr):
    words: tuple[str, ...]
    field: str | None = None

    def leaves(self):
        return [self]

    def evaluate(self, truth):
        return truth[self]


@dataclass(frozen=True)
class Near(Expr):
    """All words inside a span of ``n`` positions of one field, any order."""

    words: tuple[str, ...]
    n: int
    field: str | None = None

    def leaves(self):
        return [self]

    def evaluate(self, truth):
        return truth[self]


@dataclass(frozen=True)
class And(Expr):
    parts: tuple[Expr, ...]

    def leaves(self):
        return [x for p in self.parts for x in p.leaves()]

    def evaluate(self, truth):
        return all(p.evaluate(truth) for p in self.parts)


@dataclass(frozen=True)
class Or(Expr):
    parts: tuple[Expr, ...]

    def leaves(self):
        return [x for p in self.parts for x in p.leaves()]

    def evaluate(self, truth):
        return any(p.evaluate(truth) for p in self.parts)


@dataclass(frozen=True)
class Not(Expr):
    part: Expr

    def leaves(self):
        return self.part.leaves()

    def evaluate(self, truth):
        return not self.part.evaluate(truth)


def term(w: str, field: str | None = None) -> Term:
    return Term(w, field)


def phrase(*ws: str, field: str | None = None) -> Phrase:
    return Phrase(tuple(ws), field)


def near(*ws: str, n: int, field: str | None = None) -> Near:
    return Near(tuple(ws), n, field)


# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Filter:
    """One attribute filter. ``kind``: values | range | float_range | id_range | string."""

    kind: str
    attr: str
    values: tuple = ()
    lo: object = None
    hi: object = None
    exclude: bool = False


@dataclass(frozen=True)
class SearchSpec:
    """The settings of one search (the ~30 client settings, immutable)."""

    mode: str = "all"
    ranker: str = "proximity_bm25"
    field_weights: tuple[tuple[str, int], ...] = ()
    index_weights: tuple[tuple[str, int], ...] = ()
    filters: tuple[Filter, ...] = ()
    sort_mode: str = "relevance"
    sort_by: str = ""
    group_func: str | None = None
    group_by: str | None = None
    group_sort: str = "@group desc"
    group_distinct: str | None = None
    offset: int = 0
    limit: int = DEFAULT_LIMIT
    max_matches: int = DEFAULT_MAX_MATCHES
    cutoff: int = 0
    select: str = "*"
    as_of: str | None = None
    geo_anchor: tuple[str, str, float, float] | None = None
    overrides: tuple = ()
    tags: tuple | None = None  # tag mode: (tag table, names, tag attribute) instead of search words
    expr: Expr | None = None

    def with_(self, **kw) -> "SearchSpec":
        from dataclasses import replace

        return replace(self, **kw)
