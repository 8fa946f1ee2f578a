"""Column expressions for text: case folding, word splitting, markup removal.

All of it stays inside whole-stage code generation (``translate``, ``regexp_*``), never ``\\w``,
``\\b`` or ``lower()``, so the same words come out of Spark and out of the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the index charset (utf-8 charset table of the reference's template) ----
# Word characters: digits, underscore, a-z and Cyrillic U+0430..U+044F. A-Z and U+0410..U+042F
# fold to lower case; every other character separates words.
UPPER_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0x0410, 0x0430))
LOWER_CHARS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0x0430, 0x0450))
WORD_PATTERN = "[0-9a-z_а-я]+"
# ---- end of fixed values ----

# Markup patterns, ASCII-only so that Java regex and RE2 agree.
SCRIPT_PATTERN = r"(?is)<script[^>]*>.*?</script\s*>"
STYLE_PATTERN = r"(?is)<style[^>]*>.*?</style\s*>"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
TAG_PATTERN = r"<[^>]*>"
# ---- fixed values: named entities decoded by html_strip (&amp; last) ----
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_case(c) -> Column:
    """Charset-table case folding (only A-Z and U+0410..U+042F)."""
    return F.translate(_c(c), UPPER_CHARS, LOWER_CHARS)


def words(c) -> Column:
    """Array of indexable words of a text column, in order."""
    return F.regexp_extract_all(fold_case(c), F.lit(WORD_PATTERN), 0)


def html_strip(c) -> Column:
    """Remove markup: script/style bodies, comments, tags; decode the common entities."""
    x = _c(c)
    for pat in (SCRIPT_PATTERN, STYLE_PATTERN, COMMENT_PATTERN, TAG_PATTERN):
        x = F.regexp_replace(x, pat, " ")
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def attr_pattern(tag: str, attr: str) -> str:
    """Regex whose group 1 is the double-quoted value of ``attr`` inside ``<tag ...>``."""
    return rf'(?i)<{tag}\s(?:[^>]*?\s)?{attr}\s*=\s*"([^"]*)"'


def html_attr_values(c, tags: dict[str, list[str]]) -> Column:
    """Text of chosen tag attributes (e.g. ``{'img': ['alt', 'title'], 'a': ['title']}``), space-joined."""
    parts = [F.array_join(F.regexp_extract_all(_c(c), F.lit(attr_pattern(t, a)), 1), " ")
             for t, attrs in tags.items() for a in attrs]
    return F.concat_ws(" ", *parts)
