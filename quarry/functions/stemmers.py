"""Published stemming algorithms (M. F. Porter, 1980; Snowball Russian), plain Python per word.

These are small per-word helpers; Spark calls them through an Arrow ``pandas_udf`` on the
distinct words of a vocabulary only.
"""

from __future__ import annotations

import re
from functools import lru_cache

# ---------------------------------------------------------------------------------------------
# Porter (1980)

_VOWELS = "aeiou"


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """Number of VC sequences in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _is_cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _is_cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _is_cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    n = len(w)
    return (_is_cons(w, n - 3) and not _is_cons(w, n - 2) and _is_cons(w, n - 1)
            and w[-1] not in "wxy")


def _replace(w: str, suffix: str, rep: str, min_m: int) -> tuple[str, bool]:
    """If w ends with suffix: replace when m(stem) > min_m. Returns (word, suffix matched)."""
    if not w.endswith(suffix):
        return w, False
    stem = w[: len(w) - len(suffix)]
    if _measure(stem) > min_m:
        return stem + rep, True
    return w, True


# ---- fixed values: Porter suffix tables (steps 2, 3, 4), in the published order ----
_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
          ("logi", "log"))
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
          ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
          "ism", "ate", "iti", "ous", "ive", "ize")
# ---- end of fixed values ----


@lru_cache(maxsize=200_000)
def porter_stem(word: str | None) -> str | None:
    if word is None:
        return None
    w = word
    if len(w) <= 2 or not w.isascii() or not w.isalpha():
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in _STEP2:
        w, hit = _replace(w, suf, rep, 0)
        if hit:
            break
    # step 3
    for suf, rep in _STEP3:
        w, hit = _replace(w, suf, rep, 0)
        if hit:
            break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if _measure(stem) > 1:
                if suf == "ion":
                    if stem and stem[-1] in "st":
                        w = stem
                else:
                    w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


# ---------------------------------------------------------------------------------------------
# Snowball Russian

_RU_VOWELS = "аеиоуыэюя"

# ---- fixed values: Snowball Russian ending groups ----
_PERFECTIVE_1 = ("вшись", "вши", "в")          # preceded by а or я
_PERFECTIVE_2 = ("ывшись", "ившись", "ывши", "ивши", "ив", "ыв")
_REFLEXIVE = ("ся", "сь")
_ADJECTIVE = ("ими", "ыми", "его", "ого", "ему", "ому", "ее", "ие", "ые", "ое", "ей", "ий", "ый", "ой",
              "ем", "им", "ым", "ом", "их", "ых", "ую", "юю", "ая", "яя", "ою", "ею")
_PARTICIPLE_1 = ("ем", "нн", "вш", "ющ", "щ")   # preceded by а or я
_PARTICIPLE_2 = ("ивш", "ывш", "ующ")
_VERB_1 = ("ешь", "нно", "ете", "йте", "ла", "на", "ли", "й", "л", "ем", "н", "ло", "но", "ет", "ют",
           "ны", "ть")                            # preceded by а or я
_VERB_2 = ("уйте", "ейте", "ила", "ыла", "ена", "ите", "или", "ыли", "ило", "ыло", "ено", "ует", "уют",
           "ены", "ить", "ыть", "ишь", "ей", "уй", "ил", "ыл", "им", "ым", "ен", "ят", "ит", "ыт", "ую",
           "у", "ю")
_NOUN = ("иями", "ями", "ами", "ией", "иям", "ием", "иях", "ев", "ов", "ие", "ье", "еи", "ии", "ей",
         "ой", "ий", "ям", "ем", "ам", "ом", "ах", "ях", "ию", "ью", "ия", "ья", "а", "е", "и", "й", "о",
         "у", "ы", "ь", "ю", "я")
_SUPERLATIVE = ("ейше", "ейш")
_DERIVATIONAL = ("ость", "ост")
# ---- end of fixed values ----


def _longest(ends):
    return tuple(sorted(ends, key=len, reverse=True))


_PERFECTIVE_1, _PERFECTIVE_2 = _longest(_PERFECTIVE_1), _longest(_PERFECTIVE_2)
_ADJECTIVE, _PARTICIPLE_1, _PARTICIPLE_2 = _longest(_ADJECTIVE), _longest(_PARTICIPLE_1), _longest(_PARTICIPLE_2)
_VERB_1, _VERB_2, _NOUN = _longest(_VERB_1), _longest(_VERB_2), _longest(_NOUN)


def _ru_regions(w: str) -> tuple[int, int]:
    """Start of RV and of R2."""
    rv = len(w)
    for i, ch in enumerate(w):
        if ch in _RU_VOWELS:
            rv = i + 1
            break

    def next_r(start):
        for i in range(start + 1, len(w)):
            if w[i] not in _RU_VOWELS and w[i - 1] in _RU_VOWELS:
                return i + 1
        return len(w)

    r1 = next_r(0)
    r2 = next_r(r1) if r1 < len(w) else len(w)
    return rv, r2


def _strip(rv: str, groups1=(), groups2=()) -> str | None:
    """Remove the longest ending: group-1 endings must follow а/я (kept), group-2 ones need nothing."""
    best = None
    for e in groups1:
        if rv.endswith(e) and len(rv) > len(e) and rv[-len(e) - 1] in "ая":
            if best is None or len(e) > len(best[0]):
                best = (e, 1)
            break
    for e in groups2:
        if rv.endswith(e):
            if best is None or len(e) > len(best[0]):
                best = (e, 2)
            break
    if best is None:
        return None
    return rv[: len(rv) - len(best[0])]


@lru_cache(maxsize=200_000)
def russian_stem(word: str | None) -> str | None:
    if word is None:
        return None
    w = word.replace("ё", "е")
    rv_start, r2_start = _ru_regions(w)
    pre, rv = w[:rv_start], w[rv_start:]
    # step 1
    out = _strip(rv, _PERFECTIVE_1, _PERFECTIVE_2)
    if out is not None:
        rv = out
    else:
        for e in _REFLEXIVE:
            if rv.endswith(e):
                rv = rv[: -len(e)]
                break
        out = _strip(rv, (), _ADJECTIVE)
        if out is not None:
            rv = out
            p = _strip(rv, _PARTICIPLE_1, _PARTICIPLE_2)
            if p is not None:
                rv = p
        else:
            out = _strip(rv, _VERB_1, _VERB_2)
            if out is not None:
                rv = out
            else:
                out = _strip(rv, (), _NOUN)
                if out is not None:
                    rv = out
    # step 2
    if rv.endswith("и"):
        rv = rv[:-1]
    # step 3: derivational ending inside R2
    r2 = (pre + rv)[r2_start:] if r2_start < len(pre + rv) else ""
    for e in _DERIVATIONAL:
        if r2.endswith(e):
            rv = rv[: -len(e)]
            break
    # step 4
    if rv.endswith("нн"):
        rv = rv[:-1]
    else:
        for e in _SUPERLATIVE:
            if rv.endswith(e):
                rv = rv[: -len(e)]
                break
        if rv.endswith("нн"):
            rv = rv[:-1]
        elif rv.endswith("ь"):
            rv = rv[:-1]
    return pre + rv


_CYR = re.compile("[а-яё]")


def enru_stem(word: str | None) -> str | None:
    """Russian stem for Cyrillic words, English stem otherwise."""
    if word is None:
        return None
    return russian_stem(word) if _CYR.search(word) else porter_stem(word)
