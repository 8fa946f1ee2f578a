"""Word normal forms: none, English and Russian stems, soundex.

Stemming runs in Python through an Arrow-batched ``pandas_udf``; callers apply it to the distinct
words of a vocabulary (or of a queries table), then join the result back, so the Python cost
grows with the vocabulary, not with the text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.stemmers import enru_stem, porter_stem, russian_stem


@F.pandas_udf(T.StringType())
def _stem_en(s: pd.Series) -> pd.Series:
    return s.map(porter_stem)


@F.pandas_udf(T.StringType())
def _stem_ru(s: pd.Series) -> pd.Series:
    return s.map(russian_stem)


@F.pandas_udf(T.StringType())
def _stem_enru(s: pd.Series) -> pd.Series:
    return s.map(enru_stem)


def normalize_column(c: Column, method: str = "none") -> Column:
    if method in (None, "none"):
        return c
    if method == "soundex":
        # Spark's soundex leaves words that do not start with a letter unchanged.
        return F.soundex(c)
    if method == "stem_en":
        return _stem_en(c)
    if method == "stem_ru":
        return _stem_ru(c)
    if method == "stem_enru":
        return _stem_enru(c)
    raise ValueError(f"unknown morphology {method!r}")
