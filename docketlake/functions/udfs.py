"""Arrow functions for what has no expression; inputs are nulled where no work is needed."""

from __future__ import annotations

import difflib
import html
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or "&" not in x else html.unescape(x))


@F.pandas_udf(DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio over words, six decimals; null pairs give null at once."""

    def one(x, y):
        if x is None or y is None:
            return None
        p, q = x.split(), y.split()
        if not p and not q:
            return 1.0
        return round(difflib.SequenceMatcher(None, p, q, autojunk=False).ratio(), 6) if p and q else 0.0

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")
