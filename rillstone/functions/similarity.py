"""Ratcliff-Obershelp similarity, which Spark lacks, as a pandas UDF behind lossless filters."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import prefix_len


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 * matched / summed lengths, the first argument as first sequence (the measure isn't symmetric)."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def alike(a: str, b: str, threshold: float = 0.8) -> bool:
    """Plain form for folds: a blank is like anything."""
    return not a or not b or a == b or SequenceMatcher(None, a, b).ratio() >= threshold


def variant(a: str, b: str, threshold: float, prefix: int) -> bool:
    """Plain form for folds: a blank is like nothing, and `prefix` leading characters must be shared."""
    return bool(a and b) and (a == b or (a[:prefix] == b[:prefix] and len(a) >= prefix and len(b) >= prefix and SequenceMatcher(None, a, b).ratio() >= threshold))


def may_match(a: Column, b: Column, threshold: float, prefix: int = 0) -> Column:
    """What a ratio of `threshold` needs: 2 * the shorter length over the sum bounds it from above."""
    la, lb = F.char_length(a), F.char_length(b)
    ok = 2.0 * F.least(la, lb) >= threshold * (la + lb)
    return ok & (prefix_len(a, b) >= prefix) if prefix else ok
