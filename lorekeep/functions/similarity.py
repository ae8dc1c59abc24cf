"""Name similarity: the share of characters in matching blocks, 2 M / T.

It depends on the order of its arguments, so the earlier name comes first.  ``may_reach``
is a bound on it from lengths, cheap enough for a join condition.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def ratios(a: Column | str, b: Column | str) -> Column:
    """The similarity of two columns of names, batch by batch."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([ratio(p, q) if p is not None and q is not None else None for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Whether lengths allow 2 * min / (m + n) >= least."""
    m, n = F.length(a), F.length(b)
    return 2 * F.least(m, n) >= least * (m + n)
