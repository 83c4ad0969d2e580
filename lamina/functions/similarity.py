"""String similarity. Edit distance is Spark's own; Jaro and Jaro-Winkler are Arrow UDFs over code points."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _jaro(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = dict.fromkeys(range(len(b)))
    mine = []
    for i, c in enumerate(a):
        if (j := next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j in free and b[j] == c), None)) is not None:
            del free[j]
            mine.append(c)
    if not mine:
        return 0.0
    theirs = (c for j, c in enumerate(b) if j not in free)
    swapped = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    m = len(mine)
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3.0


def _winkler(a: str, b: str) -> float:
    score = _jaro(a, b)
    if score <= 0.7:
        return score
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return score + 0.1 * same * (1 - score)


def _over(f):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def jaro(a: Column, b: Column) -> Column:
    return _over(_jaro)(a, b)


def jaro_winkler(a: Column, b: Column) -> Column:
    return _over(_winkler)(a, b)


def near(x: Column, y: Column) -> Column:
    """Both non-empty and one edit apart at most."""
    return F.coalesce((x != "") & (y != "") & (F.levenshtein(x, y) <= 1), F.lit(False))


def spelling_neighbours(x: Column, y: Column) -> Column:
    """Different, two edits apart at most, and no more than a quarter of the longer."""
    d = F.levenshtein(x, y)
    return d.between(1, 2) & (d / F.greatest(F.length(x), F.length(y)) <= 0.25)
