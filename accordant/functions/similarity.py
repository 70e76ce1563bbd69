"""Jaro-Winkler similarity as an Arrow-batched function.

Spark has no such expression. Inputs are normalised in the JVM; a batch of pairs is compared
as character matrices, so no Python code runs per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from accordant.functions.text import normalize_match

_CELLS = 1 << 21  # character comparisons held at once


def _codes(texts: np.ndarray, width: int) -> np.ndarray:
    """Unicode texts as a (rows, width) matrix of code points, zero padded."""
    return texts.astype(f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _compare_block(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    rows = np.arange(len(left))
    wl, wr = int(n_left.max()), int(n_right.max())
    a, b = _codes(left, wl), _codes(right, wr)
    reach = np.maximum(n_left, n_right) // 2 - 1
    free = np.arange(wr)[None, :] < n_right[:, None]
    columns = np.arange(wr)[None, :]
    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    for i in range(wl):
        near = free & (np.abs(columns - i) <= reach[:, None])
        usable = near & (b == a[:, i][:, None]) & (i < n_left)[:, None]
        first = usable.argmax(axis=1)
        found = usable[rows, first]
        hit_a[:, i] = found
        hit_b[rows[found], first[found]] = True
        free[rows[found], first[found]] = False
    matches = hit_a.sum(axis=1)
    # Matched characters of both sides in order: stable sort moves them to the front.
    order_a = np.argsort(~hit_a, axis=1, kind="stable")
    order_b = np.argsort(~hit_b, axis=1, kind="stable")
    w = min(wl, wr)
    in_a = np.take_along_axis(a, order_a, axis=1)[:, :w]
    in_b = np.take_along_axis(b, order_b, axis=1)[:, :w]
    swapped = ((in_a != in_b) & (np.arange(w)[None, :] < matches[:, None])).sum(axis=1) // 2
    p = min(4, w)
    same = (a[:, :p] == b[:, :p]) & (np.arange(p)[None, :] < np.minimum(n_left, n_right)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matches / n_left + matches / n_right + (matches - swapped) / matches) / 3
    jaro = np.where(matches == 0, 0.0, jaro)
    return np.where(matches == 0, 0.0, jaro + prefix * 0.1 * (1 - jaro))


def jaro_winkler_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity of normalised texts; the prefix bonus applies at every level of similarity."""
    a, b = left.fillna("").to_numpy(dtype=object), right.fillna("").to_numpy(dtype=object)
    n_a = np.fromiter(map(len, a), dtype=np.int64, count=len(a))
    n_b = np.fromiter(map(len, b), dtype=np.int64, count=len(b))
    out = np.where((n_a > 0) & (n_b > 0) & (a == b), 1.0, 0.0)
    todo = np.flatnonzero((n_a > 0) & (n_b > 0) & (a != b))
    longest = np.maximum(n_a, n_b)
    todo = todo[np.argsort(longest[todo], kind="stable")]
    start = 0
    while start < len(todo):
        # Rows are ordered by length; a block holds texts of at most twice its shortest width.
        width = 2 * int(longest[todo[start]])
        fits = int(np.searchsorted(longest[todo], width, side="right")) - start
        size = min(fits, max(1, _CELLS // width))
        pick = todo[start:start + size]
        out[pick] = _compare_block(a[pick], b[pick], n_a[pick], n_b[pick])
        start += size
    return pd.Series(out)


@F.pandas_udf(DoubleType())
def _jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_batch(left, right)


def jaro_winkler(a: Column | str, b: Column | str, normalized: bool = False) -> Column:
    """Jaro-Winkler of the matching forms; 0.0 when either side is missing."""
    return _jaro_winkler(a, b) if normalized else _jaro_winkler(normalize_match(a), normalize_match(b))


def register(spark: SparkSession, name: str = "jaro_winkler") -> None:
    """Make the function callable from SQL (inputs already normalised)."""
    spark.udf.register(name, _jaro_winkler)
