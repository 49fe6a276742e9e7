"""Jaro-Winkler similarity of name pairs, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

from probity._shipping import ship_by_value
from probity.functions._args import ColumnOrName

ship_by_value(__name__)

# Fixed values of the measure.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7

SCORE_DIGITS = 12

_CELLS = 1 << 15  # characters compared at once: few enough to stay in the processor cache


def jaro_winkler_pairs(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Similarity of each pair in [0, 1], to twelve places; a null on either side gives NaN."""
    scores = np.full(len(left), np.nan)
    known = np.flatnonzero((left.notna() & right.notna()).to_numpy())
    a = left.to_numpy(dtype=object)[known]
    b = right.to_numpy(dtype=object)[known]
    width = np.array([max(len(x), len(y), 1) for x, y in zip(a, b)], dtype=np.int64)
    order = np.argsort(width, kind="stable")
    start = 0
    while start < len(order):
        # names of similar length share a block, so one long name does not widen all others
        end = start + 1
        while end < len(order) and (end - start + 1) * width[order[end]] <= _CELLS:
            end += 1
        block = order[start:end]
        scores[known[block]] = _score_block(a[block], b[block])
        start = end
    return scores.round(SCORE_DIGITS)


def _score_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    codes_a, len_a = _codes(a)
    codes_b, len_b = _codes(b)
    rows = np.arange(len(a))
    at_b = np.arange(codes_b.shape[1])
    window = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    hit_a = np.zeros(codes_a.shape, dtype=bool)
    free_b = at_b[None, :] < len_b[:, None]
    for i in range(codes_a.shape[1]):
        near = np.abs(at_b[None, :] - i) <= window[:, None]
        possible = free_b & near & (codes_b == codes_a[:, i, None]) & (i < len_a)[:, None]
        j = possible.argmax(axis=1)
        found = possible[rows, j]
        hit_a[:, i] = found
        free_b[rows[found], j[found]] = False
    hit_b = ~free_b & (at_b[None, :] < len_b[:, None])
    matches = hit_a.sum(axis=1)
    in_order_a = np.take_along_axis(codes_a, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)
    in_order_b = np.take_along_axis(codes_b, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)
    shared = min(codes_a.shape[1], codes_b.shape[1])
    differ = (in_order_a[:, :shared] != in_order_b[:, :shared]) & (
        np.arange(shared)[None, :] < matches[:, None]
    )
    swaps = differ.sum(axis=1) // 2
    m = np.maximum(matches, 1)
    jaro = (m / np.maximum(len_a, 1) + m / np.maximum(len_b, 1) + (m - swaps) / m) / 3.0
    jaro = np.where(matches > 0, jaro, np.where((len_a == 0) & (len_b == 0), 1.0, 0.0))
    head = min(PREFIX_LENGTH, shared)
    equal_head = (codes_a[:, :head] == codes_b[:, :head]) & (
        np.arange(head)[None, :] < np.minimum(len_a, len_b)[:, None]
    )
    prefix = np.cumprod(equal_head, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def _codes(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a matrix padded with zeros, and the lengths."""
    lengths = np.array([len(name) for name in names], dtype=np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    text = np.array(names, dtype=f"<U{width}")
    return text.view(np.uint32).reshape(len(names), width), lengths


def _score_batches(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        scores = jaro_winkler_pairs(left, right)
        yield pd.Series(scores).where(~np.isnan(scores))


# marked as not deterministic, or a filter on the score would have it computed twice
_score = F.pandas_udf(_score_batches, DoubleType()).asNondeterministic()


def jaro_winkler(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Similarity of two text columns, null if either is."""
    return _score(left, right)
