"""Sequence similarity of names: twice the characters in matching blocks over both lengths.

Blocks are found as Ratcliff and Obershelp do: the longest common block (of equal ones the first in
the candidate, then in the name), then the same on both sides of it. All pairs of an Arrow batch
take each step together, as arrays. In names of 200 characters or more, characters that make up
more than a hundredth of the name begin no block, which is what the surveyed matcher does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CUTOFF = 0.87
POPULAR_FROM = 200  # fixed value: names of this length have popular characters
_CELLS = 1 << 20  # cells of a batch's table of runs
_SLACK = 1e-9  # for products of lengths and the cut-off


def _matrix(texts: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a row each, filled up with ``fill``; and their lengths."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.full((len(texts), max(int(lengths.max()), 1)), fill, dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<i4")
    return out, lengths


def _begins(name: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether a character of a name may begin a block."""
    out = np.ones(name.shape, dtype=bool)
    for row in np.flatnonzero(lengths >= POPULAR_FROM):
        _, where, times = np.unique(name[row, : lengths[row]], return_inverse=True, return_counts=True)
        out[row, : lengths[row]] = (times <= lengths[row] // 100 + 1)[where]
    return out


def _window(values: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, fill) -> np.ndarray:
    at = low[:, None] + np.arange(int((high - low).max()))
    return np.where(at < high[:, None], values[rows[:, None], np.minimum(at, values.shape[1] - 1)], fill)


def _longest(a: np.ndarray, b: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the start in ``a``, the start in ``b`` and the size of the longest common block."""
    rows = np.arange(len(a))
    runs = np.zeros((len(a), b.shape[1] + 1), dtype=np.int32)
    start_a, start_b, size = (np.zeros(len(a), dtype=np.int64) for _ in range(3))
    for i in range(a.shape[1]):
        runs[:, 1:] = np.where((a[:, i, None] == b) & begins, runs[:, :-1] + 1, 0)
        end = runs.argmax(axis=1)
        run = runs[rows, end]
        better = run > size
        size = np.where(better, run, size)
        start_a = np.where(better, i + 1 - run, start_a)
        start_b = np.where(better, end - run, start_b)
    return start_a, start_b, size


def _grow(a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, size: np.ndarray) -> None:
    """Lengthen blocks, in place, by equal neighbours, which may be characters that begin none."""
    rows = np.arange(len(a))
    while True:
        more = (start_a > 0) & (start_b > 0)
        more &= a[rows, start_a - 1] == b[rows, start_b - 1]
        if not more.any():
            break
        start_a -= more
        start_b -= more
        size += more
    while True:
        end_a, end_b = start_a + size, start_b + size
        more = (end_a < a.shape[1]) & (end_b < b.shape[1])
        more &= a[rows, np.minimum(end_a, a.shape[1] - 1)] == b[rows, np.minimum(end_b, b.shape[1] - 1)]
        if not more.any():
            break
        size += more


def _matched(candidates: list[str], names: list[str]) -> np.ndarray:
    """Characters in matching blocks of each pair."""
    a, len_a = _matrix(candidates, -1)
    b, len_b = _matrix(names, -2)
    begins = _begins(b, len_b)
    total = np.zeros(len(a), dtype=np.int64)
    todo = np.stack([np.arange(len(a)), np.zeros_like(len_a), len_a, np.zeros_like(len_b), len_b])
    while True:
        todo = todo[:, (todo[1] < todo[2]) & (todo[3] < todo[4])]
        if not todo.shape[1]:
            return total
        rows, low_a, high_a, low_b, high_b = todo
        wa, wb = _window(a, rows, low_a, high_a, -1), _window(b, rows, low_b, high_b, -2)
        start_a, start_b, size = _longest(wa, wb, _window(begins, rows, low_b, high_b, False))
        if not begins.all():
            _grow(wa, wb, start_a, start_b, size)
        np.add.at(total, rows, size)
        start_a, start_b = low_a + start_a, low_b + start_b
        sides = [[rows, low_a, start_a, low_b, start_b], [rows, start_a + size, high_a, start_b + size, high_b]]
        todo = np.concatenate([np.stack(side)[:, size > 0] for side in sides], axis=1)


def ratios(candidates: list[str], names: list[str]) -> np.ndarray:
    """The similarity of each candidate to the name beside it; not symmetric. Two empty names: 1."""
    lengths = np.array([len(a) + len(b) for a, b in zip(candidates, names, strict=True)], dtype=np.int64)
    out = np.ones(len(lengths))
    order = np.argsort(lengths, kind="stable")[int((lengths == 0).sum()) :]
    while len(order):
        step = max(1, _CELLS // int(lengths[order[-1]]))
        chunk, order = order[-step:], order[:-step]  # the longest first, with others of like length
        out[chunk] = 2.0 * _matched([candidates[i] for i in chunk], [names[i] for i in chunk]) / lengths[chunk]
    return out


def close_ratio(candidate: Column, name: Column, cutoff: float = CUTOFF) -> Column:
    """The candidate's similarity to ``name`` if it reaches ``cutoff``, else null; null for nulls. Not symmetric."""

    @F.pandas_udf("double")
    def run(candidates: pd.Series, names: pd.Series) -> pd.Series:
        found = pd.Series(np.nan, index=candidates.index, dtype="float64")
        known = (candidates.notna() & names.notna()).to_numpy()
        got = ratios(candidates[known].tolist(), names[known].tolist())
        found[known] = np.where(got >= cutoff, got, np.nan)
        return found

    return run(candidate, name)


def lengths_within(length: Column, cutoff: float = CUTOFF) -> Column:
    """Lengths that a string may have to reach ``cutoff`` against one of ``length``."""
    low = F.ceil(length * cutoff / (2 - cutoff) - _SLACK).cast("int")
    high = F.floor(length * (2 - cutoff) / cutoff + _SLACK).cast("int")
    return F.sequence(low, high)


def chars_needed(total: Column, cutoff: float = CUTOFF) -> Column:
    """Characters that must match in a pair of ``total`` characters to reach ``cutoff``."""
    return F.ceil(total * cutoff / 2 - _SLACK).cast("int")


def chars_shared(a: Column, b: Column) -> Column:
    """Characters that ``a`` and ``b`` have in common in any order, an upper bound of those that match."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    chars = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, F.lit(1))))
    shared = F.aggregate(chars, F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))
    return F.when(F.length(a) > 0, shared).otherwise(0)


def pieces_of(length: Column, cutoff: float = CUTOFF) -> Column:
    """Into how many pieces a name of ``length`` is cut so that a partner at ``cutoff`` holds one whole.

    The partner has at most length * (2 - cutoff) / cutoff characters, and (1 - cutoff) of both
    lengths together is left out of the blocks. Each such character spoils one piece at most.
    """
    return (F.floor(length * (2 * (1 - cutoff) / cutoff) + _SLACK) + 1).cast("int")


def pieces(name: Column, cutoff: float = CUTOFF) -> Column:
    """The pieces of a name: an array of (at, gram), ``at`` from 1. Cut-offs over 2/3 leave none empty."""
    length, k = F.length(name), pieces_of(F.length(name), cutoff)
    edge = lambda i: F.floor(i * length / k + _SLACK).cast("int")
    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct((edge(i) + 1).alias("at"), F.substring(name, edge(i) + 1, edge(i + 1) - edge(i)).alias("gram")))


def grams(candidate: Column, cutoff: float = CUTOFF) -> Column:
    """The distinct substrings of a candidate as long as a piece of some name within reach may be."""
    length = F.length(candidate)
    sizes = F.transform(lengths_within(length, cutoff), lambda n: F.floor(n / pieces_of(n, cutoff) + _SLACK).cast("int"))
    low, high = F.greatest(F.array_min(sizes), F.lit(1)), F.least(F.array_max(sizes) + 1, length)
    of_size = lambda n: F.transform(F.sequence(F.lit(1), length - n + 1), lambda i: F.substring(candidate, i, n))
    return F.when(low <= high, F.array_distinct(F.flatten(F.transform(F.sequence(low, high), of_size)))).otherwise(F.array().cast("array<string>"))
