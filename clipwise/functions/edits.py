"""Edit distance over words, and dynamic time warping: Arrow-batched NumPy, as no built-in has them."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_PUNCT = re.compile(r"[^\w\s']")


def words(s: str | None) -> list[str]:
    return _PUNCT.sub("", (s or "").lower()).split()


def distance(a: list, b: list) -> int:
    """Edits that turn one sequence into the other; a row of the table at a time."""
    if not a or not b:
        return len(a) or len(b)
    names = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    y = np.array([names[x] for x in b])
    steps = np.arange(len(y) + 1)
    row = steps.copy()
    for x in (names[x] for x in a):
        best = np.minimum(row[1:] + 1, row[:-1] + (y != x))
        best = np.concatenate([[row[0] + 1], best])
        row = np.minimum.accumulate(best - steps) + steps  # insertions
    return int(row[-1])


@pandas_udf(DoubleType())
def wer(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    """Word error rate; 1 for an empty reference or a blank hypothesis; it may exceed 1."""
    out = []
    for r, h in zip(map(words, reference), map(words, hypothesis), strict=True):
        out.append(distance(r, h) / len(r) if r and h else 1.0)
    return pd.Series(out)


def dtw(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The warping path of two sequences of vectors (rows) with least total Euclidean distance."""
    cost = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    n, m = cost.shape
    total = np.full((n + 1, m + 1), np.inf)
    total[0, 0] = 0
    for d in range(2, n + m + 1):  # an anti-diagonal at a time: its cells depend on the two before it
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        total[i, j] = cost[i - 1, j - 1] + np.minimum(np.minimum(total[i - 1, j], total[i - 1, j - 1]), total[i, j - 1])
    path, i, j = [], n, m
    while i and j:
        path.append((i - 1, j - 1))
        i, j = min(((i - 1, j - 1), (i - 1, j), (i, j - 1)), key=lambda p: total[p])
    return path[::-1]
