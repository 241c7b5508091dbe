"""Token-sort similarity of company names: 200 * LCS / (len a + len b) on sorted tokens."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship the UDF with its helpers, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = 64


def _code_points(texts: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(texts), width), pad, dtype=np.int32)
    for i, t in enumerate(texts):
        if t:
            out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.int32)
    return out


def _lcs_words(a: list[str], b: list[str]) -> np.ndarray:
    """LCS lengths of many pairs at once, one 64-bit word per pair (``a`` up to 64 long)."""
    left = _code_points(a, _WORD, -1)
    right = _code_points(b, max(1, max(map(len, b))), -2)
    row = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(right.shape[1]):
        same = np.packbits(left == right[:, j : j + 1], axis=1, bitorder="little")
        match = row & same.view(np.uint64).ravel()
        row = (row + match) | (row - match)
    used = np.packbits(left >= 0, axis=1, bitorder="little").view(np.uint64).ravel()
    return np.bitwise_count(~row & used).astype(np.int64)


def _lcs_long(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        match = row & masks.get(ch, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def indel_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity 0..100 per pair; two empty strings are identical."""
    left, right = a.tolist(), b.tolist()
    la = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    lb = np.fromiter(map(len, right), dtype=np.int64, count=len(right))
    lcs = np.zeros(len(left), dtype=np.int64)
    short = np.flatnonzero((la <= _WORD) & (lb <= 4 * _WORD))
    for chunk in np.array_split(short, max(1, len(short) // 4096)):
        if len(chunk):
            lcs[chunk] = _lcs_words([left[i] for i in chunk], [right[i] for i in chunk])
    for i in np.flatnonzero((la > _WORD) | (lb > 4 * _WORD)):
        lcs[i] = _lcs_long(left[i], right[i])
    total = la + lb
    score = 200.0 * lcs / np.maximum(total, 1)
    return pd.Series(np.where(total == 0, 100.0, score))


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Score of two token-sorted forms. Arrow batches in, vectorized bit-parallel LCS."""
    return indel_ratios(a, b)
