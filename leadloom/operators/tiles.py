"""Similarity join of names for low thresholds: prefix blocks cut into equal tiles.

Under about 70 the segments of :mod:`leadloom.operators.similar` shrink to nothing, so names of a block have
to be compared. Each side of a block is put in order of length and cut into strips of equal size;
a pair of strips is one unit of work, whatever the block's share of all rows, and strips whose lengths
cannot reach the threshold never meet. Inside a tile, counts of characters bound the common
subsequence, and only pairs within that bound are scored.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.similarity import indel_ratios
from leadloom.ranges import numbered
from leadloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRIP = 1000
# Cells of the character table compared at once inside a tile.
_CELLS = 4_000_000


def _strips(names: DataFrame, form: str, norm: str, rows: int) -> DataFrame:
    placed = numbered(names.withColumn("size", F.length(form)), "block", ["size", form, norm], "place")
    return stored(placed.withColumn("strip", F.floor((F.col("place") - 1) / F.lit(rows)).cast("bigint")).drop("place"))


def _reachable(t: float) -> Column:
    """Whether two ranges of lengths hold a pair that can reach the threshold."""
    enough = lambda short, long: 200 * F.col(short) + F.lit(1e-9) >= t * (F.col(short) + F.col(long))
    apart = (F.col("hi") < F.col("lo2")) & ~enough("hi", "lo2") | (F.col("hi2") < F.col("lo")) & ~enough("hi2", "lo")
    return ~apart


def _counts(texts: list[str], alphabet: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(texts), max(1, len(alphabet))), np.int16)
    for i, text in enumerate(texts):
        for ch in text:
            j = alphabet.get(ch)
            if j is not None:
                out[i, j] += 1
    return out


def compare_tile(left: pd.DataFrame, right: pd.DataFrame, t: float) -> pd.DataFrame:
    """Pairs of two strips scoring at least ``t``, with their scores."""
    a, b = left["in_form"].tolist(), right["cand_form"].tolist()
    alphabet = {ch: j for j, ch in enumerate(sorted(set("".join(a))))}
    ca, cb = _counts(a, alphabet), _counts(b, alphabet)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    found = []
    step = max(1, _CELLS // max(1, cb.size))
    for start in range(0, len(a), step):
        rows = slice(start, start + step)
        common = np.minimum(ca[rows, None, :], cb[None, :, :]).sum(2, dtype=np.int64)
        total = la[rows, None] + lb[None, :]
        i, j = np.nonzero((200 * common + 1e-9 >= t * total) | (total == 0))
        i = i + start
        score = indel_ratios(left["in_form"].iloc[i], right["cand_form"].iloc[j]).to_numpy()
        keep = score >= t
        i, j = i[keep], j[keep]
        found.append(pd.DataFrame({
            "in_form": left["in_form"].to_numpy()[i], "in_norm": left["in_norm"].to_numpy()[i],
            "cand_form": right["cand_form"].to_numpy()[j], "cand_norm": right["cand_norm"].to_numpy()[j], "score": score[keep]}))
    return pd.concat(found)


def tiled_names(incoming: DataFrame, candidates: DataFrame, threshold: float, prefix: int, strip: int = STRIP) -> DataFrame:
    """All (incoming, candidate) pairs of a prefix block scoring at least ``threshold`` (over 0).

    The work of a block grows with the product of its sides, which no bound on the score prevents at
    low thresholds; it is spread over tiles of at most ``strip`` by ``strip`` names.
    """
    t = float(threshold)
    incoming = incoming.withColumn("block", F.substring("in_norm", 1, prefix))
    # At most prefix + 1 lengths of block keys.
    lengths = sorted(r[0] for r in incoming.select(F.length("block").alias("n")).distinct().collect())
    keys = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("cand_norm"))
    blocks = F.explode(F.transform(keys, lambda n: F.substring("cand_norm", F.lit(1), n)))
    left = _strips(incoming, "in_form", "in_norm", strip)
    right = _strips(candidates.withColumn("block", blocks), "cand_form", "cand_norm", strip).withColumnRenamed("strip", "strip2")
    ends = lambda side, s, lo, hi: side.groupBy("block", s).agg(F.min("size").alias(lo), F.max("size").alias(hi))
    # One row per strip on either side.
    tiles = ends(left, "strip", "lo", "hi").join(ends(right, "strip2", "lo2", "hi2"), "block").where(_reachable(t))
    tiles = stored(tiles.select("block", "strip", "strip2"))
    unit = ["block", "strip", "strip2"]
    ours = left.join(tiles, ["block", "strip"]).select(*unit, "in_form", "in_norm")
    theirs = right.join(tiles, ["block", "strip2"]).select(*unit, "cand_form", "cand_norm")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return compare_tile(a, b, t)

    return ours.groupBy(*unit).cogroup(theirs.groupBy(*unit)).applyInPandas(
        run, "in_form string, in_norm string, cand_form string, cand_norm string, score double")
