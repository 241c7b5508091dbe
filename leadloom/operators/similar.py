"""Exact similarity join of company-name forms without comparing whole blocks.

Two forms match when 200 * LCS / (len a + len b) >= t, i.e. when at most
D = (len a + len b) * (100 - t) / 100 single-character insertions and deletions separate
them. Cut the candidate into D + 1 segments: D edits cannot touch all of them, so at least
one segment occurs unchanged in the other form, near its old place (the segment scheme of
Pass-Join, PVLDB 2011, with insert/delete distance). Counting edits from the left, there is
always an intact segment i with exactly i edits before it, so its offset lies in
{-i, -i+2, ..., i} and at most D - i edits remain to its right. Those few (length, segment,
offset) probes are an ordinary equi-join key; only pairs meeting there are scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.similarity import indel_ratio
from leadloom.operators.tiles import tiled_names

PREFIX = 3
MIN_THRESHOLD = 70
_EPS = 1e-9


def _whole(c: Column) -> Column:
    return F.floor(c + F.lit(_EPS)).cast("int")


def _segments(length: Column, t: float) -> Column:
    """Number of segments of a candidate: one more than the edits any partner allows."""
    return _whole(length * F.lit(2 * (100 - t) / t)) + 1


def _segment_len(length: Column, n: Column, i: Column) -> Column:
    base, extra = F.floor(length / n).cast("int"), length % n
    return base + F.when(i >= n - extra, 1).otherwise(0)


def _segment_start(length: Column, n: Column, i: Column) -> Column:
    base, extra = F.floor(length / n).cast("int"), length % n
    return i * base + F.greatest(F.lit(0), i - (n - extra))


def _index(candidates: DataFrame, t: float) -> DataFrame:
    """One row per segment of every candidate form."""
    c = candidates.withColumn("lb", F.length("cand_form"))
    c = c.withColumn("n", _segments(F.col("lb"), t))
    c = c.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    lb, n, i = F.col("lb"), F.col("n"), F.col("i")
    text = F.substring("cand_form", _segment_start(lb, n, i) + 1, _segment_len(lb, n, i))
    return c.select("cand_form", "cand_norm", F.struct("lb", "i", text.alias("text")).alias("seg"))


def _probes(incoming: DataFrame, t: float) -> DataFrame:
    """Every place where a segment of a matching candidate may sit in the incoming form."""
    p = incoming.withColumn("la", F.length("in_form"))
    la = F.col("la")
    shortest = F.ceil(la * F.lit(t / (200 - t)) - F.lit(_EPS)).cast("int")
    longest = _whole(la * F.lit((200 - t) / t))
    p = p.withColumn("lb", F.explode(F.sequence(shortest, longest)))
    lb = F.col("lb")
    budget = _whole((la + lb) * F.lit((100 - t) / 100))
    # Insertions and deletions change the length difference one by one: equal parity.
    budget = budget - F.pmod(budget + la + lb, F.lit(2))
    p = p.withColumn("d", budget).where(F.col("d") >= F.abs(la - lb))
    p = p.withColumn("n", _segments(lb, t))
    p = p.withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.least(F.col("d"), F.col("n") - 1)))
    )
    i = F.col("i")
    p = p.withColumn("shift", F.explode(F.sequence(-i, i, F.lit(2))))
    size = _segment_len(lb, F.col("n"), i)
    at = _segment_start(lb, F.col("n"), i) + F.col("shift")
    fits = (F.abs(la - lb - F.col("shift")) <= F.col("d") - i) & (at >= 0) & (at + size <= la)
    return p.where(fits).select(
        "in_form", "in_norm",
        F.struct("lb", "i", F.substring("in_form", at + 1, size).alias("text")).alias("seg"),
    )


def name_prefix(norm: Column) -> Column:
    """Blocking prefix: first three characters, the whole name when shorter."""
    return F.substring(norm, 1, PREFIX)


def _within_edits(t: float) -> Column:
    """Necessary condition checked where pairs meet, before anything is shuffled or scored.

    An insertion or deletion is one edit, so a pair over the budget in (banded, JVM-side)
    edit distance cannot reach the threshold. Names sharing a long common part stop here.
    """
    total = F.length("in_form") + F.length("cand_form")
    budget = _whole(total * F.lit((100 - t) / 100))
    return F.call_function("levenshtein", F.col("in_form"), F.col("cand_form"), budget) >= 0


def _spread(names: DataFrame, column: str) -> DataFrame:
    """Names in full parallelism. They are small but every row explodes into many, so the
    size-based merging of shuffle partitions would leave the work to a few tasks."""
    spark = names.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return names.repartition(max(wanted, spark.sparkContext.defaultParallelism), column)


def similar_names(incoming: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """All (incoming, candidate) name pairs in the same prefix block scoring >= threshold.

    incoming: ``in_form, in_norm``; candidates: ``cand_form, cand_norm``; both distinct.
    The block rule is directed: the candidate's identity form starts with the incoming one's
    first three characters (or with all of it when shorter; an empty one fits everything).
    """
    if not 0 < threshold <= 100:
        raise ValueError("threshold must lie over 0 and up to 100")
    if threshold < MIN_THRESHOLD:
        # Segments shrink to nothing: blocks are compared in tiles.
        return tiled_names(incoming, candidates, threshold, PREFIX)
    t = float(threshold)
    incoming, candidates = _spread(incoming, "in_form"), _spread(candidates, "cand_form")
    signed, index = probes(incoming, t), segment_index(candidates, t)
    # Both sides carry whether the key holds a prefix; each kind is one join.
    pairs = [signed.where(side).join(index.where(side), "sig") for side in ("blocked", "NOT blocked")]
    drop = lambda df: df.select("in_form", "in_norm", "cand_form", "cand_norm")
    return _scored(drop(pairs[0]).unionByName(drop(pairs[1])), t)


def _signature(seg: Column, *more: Column) -> Column:
    return F.xxhash64(*more, seg["lb"], seg["i"], seg["text"])


def segment_index(candidates: DataFrame, t: float) -> DataFrame:
    """``sig, blocked, cand_form, cand_norm``: where names sharing a segment meet.

    Blocked signatures hold the name's prefix and serve incoming names that have a whole one; the others
    serve shorter names, which fit any candidate starting like them. An index made for ``t`` serves every
    threshold from ``t`` upwards.
    """
    index = _index(candidates, t)
    blocked = index.where(F.length("cand_norm") >= PREFIX).select(
        _signature(F.col("seg"), name_prefix(F.col("cand_norm"))).alias("sig"), F.lit(True).alias("blocked"), "cand_form", "cand_norm")
    return blocked.unionByName(index.select(_signature(F.col("seg")).alias("sig"), F.lit(False).alias("blocked"), "cand_form", "cand_norm"))


def probes(incoming: DataFrame, t: float) -> DataFrame:
    """``sig, blocked, in_form, in_norm``: what an incoming name looks for in an index made for ``t``."""
    is_long = F.length("in_norm") >= PREFIX
    seg = F.col("seg")
    whole = _probes(incoming.where(is_long), t).select(
        _signature(seg, name_prefix(F.col("in_norm"))).alias("sig"), F.lit(True).alias("blocked"), "in_form", "in_norm")
    return whole.unionByName(
        _probes(incoming.where(~is_long), t).select(_signature(seg).alias("sig"), F.lit(False).alias("blocked"), "in_form", "in_norm"))


def _scored(met: DataFrame, t: float) -> DataFrame:
    """Pairs that met, verified: same block, within the edits, scoring at least ``t``."""
    prefix = name_prefix(F.col("in_norm"))
    pairs = met.where(F.col("cand_norm").startswith(prefix) & _within_edits(t)).distinct()
    return pairs.withColumn("score", indel_ratio("in_form", "cand_form")).where(F.col("score") >= F.lit(t))


def indexed_names(incoming: DataFrame, index: DataFrame, made_for: float, threshold: float) -> DataFrame:
    """:func:`similar_names` against a stored :func:`segment_index` made for a threshold not over this one."""
    if not MIN_THRESHOLD <= made_for <= threshold <= 100:
        raise ValueError(f"an index made for {made_for} does not serve {threshold}")
    wanted = probes(_spread(incoming, "in_form"), float(made_for))
    met = wanted.join(index, ["sig", "blocked"]).select("in_form", "in_norm", "cand_form", "cand_norm")
    return _scored(met, float(threshold))
