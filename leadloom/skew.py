"""Joining rows back to a per-key summary when single keys can be huge.

A summary (winner per key, cutoff per target, ...) is the result of an aggregation, so its
side of the join is not a plain exchange and adaptive skew-join splitting does not apply.
Hot keys are therefore handled explicitly. A key is hot when it owns more than ``hot_rows``
rows, hence at most ``total_rows / hot_rows`` keys are hot, whatever the data looks like:
that is the bound that makes broadcasting the hot part safe. Everything else takes the
ordinary shuffle join. Rows are read once: those that found their hot key go through the
shuffle under an artificial key that spreads them evenly and matches nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def attach(
    rows: DataFrame,
    summary: DataFrame,
    keys: list[str],
    weight: str,
    hot_rows: int = HOT_ROWS,
    on: Column | None = None,
    fanout: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join of ``rows`` and ``summary``; ``weight`` counts the rows of a summary key.

    ``how``: "inner" drops rows without a summary, rows with a NULL key among them; "left" keeps
    them with NULL summary columns.

    The first key must be text, and rows need a distinguishing column (``seq``). A summary
    may hold several rows per key, each carrying the key's weight; ``on`` then picks among
    them and ``fanout`` names the column with their number. A key must outweigh the limit by
    that factor to be hot, which keeps the bound on broadcast rows.
    """
    values = [c for c in summary.columns if c not in keys and c not in (weight, fanout)]
    packed = summary.select(*keys, weight, F.struct(*values).alias("s"), *([fanout] if fanout else []))
    limit = F.lit(hot_rows) * F.col(fanout) if fanout else F.lit(hot_rows)
    side = lambda cond, tag: packed.where(cond).select(
        *[F.col(k).alias(f"__{tag}_{k}") for k in keys], F.col("s").alias(f"__{tag}")
    )
    hot = F.broadcast(side(F.col(weight) > limit, "hot"))
    cold = side(F.col(weight) <= limit, "cold")

    equal = lambda tag, ks: [F.col(k) == F.col(f"__{tag}_{k}") for k in ks]
    with_hot = rows.join(hot, reduce(Column.__and__, equal("hot", keys)), "left")
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    settled = F.col("__hot").isNotNull() | missing
    spread = F.concat(F.lit("\u0001"), F.xxhash64(*rows.columns).cast("string"))
    probe = F.when(settled, spread).otherwise(F.col(keys[0]))
    cold_match = reduce(
        Column.__and__, [probe == F.col(f"__cold_{keys[0]}"), *equal("cold", keys[1:])]
    )
    joined = with_hot.join(cold, cold_match, "left")
    found = joined.withColumn("__s", F.coalesce("__hot", "__cold"))
    if how == "inner":
        found = found.where(F.col("__s").isNotNull())
    out = found.select(*rows.columns, "__s.*")
    return out if on is None else out.where(on)
