"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import running_totals, stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("bigint")


class Mix(NamedTuple):
    plan: DataFrame
    entries: DataFrame


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2
) -> DataFrame:
    """``source, source_size, target, before``: one row per source, NULL included.

    Sources by code point, NULL last, take ``weights`` in turn and share ``share`` times all
    sizes. Nobody gets more than ``repeats`` times its own size; what exceeds that is shared
    again by weight. That ends at one level: the target is the smaller of the limit and level
    times weight, so sources sorted by limit / weight and running totals give it directly.
    ``before`` is the size of all earlier sources. Without any words every target is 0.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("last", F.col("source").isNull())
    ranked = running_totals(sums, ["last", "source"], place="1L", upto="source_size")
    turn = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", "place", (F.col("upto") - F.col("source_size")).alias("before"), turn.alias("weight")))
    whole = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total, weight_sum = whole["s"] or 0, whole["w"] or 0
    limit = F.lit(repeats) * F.col("source_size")
    ratios = ranked.select((limit / F.col("weight")).alias("ratio"), "place", limit.alias("cap"), "weight")
    filled = running_totals(ratios, ["ratio", "place"], caps="cap", weights="weight")
    level = (F.lit(share * total) - (F.col("caps") - F.col("cap"))) / (F.lit(weight_sum) - (F.col("weights") - F.col("weight")))
    first = filled.select(level.alias("level"), "ratio", "place").where("level <= ratio")
    found = first.agg(F.min_by("level", F.struct("ratio", "place"))).first()[0]
    target = limit.cast("double") if found is None else F.least(limit.cast("double"), F.lit(found) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"), "before")


def mix(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix",
) -> Mix:
    """What a mix of all documents takes, in the order it takes it.

    Every source runs through its shuffled documents ``repeats`` times. A document's virtual
    finish time is the size its source has used with it, divided by the source's target; the
    entries of all sources, range-sorted by it, are cut at the total budget, the sum of all
    targets: whoever is served early enough is taken, the one entry that crosses the budget in
    part. Finish times up to 1 always fit, so no source misses its target by more than its next
    entry, nor passes it by more than what the others' last entries left.

    plan: one row per input row: ``row`` (a unique number), ``doc_id, source, size,
    source_size, target, taken``. entries: ``row, doc_id, pass, finish, take, upto`` with the
    running total ``upto``, one row per (row, pass) that is taken. The shuffle is a hash of
    ``seed`` and id, so reruns agree; repeated ids are rows of their own; NULL sources are a
    source; empty documents take nothing; without rows both tables are empty.

    A source's running total is the running total of all rows sorted by (source, shuffle) less
    the sizes of earlier sources, so a source owning most rows is spread like any other.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffle"),
    )
    sized = stored(sized.withColumn("last", F.col("source").isNull()))
    targets = source_targets(sized, weights, share, repeats)
    # The hash of the whole row parts rows that share id and source.
    placed = running_totals(sized, ["last", "source", "shuffle", "doc_id", "size"], row="1L", upto="size")
    # One row per source. Adaptive execution broadcasts it below the session's size limit only.
    packed = placed.withColumn("__s", F.coalesce(F.col("source"), F.lit("\u0001")))
    named = targets.select(F.coalesce("source", F.lit("\u0001")).alias("__s"), F.col("source").isNull().alias("__n"),
                           "source_size", "target", "before")
    joined = packed.join(named, (packed["__s"] == named["__s"]) & (packed["last"] == named["__n"]))
    plan = stored(joined.select("row", "doc_id", "source", "size", "source_size", "target",
                                (F.col("upto") - F.col("before") - F.col("size")).alias("start")))
    passes = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    entries = plan.where("size > 0").select("*", passes.alias("pass"))
    finish = (F.col("pass") * F.col("source_size") + F.col("start") + F.col("size")) / F.col("target")
    entries = entries.select("row", "doc_id", "pass", finish.alias("finish"), F.col("size").alias("take"))
    budget = targets.agg(F.sum(F.round("target").cast("bigint"))).first()[0] or 0
    queue = running_totals(entries, ["finish", "row", "pass"], upto="take")
    before = F.col("upto") - F.col("take")
    queue = queue.where(before < budget).withColumn("take", F.least("take", budget - before)).withColumn("upto", F.least("upto", F.lit(budget)))
    taken = queue.groupBy("row").agg(F.sum("take").alias("taken"))
    out = plan.join(taken, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    return Mix(out, queue)
