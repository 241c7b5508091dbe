"""Running values along ordered groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.llm.shared import stored

# Alike rows are numbered together and told apart afterwards, this many at a time.
COPIES = 4096
_FOLD = {"sum": F.sum, "xor": F.bit_xor}


def running(df: DataFrame, group: list[str], order: list[str], **values: tuple[str, Column]) -> DataFrame:
    """``df`` with ``name=(fold, value)``: the fold of ``value`` along its group up to and including the row.

    ``fold`` is "sum" or "xor" of a bigint. Rows ascend by ``order`` (NULL first); rows that tie there must
    be alike. A group may hold any share of the rows: rows are dealt by ranges of (group, order) and
    stored, each range folds its own part of a group, and a group that goes on in a later range gets
    there what its earlier ranges held. Only two groups of a range can go on, its first and its last,
    so that list has two rows per range at most and is broadcast.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = {f"__v_{n}": v for n, (_, v) in values.items()}
    dealt = df.withColumns(inner).repartitionByRange(parts, *group, *order).withColumn("__part", F.spark_partition_id())
    kept = stored(dealt)
    fold = lambda n, c: _FOLD[values[n][0]](c)
    totals = F.struct(*[F.col(f"__t_{n}") for n in values])
    each = kept.groupBy("__part", F.struct(*group).alias("__g")).agg(*[fold(n, f"__v_{n}").alias(f"__t_{n}") for n in values])
    # One row per range from here on.
    edges = each.groupBy("__part").agg(F.min("__g").alias("first"), F.max(F.struct("__g", totals.alias("t"))).alias("last"))
    none = F.struct(*[F.lit(0).cast("bigint").alias(f"__t_{n}") for n in values])
    ends = F.when(F.col("first") == F.col("last.__g"), F.array(F.struct(F.col("last.__g").alias("g"), F.col("last.t").alias("t"))))
    ends = ends.otherwise(F.array(F.struct(F.col("last.__g").alias("g"), F.col("last.t").alias("t")), F.struct(F.col("first").alias("g"), none.alias("t"))))
    earlier = W.partitionBy("g").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = edges.select("__part", F.inline(ends)).select(
        F.col("__part").alias("__at"), F.col("g").alias("__of"),
        *[F.coalesce(fold(n, f"t.__t_{n}").over(earlier), F.lit(0).cast("bigint")).alias(f"__s_{n}") for n in values])
    same = (F.col("__part") == F.col("__at")) & F.struct(*group).eqNullSafe(F.col("__of"))
    inside = W.partitionBy("__part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)

    def total(n: str) -> Column:
        start, own = F.coalesce(f"__s_{n}", F.lit(0).cast("bigint")), fold(n, f"__v_{n}").over(inside)
        return (start + own if values[n][0] == "sum" else start.bitwiseXOR(own)).alias(n)

    return kept.join(F.broadcast(starts), same, "left").select(*df.columns, *map(total, values))


def ranked(leaves: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with ``r``, their place from 0 in the order of their group; fully alike rows in any order.

    Alike rows are counted before they are dealt by order, so that no number of copies meets.
    """
    names = leaves.columns
    counted = leaves.groupBy(*names).agg(F.count("*").alias("__n"))
    placed = running(counted, group, order, __upto=("sum", F.col("__n")))
    first, last = F.col("__upto") - F.col("__n"), F.col("__upto") - 1
    chunks = placed.select(*names, F.explode(F.sequence(first, last, F.lit(COPIES))).alias("__from"), last.alias("__last"))
    each = F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + COPIES - 1, "__last")))
    return chunks.select(*names, each.alias("r"))
