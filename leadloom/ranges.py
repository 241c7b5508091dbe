"""Places and running counts along ordered groups when single groups can be huge.

A window over a group runs in one task. Here rows are dealt by ranges of (group, order) instead: each
range counts its own part of a group, and only the first group of a range can have begun in an
earlier one, so what a range needs from the others is one number. Those numbers, one row per range
and edge group, are the only thing that meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.session import stored


def running_sum(df: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over the rows of the group up to and including this one.

    Rows that tie in ``order`` must carry the same values. Ranges are stored before they are used,
    so a retried task sees the same ranges.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    dealt = stored(df.withColumn("__v", value.cast("bigint")).repartitionByRange(ranges, group, *order).withColumn("__r", F.spark_partition_id()))
    sums = dealt.groupBy("__r", group).agg(F.sum("__v").alias("__sum"))
    place = F.struct(F.col(group).alias("g"), F.col("__sum"))
    edges = sums.groupBy("__r").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # The last group of a range may go on; the first one may have begun before.
    asks = F.array(F.struct(F.col("last.g").alias("g"), F.col("last.__sum").alias("s")))
    other = F.array(F.struct(F.col("first.g").alias("g"), F.lit(0).cast("bigint").alias("s")))
    asks = F.when(F.col("first.g").eqNullSafe(F.col("last.g")), asks).otherwise(F.concat(asks, other))
    before = W.partitionBy("g").orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    starts = edges.select("__r", F.inline(asks)).select(
        F.col("__r").alias("__at"), F.col("g").alias("__g"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("__from"))
    own = F.sum("__v").over(W.partitionBy("__r", group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    here = (F.col("__r") == F.col("__at")) & F.col(group).eqNullSafe(F.col("__g"))
    # Two rows per range at most, whatever the input: safe to broadcast.
    joined = dealt.join(F.broadcast(starts), here, "left")
    return joined.select(*df.columns, (F.coalesce("__from", F.lit(0)) + own).alias(name))


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Place of every row in its group, from 1."""
    return running_sum(df, group, order, F.lit(1), name)
