"""Intermediate tables in the folder all executors share, and distributed running totals."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.session import ensure_checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    The files outlive executors, cut the lineage, and are pruned by column when read again.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, order: list[str | Column], **values: str | Column) -> DataFrame:
    """``df`` with, for each ``name=value``, the total of ``value`` up to and including the row.

    Rows are range-partitioned by ``order`` (which must not tie, or ties must be alike), stored,
    summed per partition, and every partition adds the totals of those before it. Only one row
    per partition meets in one place; no group of rows does, whatever its key.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    kept = stored(ranged.select("*", *[F.expr(v).alias(f"__{n}") if isinstance(v, str) else v.alias(f"__{n}")
                                       for n, v in values.items()]))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = kept.groupBy("__part").agg(*[F.sum(f"__{n}").alias(f"__sum_{n}") for n in values])
    starts = starts.select("__part", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__from_{n}")
                                       for n in values])
    inside = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # One row per partition of the range sort: a few thousand at most, so it may be broadcast.
    out = kept.join(F.broadcast(starts), "__part")
    return out.select(*df.columns, *[(F.col(f"__from_{n}") + F.sum(f"__{n}").over(inside)).alias(n) for n in values])
