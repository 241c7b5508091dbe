"""Scans of hand-made and older inputs: JSON records and dimensions with faults, evolving snapshots."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.ranges import numbered
from leadloom.session import stored

_CORRUPT = "_corrupt"


class Scan(NamedTuple):
    """``rows`` that could be read, and ``errors``: ``url`` (the file), ``error_type``, ``record``."""

    rows: DataFrame
    errors: DataFrame


def scan_records(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> Scan:
    """JSON records, one per line or (``multi_line``) arrays of them in whole files.

    A record that is no JSON, or whose values do not fit the schema, becomes an error row with
    its text; the other records of its file are read all the same (text after a record's end on its line is
    passed over). With ``multi_line`` a file whose
    JSON is broken is one such record. A file is one task there, so keep those small.
    """
    read = spark.read.schema(f"{schema}, {_CORRUPT} STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    # Parsed once and stored: rows and errors are two views of it.
    found = stored(read.option("multiLine", multi_line).json(path).withColumn("url", F.col("_metadata.file_path")))
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    bad = found.where(F.col(_CORRUPT).isNotNull())
    errors = bad.select("url", F.lit("MalformedRecord").alias("error_type"), F.col(_CORRUPT).alias("record"))
    return Scan(found.where(F.col(_CORRUPT).isNull()).select(*names), errors)


DIMENSION = "slug STRING, labels MAP<STRING, STRING>, code STRING"


def scan_dimension(spark: SparkSession, path: str) -> Scan:
    """Categories or cities as JSON lines: ``slug``, its ``labels`` by site as a map, and a site's ``code``.

    Entries without a slug are errors as well.
    """
    found = scan_records(spark, path, DIMENSION)
    unnamed = found.rows.where(F.coalesce(F.trim("slug"), F.lit("")) == "")
    more = unnamed.select(F.lit(None).cast("string").alias("url"), F.lit("MissingSlug").alias("error_type"), F.to_json(F.struct(*unnamed.columns)).alias("record"))
    return Scan(found.rows.where(F.coalesce(F.trim("slug"), F.lit("")) != ""), found.errors.unionByName(more))


def scan_snapshots(
    spark: SparkSession, paths: list[str], columns: dict[str, list[str]],
) -> DataFrame:
    """Several parquet snapshots of a legacy table as one, in order of arrival.

    ``columns`` gives each wanted text column with the names it has had; the first of them a snapshot
    holds a value under counts, and a snapshot without any of them gives NULL. ``seq`` numbers rows by snapshot, then
    file, then place in the file.
    """
    parts = []
    for k, path in enumerate(paths):
        one = spark.read.parquet(path)
        have = set(one.columns)
        value = lambda names: F.coalesce(*[F.col(n).cast("string") for n in names if n in have], F.lit(None).cast("string"))  # noqa: B023, E731
        parts.append(one.select(
            F.lit("all").alias("table"), F.lit(k).alias("snapshot"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
            *[value(names).alias(c) for c, names in columns.items()]))
    whole = reduce(DataFrame.unionByName, parts)
    placed = numbered(whole, "table", ["snapshot", "file", "row"], "place")
    place: Column = F.col("place") - 1
    return placed.select(place.alias("seq"), "snapshot", *columns)
