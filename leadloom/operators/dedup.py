"""Duplicate handling: keeper selection with audit rows, idempotent append, fill-first merge.

All of them aggregate narrow rows per key first (partial aggregation on the map side), never rank
a whole key group inside one task, so a key owning a third of the rows costs one combined row
per map task.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import skew
from leadloom.functions.text import digits_only, not_blank, present
from leadloom.functions.urls import source_name
from leadloom.operators.leads import as_of_column, enrichment_count


class Dedup(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def deduplicate(
    leads: DataFrame, as_of: datetime | str | Column, hot_rows: int = skew.HOT_ROWS
) -> Dedup:
    """Best lead per key: richer first, then the smaller name, then the earlier one; the others
    become audit rows. Blank keys pass through.

    Only the ranking columns are aggregated; the one summary row per repeated key then meets the
    rows once, for both outputs, and rows without a key are spread.
    """
    keyed = leads.withColumn("__key", F.when(not_blank("dedup_key"), F.col("dedup_key")))
    order = F.struct((-enrichment_count()).alias("poorer"), "company_name", "seq")
    keepers = (
        keyed.where("__key IS NOT NULL").groupBy("__key")
        .agg(F.min(order).alias("w"), F.count("*").alias("group_rows"))
        .where("group_rows > 1")
        .select(
            "__key",
            F.col("w.company_name").alias("__kept_company"),
            F.col("w.seq").alias("__kept_seq"),
            (-F.col("w.poorer")).alias("__kept_fields"),
            "group_rows",
        )
    )
    judged = skew.attach(keyed, keepers, ["__key"], "group_rows", hot_rows, how="left")
    kept = judged.where(F.col("__kept_seq").isNull() | (F.col("seq") == F.col("__kept_seq")))
    fields, best = enrichment_count(), F.col("__kept_fields")
    reason = F.when(
        fields < best, F.format_string("Fewer enrichment fields (%d vs %d)", fields, best)
    ).otherwise(F.format_string("Tied at %d enrichment fields, rejected alphabetically", fields))
    rejected = judged.where(F.col("seq") != F.col("__kept_seq")).select(
        "dedup_key",
        F.col("__kept_company").alias("kept_company"),
        F.col("company_name").alias("rejected_company"),
        reason.alias("reason"),
        as_of_column(as_of).alias("timestamp"),
    )
    return Dedup(kept.select(*leads.columns), rejected)


def _first_per_group(rows: DataFrame, has_key: Column, key: str, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Earliest row per key; rows without a key all stay."""
    keyed = rows.withColumn("__key", F.when(has_key, F.col(key)))
    firsts = (
        keyed.where("__key IS NOT NULL").groupBy("__key")
        .agg(F.min("seq").alias("__first"), F.count("*").alias("group_rows")).where("group_rows > 1")
    )
    judged = skew.attach(keyed, firsts, ["__key"], "group_rows", hot_rows, how="left")
    return judged.where(F.col("__first").isNull() | (F.col("seq") == F.col("__first"))).select(*rows.columns)


def existing_keys(*tables: DataFrame, key_col: str = "dedup_key") -> DataFrame:
    """Distinct non-empty keys of one or more tables."""
    keys = [t.select(F.col(key_col).alias("dedup_key")).where(present("dedup_key")) for t in tables]
    return reduce(DataFrame.unionByName, keys).distinct()


def filter_new_rows(rows: DataFrame, existing: DataFrame, key_col: str = "dedup_key") -> DataFrame:
    """Rows whose key is not stored yet; within the batch the earliest row of a key wins.

    Rows without a key always pass. ``existing`` has one column ``dedup_key``.
    """
    has_key = present(key_col)
    first = _first_per_group(rows, has_key, key_col)
    # A keyless row gets a join value no stored key has, so blanks do not pile up in one task.
    probe = F.when(has_key, F.col(key_col)).otherwise(
        F.concat(F.lit("\u0001"), F.col("seq").cast("string"))
    )
    stored = existing.select(F.col("dedup_key").alias("__stored"))
    return first.join(stored, probe == F.col("__stored"), "left_anti")


def fill_first(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """One row per key: every field is its first non-empty value in input order.

    Empty means NULL, '' or a numeric zero.
    """
    def filled(name: str, dtype: str) -> Column:
        if dtype == "string":
            return present(name)
        if dtype in ("int", "bigint", "double", "float"):
            return F.coalesce(F.col(name) != 0, F.lit(False))
        return F.col(name).isNotNull()

    firsts = [
        F.min_by(n, F.when(filled(n, t), F.col(order))).alias(n)
        for n, t in rows.dtypes
        if n not in (key, order)
    ]
    return rows.groupBy(key).agg(*firsts, F.min(order).alias(order))


def multi_source_groups(records: DataFrame) -> DataFrame:
    """Phone groups (last ten digits) listed by at least two directories.

    The collected set is bounded by the number of known directories.
    """
    digits = digits_only(F.coalesce(F.col("phone"), F.lit("")))
    return (
        records.where(F.length(digits) >= 10)
        .select(F.right(digits, F.lit(10)).alias("phone10"), source_name("source_url").alias("source"))
        .where(F.col("source").isNotNull())
        .groupBy("phone10")
        .agg(F.array_sort(F.collect_set("source")).alias("sources"))
        .where(F.size("sources") >= 2)
    )
