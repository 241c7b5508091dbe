"""Property graph of legacy lead rows: companies plus six edge tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.names import (
    industry_code,
    legacy_address,
    legacy_emails,
    legacy_key,
    legacy_phones,
)
from leadloom.functions.text import blank_to_null, first_present
from leadloom.functions.urls import source_label
from leadloom.operators.dedup import fill_first


class LegacyGraph(NamedTuple):
    companies: DataFrame
    has_phone: DataFrame
    has_email: DataFrame
    has_website: DataFrame
    located_in: DataFrame
    belongs_to: DataFrame
    sourced_from: DataFrame
    industries: DataFrame


def _first_of(columns: list[str], *names: str) -> Column:
    there = [n for n in names if n in columns]
    return first_present(*there) if there else F.lit(None).cast("string")


def build_legacy_graph(rows: DataFrame) -> LegacyGraph:
    """Merge rows by the folded key (first non-empty value per field), then derive edges."""
    keyed = rows.withColumn("legacy_key", legacy_key("company_name", "website"))
    merged = fill_first(keyed, "legacy_key")
    cols = merged.columns
    url = _first_of(cols, "source_url", "url")
    industry = blank_to_null(_first_of(cols, "industry", "category"))
    mail_cols = [c for c in ("email", "raw_email") if c in cols]
    wide = merged.select(
        F.col("legacy_key").alias("dedup_key"),
        "seq",
        F.coalesce(blank_to_null("company_name"), F.lit("Unknown")).alias("company_name"),
        blank_to_null("website").alias("website"),
        legacy_address(*[c for c in ("address", "locality", "city") if c in cols]).alias("address"),
        (blank_to_null("city") if "city" in cols else F.lit(None).cast("string")).alias("city"),
        industry.alias("industry"),
        industry_code(industry).alias("industry_code"),
        blank_to_null(url).alias("source_url"),
        legacy_phones(cols).alias("phones"),
        legacy_emails(*mail_cols).alias("emails"),
        source_label(url, "migrate").alias("source"),
    )
    edge = lambda value, name: (
        wide.select("dedup_key", value.alias(name)).where(F.col(name).isNotNull()).distinct()
    )
    known = F.when(F.col("source") != "Unknown", F.col("source"))
    industries = (
        wide.where(F.col("industry_code").isNotNull())
        .groupBy(F.col("industry_code").alias("code"))
        .agg(F.min_by("industry", "seq").alias("name"))
    )
    return LegacyGraph(
        wide.select("dedup_key", "company_name", "website", "address", "industry_code", "source_url"),
        edge(F.explode("phones"), "phone"),
        edge(F.explode("emails"), "email"),
        edge(F.col("website"), "website"),
        edge(F.col("city"), "city"),
        edge(F.col("industry_code"), "code"),
        edge(known, "source"),
        industries,
    )
