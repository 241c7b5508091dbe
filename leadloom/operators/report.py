"""Fill rates, KPI cards, source counts, dashboard search and sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import empty_to_null, present
from leadloom.functions.urls import source_label

DASHBOARD_COLUMNS = [
    "company_name", "website", "email", "phone", "address", "industry_code", "dedup_key",
    "source_url",
]


def fill_rates(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Per site: records and how many carry phone/email/website; idle enabled targets are 0."""
    rates = (
        records.withColumn("site", source_label("source_url", "slug"))
        .groupBy("site")
        .agg(
            F.count("*").alias("total"),
            *[F.count_if(present(c)).alias(c) for c in ("phone", "email", "website")],
        )
    )
    wanted = targets.where(F.col("enabled") & present("name")).select(
        F.lower("name").alias("site")
    ).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rates.join(wanted, "site", "full").select(
        "site", *[zero(c) for c in ("total", "phone", "email", "website")]
    )


def kpis(leads: DataFrame) -> DataFrame:
    """KPI cards in one pass; ``domains`` counts keyed rows, ``distinct_domains`` keys."""
    return leads.agg(
        F.count("*").alias("total"),
        F.count_if(present("phone")).alias("with_phone"),
        F.count_if(present("email")).alias("with_email"),
        F.count_if(present("website")).alias("with_website"),
        F.count_if(present("dedup_key")).alias("domains"),
        F.count_distinct(empty_to_null("dedup_key")).alias("distinct_domains"),
    )


def source_counts(leads: DataFrame) -> DataFrame:
    """Leads per source label, sorted by label."""
    return (
        leads.select(source_label("source_url", "dashboard").alias("source"))
        .groupBy("source")
        .agg(F.count("*").alias("leads"))
        .orderBy("source")
    )


def dashboard_rows(leads: DataFrame) -> DataFrame:
    """Dashboard dataset: eight columns plus the derived source, ordered by name.

    ``seq`` breaks ties, which also lets the sort split a name that fills many rows.
    """
    return leads.orderBy("company_name", "seq").select(
        *DASHBOARD_COLUMNS, source_label("source_url", "dashboard").alias("source")
    )


def search_leads(
    rows: DataFrame, query: str = "", source: str = "", has: str = ""
) -> DataFrame:
    """Interactive filter: substring over name/phone/address/industry, source, field presence."""
    haystack = F.lower(
        F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit(""))
                           for c in ("company_name", "phone", "address", "industry_code")])
    )
    out = rows
    if query:
        out = out.where(haystack.contains(query.lower()))
    if source:
        out = out.where(F.col("source") == source)
    needed = {"": [], "phone": ["phone"], "email": ["email"], "website": ["website"],
              "phone_email": ["phone", "email"]}
    for c in needed[has]:
        out = out.where(present(c))
    return out


def sort_leads(rows: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Case-insensitive order, NULL as '', ties in input order."""
    key = F.lower(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return rows.orderBy(key.asc() if ascending else key.desc(), F.col("seq").asc())


def early_stop_report(stops: DataFrame) -> DataFrame:
    """Early-stopped targets with their reason, sorted."""
    cols = ["site", "category_slug", "city_slug"]
    return stops.select(*cols, "reason").orderBy(*cols)
