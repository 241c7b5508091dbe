"""Raw rows to leads, record checks, validation and scoring: narrow column work, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import constants as K
from leadloom import skew
from leadloom.functions.contacts import mark_unverified
from leadloom.functions.text import empty_to_null, first_present, not_blank, present, strip
from leadloom.functions.urls import is_valid_url, site_key, source_name


class Validated(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def as_of_column(as_of: datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def raw_to_lead(raw: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Leads from raw rows: identity key, source list, first-seen and scrape times."""
    now = as_of_column(as_of)
    existing = F.col("dedup_key") if "dedup_key" in raw.columns else F.lit(None).cast("string")
    source = source_name("source_url")
    missing = {
        "employee_count": F.lit(None).cast("int"),
        "revenue_band": F.lit(None).cast("string"),
        "category_slug": F.lit(None).cast("string"),
        "city_slug": F.lit(None).cast("string"),
    }
    base = raw.withColumns({c: v for c, v in missing.items() if c not in raw.columns})
    return base.withColumns(
        {
            "dedup_key": F.coalesce(empty_to_null(existing), site_key("website")),
            "sources": F.when(source.isNotNull(), F.array(source)),
            "category_slug": empty_to_null("category_slug"),
            "city_slug": empty_to_null("city_slug"),
            "scraped_at": now,
            "first_seen": now,
            "last_seen": F.lit(None).cast("timestamp"),
        }
    )


def enrichment_count(fields: Iterable[str] = ("employee_count", "revenue_band")) -> Column:
    """Number of non-NULL enrichment fields (a zero counts)."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))


def with_violations(leads: DataFrame) -> DataFrame:
    """Record checks as an array of messages; the name is stored stripped."""
    checks = F.array(
        F.when(~not_blank("company_name"), F.lit("company_name must not be empty")),
        F.when(~is_valid_url("website"), F.concat(F.lit("Invalid URL: "), F.col("website"))),
        F.when(~is_valid_url("source_url"), F.concat(F.lit("Invalid URL: "), F.col("source_url"))),
        F.when(
            ~F.col("lead_score").between(0, 100), F.lit("lead_score must be between 0 and 100")
        ),
    )
    return leads.withColumns(
        {"violations": F.array_compact(checks), "company_name": strip("company_name")}
    )


def rejection_reason() -> Column:
    """Why a lead is rejected, NULL when it is fine."""
    no_contact = ~present("email") & ~not_blank("phone")
    return F.when(~not_blank("company_name"), F.lit("Empty company_name")).when(
        no_contact, F.lit("Missing both email and phone")
    )


def filter_valid(leads: DataFrame) -> Validated:
    """Valid leads (bad e-mails prefixed) and invalid ones with their reason."""
    judged = leads.withColumn("reason", rejection_reason())
    valid = judged.where(F.col("reason").isNull()).drop("reason")
    return Validated(
        valid.withColumn("email", mark_unverified("email")),
        judged.where(F.col("reason").isNotNull()),
    )


def is_member(column: str, values: Iterable[str] | None) -> Column:
    allowed = sorted(values or ())
    if not allowed:
        return F.lit(False)
    return F.coalesce(F.col(column), F.lit("")).isin(allowed)


def score_breakdown(
    as_of: datetime | str | Column,
    icp_categories: Iterable[str] | None = None,
    icp_cities: Iterable[str] | None = None,
) -> Column:
    """Score parts as one struct. Absent contact fields are NULL, so to_json leaves them out."""
    now = as_of_column(as_of)
    points = lambda c, w: F.when(present(c), F.lit(w))
    phone = points("phone", K.SCORE_PHONE)
    email = points("email", K.SCORE_EMAIL)
    website = points("website", K.SCORE_WEBSITE)
    zero = F.lit(0)
    contact = sum((F.coalesce(p, zero) for p in (phone, email, website)), zero)

    n = F.coalesce(F.size("sources"), zero)
    tier = F.when(n >= 3, "all_3").when(n >= 2, "2_sites").otherwise("single")
    source_score = (
        F.when(n >= 3, K.SCORE_THREE_SOURCES).when(n >= 2, K.SCORE_TWO_SOURCES).otherwise(0)
    )

    # Whole days are taken on UTC microseconds, independent of the session time zone.
    day = 86_400_000_000
    seen, at = F.unix_micros("first_seen"), F.unix_micros(now)
    today = F.floor(seen / day) == F.floor(at / day)
    recent = F.floor((at - seen) / day) <= 7
    recency = (
        F.when(seen.isNull(), "new").when(today, "today").when(recent, "last_7_days")
        .otherwise("older")
    )
    recency_score = (
        F.when(seen.isNull() | today, K.SCORE_NEW).when(recent, K.SCORE_LAST_WEEK).otherwise(0)
    )
    icp = F.when(
        is_member("category_slug", icp_categories) | is_member("city_slug", icp_cities), K.SCORE_ICP
    ).otherwise(0)
    total = F.least(contact + source_score + recency_score + icp, F.lit(K.SCORE_CAP))
    return F.struct(
        phone.alias("has_phone"),
        email.alias("has_email"),
        website.alias("has_website"),
        contact.alias("contact"),
        tier.alias("multi_source"),
        source_score.alias("source_score"),
        recency.alias("recency"),
        recency_score.alias("recency_score"),
        icp.alias("icp_match"),
        total.alias("total"),
    )


def score_leads(
    leads: DataFrame,
    as_of: datetime | str | Column,
    icp_categories: Iterable[str] | None = None,
    icp_cities: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``lead_score_breakdown`` and ``lead_score``."""
    scored = leads.withColumn(
        "lead_score_breakdown", score_breakdown(as_of, icp_categories, icp_cities)
    )
    return scored.withColumn("lead_score", F.col("lead_score_breakdown.total"))


def seed_score() -> Column:
    """Contact-completeness score used for seeded rows."""
    weights = [
        ("email", K.SEED_EMAIL), ("phone", K.SEED_PHONE),
        ("website", K.SEED_WEBSITE), ("industry_code", K.SEED_INDUSTRY),
    ]
    total = sum((F.when(present(c), w).otherwise(0) for c, w in weights), F.lit(0))
    return F.least(total, F.lit(100))


def rescore_from_companies(
    leads: DataFrame, resolved: DataFrame, companies: DataFrame, as_of: datetime | str | Column,
    icp_categories: Iterable[str] | None = None, icp_cities: Iterable[str] | None = None,
) -> DataFrame:
    """Score again with the sources of the resolved company, so multi-source points apply.

    ``resolved`` maps ``seq`` to a company key; all three inputs are distributed tables.
    """
    linked = resolved.select("seq", F.col("dedup_key").alias("company_key"))
    sizes = linked.groupBy("company_key").agg(F.count("*").alias("company_rows"))
    company_sources = companies.select(
        F.col("dedup_key").alias("company_key"), F.col("sources").alias("company_sources")
    ).join(sizes, "company_key")
    found = skew.attach(
        leads.join(linked, "seq"), company_sources, ["company_key"], "company_rows"
    )
    enriched = (
        found.withColumn("sources", F.coalesce("company_sources", "sources"))
        .drop("company_key", "company_sources")
        .unionByName(leads.join(linked.select("seq"), "seq", "left_anti"))
    )
    return score_leads(enriched, as_of, icp_categories, icp_cities)


__all__ = [
    "Validated", "raw_to_lead", "enrichment_count", "with_violations", "rejection_reason",
    "filter_valid", "score_breakdown", "score_leads", "seed_score", "rescore_from_companies",
    "as_of_column", "first_present",
]
