"""Detail-page enrichment of listing records, its budget and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import DETAIL_BUDGET
from leadloom.functions.contacts import (
    drop_site_wide_email,
    drop_site_wide_phone,
    first_email,
    first_mobile,
    first_phone,
    first_website,
)
from leadloom.functions.text import first_present, not_blank, present
from leadloom.operators.extract import revealed_contacts

FIELDS = ("phone", "email", "website")


def needs_detail() -> Column:
    """A record with both phone and e-mail needs no detail page."""
    return ~(present("phone") & present("email"))


def select_needy(records: DataFrame, budget: int = DETAIL_BUDGET) -> DataFrame:
    """The first ``budget`` records of the run that need a detail page and have its URL."""
    return records.where(needs_detail() & present("detail_url")).orderBy("seq").limit(budget)


def detail_contacts(pages: DataFrame, reveal: bool = False) -> DataFrame:
    """Contacts found on captured detail pages: ``record_id, fetched, detail_*``.

    ``reveal`` takes phone and e-mail from the captured reveal payloads instead of the text.
    """
    html = F.col("html")
    fetched = not_blank("html") & (F.trim(html) != "None")
    if reveal:
        seen = revealed_contacts("payloads")
        phone, email = seen["phone"], seen["email"]
    else:
        phone, email = first_phone(html), first_email(html)
    return pages.select(
        "record_id",
        F.coalesce(fetched, F.lit(False)).alias("fetched"),
        phone.alias("detail_phone"), email.alias("detail_email"),
        first_website(html).alias("detail_website"),
    )


def enrich(records: DataFrame, details: DataFrame, detail_wins: bool = True) -> DataFrame:
    """Merge detail contacts into records by ``record_id``.

    Records that already have phone and e-mail, or whose page was not fetched, stay as they
    are. ``attempted``/``fetched`` are kept for the statistics. With ``detail_wins`` a detail
    value replaces a listing value; without it only gaps are filled.
    """
    joined = records.join(details.withColumn("__hit", F.lit(True)), "record_id", "left")
    attempted = F.coalesce(F.col("__hit"), F.lit(False)) & needs_detail()
    fetched = attempted & F.coalesce(F.col("fetched"), F.lit(False))
    order = (lambda f: (f"detail_{f}", f)) if detail_wins else (lambda f: (f, f"detail_{f}"))
    clean = {
        "phone": drop_site_wide_phone, "email": drop_site_wide_email, "website": lambda c: c,
    }
    merged = {
        f: F.when(F.col("fetched"), clean[f](first_present(*order(f)))).otherwise(F.col(f))
        for f in FIELDS
    }
    return (
        joined.withColumns({"attempted": attempted, "fetched": fetched})
        .withColumns(merged)
        .drop("__hit", *[f"detail_{f}" for f in FIELDS])
    )


def backfill_phone(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Give records without a phone the first mobile number of their detail page."""
    found = pages.select("record_id", first_mobile("html").alias("__mobile"))
    return (
        records.join(found, "record_id", "left")
        .withColumn("phone", F.coalesce(first_present("phone"), F.col("__mobile")))
        .drop("__mobile")
    )


def enrich_stats(enriched: DataFrame) -> DataFrame:
    """Attempted, fetched and failed pages, and fields still unavailable after a fetch."""
    gone = lambda f: F.count_if(F.col("fetched") & ~present(f)).alias(f"{f}_unavailable")
    return enriched.agg(
        F.count_if("attempted").alias("attempted"),
        F.count_if("fetched").alias("fetched"),
        F.count_if(F.col("attempted") & ~F.col("fetched")).alias("fetch_failed"),
        *[gone(f) for f in FIELDS],
    )
