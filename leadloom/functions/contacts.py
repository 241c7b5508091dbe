"""Contact extraction and validation expressions (e-mail, phone, website)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import (
    EMAIL_PATTERN,
    INTERNATIONAL_PATTERN,
    LANDLINE_PATTERN,
    MOBILE_PATTERN,
    SITE_WIDE_EMAILS,
    SITE_WIDE_PHONES,
    UNVERIFIED_PREFIX,
    URL_PATTERN,
)
from leadloom.functions.text import blank_to_null, col, let, not_blank, present, strip
from leadloom.functions.urls import drop_www, is_directory_host

MIN_PHONE, MAX_PHONE = 10, 15


# Long texts rarely hold a contact, so each extractor first looks for what every match must
# contain; the pattern itself runs only on texts that have it.


def _with_at(text: Column | str) -> Column:
    return F.when(col(text).contains("@"), col(text))


def emails(text: Column | str) -> Column:
    """All e-mail addresses in order of appearance."""
    found = F.regexp_extract_all(_with_at(text), F.lit(EMAIL_PATTERN), F.lit(0))
    none = F.when(col(text).isNotNull(), F.expr("CAST(array() AS ARRAY<STRING>)"))
    return F.coalesce(found, none)


def first_email(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_with_at(text), EMAIL_PATTERN, 0), F.lit(""))


def _phone_chars(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\d+]", "")


def _first_match(text: Column, pattern: str) -> Column:
    return F.nullif(_phone_chars(F.regexp_extract(text, "(?U)" + pattern, 0)), F.lit(""))


def _dialable(text: Column | str) -> Column:
    """Text reduced to its digit groups, NULL when no six digits follow each other.

    The phone patterns allow one separator at most between digits or plus signs, so a longer
    gap can never lie inside a match and shrinks to one mark.
    """
    c = col(text)
    return F.when(c.rlike(r"(?U)\d{6}"), F.regexp_replace(c, r"(?U)[^\d+]{2,}", "#"))


def first_mobile(text: Column | str) -> Column:
    """First mobile number, cut to 15 characters."""
    return F.substring(_first_match(_dialable(text), MOBILE_PATTERN), 1, MAX_PHONE)


def first_phone(text: Column | str) -> Column:
    """First mobile, else international, else landline number (first match of each)."""
    def find(t: Column) -> Column:
        mobile = _first_match(t, MOBILE_PATTERN)
        foreign = _first_match(t, INTERNATIONAL_PATTERN)
        return F.coalesce(
            F.when(F.length(mobile) >= MIN_PHONE, mobile),
            F.when(F.length(foreign) >= MIN_PHONE, foreign),
            _first_match(t, LANDLINE_PATTERN),
        )

    return F.substring(let(_dialable(text), find), 1, MAX_PHONE)


def clean_phone(c: Column | str) -> Column:
    """Digits and plus signs; NULL below ten characters, cut to fifteen."""
    kept = _phone_chars(col(c))
    return F.when(F.length(kept) >= MIN_PHONE, F.substring(kept, 1, MAX_PHONE))


def websites(html: Column | str) -> Column:
    """Distinct company URLs in order: scripts, styles and directory hosts are ignored."""
    linked = F.when(col(html).contains("http"), col(html))
    visible = F.regexp_replace(linked, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    urls = F.regexp_extract_all(visible, F.lit("(?U)" + URL_PATTERN), F.lit(0))
    host = lambda u: drop_www(F.lower(F.regexp_extract(u, r"https?://([^/?#]+)", 1)))
    own = F.filter(urls, lambda u: host(u).contains(".") & ~is_directory_host(host(u)))
    cut = lambda u: F.regexp_replace(F.regexp_replace(u, r"\?.*$", ""), r"/+$", "")
    none = F.when(col(html).isNotNull(), F.expr("CAST(array() AS ARRAY<STRING>)"))
    return F.coalesce(F.array_distinct(F.transform(own, cut)), none)


def first_website(html: Column | str) -> Column:
    return F.get(websites(html), F.lit(0))


def drop_site_wide_phone(c: Column | str) -> Column:
    return F.when(~col(c).isin(SITE_WIDE_PHONES), col(c))


def drop_site_wide_email(c: Column | str) -> Column:
    return F.when(~col(c).isin(SITE_WIDE_EMAILS), col(c))


def is_valid_email(c: Column | str) -> Column:
    return F.coalesce(strip(c).rlike(f"^{EMAIL_PATTERN}$"), F.lit(False))


def flag_invalid_email(c: Column | str) -> Column:
    """Trimmed address; an invalid one is prefixed, a blank one is NULL."""
    trimmed = blank_to_null(c)
    return F.when(is_valid_email(c), trimmed).otherwise(
        F.concat(F.lit(UNVERIFIED_PREFIX), trimmed)
    )


def mark_unverified(c: Column | str) -> Column:
    """Validation variant: valid addresses stay untrimmed, whitespace only is prefixed."""
    bad = present(c) & ~is_valid_email(c)
    return F.when(bad, F.concat(F.lit(UNVERIFIED_PREFIX), strip(c))).otherwise(col(c))


def has_phone(c: Column | str) -> Column:
    return not_blank(c)
