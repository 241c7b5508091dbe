"""Company-name normalization and the identity keys built on it."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import DESCRIPTOR_WORDS, LEGAL_WORDS, LEGACY_PHONE_COLUMNS
from leadloom.functions.contacts import emails
from leadloom.functions.text import (
    blank_to_null,
    col,
    digits_only,
    first_present,
    not_blank,
    present,
    strip,
)


def _without_words(name: Column | str, words: list[str]) -> Column:
    spaced = F.regexp_replace(F.lower(col(name)), r"(?U)[^\w\s]", " ")
    dropped = F.regexp_replace(spaced, rf"(?U)\b({'|'.join(words)})\b", " ")
    return F.trim(F.regexp_replace(dropped, r"(?U)\s+", " "))


def normalize_company_name(name: Column | str) -> Column:
    """Identity form: legal and descriptor words dropped. May become ''."""
    return _without_words(name, LEGAL_WORDS + DESCRIPTOR_WORDS)


def fuzzy_normalize_company_name(name: Column | str) -> Column:
    """Comparison form: only legal words dropped."""
    return _without_words(name, LEGAL_WORDS)


def token_sorted(form: Column | str) -> Column:
    """Whitespace tokens in sorted order, single-spaced."""
    return F.array_join(F.array_sort(F.split(col(form), " ")), " ")


def phone_key(phone: Column | str) -> Column:
    """Identity key of a phone with at least ten digits, else NULL."""
    d = digits_only(phone)
    return F.when(F.length(d) >= 10, F.md5(F.concat(F.lit("phone:"), F.right(d, F.lit(10)))))


def entity_key(name: Column | str, phone: Column | str, website: Column | str) -> Column:
    """Phone key when there is one, else normalized name plus scheme-less website."""
    site = strip(F.lower(F.coalesce(col(website), F.lit(""))))
    site = F.regexp_replace(F.regexp_replace(site, r"^https?://", ""), r"/+$", "")
    text = F.concat(F.lit("name:"), normalize_company_name(F.coalesce(col(name), F.lit(""))))
    text = F.when(site != "", F.concat(text, F.lit("|web:"), site)).otherwise(text)
    return F.coalesce(phone_key(phone), F.md5(text))


def primary_contact(phone: Column | str, email: Column | str, website: Column | str) -> Column:
    """Phone digits, else e-mail, else website (inner whitespace collapsed), else ''."""
    squeeze = lambda c: F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))
    return F.coalesce(
        F.nullif(digits_only(phone), F.lit("")),
        F.when(present(email), squeeze(email)),
        F.when(present(website), squeeze(website)),
        F.lit(""),
    )


def raw_record_id(
    source: Column | str, name: Column | str, primary: Column | str
) -> Column:
    return F.lower(F.concat_ws("|", col(source), col(name), col(primary)))


def hash_bucket(text: Column | str, n: int, divide_by: int = 1) -> Column:
    """First 32 bits of the md5, divided, modulo ``n``: a stable attribute index."""
    idx = F.conv(F.substring(F.md5(col(text)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(F.floor(idx / F.lit(divide_by)) if divide_by > 1 else idx, F.lit(n))


@cache
def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """ASCII text of every character whose compatibility decomposition holds some: one letter, or more."""
    single, several = {}, {}
    for point in range(128, sys.maxunicode + 1):
        ch = chr(point)
        if unicodedata.decomposition(ch):
            text = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
            if text:
                (single if len(text) == 1 else several)[ch] = text
    return single, several


def ascii_fold(text: Column) -> Column:
    """Text decomposed for compatibility with everything but ASCII left out. Built-in functions only.

    The table of decompositions becomes part of the plan: characters that keep one letter are
    translated, the few that keep several are looked up where a text holds one.
    """
    single, several = _decompositions()
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    looked_up = F.array_join(F.transform(chars, lambda c: F.when(c.rlike(r"^\p{ASCII}"), c).otherwise(F.coalesce(F.try_element_at(table, c), c))), "")
    some = "[" + "".join(several) + "]"
    whole = F.when(text.rlike(some), looked_up).otherwise(text)
    return F.regexp_replace(F.translate(whole, "".join(single), "".join(single.values())), r"\P{ASCII}+", "")


def legacy_key(name: Column | str, website: Column | str) -> Column:
    """md5 of the ASCII-folded lower-cased ``name|website`` (a NULL part reads ``None``)."""
    part = lambda c: F.coalesce(col(c), F.lit("None"))
    raw = F.lower(strip(F.concat(part(name), F.lit("|"), part(website))))
    return F.md5(F.when(raw.rlike(r"^\p{ASCII}*$"), raw).otherwise(ascii_fold(raw)))


def legacy_phones(columns: list[str]) -> Column:
    """Sorted distinct digit runs (6-15) of whichever candidate phone columns exist."""
    runs = [
        F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(r"(?U)\d{6,15}"), F.lit(0))
        for c in LEGACY_PHONE_COLUMNS
        if c in columns
    ]
    if not runs:
        return F.expr("CAST(array() AS ARRAY<STRING>)")
    return F.array_sort(F.array_distinct(F.concat(*runs)))


def legacy_emails(*cols: Column | str) -> Column:
    joined = F.concat_ws("|", *[F.coalesce(col(c), F.lit("")) for c in cols])
    return F.array_sort(F.array_distinct(F.transform(emails(joined), F.lower)))


def industry_code(c: Column | str) -> Column:
    """Upper-case code; long ones are replaced by sixteen md5 characters."""
    text = blank_to_null(c)
    code = F.regexp_replace(F.upper(text), "[ /]", "_")
    code = F.when(F.length(code) > 50, F.substring(F.md5(code), 1, 16)).otherwise(code)
    return F.when(~text.isin("N/A", "n/a"), code)


def legacy_address(*cols: Column | str) -> Column:
    return blank_to_null(F.concat_ws(" ", *[F.nullif(col(c), F.lit("")) for c in cols]))


__all__ = [
    "normalize_company_name", "fuzzy_normalize_company_name", "token_sorted", "phone_key",
    "entity_key", "primary_contact", "raw_record_id", "hash_bucket", "legacy_key",
    "legacy_phones", "legacy_emails", "industry_code", "legacy_address", "first_present",
    "not_blank",
]
