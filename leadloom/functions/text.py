"""String helpers with Unicode-aware semantics (``(?U)``: \\w, \\d, \\s, \\b beyond ASCII)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """True when the value is neither NULL nor the empty string (never NULL itself)."""
    return F.coalesce(col(c) != "", F.lit(False))


def strip(c: Column | str) -> Column:
    """Remove all leading and trailing whitespace (``trim`` would only drop spaces)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def not_blank(c: Column | str) -> Column:
    """True when something other than whitespace is there."""
    return F.coalesce(col(c).rlike(r"(?U)\S"), F.lit(False))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_present(*cols: Column | str) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[empty_to_null(c) for c in cols])


def safe_str(c: Column | str, max_len: int = 1000) -> Column:
    """Stripped and truncated text; NULL, empty and the word ``null`` become NULL."""
    value = col(c)
    return F.when(value != "null", F.substring(blank_to_null(value), 1, max_len))


def joined_nonempty(sep: str, *cols: Column | str) -> Column:
    """Separator-joined parts, leaving out empty ones (no surviving part gives '')."""
    return F.concat_ws(sep, *[empty_to_null(c) for c in cols])


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?U)\D", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Inside lambdas nothing is shared between uses, so a parsed document referred to twice
    would be parsed twice, for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
