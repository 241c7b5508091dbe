"""URL expressions. Regex-based: the built-in parser raises or loses ports on dirty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import DIRECTORY_DOMAINS, SOURCE_DOMAINS, SOURCE_SLUGS
from leadloom.functions.text import blank_to_null, col, present, strip

_SCHEME = r"[a-zA-Z][a-zA-Z0-9+.\-]*"


def netloc(c: Column | str) -> Column:
    """Authority part (user info and port kept), '' when there is none."""
    return F.regexp_extract(col(c), rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def drop_www(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"^www\.", "")


def site_key(website: Column | str) -> Column:
    """Lower-case host without ``www.`` (port kept); '' when there is no website."""
    web = F.coalesce(col(website), F.lit(""))
    host = F.coalesce(F.nullif(netloc(web), F.lit("")), web)
    return F.regexp_replace(drop_www(F.lower(host)), r"(?s)/.*$", "")


def normalize_domain(website: Column | str) -> Column:
    """Lower, strip, drop a leading ``www.`` and trailing slashes; a scheme stays."""
    c = col(website)
    return F.when(c != "", F.regexp_replace(drop_www(strip(F.lower(c))), r"/+$", ""))


def is_valid_url(c: Column | str) -> Column:
    """Scheme and authority are both there; a missing URL counts as valid."""
    return ~present(c) | col(c).rlike(rf"^{_SCHEME}://[^/?#]")


def source_name(url: Column | str) -> Column:
    """Directory label of a source URL (case-sensitive), NULL when unknown."""
    c = col(url)
    return F.coalesce(*[F.when(c.contains(d), F.lit(n)) for d, n in SOURCE_DOMAINS.items()])


def source_label(url: Column | str, mode: str) -> Column:
    """Label variants: ``migrate`` (lower-cased URL), ``dashboard`` (host fallback), ``slug``."""
    c = F.coalesce(col(url), F.lit(""))
    if mode == "migrate":
        return F.coalesce(source_name(F.lower(c)), F.lit("Unknown"))
    if mode == "dashboard":
        host = F.when(c.contains("//"), F.get(F.split(c, "/"), F.lit(2)))
        return F.coalesce(source_name(c), host, F.lit("Unknown"))
    if mode == "slug":
        low = F.lower(c)
        return F.coalesce(
            *[F.when(low.contains(s), F.lit(s)) for s in SOURCE_SLUGS], F.lit("unknown")
        )
    raise ValueError(f"unknown source label mode {mode!r}")


def is_directory_host(host: Column | str) -> Column:
    """True for a directory/social domain or one of its subdomains. Accepts full URLs."""
    h = F.lower(strip(host))
    bare = F.when(
        h.contains("://"), F.regexp_replace(netloc(h), r"^.*@", "")
    ).otherwise(h)
    bare = F.regexp_replace(drop_www(bare), r":.*$", "")
    pattern = "|".join(d.replace(".", r"\.") for d in DIRECTORY_DOMAINS)
    return F.coalesce(bare.rlike(rf"^(?:.*\.)?(?:{pattern})$"), F.lit(False))


def with_scheme(website: Column | str) -> Column:
    """Prefix ``https://`` when the text does not start with http; blank becomes NULL."""
    w = blank_to_null(website)
    return F.when(w.startswith("http"), w).otherwise(F.concat(F.lit("https://"), w))


def company_website(website: Column | str) -> Column:
    """The website unless it belongs to a directory."""
    return F.when(~is_directory_host(website), col(website))


def endpoint_key(c: Column | str) -> Column:
    """Credential-free ``host:port`` of an endpoint URL; '' when blank."""
    text = strip(F.coalesce(col(c).cast("string"), F.lit("")))
    full = F.when(text.contains("://"), text).otherwise(F.concat(F.lit("http://"), text))
    return F.when(text == "", F.lit("")).otherwise(
        F.regexp_replace(netloc(full), r"^.*@", "")
    )


def _collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.expr("CAST(array() AS ARRAY<STRING>)"),
        lambda acc, s: F.when(
            s == "..",
            F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc),
        ).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), tail)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute http(s) URL of ``href`` seen on page ``base``; NULL when there is none."""
    b, h = F.coalesce(col(base), F.lit("")), blank_to_null(href)
    origin = F.regexp_extract(b, rf"^({_SCHEME}://[^/?#]*)", 1)
    base_path = F.regexp_extract(b, rf"^{_SCHEME}://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(
        F.nullif(F.regexp_extract(base_path, r"^(.*/)", 1), F.lit("")), F.lit("/")
    )
    path = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    target = (
        F.when(h.rlike(rf"^{_SCHEME}:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, rf"^({_SCHEME}:)", 1), h))
        .when(h.startswith("/"), F.concat(origin, _collapse_dots(path), rest))
        .when(h.startswith("?"), F.concat(F.regexp_extract(b, r"^([^?#]*)", 1), h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, r"^([^#]*)", 1), h))
        .otherwise(F.concat(origin, _collapse_dots(F.concat(folder, path)), rest))
    )
    return F.when(target.rlike(r"^https?://"), target)


def profile_url(s_url: Column | str, domain: str = "indiamart.com") -> Column:
    """Directory profile page: query cut off, exactly one trailing slash."""
    u = strip(s_url)
    cut = F.regexp_replace(F.regexp_replace(u, r"(?s)\?.*$", ""), r"/+$", "")
    return F.when(u.contains(domain), F.concat(cut, F.lit("/")))


def page_url(base: Column | str, page: Column | str, paged: Column | None = None) -> Column:
    """Listing page URL: page 1 (or a site without paging) is the base itself."""
    b, p = col(base), col(page)
    first = (p <= 1) if paged is None else (p <= 1) | ~paged
    numbered = F.concat(F.regexp_replace(b, r"/+$", ""), F.lit("?page="), p.cast("string"))
    return F.when(first, b).otherwise(numbered)
