"""Listing extraction from captured pages.

Every strategy is a column expression that turns one page into an array of listing structs,
so a whole cascade is a narrow projection followed by one ``inline``: no shuffle, no
self-join, and a lower-priority strategy is evaluated only for pages where the ones before
it found nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import constants as K
from leadloom.functions.contacts import (
    clean_phone,
    drop_site_wide_email,
    drop_site_wide_phone,
    first_email,
    first_phone,
    first_website,
)
from leadloom.functions.text import (
    blank_to_null,
    col,
    empty_to_null,
    first_present,
    joined_nonempty,
    let,
    present,
    safe_str,
    strip,
)
from leadloom.functions.urls import company_website, profile_url, resolve_url, with_scheme

LISTING = (
    "ARRAY<STRUCT<company_name: STRING, website: STRING, email: STRING, phone: STRING, "
    "address: STRING, industry_code: STRING, detail_url: STRING>>"
)
_FIELDS = [
    "company_name", "website", "email", "phone", "address", "industry_code", "detail_url",
]


class Parsed(NamedTuple):
    records: DataFrame
    errors: DataFrame


def page_text(content: Column | str, binary: bool = False) -> Column:
    """Page text; binary captures are decoded as UTF-8 with bad bytes replaced."""
    return F.make_valid_utf8(col(content).cast("string")) if binary else col(content)


def _listing(**fields: Column) -> Column:
    return F.struct(
        *[fields.get(f, F.lit(None).cast("string")).cast("string").alias(f) for f in _FIELDS]
    )


def _named(rows: Column) -> Column:
    """Listings that have a name; never NULL."""
    kept = F.filter(rows, lambda r: present(r["company_name"]))
    return F.coalesce(kept, F.expr(f"CAST(array() AS {LISTING})"))


def _text(c: Column) -> Column:
    """Stripped JSON text field, '' when missing."""
    return strip(F.coalesce(c, F.lit("")))


def _is_object(json_text: Column) -> Column:
    return F.ltrim(json_text).startswith("{")


# --- column-oriented payload -------------------------------------------------------------

_COLUMNAR = "columns: ARRAY<STRING>, data: ARRAY<STRING>"
_COLUMNAR_LIST = f"STRUCT<results: STRUCT<{_COLUMNAR}>, {_COLUMNAR}>"
_COLUMNAR_PAGE = (
    f"props STRUCT<pageProps: STRUCT<listData: {_COLUMNAR_LIST}, listingData: {_COLUMNAR_LIST}>>"
)
_NESTED = "cmp_params STRUCT<email: STRING, website: STRING, misc: STRING>"


def columnar_listings(html: Column | str) -> Column:
    """Rows of an embedded ``columns`` + ``data`` payload, with nested-JSON fallbacks."""
    block = F.regexp_extract(
        col(html),
        r'(?s)<script\s+id="__NEXT_DATA__"\s+type="application/json">(.*?)</script>', 1,
    )
    fields = ["name", "VNumber", "NewAddress", "area", "city", "type", "email", "website", "bd_params"]

    def listing(cell: Column, nested: Column) -> Column:
        own_site = company_website(with_scheme(cell["website"]))
        return _listing(
            company_name=cell["name"],
            website=F.coalesce(own_site, company_website(with_scheme(nested["website"]))),
            email=first_present(cell["email"], nested["email"]),
            phone=clean_phone(first_present(cell["VNumber"], nested["misc"])),
            address=safe_str(joined_nonempty(", ", cell["NewAddress"], cell["area"], cell["city"])),
            industry_code=safe_str(cell["type"]),
        )

    def row(raw: Column, at: Column) -> Column:
        picked = let(
            F.from_json(raw, "ARRAY<STRING>"),
            lambda cells: F.struct(*[_text(F.get(cells, at[f])).alias(f) for f in fields]),
        )
        return let(
            picked,
            lambda cell: let(
                F.from_json(cell["bd_params"], _NESTED)["cmp_params"],
                lambda nested: listing(cell, nested),
            ),
        )

    def rows(page: Column) -> Column:
        names = F.coalesce(page["results"]["columns"], page["columns"])
        data = F.coalesce(page["results"]["data"], page["data"])
        at = lambda n: F.struct(
            *[(F.array_position(n, f).cast("int") - 1).alias(f) for f in fields]
        )
        lists = F.filter(data, lambda r: F.ltrim(r).startswith("["))
        return let(let(names, at), lambda index: F.transform(lists, lambda r: row(r, index)))

    pages = let(
        F.from_json(F.nullif(block, F.lit("")), _COLUMNAR_PAGE)["props"]["pageProps"],
        lambda props: let(F.coalesce(props["listData"], props["listingData"]), rows),
    )
    return _named(pages)


# --- assigned page state -----------------------------------------------------------------

_STATE = "data ARRAY<STRING>, plaWidgetData ARRAY<STRUCT<COMPANYNAME: STRING, CONTACT_NUMBER: STRING>>"
_STATE_ITEM = "CMP STRING, ad STRING, city STRING, g_s STRING, ds STRING, s_url STRING"


def state_json(html: Column | str) -> Column:
    """Text from the first assigned page state on; the JSON reader stops at its end."""
    h = col(html)
    after = lambda marker: F.get(F.split(h, rf"window\.{marker} = ", 2), F.lit(1))
    opens = lambda c: F.when(c.rlike(r"^[\{\[]"), c)
    return F.coalesce(opens(after("__INITIAL_STATE__")), opens(after("__PRELOADED_STATE__")))


def state_listings(html: Column | str) -> Column:
    """Items of the page state; the phone comes from the ad of the same name (last ad wins)."""

    def listing(item: Column, name: Column, s_url: Column, ads: Column) -> Column:
        same = F.filter(ads, lambda a: a["name"] == name)
        return _listing(
            company_name=name,
            website=F.when((s_url != "") & ~s_url.contains("indiamart.com"), s_url),
            phone=clean_phone(F.try_element_at(same, F.lit(-1))["phone"]),
            address=safe_str(joined_nonempty(", ", *[_text(item[f]) for f in ("ad", "city", "g_s")])),
            industry_code=safe_str(_text(item["ds"]), 300),
            detail_url=profile_url(s_url),
        )

    def row(raw: Column, ads: Column) -> Column:
        return let(
            F.from_json(F.when(_is_object(raw), raw), _STATE_ITEM),
            lambda item: let(
                _text(item["CMP"]),
                lambda name: let(
                    _text(item["s_url"]), lambda s_url: listing(item, name, s_url, ads)
                ),
            ),
        )

    def rows(state: Column) -> Column:
        trimmed = F.transform(
            F.coalesce(state["plaWidgetData"], F.expr("CAST(array() AS ARRAY<STRUCT<COMPANYNAME: STRING, CONTACT_NUMBER: STRING>>)")),
            lambda a: F.struct(
                _text(a["COMPANYNAME"]).alias("name"), _text(a["CONTACT_NUMBER"]).alias("phone")
            ),
        )
        usable = F.filter(trimmed, lambda a: (a["name"] != "") & (a["phone"] != ""))
        return let(usable, lambda ads: F.transform(state["data"], lambda r: row(r, ads)))

    parsed = let(
        state_json(html), lambda text: F.from_json(F.when(text.startswith("{"), text), _STATE)
    )
    return _named(let(parsed, rows))


# --- captured requests -------------------------------------------------------------------

_PAYLOAD = (
    "data STRUCT<searchOutput: STRUCT<results: ARRAY<STRING>>>, "
    "results ARRAY<STRING>, listData ARRAY<STRING>"
)
_PAYLOAD_ITEM = ", ".join(
    f"{f} STRING"
    for f in (
        "name", "title", "contactNumber", "phone", "VNumber", "address", "NewAddress", "area",
        "city", "type", "category", "businessType", "website", "email",
    )
)


def _payload_rows(body: Column) -> Column:
    some = lambda a: F.when(F.size(a) > 0, a)
    rows = let(
        F.from_json(F.when(_is_object(body), body), _PAYLOAD),
        lambda p: F.coalesce(
            some(p["data"]["searchOutput"]["results"]), some(p["results"]), some(p["listData"])
        ),
    )
    return F.filter(rows, _is_object)


def best_payload(payloads: Column | str, site: str = "justdial") -> Column:
    """Rows of the first payload of the site's own API, else of the first other payload."""
    parsed = F.transform(
        col(payloads),
        lambda p: F.struct(
            F.coalesce(F.lower(p["url"]).contains(site), F.lit(False)).alias("own"),
            _payload_rows(p["body"]).alias("rows"),
        ),
    )
    return let(
        F.filter(parsed, lambda p: p["rows"].isNotNull()),
        lambda usable: F.coalesce(
            F.get(F.filter(usable, lambda p: p["own"]), F.lit(0))["rows"],
            F.get(usable, F.lit(0))["rows"],
        ),
    )


def payload_listings(payloads: Column | str) -> Column:
    """Listings of the chosen captured payload, field aliases coalesced."""
    def listing(item: Column) -> Column:
        pick = lambda *names: _text(first_present(*[item[n] for n in names]))
        return _listing(
            company_name=pick("name", "title"),
            website=company_website(with_scheme(item["website"])),
            email=blank_to_null(item["email"]),
            phone=clean_phone(pick("contactNumber", "phone", "VNumber")),
            address=safe_str(
                joined_nonempty(", ", pick("address", "NewAddress"), pick("area"), pick("city"))
            ),
            industry_code=safe_str(pick("type", "category", "businessType")),
        )

    rows = F.transform(best_payload(payloads), lambda r: let(F.from_json(r, _PAYLOAD_ITEM), listing))
    return _named(rows)


# --- JSON-LD -----------------------------------------------------------------------------

_LD_NODE = (
    "`@type` STRING, name STRING, url STRING, telephone STRING, contactPoint STRING, "
    "address STRING"
)
_LD_GRAPH = "`@graph` ARRAY<STRING>"
_LD_ADDRESS = "streetAddress STRING, addressLocality STRING, addressRegion STRING"


def json_ld_blocks(html: Column | str) -> Column:
    return F.regexp_extract_all(
        col(html),
        F.lit(r'(?s)<script\s+type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1),
    )


def json_ld_listings(html: Column | str) -> Column:
    """Business nodes of all JSON-LD blocks, members of an ``@graph`` included."""
    def nodes(block: Column) -> Column:
        only = F.when(_is_object(block), F.array(block))
        return let(
            F.from_json(F.when(_is_object(block), block), _LD_GRAPH)["@graph"],
            lambda graph: F.when(graph.isNotNull(), F.filter(graph, _is_object)).otherwise(only),
        )

    def address(text: Column) -> Column:
        parts = let(
            F.from_json(text, _LD_ADDRESS),
            lambda a: joined_nonempty(
                ", ", *[_text(a[f]) for f in ("streetAddress", "addressLocality", "addressRegion")]
            ),
        )
        return F.when(_is_object(text), parts).otherwise(text)

    def listing(node: Column) -> Column:
        point = node["contactPoint"]
        points = F.coalesce(
            F.from_json(point, "ARRAY<STRUCT<email: STRING>>"),
            F.array(F.from_json(point, "email STRING")),
        )
        mails = F.filter(F.transform(points, lambda p: p["email"]), present)
        typed = node["@type"].isNull() | node["@type"].isin(K.BUSINESS_TYPES)
        return _listing(
            company_name=F.when(typed, _text(node["name"])),
            website=company_website(blank_to_null(node["url"])),
            email=F.get(mails, F.lit(0)),
            phone=clean_phone(_text(node["telephone"])),
            address=safe_str(address(node["address"])),
        )

    blocks = F.filter(F.transform(json_ld_blocks(html), nodes), lambda b: b.isNotNull())
    rows = F.transform(F.flatten(blocks), lambda r: let(F.from_json(r, _LD_NODE), listing))
    return _named(rows)


# --- text fallback -----------------------------------------------------------------------


def listing_names(html: Column | str, patterns: list[str]) -> Column:
    """Names matched by the first pattern that matches anything."""
    found = [F.regexp_extract_all(col(html), F.lit("(?U)" + p), F.lit(1)) for p in patterns]
    chosen = F.coalesce(*[F.when(F.size(f) > 0, f) for f in found])
    return F.transform(chosen, strip)


def text_listings(
    html: Column | str, patterns: list[str], distinct: bool = True, min_len: int = 1,
    max_len: int | None = None,
) -> Column:
    """Name-only listings, each with the contacts found anywhere on the page."""
    names = F.filter(listing_names(html, patterns), lambda n: F.length(n) >= min_len)
    if distinct:
        names = F.array_distinct(names)
    h = col(html)
    cut = (lambda n: F.substring(n, 1, max_len)) if max_len else (lambda n: n)

    def with_contact(found: Column) -> Column:
        # One contact struct per page, shared by all its names.
        contact = F.struct(
            first_website(h).alias("website"), first_email(h).alias("email"),
            first_phone(h).alias("phone"),
        )
        listing = lambda n, c: _listing(
            company_name=cut(n), website=c["website"], email=c["email"], phone=c["phone"]
        )
        rows = let(contact, lambda c: F.transform(found, lambda n: listing(n, c)))
        return F.when(F.size(found) > 0, rows)

    return _named(let(names, with_contact))


def site_text_listings(html: Column | str, site: str) -> Column:
    """Text fallback with the settings of a directory site."""
    patterns = K.NAME_PATTERNS[site]
    if site == "justdial":
        return text_listings(html, patterns, distinct=False, min_len=2)
    return text_listings(html, patterns, max_len=200 if site == "tradeindia" else None)


# --- cascade and registry ----------------------------------------------------------------


def with_cascade(pages: DataFrame, strategies: list[tuple[str, Column]]) -> DataFrame:
    """Add ``strategy`` and ``listings`` of the first strategy with at least one listing.

    One projection per strategy, each guarded by the result so far, so an expression is
    evaluated at most once per page and only where it is still needed.
    """
    empty = F.expr(f"CAST(array() AS {LISTING})")
    out = pages.withColumns({"strategy": F.lit(None).cast("string"), "listings": empty})
    for name, rows in strategies:
        out = out.withColumn("__try", F.when(F.size("listings") == 0, rows))
        hit = F.size("__try") > 0
        out = out.withColumns(
            {
                "strategy": F.when(hit, F.lit(name)).otherwise(F.col("strategy")),
                "listings": F.when(hit, F.col("__try")).otherwise(F.col("listings")),
            }
        ).drop("__try")
    return out


def explode_listings(
    pages: DataFrame, listings: Column, source_url: str = "url", keep: list[str] | None = None,
) -> DataFrame:
    """One row per listing; ``position`` is its order within the page."""
    carried = keep if keep is not None else [c for c in pages.columns if c not in ("html", "payloads")]
    return (
        pages.select(*carried, F.col(source_url).alias("source_url"),
                     F.posexplode(listings).alias("position", "l"))
        .select(*carried, "source_url", "position", "l.*")
        .withColumns({"phone": drop_site_wide_phone("phone"), "email": drop_site_wide_email("email")})
    )


def strategy_cascade(pages: DataFrame, site: str) -> DataFrame:
    """Listings of pages of one directory site by its strategy order."""
    html = F.col("html")
    has_payloads = "payloads" in pages.columns
    orders = {
        "justdial": (
            ([("payload", payload_listings("payloads"))] if has_payloads else [])
            + [("columnar", columnar_listings(html)), ("json_ld", json_ld_listings(html)),
               ("text", site_text_listings(html, "justdial"))]
        ),
        "indiamart": [("state", state_listings(html)), ("text", site_text_listings(html, "indiamart"))],
        "tradeindia": [("text", site_text_listings(html, "tradeindia"))],
    }
    solved = with_cascade(pages, orders[site])
    kept = [c for c in solved.columns if c not in ("html", "payloads", "listings")]
    return explode_listings(solved, F.col("listings"), keep=kept)


Extractor = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Extractor] = {}


def register_parser(name: str) -> Callable[[Extractor], Extractor]:
    """Register an extractor (pages -> listings) under a parser name."""
    def add(fn: Extractor) -> Extractor:
        REGISTRY[name] = fn
        return fn

    return add


@register_parser("parse_justdial")
def parse_justdial(pages: DataFrame) -> DataFrame:
    return strategy_cascade(pages, "justdial")


@register_parser("parse_indiamart")
def parse_indiamart(pages: DataFrame) -> DataFrame:
    return strategy_cascade(pages, "indiamart")


@register_parser("parse_tradeindia")
def parse_tradeindia(pages: DataFrame) -> DataFrame:
    return strategy_cascade(pages, "tradeindia")


def parse_pages(pages: DataFrame, parser_col: str = "parser") -> Parsed:
    """Run each page through its registered parser; other pages become error rows."""
    known = sorted(REGISTRY)
    name = F.coalesce(F.col(parser_col), F.lit(""))
    parts = [REGISTRY[p](pages.where(name == p)) for p in known]
    errors = pages.where(~name.isin(known)).select(
        F.col("url"), F.lit("UnknownParser").alias("error_type")
    )
    return Parsed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), errors)


# --- links -------------------------------------------------------------------------------


def detail_url(page_url: Column | str, *hrefs: Column | str) -> Column:
    """First href that resolves to an http(s) URL."""
    return F.coalesce(*[resolve_url(page_url, h) for h in hrefs])


def pair_by_position(
    pages: DataFrame, url_contains: str, records: str = "records", cards: str = "cards",
) -> DataFrame:
    """k-th named card goes with the k-th record of the page.

    ``cards``: array of (name, href); ``records``: array of structs in page order. Both sit in
    one row, so pairing is an index lookup.
    """
    named = F.filter(F.col(cards), lambda c: blank_to_null(c["name"]).isNotNull())
    links = F.transform(
        named,
        lambda c: F.when(
            F.coalesce(c["href"].contains(url_contains), F.lit(False)) & ~c["href"].endswith("#"),
            resolve_url(F.col("url"), c["href"]),
        ),
    )
    return pages.withColumn("__links", links).select(
        *[c for c in pages.columns if c not in (records, cards)],
        F.posexplode(records).alias("position", "record"), "__links",
    ).withColumn("detail_url", F.get("__links", F.col("position"))).drop("__links")


def revealed_contacts(payloads: Column | str, url_part: str = "get-user-mobile") -> Column:
    """First usable phone and e-mail over all captured reveal payloads of a page."""
    body = lambda p: F.from_json(F.when(_is_object(p["body"]), p["body"]),
                                 "default_mobile STRING, default_email STRING")
    hits = F.filter(col(payloads), lambda p: F.coalesce(p["url"].contains(url_part), F.lit(False)))
    parsed = F.transform(hits, body)
    phones = F.array_compact(F.transform(parsed, lambda b: clean_phone(b["default_mobile"])))
    mails = F.array_compact(F.transform(parsed, lambda b: blank_to_null(b["default_email"])))
    return F.struct(
        F.get(phones, F.lit(0)).alias("phone"), F.get(mails, F.lit(0)).alias("email")
    )


__all__ = [
    "Parsed", "page_text", "columnar_listings", "state_json", "state_listings", "best_payload",
    "payload_listings", "json_ld_blocks", "json_ld_listings", "listing_names", "text_listings",
    "site_text_listings", "with_cascade", "explode_listings", "strategy_cascade", "register_parser",
    "parse_pages", "detail_url", "pair_by_position", "revealed_contacts", "REGISTRY",
    "empty_to_null",
]
