"""Crawl frontier, request quotas, pagination and fetch-log reports, all over tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom import constants as K
from leadloom import skew
from leadloom.functions.text import not_blank, present, strip
from leadloom.functions.urls import endpoint_key, page_url


class Frontier(NamedTuple):
    urls: DataFrame
    config_errors: DataFrame


class Pagination(NamedTuple):
    records: DataFrame
    stops: DataFrame


def enabled_targets(targets: DataFrame, known_sites: list[str] | None = None) -> DataFrame:
    """Enabled targets of known sites."""
    site = F.lower("name")
    return targets.where(
        F.coalesce(F.col("enabled"), F.lit(False)) & site.isin(known_sites or K.KNOWN_SITES)
    )


def check_max_pages(targets: DataFrame) -> Column:
    """True when ``max_pages`` is usable: absent, or at least 1."""
    return F.coalesce(F.col("max_pages") >= 1, F.lit(True))


def site_labels(items: DataFrame, sites: dict[str, str]) -> DataFrame:
    """(site, slug, label) for every configured site: the site's own label, else the slug.

    ``sites`` (site -> URL template) is configuration, so it is exploded from a literal. A
    label that is present but empty drops the combination.
    """
    each = F.array(
        *[
            F.struct(F.lit(s).alias("site"), F.lit(i).alias("site_pos"), F.lit(t).alias("template"))
            for i, (s, t) in enumerate(sites.items())
        ]
    )
    label = F.coalesce(F.try_element_at("labels", F.col("site")), F.col("slug"))
    return items.select("*", F.inline(each)).withColumn("label", label).where(present("label"))


def expand_start_urls(
    categories: DataFrame, cities: DataFrame, sites: dict[str, str],
    code_site: str = "tradeindia",
) -> Frontier:
    """Page-1 URL of every (site, category, city); category-major order in ``ordinal``.

    categories/cities: ``pos, slug, labels`` (cities also ``code``). The product of the two
    dimensions is the frontier itself; it is formed per site. A site that needs city codes
    and lacks one is reported whole in ``config_errors`` while the other sites go on; sites
    without a template are skipped.
    """
    sites = {s: t for s, t in sites.items() if t}
    if not sites:
        raise ValueError("no site has a URL template")
    cats = site_labels(categories, sites).select(
        "site", "site_pos", "template", F.col("pos").alias("cat_pos"),
        F.col("slug").alias("category_slug"), F.col("label").alias("cat_label"),
    )
    towns = site_labels(cities, sites).select(
        "site", "template", F.col("pos").alias("city_pos"), F.col("slug").alias("city_slug"),
        F.col("label").alias("city_label"), F.coalesce("code", F.lit("")).alias("code"),
    )
    # At most one row per configured site.
    broken = (
        towns.where((F.col("site") == code_site) & ~present("code"))
        .groupBy("site", "template")
        .agg(F.min_by("city_slug", "city_pos").alias("city_slug"))
    )
    errors = broken.select(
        "site", F.col("template").alias("url"), F.lit("ConfigError").alias("error_type"),
        F.concat(F.lit("missing code for city "), F.col("city_slug")).alias("detail"),
    )
    sound = towns.drop("template").join(F.broadcast(broken.select("site")), "site", "left_anti")
    url = F.replace(F.col("template"), F.lit("{category}"), F.col("cat_label"))
    url = F.replace(url, F.lit("{city}"), F.col("city_label"))
    url = F.replace(url, F.lit("{code}"), F.col("code"))
    return Frontier(
        cats.join(sound, "site").select(
            "site", "category_slug", "city_slug", url.alias("url"),
            F.struct("site_pos", "cat_pos", "city_pos").alias("ordinal"),
        ),
        errors,
    )


def target_config_errors(targets: DataFrame, sites: dict[str, str]) -> DataFrame:
    """Error rows of enabled targets whose ``max_pages`` is unusable."""
    site = F.lower("name")
    template = F.coalesce(
        *[F.when(site == s, F.lit(t)) for s, t in sites.items()], F.lit("")
    )
    bad = enabled_targets(targets, K.PAGINATED_SITES).where(~check_max_pages(targets))
    return bad.select(
        site.alias("site"), template.alias("url"), F.lit("ConfigError").alias("error_type")
    )


def expand_pages(frontier: DataFrame, pages: Column | int, paged: Column | None = None) -> DataFrame:
    """Listing pages 1..pages of every start URL."""
    last = F.lit(pages) if isinstance(pages, int) else pages
    numbered = frontier.where(last >= 1).withColumn("page", F.explode(F.sequence(F.lit(1), last)))
    return numbered.withColumn("page_url", page_url("url", "page", paged))


def daily_quota(
    requests: DataFrame, caps: DataFrame, prior: DataFrame | None = None, hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Flag every request as allowed or denied under its domain's daily cap.

    requests: ``date, domain, seq, ...``; caps: ``domain, cap``; prior: ``date, domain,
    consumed`` from earlier runs of the day. Denied requests consume nothing, so the allowed
    ones are the first ``cap - consumed`` by ``seq``; requests without a date or domain, or of a
    domain without a cap, are denied. Ranking is limited to as many rows per group as the
    largest cap, which Spark prunes before the shuffle; the rank then becomes one cutoff row per
    group, and requests are compared with their cutoff.
    """
    group = ["date", "domain"]
    largest = caps.agg(F.max("cap")).first()[0] or 0
    rank = F.row_number().over(W.partitionBy(*group).orderBy("seq"))
    head = requests.select(*group, "seq").withColumn("rank", rank).where(F.col("rank") <= largest)
    sizes = requests.groupBy(*group).agg(F.count("*").alias("group_rows"))
    limits = sizes.join(caps, "domain", "left")
    if prior is not None:
        limits = limits.join(prior, group, "left")
    else:
        limits = limits.withColumn("consumed", F.lit(0))
    room = F.greatest(
        F.coalesce(F.col("cap"), F.lit(0)) - F.coalesce(F.col("consumed"), F.lit(0)), F.lit(0)
    )
    limits = limits.select(*group, "group_rows", room.alias("room"))
    cutoffs = (
        limits.join(head, group, "left")
        .groupBy(*group, "group_rows", "room")
        .agg(F.max(F.when(F.col("rank") <= F.col("room"), F.col("seq"))).alias("cutoff"))
        .drop("room")
    )
    flagged = skew.attach(requests, cutoffs, group, "group_rows", hot_rows, how="left")
    allowed = F.coalesce(F.col("seq") <= F.col("cutoff"), F.lit(False))
    return flagged.withColumn("allowed", allowed).drop("cutoff")


def quota_report(
    requests: DataFrame, caps: DataFrame, prior: DataFrame | None = None
) -> DataFrame:
    """Budget units used per (date, domain) and whether the cap denied anything.

    Requests without a domain use nothing and count as denied.
    """
    counts = requests.where(~F.coalesce(F.col("domain").startswith("__"), F.lit(False))).groupBy("date", "domain").agg(
        F.count("*").alias("requested")
    )
    if prior is not None:
        counts = counts.join(
            prior.where(~F.col("domain").startswith("__")), ["date", "domain"], "full"
        )
    else:
        counts = counts.withColumn("consumed", F.lit(0))
    asked = F.coalesce(F.col("requested"), F.lit(0))
    before = F.coalesce(F.col("consumed"), F.lit(0))
    cap = F.coalesce(F.col("cap"), F.lit(0))
    used = before + F.least(asked, F.greatest(cap - before, F.lit(0)))
    return counts.join(caps, "domain", "left").select(
        "date", "domain", used.cast("bigint").alias("used"),
        (asked > F.greatest(cap - before, F.lit(0))).alias("cap_reached"),
    )


TARGET = ["site", "category_slug", "city_slug"]


def _target_key() -> Column:
    """One text for a target, absent slugs included; NULL where its site is not paginated."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    return F.when(F.col("site").isin(K.PAGINATED_SITES), F.concat_ws("\u0001", *[part(c) for c in TARGET]))


def early_stop(
    pages: DataFrame, records: DataFrame, max_pages: int | None = None,
    hot_rows: int = skew.HOT_ROWS,
) -> Pagination:
    """Where pagination ends per target, and the records up to there.

    pages: one row per fetched page (``site, category_slug, city_slug, page``); records add
    ``company_name``. A page without records stops as ``empty``; a page without a name unseen
    on earlier pages stops as ``0_new``. Records of the stopping page are kept. Only paginated
    sites are walked page by page: records of others all stay and never stop. Absent slugs are
    values of a target like any other.
    """
    pages, records = pages.withColumn("__target", _target_key()), records.withColumn("__target", _target_key())
    if max_pages is not None:
        within = F.col("__target").isNull() | (F.col("page") <= max_pages)
        pages, records = pages.where(within), records.where(within)
    walked, found = pages.where("__target IS NOT NULL"), records.where("__target IS NOT NULL")
    name = strip(F.lower("company_name"))
    first_page = (
        found.where(not_blank("company_name"))
        .groupBy("__target", name.alias("name"))
        .agg(F.min("page").alias("page"))
    )
    fresh = first_page.groupBy("__target", "page").agg(F.count("*").alias("new_names"))
    rows = found.groupBy("__target", "page").agg(F.count("*").alias("rows"))
    per_page = (
        walked.select("__target", *TARGET, "page").distinct()
        .join(rows, ["__target", "page"], "left")
        .join(fresh, ["__target", "page"], "left")
    )
    ends = F.col("new_names").isNull()
    per_target = per_page.groupBy("__target").agg(
        *[F.first(c).alias(c) for c in TARGET],
        F.min(F.when(ends, F.col("page"))).alias("stop_page"),
        F.min_by(F.when(F.col("rows").isNull(), "empty").otherwise("0_new"),
                 F.when(ends, F.col("page"))).alias("reason"),
        F.sum("rows").alias("target_rows"),
    )
    kept = skew.attach(
        records,
        per_target.select("__target", "stop_page", F.coalesce("target_rows", F.lit(0)).alias("target_rows")),
        ["__target"], "target_rows", hot_rows, how="left",
    )
    kept = kept.where(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page")))
    stops = per_target.where(F.col("stop_page").isNotNull()).drop("target_rows", "__target")
    return Pagination(kept.drop("stop_page", "__target"), stops)


def body_bytes(body: str | Column = "body") -> Column:
    return F.octet_length(F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit("")))


def is_blocked(status: str = "status", body: str = "body") -> Column:
    """Blocked response: a listed status, or 200 with a body under the byte floor."""
    short = (F.col(status) == 200) & (body_bytes(body) < K.BLOCKED_BODY_BYTES)
    return F.coalesce(F.col(status).isin(K.BLOCKED_STATUS_CODES) | short, F.lit(False))


def outcome_summary(fetch_log: DataFrame) -> DataFrame:
    """Per site: distinct blocked endpoints, blocked events with a tiny body, successes.

    ``yielded`` tells whether the page produced records.
    """
    blocked = is_blocked()
    endpoint = F.coalesce(F.nullif(endpoint_key("endpoint"), F.lit("")), F.lit("none"))
    return fetch_log.groupBy("site").agg(
        F.count_distinct(F.when(blocked, endpoint)).alias("blocked_endpoints"),
        F.count_if(blocked & (body_bytes() < K.BLOCKED_BODY_BYTES)).alias("blocked_small"),
        F.count_if(~blocked & F.col("yielded")).alias("succeeded"),
    )


def bytes_fetched(fetch_log: DataFrame) -> DataFrame:
    """Bytes of record-yielding pages per parser, with the total as parser NULL."""
    return (
        fetch_log.where("yielded")
        .rollup("parser")
        .agg(F.sum(body_bytes()).alias("bytes"))
    )


def dedupe_endpoints(endpoints: DataFrame) -> DataFrame:
    """First endpoint per credential-free ``host:port``; blank keys drop out."""
    keyed = endpoints.withColumn("endpoint_key", endpoint_key("endpoint"))
    return (
        keyed.where(present("endpoint_key"))
        .groupBy("endpoint_key")
        .agg(F.min_by("endpoint", "seq").alias("endpoint"), F.min("seq").alias("seq"))
    )
