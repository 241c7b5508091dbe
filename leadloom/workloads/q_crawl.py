"""Frontier, quota, pagination and fetch-log queries."""

import uuid

from pyspark.sql import functions as F

from leadloom.functions.urls import page_url
from leadloom.operators import frontier as R
from leadloom.operators.report import early_stop_report
from leadloom.plans.quota_run import quota_run
from leadloom.session import ensure_checkpoint_dir
from leadloom.sources.tables import TableStore
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import FETCH_LOG, LISTINGS, TARGETS, not_blank, query, strip

SITES = {
    "indiamart": "https://dir.example.com/{city}/{category}.html",
    "tradeindia": "https://www.example.in/{city}-{code}/{category}/",
    "blank": "",
}


def _categories(spark, sf):
    seg = A.table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.min("c_custkey").alias("pos"))
    slug = F.lower("c_mktsegment")
    return seg.select(
        "pos", slug.alias("slug"),
        F.create_map(
            F.lit("indiamart"), F.concat(slug, F.lit("-services")),
            F.when(slug == "machinery", F.lit("tradeindia")).otherwise(F.lit("other")), F.lit(""),
        ).alias("labels"),
    )


def _cities(spark, sf, missing_code=False):
    n = F.col("n_nationkey")
    code = F.when((n == 7) & F.lit(missing_code), "").otherwise(F.concat(F.lit("22"), n.cast("string")))
    return A.table(spark, sf, "nation").select(
        n.alias("pos"), F.lower("n_name").alias("slug"),
        F.create_map(F.lit("tradeindia"), F.initcap("n_name")).alias("labels"), code.alias("code"),
    )


_CATS = "cats AS (SELECT DISTINCT lower(c_mktsegment) AS category_slug FROM customer)"
_TOWNS = "towns AS (SELECT lower(n_name) AS city_slug, upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS label, '22' || n_nationkey AS code FROM nation)"
_URLS = f"""
SELECT 'indiamart' AS site, category_slug, city_slug,
  'https://dir.example.com/' || city_slug || '/' || category_slug || '-services.html' AS url FROM cats, towns"""
_TI_URLS = """
SELECT 'tradeindia', category_slug, city_slug, 'https://www.example.in/' || label || '-' || code || '/' || category_slug || '/'
FROM cats, towns WHERE category_slug <> 'machinery'"""


@query("frontier", f"WITH {_CATS}, {_TOWNS} {_URLS} UNION ALL {_TI_URLS}")
def _(spark, sf):
    return R.expand_start_urls(_categories(spark, sf), _cities(spark, sf), SITES).urls.drop("ordinal")


@query("frontier_config_error", f"""
WITH {_CATS}, {_TOWNS} SELECT site, city_slug AS detail, url FROM (
  SELECT site, category_slug, city_slug, url FROM ({_URLS}))
UNION ALL SELECT 'tradeindia', 'missing code for city nation_7', 'https://www.example.in/{{city}}-{{code}}/{{category}}/'""")
def _(spark, sf):
    out = R.expand_start_urls(_categories(spark, sf), _cities(spark, sf, True), SITES)
    good = out.urls.select("site", F.col("city_slug").alias("detail"), "url")
    return good.unionByName(out.config_errors.select("site", "detail", "url"))


@query("enabled_targets", f"""
SELECT lower(name) AS site FROM ({TARGETS}) WHERE enabled AND lower(name) IN ('justdial', 'indiamart', 'tradeindia')""")
def _(spark, sf):
    return R.enabled_targets(A.targets(spark, sf)).select(F.lower("name").alias("site"))


@query("target_config_errors", f"""
SELECT lower(name) AS site, CASE lower(name) WHEN 'indiamart' THEN '{SITES['indiamart']}' ELSE '{SITES['tradeindia']}' END AS url,
  'ConfigError' AS error_type FROM ({TARGETS}) WHERE enabled AND lower(name) IN ('indiamart', 'tradeindia') AND pos - 101 < 1""")
def _(spark, sf):
    targets = A.targets(spark, sf).withColumn("max_pages", F.col("pos") - 101)
    return R.target_config_errors(targets, SITES)


@query("page_urls", rf"""
SELECT page_id, page, CASE WHEN page <= 1 THEN url ELSE rtrim(url, '/') || '?page=' || page END AS page_url
FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') || '/' AS url FROM pages), range(1, 5) AS r(page)
WHERE page <= 1 + page_id % 4""")
def _(spark, sf):
    base = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/"))
    pages = A.table(spark, sf, "pages").select("page_id", base.alias("url"))
    last = (1 + F.col("page_id") % 4).cast("int")
    return R.expand_pages(pages, last).select("page_id", F.col("page").cast("bigint").alias("page"), "page_url")


_CAPS = """
caps AS (SELECT 'site' || n_nationkey || '.example.com' AS domain, CASE WHEN n_nationkey % 5 = 0 THEN 40 + n_nationkey ELSE 6 + n_nationkey % 7 END AS cap FROM nation),
prior AS (SELECT '2024-01-01' AS date, domain, cap % 4 AS consumed FROM caps)"""


@query("daily_quota", f"""
WITH log AS ({FETCH_LOG}), {_CAPS}
SELECT seq, log.date, log.domain, coalesce(row_number() OVER (PARTITION BY log.date, log.domain ORDER BY seq)
  <= greatest(cap - coalesce(consumed, 0), 0), false) AS allowed
FROM log LEFT JOIN caps USING (domain) LEFT JOIN prior ON prior.date = log.date AND prior.domain = log.domain""")
def _(spark, sf):
    flagged = R.daily_quota(
        A.fetch_log(spark, sf).select("seq", "date", "domain"), A.caps(spark, sf), A.prior(spark, sf)
    )
    return flagged.select("seq", "date", "domain", "allowed")


@query("quota_two_runs", f"""
WITH log AS ({FETCH_LOG}), {_CAPS}
SELECT seq, log.date, log.domain, coalesce(row_number() OVER (PARTITION BY log.date, log.domain ORDER BY seq % 2, seq)
  <= greatest(cap - coalesce(consumed, 0), 0), false) AS allowed
FROM log LEFT JOIN caps USING (domain) LEFT JOIN prior ON prior.date = log.date AND prior.domain = log.domain""")
def _(spark, sf):
    """Half of the requests in one run, half in the next; the second starts from what the first consumed."""
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark)}/quota-{uuid.uuid4().hex}")
    log = A.fetch_log(spark, sf).select("seq", "date", "domain")
    no_rows = spark.createDataFrame([], store.schemas["request_decisions"])
    store.overwrite_together("quota", {"request_counts": A.prior(spark, sf), "request_decisions": no_rows})
    runs = [quota_run(store, log.where(half), A.caps(spark, sf), keep_days=100_000) for half in ("seq % 2 = 0", "seq % 2 = 1")]
    return runs[0].unionByName(runs[1])


@query("quota_report", f"""
WITH log AS ({FETCH_LOG}), {_CAPS}, asked AS (SELECT date, domain, count(*) AS requested FROM log GROUP BY 1, 2)
SELECT date, domain, coalesce(consumed, 0) + least(coalesce(requested, 0), greatest(coalesce(cap, 0) - coalesce(consumed, 0), 0)) AS used,
  coalesce(requested, 0) > greatest(coalesce(cap, 0) - coalesce(consumed, 0), 0) AS cap_reached
FROM asked FULL JOIN prior USING (date, domain) LEFT JOIN caps USING (domain)""")
def _(spark, sf):
    return R.quota_report(A.fetch_log(spark, sf), A.caps(spark, sf), A.prior(spark, sf))


_STOPS = f"""
rec AS (SELECT *, {strip('lower(company_name)')} AS name, site || '|' || coalesce('=' || category_slug, '') || '|' || coalesce('=' || city_slug, '') AS k
  FROM ({LISTINGS})),
walk AS (SELECT * FROM rec WHERE site IN ('indiamart', 'tradeindia')),
tg AS (SELECT DISTINCT k, site, category_slug, city_slug FROM walk),
pg AS (SELECT tg.*, CAST(r.page AS INT) AS page FROM tg, range(1, 14) AS r(page)),
firsts AS (SELECT k, name, min(page) AS page FROM walk WHERE {not_blank('company_name')} GROUP BY ALL),
per AS (SELECT pg.*,
    (SELECT count(*) FROM walk r WHERE r.k = pg.k AND r.page = pg.page) AS n,
    (SELECT count(*) FROM firsts f WHERE f.k = pg.k AND f.page = pg.page) AS fresh
  FROM pg),
stops AS (SELECT k, site, category_slug, city_slug, min(page) AS stop_page,
    CASE WHEN arg_min(n, page) = 0 THEN 'empty' ELSE '0_new' END AS reason FROM per WHERE fresh = 0 GROUP BY ALL)"""


def _pagination(spark, sf):
    records = A.listings(spark, sf)
    pages = (
        records.select(*R.TARGET).distinct()
        .withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(13))))
    )
    return R.early_stop(pages, records)


@query("early_stop", f"""
WITH {_STOPS} SELECT seq, rec.site, rec.page FROM rec LEFT JOIN stops USING (k)
WHERE stop_page IS NULL OR rec.page <= stop_page""")
def _(spark, sf):
    return _pagination(spark, sf).records.select("seq", "site", "page")


@query("early_stop_report", f"WITH {_STOPS} SELECT site, category_slug, city_slug, reason FROM stops ORDER BY 1, 2, 3")
def _(spark, sf):
    return early_stop_report(_pagination(spark, sf).stops)


_BLOCKED = """(status IN (401, 403, 407, 429, 444, 500, 502, 503, 504)
  OR (status = 200 AND strlen(coalesce(body, '')) < 500))"""


@query("blocked", f"SELECT seq, status, {_BLOCKED} AS blocked FROM ({FETCH_LOG})")
def _(spark, sf):
    return A.fetch_log(spark, sf).select("seq", "status", R.is_blocked().alias("blocked"))


@query("outcomes", rf"""
SELECT site, count(DISTINCT CASE WHEN {_BLOCKED} THEN coalesce(regexp_extract(endpoint, '@(.*)$', 1), 'none') END) AS blocked_endpoints,
  count(*) FILTER (WHERE {_BLOCKED} AND strlen(coalesce(body, '')) < 500) AS blocked_small,
  count(*) FILTER (WHERE NOT {_BLOCKED} AND yielded) AS succeeded
FROM ({FETCH_LOG}) GROUP BY site""")
def _(spark, sf):
    return R.outcome_summary(A.fetch_log(spark, sf))


@query("bytes_fetched", f"""
SELECT parser, CAST(sum(strlen(coalesce(body, ''))) AS BIGINT) AS bytes FROM ({FETCH_LOG}) WHERE yielded GROUP BY ROLLUP (parser)""")
def _(spark, sf):
    return R.bytes_fetched(A.fetch_log(spark, sf))


@query("paged_sites", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN rtrim(url, '/') || '?page=3' ELSE url END AS page_url FROM pages""")
def _(spark, sf):
    paged = F.col("page_id") % 2 == 0
    return A.table(spark, sf, "pages").select("page_id", page_url("url", F.lit(3), paged).alias("page_url"))
