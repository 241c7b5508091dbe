"""Extraction queries over captured pages."""

from pyspark.sql import functions as F

from leadloom.constants import DIRECTORY_DOMAINS
from leadloom.functions import contacts as C
from leadloom.functions import urls as U
from leadloom.operators import detail as T
from leadloom.operators import extract as E
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import LEADS, clean_phone, not_blank, present, query, strip

_HIDDEN = r"regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
_W = r"\p{L}\p{M}\p{Nd}\p{Pc}"
_DIRECTORY = "|".join(d.replace(".", r"\.") for d in DIRECTORY_DOMAINS)
_HOST = r"regexp_replace(lower(regexp_extract(u, 'https?://([^/?#]+)', 1)), '^www\.', '')"
_URLS = rf"""
SELECT page_id, list(u ORDER BY i) AS websites FROM (
  SELECT page_id, u, min(i) AS i FROM (
    SELECT page_id, rtrim(regexp_replace(u, '\?.*$', ''), '/') AS u, i FROM (
      SELECT page_id, unnest(us) AS u, generate_subscripts(us, 1) AS i FROM (
        SELECT page_id, regexp_extract_all({_HIDDEN}, 'https?://[-{_W}.%+]+[-{_W}/?=&+#]*') AS us FROM pages))
    WHERE contains({_HOST}, '.') AND NOT regexp_matches(regexp_replace({_HOST}, ':.*$', ''), '^(?:.*\.)?(?:{_DIRECTORY})$'))
  GROUP BY page_id, u) GROUP BY page_id"""


@query("extract_websites", f"""
SELECT page_id, coalesce(array_to_string(websites, ' '), '') AS websites FROM pages LEFT JOIN ({_URLS}) USING (page_id)""")
def _(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", F.array_join(C.websites("html"), " ").alias("websites"))


@query("directory_hosts", rf"""
SELECT page_id, regexp_matches(regexp_replace(regexp_replace(lower(regexp_extract(u, '//([^/?#]*)', 1)), '^www\.', ''), ':.*$', ''),
  '^(?:.*\.)?(?:{_DIRECTORY})$') AS is_directory
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://www.facebook.com:443/p' WHEN 1 THEN 'http://notjustdial.com/x'
  WHEN 2 THEN 'https://m.indiamart.com' ELSE url END AS u FROM pages)""")
def _(spark, sf):
    k = F.col("page_id") % 4
    u = (F.when(k == 0, "https://www.facebook.com:443/p").when(k == 1, "http://notjustdial.com/x")
         .when(k == 2, "https://m.indiamart.com").otherwise(F.col("url")))
    return A.table(spark, sf, "pages").select("page_id", U.is_directory_host(u).alias("is_directory"))


@query("page_titles", rf"""
SELECT page_id, 0 AS position, {strip(r"regexp_extract(html, '<h1[^>]*>([^<]+)</h1>', 1)")} AS company_name,
  nullif(regexp_extract(html, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}'), '') AS email, w.websites[1] AS website
FROM pages LEFT JOIN ({_URLS}) w USING (page_id) WHERE regexp_matches(html, '<h1[^>]*>[^<]*[^<\s][^<]*</h1>')""")
def _(spark, sf):
    pages = A.table(spark, sf, "pages")
    found = E.explode_listings(pages, E.text_listings("html", [r"<h1[^>]*>([^<]+)</h1>"]))
    return found.select("page_id", "position", "company_name", "email", "website")


@query("captured_pages", "SELECT page_id, html, strlen(html) AS bytes FROM pages")
def _(spark, sf):
    pages = A.table(spark, sf, "pages").withColumn("raw", F.col("html").cast("binary"))
    return pages.select("page_id", E.page_text("raw", binary=True).alias("html"), F.octet_length("raw").cast("bigint").alias("bytes"))


_OWN_WEB = "CASE WHEN contains(website, 'facebook.com') THEN NULL ELSE website END"
_NAMED = f"SELECT * FROM ({LEADS}) WHERE {not_blank('company_name')}"
_PHONE = clean_phone("phone")


@query("json_ld", f"""
SELECT seq AS page_id, {strip('company_name')} AS company_name, CASE WHEN seq % 9 = 0 THEN NULL ELSE website END AS website,
  nullif(email, '') AS email, {_PHONE} AS phone, address || ', ' || city_slug AS address
FROM ({_NAMED}) WHERE seq % 6 <> 1""")
def _(spark, sf):
    pages = A.json_ld_pages(spark, sf)
    found = E.explode_listings(pages, E.json_ld_listings("html"))
    return found.select("page_id", "company_name", "website", "email", "phone", "address")


_PLACE = f"SELECT *, seq // 10 AS page_id FROM ({_NAMED})"
_AD_PHONE = f"""
ads AS (SELECT page_id, company_name AS ad_name, arg_max(phone, seq) AS ad_phone FROM p WHERE {not_blank('phone')} GROUP BY ALL)"""


@query("state_payload", f"""
WITH p AS ({_PLACE}), {_AD_PHONE}
SELECT p.page_id, row_number() OVER (PARTITION BY p.page_id ORDER BY seq) - 1 AS position, company_name,
  CASE WHEN seq % 2 = 1 THEN website END AS website, {clean_phone('ad_phone')} AS phone,
  concat_ws(', ', address, city_slug) AS address, industry_code,
  CASE WHEN seq % 2 = 0 THEN 'https://www.indiamart.com/c' || seq || '/' END AS detail_url
FROM p LEFT JOIN ads ON p.page_id = ads.page_id AND company_name = ad_name""")
def _(spark, sf):
    found = E.explode_listings(A.state_pages(spark, sf), E.state_listings("html"))
    return found.select(
        "page_id", F.col("position").cast("bigint").alias("position"), "company_name", "website", "phone",
        "address", "industry_code", "detail_url",
    )


@query("columnar_payload", f"""
WITH p AS ({_PLACE})
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY seq) - 1 AS position, company_name,
  nullif(CASE WHEN seq % 2 = 0 THEN {strip('email')} ELSE email END, '') AS email,
  website, {_PHONE} AS phone, concat_ws(', ', address, city_slug) AS address, industry_code
FROM p""")
def _(spark, sf):
    found = E.explode_listings(A.columnar_pages(spark, sf), E.columnar_listings("html"))
    return found.select(
        "page_id", F.col("position").cast("bigint").alias("position"), "company_name", "email", "website", "phone",
        "address", "industry_code",
    )


@query("payload_pick", f"""
WITH p AS ({_PLACE})
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY seq) - 1 AS position, company_name,
  nullif({strip('email')}, '') AS email, website, {_PHONE} AS phone, concat_ws(', ', address, city_slug) AS address, industry_code
FROM p""")
def _(spark, sf):
    found = E.explode_listings(A.payload_pages(spark, sf), E.payload_listings("payloads"))
    return found.select(
        "page_id", F.col("position").cast("bigint").alias("position"), "company_name", "email", "website", "phone",
        "address", "industry_code",
    )


@query("strategy_cascade", f"""
WITH p AS ({_PLACE}), {_AD_PHONE}
SELECT p.page_id, 'state' AS strategy, company_name, {clean_phone('ad_phone')} AS phone, CAST(NULL AS VARCHAR) AS email
FROM p LEFT JOIN ads ON p.page_id = ads.page_id AND company_name = ad_name WHERE p.page_id % 3 = 0
UNION ALL SELECT DISTINCT page_id, 'text', company_name, '9876543210', 'info@contact.in' FROM p WHERE page_id % 3 = 1""")
def _(spark, sf):
    found = E.strategy_cascade(A.cascade_pages(spark, sf), "indiamart")
    return found.select("page_id", "strategy", "company_name", "phone", "email")


@query("parser_registry", f"""
WITH p AS ({_PLACE})
SELECT 'records' AS kind, 'parse_indiamart' AS parser, count(*) AS n FROM (
  SELECT seq::VARCHAR FROM p WHERE page_id % 3 = 0 UNION ALL SELECT DISTINCT page_id || company_name FROM p WHERE page_id % 3 = 1)
UNION ALL SELECT 'UnknownParser', 'parse_other', count(DISTINCT seq // 10) FROM ({LEADS}) WHERE (seq // 10) % 3 = 2""")
def _(spark, sf):
    pages = A.cascade_pages(spark, sf).withColumn(
        "parser", F.when(F.col("page_id") % 3 == 2, "parse_other").otherwise("parse_indiamart")
    )
    parsed = E.parse_pages(pages)
    records = parsed.records.groupBy(F.lit("records").alias("kind"), "parser").agg(F.count("*").alias("n"))
    errors = parsed.errors.groupBy(F.col("error_type").alias("kind"), F.lit("parse_other").alias("parser")).agg(F.count("*").alias("n"))
    return records.unionByName(errors)


@query("detail_urls", rf"""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/company/' || page_id
  WHEN 1 THEN 'https://other.example.com/' || page_id WHEN 2 THEN NULL
  WHEN 3 THEN regexp_extract(url, '^(https?:)', 1) || '//cdn.example.com/x'
  ELSE coalesce(nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(https?://[^/?#]*/.*/)', 1), ''),
    regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/') || 'co-' || page_id END AS detail_url FROM pages""")
def _(spark, sf):
    k, n = F.col("page_id") % 5, F.col("page_id").cast("string")
    href = (F.when(k == 0, F.concat(F.lit("/a/../company/./"), n)).when(k == 1, F.concat(F.lit(" https://other.example.com/"), n))
            .when(k == 2, "mailto:x@y.in").when(k == 3, "//cdn.example.com/x").otherwise(F.concat(F.lit("co-"), n)))
    return A.table(spark, sf, "pages").select("page_id", E.detail_url("url", href).alias("detail_url"))


@query("positional_pairs", f"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq) - 1 AS position FROM ({_PLACE}))
SELECT page_id, position, company_name, CASE WHEN seq % 3 <> 0 THEN 'https://dir.indiamart.com/p/' || seq END AS detail_url FROM p""")
def _(spark, sf):
    from leadloom.functions.text import not_blank as filled

    page = F.floor(F.col("seq") / 10).cast("bigint").alias("page_id")
    k = F.col("seq").cast("string")
    href = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("/p/"), k, F.lit("#"))).otherwise(F.concat(F.lit("/p/indiamart/../"), k))
    leads = A.leads(spark, sf).groupBy(page).agg(
        F.array_sort(F.collect_list(F.struct("seq", F.col("company_name").alias("name"), href.alias("href")))).alias("cards"),
        F.array_sort(F.collect_list(F.when(filled("company_name"), F.struct("seq", "company_name")))).alias("records"),
    ).withColumn("url", F.lit("https://dir.indiamart.com/list/1"))
    return E.pair_by_position(leads, "/p/").select(
        "page_id", F.col("position").cast("bigint").alias("position"), "record.company_name", "detail_url"
    )


@query("reveal_merge", f"""
SELECT seq AS page_id, {_PHONE} AS phone, nullif({strip('email')}, '') AS email FROM ({LEADS})""")
def _(spark, sf):
    call = lambda **kw: F.to_json(F.struct(*[v.alias(k) for k, v in kw.items()]))
    payload = lambda url, body: F.struct(F.lit(url).alias("url"), body.alias("body"))
    payloads = F.array(
        payload("https://x.example.com/other", F.lit('{"default_mobile":"9999999999"}')),
        payload("https://x.example.com/get-user-mobile?1", F.lit("not json")),
        payload("https://x.example.com/get-user-mobile?2", call(default_mobile=F.lit("0"), default_email=F.col("email"))),
        payload("https://x.example.com/get-user-mobile?3", call(default_mobile=F.col("phone"))),
    )
    rows = A.leads(spark, sf).select("seq", payloads.alias("payloads"))
    return rows.select(F.col("seq").alias("page_id"), E.revealed_contacts("payloads")["phone"].alias("phone"),
                       E.revealed_contacts("payloads")["email"].alias("email"))


def _records(spark, sf):
    return A.leads(spark, sf).select(
        F.col("seq").alias("record_id"), "seq", "company_name", "phone", "email", "website",
        F.concat(F.lit("https://dir.indiamart.com/p/"), F.col("seq").cast("string")).alias("detail_url"),
    )


_NEEDY = f"NOT ({present('phone')} AND {present('email')})"
_FETCHED = f"(seq % 3 = 0 AND {_NEEDY} AND seq % 12 <> 0)"
_D_PHONE = "'98' || lpad(CAST(seq % 1000 AS VARCHAR), 8, '0')"
_ENRICHED = f"""
SELECT seq AS record_id, (seq % 3 = 0 AND {_NEEDY}) AS attempted, {_FETCHED} AS fetched,
  CASE WHEN NOT {_FETCHED} THEN phone WHEN seq % 12 = 3 THEN nullif(CASE WHEN false THEN phone END, '') ELSE {_D_PHONE} END AS phone,
  CASE WHEN NOT {_FETCHED} THEN email WHEN seq % 12 = 3 THEN NULL ELSE 'detail' || seq || '@shop.in' END AS email,
  CASE WHEN NOT {_FETCHED} THEN website WHEN seq % 12 = 3 THEN nullif(website, '') ELSE 'https://shop' || seq || '.in' END AS website
FROM ({LEADS})"""


@query("detail_enrich", _ENRICHED)
def _(spark, sf):
    merged = T.enrich(_records(spark, sf), T.detail_contacts(A.detail_pages(spark, sf)))
    return merged.select("record_id", "attempted", "fetched", "phone", "email", "website")


@query("detail_fill_only", f"""
SELECT seq AS record_id, CASE WHEN {_FETCHED} AND seq % 12 <> 3 THEN coalesce(nullif(phone, ''), {_D_PHONE})
    WHEN {_FETCHED} THEN CASE WHEN coalesce(nullif(phone, ''), '01146710423') <> '01146710423' THEN phone END ELSE phone END AS phone,
  CASE WHEN {_FETCHED} THEN coalesce(nullif(website, ''), CASE WHEN seq % 12 <> 3 THEN 'https://shop' || seq || '.in' END) ELSE website END AS website
FROM ({LEADS})""")
def _(spark, sf):
    merged = T.enrich(_records(spark, sf), T.detail_contacts(A.detail_pages(spark, sf)), detail_wins=False)
    return merged.select("record_id", "phone", "website")


@query("detail_budget", f"SELECT seq AS record_id FROM ({LEADS}) WHERE {_NEEDY} ORDER BY seq LIMIT 20")
def _(spark, sf):
    return T.select_needy(_records(spark, sf)).select("record_id")


@query("phone_backfill", f"""
SELECT seq AS record_id, coalesce(nullif(phone, ''), CASE WHEN seq % 3 = 0 AND seq % 12 NOT IN (0, 3) THEN {_D_PHONE} END) AS phone
FROM ({LEADS})""")
def _(spark, sf):
    return T.backfill_phone(_records(spark, sf), A.detail_pages(spark, sf)).select("record_id", "phone")


@query("enrich_stats", f"""
SELECT count(*) FILTER (WHERE attempted) AS attempted, count(*) FILTER (WHERE fetched) AS fetched,
  count(*) FILTER (WHERE attempted AND NOT fetched) AS fetch_failed,
  count(*) FILTER (WHERE fetched AND NOT {present('phone')}) AS phone_unavailable,
  count(*) FILTER (WHERE fetched AND NOT {present('email')}) AS email_unavailable,
  count(*) FILTER (WHERE fetched AND NOT {present('website')}) AS website_unavailable FROM ({_ENRICHED})""")
def _(spark, sf):
    return T.enrich_stats(T.enrich(_records(spark, sf), T.detail_contacts(A.detail_pages(spark, sf))))
