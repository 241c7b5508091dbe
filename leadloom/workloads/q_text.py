"""Scalar and projection queries."""

from pyspark.sql import functions as F

from leadloom.functions import contacts as C
from leadloom.functions import names as N
from leadloom.functions import text as X
from leadloom.functions import urls as U
from leadloom.operators.frontier import dedupe_endpoints
from leadloom.operators.leads import enrichment_count, raw_to_lead, with_violations
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import (
    EMAIL,
    LEADS,
    LEGACY,
    blank_to_null,
    clean_phone,
    digits,
    entity_key,
    fuzzy_norm,
    norm,
    not_blank,
    query,
    site_key,
    source_name,
    strip,
    valid_email,
)

ENDPOINTS = """
SELECT event_id AS seq,
  CASE event_id % 5 WHEN 0 THEN 'http://user:pw@10.1.0.' || CAST(user_id % 40 AS STRING) || ':8080/path'
    WHEN 1 THEN ' 10.1.0.' || CAST(user_id % 40 AS STRING) || ':8080 '
    WHEN 2 THEN 'https://10.1.0.' || CAST(user_id % 40 AS STRING) WHEN 3 THEN '  ' ELSE NULL END AS endpoint
FROM {events}
"""
_ENDPOINT_KEY = (
    rf"regexp_replace(regexp_extract(CASE WHEN contains({strip('endpoint')}, '://') THEN {strip('endpoint')} "
    rf"ELSE 'http://' || {strip('endpoint')} END, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)', 1), '^.*@', '')"
)
_ENDPOINT_KEY = f"CASE WHEN {not_blank('endpoint')} THEN {_ENDPOINT_KEY} ELSE '' END"


@query("raw_to_lead", f"""
WITH leads AS ({LEADS})
SELECT seq, {site_key('website')} AS dedup_key, {source_name('source_url')} AS source,
  category_slug, city_slug, '{A.AS_OF}' AS first_seen FROM leads""")
def _(spark, sf):
    leads = raw_to_lead(A.leads(spark, sf), A.AS_OF)
    return leads.select(
        "seq", "dedup_key", F.get("sources", F.lit(0)).alias("source"), "category_slug", "city_slug",
        F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"),
    )


@query("normalize_domain", rf"""
SELECT page_id, rtrim(regexp_replace({strip('lower(url)')}, '^www\.', ''), '/') AS domain FROM pages
UNION ALL
SELECT -1 - seq, rtrim(regexp_replace({strip('lower(w)')}, '^www\.', ''), '/')
FROM (SELECT seq, regexp_replace(website, '^https://', '') AS w FROM ({LEADS}))""")
def _(spark, sf):
    pages = A.table(spark, sf, "pages").select("page_id", U.normalize_domain("url").alias("domain"))
    bare = F.regexp_replace("website", "^https://", "")
    rows = A.leads(spark, sf).select(
        (-1 - F.col("seq")).alias("page_id"), U.normalize_domain(bare).alias("domain")
    )
    return pages.unionByName(rows)


@query("source_name", f"""
SELECT seq, {source_name('source_url')} AS source,
  coalesce({source_name('lower(source_url)')}, 'Unknown') AS migrate_label,
  coalesce({source_name('source_url')}, CASE WHEN contains(source_url, '//') THEN split_part(source_url, '/', 3) END, 'Unknown') AS dashboard_label,
  CASE WHEN contains(source_url, 'justdial') THEN 'justdial' WHEN contains(source_url, 'indiamart') THEN 'indiamart'
    WHEN contains(source_url, 'tradeindia') THEN 'tradeindia' ELSE 'unknown' END AS slug
FROM ({LEADS})""")
def _(spark, sf):
    return A.leads(spark, sf).select(
        "seq", U.source_name("source_url").alias("source"),
        U.source_label("source_url", "migrate").alias("migrate_label"),
        U.source_label("source_url", "dashboard").alias("dashboard_label"),
        U.source_label("source_url", "slug").alias("slug"),
    )


@query("flag_email", f"""
SELECT seq, {valid_email('email')} AS valid,
  CASE WHEN {valid_email('email')} THEN {strip('email')}
    WHEN {not_blank('email')} THEN 'UNVERIFIED:' || {strip('email')} END AS flagged
FROM ({LEADS})""")
def _(spark, sf):
    return A.leads(spark, sf).select(
        "seq", C.is_valid_email("email").alias("valid"), C.flag_invalid_email("email").alias("flagged")
    )


@query("company_norm", f"SELECT seq, {norm('company_name')} AS name FROM ({LEADS})")
def _(spark, sf):
    return A.leads(spark, sf).select("seq", N.normalize_company_name("company_name").alias("name"))


@query("fuzzy_norm", f"SELECT seq, {fuzzy_norm('company_name')} AS name FROM ({LEADS})")
def _(spark, sf):
    return A.leads(spark, sf).select("seq", N.fuzzy_normalize_company_name("company_name").alias("name"))


@query("entity_key", f"""
SELECT seq, {entity_key('company_name', blank_to_null('phone'), 'website')} AS entity_key FROM ({LEADS})""")
def _(spark, sf):
    key = N.entity_key("company_name", X.blank_to_null("phone"), "website")
    return A.leads(spark, sf).select("seq", key.alias("entity_key"))


_PRIMARY = (
    rf"coalesce(nullif({digits(blank_to_null('phone'))}, ''), "
    rf"trim(regexp_replace({blank_to_null('email')}, '\s+', ' ', 'g')), "
    rf"trim(regexp_replace({blank_to_null('website')}, '\s+', ' ', 'g')), '')"
)


@query("raw_record_id", f"""
SELECT seq, {_PRIMARY} AS primary_contact,
  lower(concat_ws('|', {source_name('source_url')}, company_name, {_PRIMARY})) AS raw_record_id
FROM ({LEADS})""")
def _(spark, sf):
    primary = N.primary_contact(*[X.blank_to_null(c) for c in ("phone", "email", "website")])
    return A.leads(spark, sf).select(
        "seq", primary.alias("primary_contact"),
        N.raw_record_id(U.source_name("source_url"), "company_name", primary).alias("raw_record_id"),
    )


@query("record_violations", rf"""
SELECT seq, {strip('company_name')} AS company_name,
  concat_ws('; ', CASE WHEN NOT {not_blank('company_name')} THEN 'company_name must not be empty' END,
    CASE WHEN w <> '' AND NOT regexp_matches(w, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]') THEN 'Invalid URL: ' || w END,
    CASE WHEN s < 0 OR s > 100 THEN 'lead_score must be between 0 and 100' END) AS violations
FROM (SELECT seq, company_name, CASE WHEN seq % 13 = 0 THEN regexp_replace(website, '^https:', '') ELSE website END AS w,
  seq % 120 - 5 AS s FROM ({LEADS}))""")
def _(spark, sf):
    leads = A.leads(spark, sf).withColumns({
        "website": F.when(F.col("seq") % 13 == 0, F.regexp_replace("website", "^https:", "")).otherwise(F.col("website")),
        "lead_score": (F.col("seq") % 120 - 5).cast("int"),
    })
    return with_violations(leads).select(
        "seq", "company_name", F.array_join("violations", "; ").alias("violations")
    )


@query("hash_bucket", """
SELECT c_custkey, CAST(('0x' || substr(md5(c_name), 1, 8))::BIGINT % 10 AS BIGINT) AS city_bucket,
  CAST((('0x' || substr(md5(c_name), 1, 8))::BIGINT // 10) % 10 AS BIGINT) AS category_bucket FROM customer""")
def _(spark, sf):
    return A.table(spark, sf, "customer").select(
        "c_custkey", N.hash_bucket("c_name", 10).cast("bigint").alias("city_bucket"),
        N.hash_bucket("c_name", 10, 10).cast("bigint").alias("category_bucket"),
    )


@query("legacy_key", f"""
SELECT seq, md5(lower({strip("coalesce(company_name, 'None') || '|' || coalesce(website, 'None')")})) AS legacy_key
FROM ({LEADS})""")
def _(spark, sf):
    return A.leads(spark, sf).select("seq", N.legacy_key("company_name", "website").alias("legacy_key"))


_LINE = "split_part(coalesce(text, ''), chr(10), 1)"


@query("legacy_key_folded", rf"""
SELECT doc_id, md5(regexp_replace(strip_accents(lower({strip(f"{_LINE} || '|' || coalesce(source, 'None')")})), '[^\x00-\x7F]', '', 'g')) AS legacy_key
FROM documents""")
def _(spark, sf):
    """Names in four languages: the first line of every document."""
    name = F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1))
    rows = A.table(spark, sf, "documents").select("doc_id", name.alias("name"), "source")
    return rows.select("doc_id", N.legacy_key("name", "source").alias("legacy_key"))


_CODE = f"upper(replace(replace({strip('industry')}, ' ', '_'), '/', '_'))"


@query("industry_code", f"""
SELECT seq, CASE WHEN {strip('industry')} IN ('', 'N/A', 'n/a') THEN NULL
  WHEN length({_CODE}) > 50 THEN substr(md5({_CODE}), 1, 16) ELSE {_CODE} END AS code
FROM ({LEGACY})""")
def _(spark, sf):
    return A.legacy_rows(spark, sf).select("seq", N.industry_code("industry").alias("code"))


@query("contacts_from_row", f"""
SELECT seq,
  array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(coalesce(phone, ''), '[0-9]{{6,15}}'),
    regexp_extract_all(coalesce(phone1, ''), '[0-9]{{6,15}}')))), ',') AS phones,
  array_to_string(list_sort(list_distinct(list_transform(
    regexp_extract_all(coalesce(email, '') || '|' || coalesce(raw_email, ''), '{EMAIL}'), lambda x: lower(x)))), ',') AS emails,
  nullif(trim(concat_ws(' ', nullif(address, ''), nullif(locality, ''), nullif(city, ''))), '') AS address
FROM ({LEGACY})""")
def _(spark, sf):
    rows = A.legacy_rows(spark, sf)
    return rows.select(
        "seq", F.array_join(N.legacy_phones(rows.columns), ",").alias("phones"),
        F.array_join(N.legacy_emails("email", "raw_email"), ",").alias("emails"),
        N.legacy_address("address", "locality", "city").alias("address"),
    )


@query("endpoint_keys", f"SELECT seq, {_ENDPOINT_KEY} AS endpoint_key FROM ({ENDPOINTS.format(events='events')})")
def _(spark, sf):
    rows = spark.sql(ENDPOINTS, events=A.table(spark, sf, "events"))
    return rows.select("seq", U.endpoint_key("endpoint").alias("endpoint_key"))


@query("endpoint_dedupe", f"""
SELECT endpoint_key, arg_min(endpoint, seq) AS endpoint, min(seq) AS seq FROM (
  SELECT *, {_ENDPOINT_KEY} AS endpoint_key FROM ({ENDPOINTS.format(events='events')}))
WHERE endpoint_key <> '' GROUP BY endpoint_key""")
def _(spark, sf):
    return dedupe_endpoints(spark.sql(ENDPOINTS, events=A.table(spark, sf, "events")))


@query("enrichment_count", f"""
SELECT seq, (employee_count IS NOT NULL)::INT + (revenue_band IS NOT NULL)::INT AS fields FROM ({LEADS})""")
def _(spark, sf):
    return A.leads(spark, sf).select("seq", enrichment_count().alias("fields"))


@query("extract_emails", f"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '{EMAIL}'), ',') AS emails,
  nullif(regexp_extract(text, '{EMAIL}'), '') AS first_email FROM documents""")
def _(spark, sf):
    return A.table(spark, sf, "documents").select(
        "doc_id", F.array_join(C.emails("text"), ",").alias("emails"), C.first_email("text").alias("first_email")
    )


# Whole document texts, each followed by one phone-like passage.
CALLS = """
SELECT doc_id, text || CASE doc_id % 8
  WHEN 0 THEN ' call 98765' || lpad(CAST(doc_id % 100000 AS STRING), 5, '0') || ' now'
  WHEN 1 THEN ' call +91 87654' || lpad(CAST(doc_id % 100000 AS STRING), 5, '0') || ' now'
  WHEN 2 THEN ' call +1-555-12' || lpad(CAST(doc_id % 100000 AS STRING), 5, '0') || ' now'
  WHEN 3 THEN ' call 011-234' || lpad(CAST(doc_id % 100000 AS STRING), 5, '0') || ' now'
  WHEN 4 THEN ' pin 12' || CAST(doc_id % 1000 AS STRING) || '.'
  WHEN 5 THEN ' id_9876543210' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0')
  WHEN 6 THEN ' 0' || '22 9' || lpad(CAST(doc_id % 100000 AS STRING), 6, '0') || ' or 7' || lpad(CAST(doc_id % 1000 AS STRING), 9, '0') || ';'
  ELSE '' END AS text
FROM {documents}
"""


def _capture(pattern: str) -> str:
    found = rf"regexp_extract(text, '(?:^|[^0-9])({pattern})(?:[^0-9]|$)', 1)"
    return f"regexp_replace({found}, '[^0-9+]', '', 'g')"


_MOBILE = _capture(r"(?:\+?91[-\s]?)?[6-9][0-9]{9}")
_FOREIGN = _capture(r"\+[0-9]{1,3}[-\s]?[0-9]{1,4}[-\s]?[0-9]{6,8}")
_LANDLINE = _capture(r"0[0-9]{2,4}[-\s]?[0-9]{6,8}")


@query("extract_phone", f"""
SELECT doc_id, substr(CASE WHEN length({_MOBILE}) >= 10 THEN {_MOBILE} WHEN length({_FOREIGN}) >= 10 THEN {_FOREIGN}
  ELSE nullif({_LANDLINE}, '') END, 1, 15) AS phone, nullif(substr({_MOBILE}, 1, 15), '') AS mobile
FROM ({CALLS.format(documents='documents')})""")
def _(spark, sf):
    texts = spark.sql(CALLS, documents=A.table(spark, sf, "documents"))
    return texts.select("doc_id", C.first_phone("text").alias("phone"), C.first_mobile("text").alias("mobile"))


@query("clean_phone", f"""
SELECT seq, {clean_phone('p')} AS phone,
  CASE WHEN {clean_phone('p')} <> '01146710423' THEN {clean_phone('p')} END AS own_phone,
  CASE WHEN e <> 'helpdesk@tradeindia.com' THEN e END AS own_email
FROM (SELECT seq, CASE WHEN seq % 10 = 0 THEN '011-4671 0423' WHEN seq % 10 = 1 THEN '-' WHEN seq % 10 = 2 THEN '12 34'
    WHEN seq % 10 = 3 THEN phone || ' / ' || phone ELSE phone END AS p,
  CASE WHEN seq % 9 = 0 THEN 'helpdesk@tradeindia.com' ELSE email END AS e FROM ({LEADS}))""")
def _(spark, sf):
    k = F.col("seq") % 10
    raw = (
        F.when(k == 0, "011-4671 0423").when(k == 1, "-").when(k == 2, "12 34")
        .when(k == 3, F.concat("phone", F.lit(" / "), "phone")).otherwise(F.col("phone"))
    )
    email = F.when(F.col("seq") % 9 == 0, "helpdesk@tradeindia.com").otherwise(F.col("email"))
    phone = C.clean_phone(raw)
    return A.leads(spark, sf).select(
        "seq", phone.alias("phone"), C.drop_site_wide_phone(phone).alias("own_phone"),
        C.drop_site_wide_email(email).alias("own_email"),
    )


@query("safe_str", f"""
SELECT conv_id, turn, CASE WHEN text <> 'null' THEN substr({blank_to_null('text')}, 1, 300) END AS short,
  CASE WHEN role <> 'null' THEN substr({blank_to_null('role')}, 1, 4) END AS role4 FROM conversations""")
def _(spark, sf):
    return A.table(spark, sf, "conversations").select(
        "conv_id", "turn", X.safe_str("text", 300).alias("short"), X.safe_str("role", 4).alias("role4")
    )


@query("icp_flags", f"""
SELECT seq, category_slug IN ('building', 'machinery') AS icp_category, city_slug IN ('nation_3') AS icp_city
FROM ({LEADS})""")
def _(spark, sf):
    from leadloom.operators.leads import is_member

    return A.leads(spark, sf).select(
        "seq", is_member("category_slug", {"building", "machinery"}).alias("icp_category"),
        is_member("city_slug", {"nation_3"}).alias("icp_city"),
    )
