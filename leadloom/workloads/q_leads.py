"""Dedup, validation, scoring, promotion and report queries."""

import uuid

from pyspark.sql import functions as F

from leadloom.operators import dedup as D
from leadloom.operators import gates as G
from leadloom.operators import report as H
from leadloom.operators.leads import filter_valid, raw_to_lead, score_leads, seed_score
from leadloom.plans.lead_run import clean_leads
from leadloom.session import ensure_checkpoint_dir, stored
from leadloom.sources.tables import TableStore, error_rows, lead_rows, rejected_rows
from leadloom.streaming.ingest import start_promotion_stream, stream_name
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import (
    CRAWL_ERRORS,
    ERRORS,
    JUDGED,
    KEPT,
    KEYED,
    LEADS,
    TARGETS,
    blank_to_null,
    digits,
    not_blank,
    present,
    query,
    site_key,
    source_name,
    strip,
    valid_email,
)

ICP_CATEGORIES, ICP_CITIES = {"building", "machinery"}, {"nation_3", "nation_7"}


def _leads(spark, sf):
    """Leads with keys, keeping the adapter's varied first_seen times."""
    raw = A.leads(spark, sf).withColumnRenamed("first_seen", "seen")
    return raw_to_lead(raw, A.AS_OF).withColumn("first_seen", F.col("seen")).drop("seen")


def _kept(spark, sf):
    return D.deduplicate(_leads(spark, sf), A.AS_OF)


@query("dedup_kept", f"WITH {KEPT} SELECT seq, dedup_key, company_name, fields FROM kept")
def _(spark, sf):
    from leadloom.operators.leads import enrichment_count

    return _kept(spark, sf).kept.select("seq", "dedup_key", "company_name", enrichment_count().alias("fields"))


_REJECTED = f"""
SELECT dedup_key, kept_company, company_name AS rejected_company,
  CASE WHEN fields < kept_fields THEN 'Fewer enrichment fields (' || fields || ' vs ' || kept_fields || ')'
    ELSE 'Tied at ' || fields || ' enrichment fields, rejected alphabetically' END AS reason
FROM (SELECT *, row_number() OVER w AS rn, first_value(company_name) OVER w AS kept_company,
    first_value(fields) OVER w AS kept_fields
  FROM keyed WHERE {not_blank('dedup_key')}
  WINDOW w AS (PARTITION BY dedup_key ORDER BY fields DESC, company_name, seq)) WHERE rn > 1"""


@query("dedup_rejected", f"WITH {KEYED} {_REJECTED}")
def _(spark, sf):
    return _kept(spark, sf).rejected.drop("timestamp")


_VALID = f"SELECT * FROM judged WHERE reason IS NULL"
_MARKED = f"CASE WHEN {present('email')} AND NOT {valid_email('email')} THEN 'UNVERIFIED:' || {strip('email')} ELSE email END"


@query("validate_valid", f"WITH {JUDGED} SELECT seq, company_name, {_MARKED} AS email, phone FROM judged WHERE reason IS NULL")
def _(spark, sf):
    return filter_valid(_kept(spark, sf).kept).valid.select("seq", "company_name", "email", "phone")


@query("validate_invalid", f"WITH {JUDGED} SELECT seq, company_name, email, phone, reason FROM judged WHERE reason IS NOT NULL")
def _(spark, sf):
    return filter_valid(_kept(spark, sf).kept).invalid.select("seq", "company_name", "email", "phone", "reason")


_SCORED = f"""
parts AS (SELECT seq, CASE WHEN {present('phone')} THEN 25 END AS has_phone,
  CASE WHEN {present(_MARKED)} THEN 15 END AS has_email, CASE WHEN {present('website')} THEN 15 END AS has_website,
  n AS source_count, CASE WHEN first_seen IS NULL THEN 'new'
    WHEN first_seen::DATE = DATE '{A.AS_OF[:10]}' THEN 'today'
    WHEN date_diff('hour', first_seen, TIMESTAMP '{A.AS_OF}') < 192 THEN 'last_7_days' ELSE 'older' END AS recency,
  CASE WHEN category_slug IN ('building', 'machinery') OR city_slug IN ('nation_3', 'nation_7') THEN 10 ELSE 0 END AS icp_match
  FROM (SELECT *, seq % 4 AS n FROM judged WHERE reason IS NULL)),
scored AS (SELECT *, coalesce(has_phone, 0) + coalesce(has_email, 0) + coalesce(has_website, 0) AS contact,
  CASE WHEN source_count >= 3 THEN 'all_3' WHEN source_count = 2 THEN '2_sites' ELSE 'single' END AS multi_source,
  CASE WHEN source_count >= 3 THEN 35 WHEN source_count = 2 THEN 25 ELSE 0 END AS source_score,
  CASE recency WHEN 'new' THEN 10 WHEN 'today' THEN 10 WHEN 'last_7_days' THEN 5 ELSE 0 END AS recency_score FROM parts)"""


def _scored(spark, sf):
    valid = filter_valid(_kept(spark, sf).kept).valid
    names = F.array(*[F.lit(s) for s in ("Justdial", "IndiaMART", "TradeIndia")])
    many = valid.withColumn("sources", F.slice(names, F.lit(1), (F.col("seq") % 4).cast("int")))
    return score_leads(many, A.AS_OF, ICP_CATEGORIES, ICP_CITIES)


@query("lead_score", f"""
WITH {JUDGED}, {_SCORED}
SELECT seq, least(contact + source_score + recency_score + icp_match, 100) AS lead_score FROM scored""")
def _(spark, sf):
    return _scored(spark, sf).select("seq", "lead_score")


@query("score_breakdown", f"""
WITH {JUDGED}, {_SCORED}
SELECT seq, has_phone, has_email, has_website, contact, multi_source, source_score, recency, recency_score, icp_match,
  least(contact + source_score + recency_score + icp_match, 100) AS total FROM scored""")
def _(spark, sf):
    return _scored(spark, sf).select("seq", "lead_score_breakdown.*")


@query("seed_score", f"""
SELECT seq, CASE WHEN {present('email')} THEN 25 ELSE 0 END + CASE WHEN {present('phone')} THEN 25 ELSE 0 END
  + CASE WHEN {present('website')} THEN 20 ELSE 0 END + CASE WHEN {present('industry_code')} THEN 10 ELSE 0 END AS score
FROM ({LEADS})""")
def _(spark, sf):
    return A.leads(spark, sf).select("seq", seed_score().alias("score"))


@query("existing_keys", f"WITH {KEYED} SELECT DISTINCT dedup_key FROM keyed WHERE {present('dedup_key')}")
def _(spark, sf):
    leads = _leads(spark, sf)
    return D.existing_keys(leads.where("seq % 3 = 1"), leads.where("seq % 3 <> 1"))


def _new_rows(key: str, where_old: str) -> str:
    return f"""
SELECT seq, {key} AS key FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY seq) AS rn FROM keyed
    WHERE seq % 2 = 1 AND {present(key)}) WHERE rn = 1
  AND {key} NOT IN (SELECT {key} FROM keyed WHERE {where_old} AND {present(key)})
UNION ALL SELECT seq, {key} FROM keyed WHERE seq % 2 = 1 AND NOT {present(key)}"""


@query("idempotent_append", f"WITH {KEYED} {_new_rows('dedup_key', 'seq % 2 = 0')}")
def _(spark, sf):
    leads = _leads(spark, sf)
    stored = D.existing_keys(leads.where("seq % 2 = 0"))
    return D.filter_new_rows(leads.where("seq % 2 = 1"), stored).select("seq", F.col("dedup_key").alias("key"))


@query("filter_new_rows", f"WITH {KEYED} {_new_rows('phone', 'seq % 2 = 0')}")
def _(spark, sf):
    leads = _leads(spark, sf)
    stored = D.existing_keys(leads.where("seq % 2 = 0"), key_col="phone")
    return D.filter_new_rows(leads.where("seq % 2 = 1"), stored, "phone").select("seq", F.col("phone").alias("key"))


_GATE = "error_count, target_count, error_count / target_count AS failure_rate, error_count / target_count <= 0.3 AS passed"


@query("failure_gate", f"""
SELECT {_GATE} FROM (SELECT (SELECT count(*) FROM ({ERRORS}) WHERE run_id = 'run-1') AS error_count,
  (SELECT count(*) FROM ({TARGETS})) AS target_count)""")
def _(spark, sf):
    return G.failure_gate(A.errors(spark, sf), A.targets(spark, sf), run_id="run-1")


@query("failure_gate_urls", f"""
SELECT {_GATE} FROM (SELECT (SELECT count(DISTINCT {blank_to_null('url')}) FROM ({ERRORS})) AS error_count,
  (SELECT count(*) FROM ({TARGETS})) AS target_count)""")
def _(spark, sf):
    return G.failure_gate(A.errors(spark, sf), A.targets(spark, sf), mode="urls")


_PROMOTED = f"""
WITH {JUDGED}, staged AS (SELECT * FROM judged WHERE reason IS NULL)
SELECT seq, company_name, dedup_key FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY seq) AS rn FROM staged WHERE {present('dedup_key')})
WHERE rn = 1 AND dedup_key NOT IN (SELECT dedup_key FROM keyed WHERE seq % 5 = 1 AND {present('dedup_key')})
UNION ALL SELECT seq, company_name, dedup_key FROM staged WHERE NOT {present('dedup_key')}"""


def _staged(leads):
    """Cleaned leads as stored: promotion reads them several times."""
    return stored(filter_valid(D.deduplicate(leads, A.AS_OF).kept).valid)


@query("promotion", _PROMOTED)
def _(spark, sf):
    leads = _leads(spark, sf)
    return G.promote(_staged(leads), leads.where("seq % 5 = 1")).select("seq", "company_name", "dedup_key")


@query("promotion_stream", _PROMOTED)
def _(spark, sf):
    """The same as a stream over eight staged files, two of them in each micro-batch."""
    leads = _leads(spark, sf)
    root = f"{ensure_checkpoint_dir(spark)}/promotion-{uuid.uuid4().hex}"
    store = TableStore(spark, f"{root}/db")
    store.overwrite("leads", leads.where("seq % 5 = 1"))
    store._typed("staging", _staged(leads)).repartition(8, "dedup_key", "seq").write.parquet(f"{root}/staged")
    start_promotion_stream(spark, f"{root}/staged", store, f"{root}/position", files_per_batch=2).awaitTermination()
    return store.read_batches("leads", stream_name(f"{root}/position")).select("seq", "company_name", "dedup_key")


@query("fill_first_merge", f"""
SELECT phone AS key, min(seq) AS seq, arg_min(email, seq) FILTER (WHERE {present('email')}) AS email,
  arg_min(website, seq) FILTER (WHERE {present('website')}) AS website,
  arg_min(employee_count, seq) FILTER (WHERE employee_count <> 0) AS employee_count
FROM ({LEADS}) GROUP BY phone""")
def _(spark, sf):
    rows = A.leads(spark, sf).select(F.col("phone").alias("key"), "seq", "email", "website", "employee_count")
    return D.fill_first(rows, "key")


# The same phone number listed by another directory every 700 leads.
_SPREAD = """SELECT phone, CASE (seq // 700) % 3 WHEN 0 THEN 'https://www.justdial.com/list'
  WHEN 1 THEN 'https://dir.indiamart.com/list' ELSE 'https://elsewhere.example.org' END AS source_url"""


@query("multi_source", f"""
SELECT phone10, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM (
  SELECT right({digits('phone')}, 10) AS phone10, {source_name('source_url')} AS source FROM ({_SPREAD} FROM ({LEADS}))
  WHERE length({digits('phone')}) >= 10) WHERE source IS NOT NULL GROUP BY phone10 HAVING count(DISTINCT source) >= 2""")
def _(spark, sf):
    leads = A.leads(spark, sf)
    k = F.floor(F.col("seq") / 700) % 3
    url = (F.when(k == 0, "https://www.justdial.com/list").when(k == 1, "https://dir.indiamart.com/list")
           .otherwise("https://elsewhere.example.org"))
    groups = D.multi_source_groups(leads.withColumn("source_url", url))
    return groups.withColumn("sources", F.array_join("sources", ","))


@query("run_summary", f"""
WITH {JUDGED}
SELECT (SELECT count(*) FROM keyed) AS scraped, (SELECT count(*) FROM keyed WHERE fields > 0) AS enriched_count,
  (SELECT count(*) FROM judged WHERE reason IS NULL) AS kept_after_validation,
  (SELECT count(*) FROM keyed) - (SELECT count(*) FROM kept) AS rejected_duplicates,
  (SELECT count(*) FROM ({ERRORS})) AS errors, (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS invalid_records""")
def _(spark, sf):
    run = clean_leads(A.leads(spark, sf), A.AS_OF, ICP_CATEGORIES, ICP_CITIES)
    return G.run_summary(run.leads, run.scored, run.rejected, A.errors(spark, sf), run.invalid)


_POINTS = {"has_phone": f"CASE WHEN {present('phone')} THEN 25 END", "has_email": f"CASE WHEN {present('email')} THEN 15 END",
           "has_website": f"CASE WHEN {present('website')} THEN 15 END"}
_CONTACT = " + ".join(f"coalesce({p}, 0)" for p in _POINTS.values())
_ICP = "CASE WHEN category_slug IN ('building', 'machinery') OR city_slug IN ('nation_3', 'nation_7') THEN 10 ELSE 0 END"
_JSON = " || ".join(f"""coalesce('"{n}":' || ({p}) || ',', '')""" for n, p in _POINTS.items())


@query("lead_rows", f"""
WITH {JUDGED}
SELECT company_name, coalesce(website, '') AS website, coalesce({_MARKED}, '') AS email, coalesce(phone, '') AS phone,
  coalesce(address, '') AS address, coalesce(industry_code, '') AS industry_code, coalesce(CAST(employee_count AS VARCHAR), '') AS employee_count,
  coalesce(revenue_band, '') AS revenue_band, source_url, '2026-01-31T12:00:00' AS scraped_at, dedup_key,
  CAST(least({_CONTACT} + 10 + {_ICP}, 100) AS VARCHAR) AS lead_score,
  '{{' || {_JSON} || '"contact":' || ({_CONTACT}) || ',"multi_source":"single","source_score":0,"recency":"today","recency_score":10,"icp_match":'
    || {_ICP} || ',"total":' || least({_CONTACT} + 10 + {_ICP}, 100) || '}}' AS lead_score_breakdown, coalesce(category_slug, '') AS category_slug
FROM judged WHERE reason IS NULL""")
def _(spark, sf):
    """Flagship: convert, deduplicate, validate, score and flatten the whole lead table."""
    rows = lead_rows(clean_leads(A.leads(spark, sf), A.AS_OF, ICP_CATEGORIES, ICP_CITIES).scored)
    return rows.withColumn("scraped_at", F.substring("scraped_at", 1, 19))


@query("error_rows", f"SELECT url, '2026-01-31T12:00:00' AS timestamp, error_type FROM ({CRAWL_ERRORS})")
def _(spark, sf):
    return error_rows(A.crawl_errors(spark, sf)).withColumn("timestamp", F.substring("timestamp", 1, 19))


@query("rejected_rows", f"WITH {KEYED} SELECT *, '2026-01-31T12:00:00' AS timestamp FROM ({_REJECTED})")
def _(spark, sf):
    rows = rejected_rows(_kept(spark, sf).rejected)
    return rows.withColumn("timestamp", F.substring("timestamp", 1, 19))


@query("fill_rates", f"""
WITH r AS (SELECT CASE WHEN contains(source_url, 'justdial') THEN 'justdial' WHEN contains(source_url, 'indiamart') THEN 'indiamart'
    WHEN contains(source_url, 'tradeindia') THEN 'tradeindia' ELSE 'unknown' END AS site, * FROM ({LEADS})),
  a AS (SELECT site, count(*) AS total, count(*) FILTER (WHERE phone <> '') AS phone,
    count(*) FILTER (WHERE email <> '') AS email, count(*) FILTER (WHERE website <> '') AS website FROM r GROUP BY site)
SELECT site, coalesce(total, 0) AS total, coalesce(phone, 0) AS phone, coalesce(email, 0) AS email, coalesce(website, 0) AS website
FROM a FULL JOIN (SELECT lower(name) AS site FROM ({TARGETS}) WHERE enabled) USING (site)""")
def _(spark, sf):
    return H.fill_rates(A.leads(spark, sf), A.targets(spark, sf))


@query("kpis", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE phone <> '') AS with_phone, count(*) FILTER (WHERE email <> '') AS with_email,
  count(*) FILTER (WHERE website <> '') AS with_website, count(*) FILTER (WHERE {site_key('website')} <> '') AS domains,
  count(DISTINCT nullif({site_key('website')}, '')) AS distinct_domains FROM ({LEADS})""")
def _(spark, sf):
    return H.kpis(_leads(spark, sf))


_LABEL = f"coalesce({source_name('source_url')}, split_part(source_url, '/', 3))"


@query("source_counts", f"SELECT {_LABEL} AS source, count(*) AS leads FROM ({LEADS}) GROUP BY 1 ORDER BY 1")
def _(spark, sf):
    return H.source_counts(A.leads(spark, sf))


@query("dashboard_rows", f"""
SELECT company_name, website, email, phone, address, industry_code, {site_key('website')} AS dedup_key, source_url,
  {_LABEL} AS source FROM ({LEADS}) ORDER BY company_name""")
def _(spark, sf):
    return H.dashboard_rows(_leads(spark, sf))


_HAY = "lower(company_name || ' ' || coalesce(phone, '') || ' ' || coalesce(address, '') || ' ' || coalesce(industry_code, ''))"


@query("search_leads", f"""
SELECT company_name, phone, email, source_url FROM ({LEADS})
WHERE contains({_HAY}, 'vert') AND {_LABEL} = 'IndiaMART' AND phone <> '' AND email <> ''""")
def _(spark, sf):
    found = H.search_leads(H.dashboard_rows(_leads(spark, sf)), "VERT", "IndiaMART", "phone_email")
    return found.select("company_name", "phone", "email", "source_url")


@query("sorted_leads", f"""
SELECT seq, email FROM ({LEADS}) ORDER BY lower(coalesce(email, '')) DESC, seq""")
def _(spark, sf):
    return H.sort_leads(A.leads(spark, sf), "email", ascending=False).select("seq", "email")
