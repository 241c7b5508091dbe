"""Table schemas (DDL strings understood by spark.read / from_json / createDataFrame)."""

BREAKDOWN = (
    "STRUCT<has_phone: INT, has_email: INT, has_website: INT, contact: INT, "
    "multi_source: STRING, source_score: INT, recency: STRING, recency_score: INT, "
    "icp_match: INT, total: INT>"
)

RAW_RECORDS = (
    "seq BIGINT, company_name STRING, website STRING, email STRING, phone STRING, "
    "address STRING, industry_code STRING, employee_count INT, revenue_band STRING, "
    "source_url STRING, detail_url STRING, dedup_key STRING, category_slug STRING, city_slug STRING"
)

LEADS = (
    "seq BIGINT, company_name STRING, website STRING, email STRING, phone STRING, "
    "address STRING, industry_code STRING, employee_count INT, revenue_band STRING, "
    "source_url STRING, scraped_at TIMESTAMP, dedup_key STRING, lead_score INT, "
    f"lead_score_breakdown {BREAKDOWN}, sources ARRAY<STRING>, city_slug STRING, "
    "category_slug STRING, first_seen TIMESTAMP, last_seen TIMESTAMP"
)

REJECTED_DUPLICATES = (
    "dedup_key STRING, kept_company STRING, rejected_company STRING, reason STRING, "
    "timestamp TIMESTAMP"
)

SCRAPE_ERRORS = "url STRING, timestamp TIMESTAMP, error_type STRING, run_id STRING"

COMPANIES = (
    "dedup_key STRING, company_name STRING, normalized_name STRING, phone STRING, "
    "email STRING, website STRING, address STRING, industry_code STRING, "
    "first_seen TIMESTAMP, last_seen TIMESTAMP, lead_score INT, "
    f"lead_score_breakdown {BREAKDOWN}, sources ARRAY<STRING>"
)
LISTED_IN = "dedup_key STRING, category STRING"
LOCATED_IN = "dedup_key STRING, city STRING"
SOURCED_FROM = (
    "dedup_key STRING, source STRING, scraped_at TIMESTAMP, raw_record_id STRING"
)

FUZZY_REVIEW = (
    "timestamp TIMESTAMP, action STRING, incoming_name STRING, incoming_normalized STRING, "
    "candidate_name STRING, candidate_normalized STRING, score DOUBLE, threshold INT, "
    "verdict STRING"
)

TABLES = {
    "leads": LEADS,
    "staging": LEADS,
    "scrape_errors": SCRAPE_ERRORS,
    "rejected_duplicates": REJECTED_DUPLICATES,
}
GRAPH_TABLES = {
    "companies": COMPANIES,
    "listed_in": LISTED_IN,
    "located_in": LOCATED_IN,
    "sourced_from": SOURCED_FROM,
    "categories": "name STRING",
    "cities": "name STRING",
    "source_nodes": "name STRING",
}
QUOTA_TABLES = {
    "request_counts": "date STRING, domain STRING, consumed BIGINT",
    "request_decisions": "seq BIGINT, date STRING, domain STRING, allowed BOOLEAN",
}
