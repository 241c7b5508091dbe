"""Registry of benchmark queries and their ANSI counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom import constants as K
from leadloom.workloads import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL text that must give the same rows."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


# --- SQL fragments for the counterparts --------------------------------------------------

_TABLES = {t: t for t in ("customer", "nation", "orders", "events")}
LEADS = A.LEADS_SQL.format(**_TABLES)
LISTINGS = A.LISTINGS_SQL.format(**_TABLES)
FETCH_LOG = A.FETCH_LOG_SQL.format(**_TABLES)
TARGETS = A.TARGETS_SQL.format(**_TABLES)
ERRORS = A.ERRORS_SQL.format(**_TABLES)
CRAWL_ERRORS = A.CRAWL_ERRORS_SQL.format(**_TABLES)
LEGACY = A.LEGACY_SQL.format(leads=LEADS)

EMAIL = K.EMAIL_PATTERN
LEGAL = "|".join(K.LEGAL_WORDS)
LEGAL_AND_DESCRIPTORS = "|".join(K.LEGAL_WORDS + K.DESCRIPTOR_WORDS)


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def blank_to_null(e: str) -> str:
    return f"nullif({strip(e)}, '')"


def present(e: str) -> str:
    return f"coalesce({e} <> '', false)"


def not_blank(e: str) -> str:
    return rf"coalesce(regexp_matches({e}, '\S'), false)"


def _words(e: str, words: str) -> str:
    spaced = rf"regexp_replace(lower({e}), '[^\w\s]', ' ', 'g')"
    dropped = rf"regexp_replace({spaced}, '\b({words})\b', ' ', 'g')"
    return rf"trim(regexp_replace({dropped}, '\s+', ' ', 'g'))"


def norm(e: str) -> str:
    return _words(e, LEGAL_AND_DESCRIPTORS)


def fuzzy_norm(e: str) -> str:
    return _words(e, LEGAL)


def fuzzy_form(e: str) -> str:
    return f"array_to_string(list_sort(string_split({fuzzy_norm(e)}, ' ')), ' ')"


def digits(e: str) -> str:
    return f"regexp_replace({e}, '[^0-9]', '', 'g')"


def phone_key(e: str) -> str:
    return f"CASE WHEN length({digits(e)}) >= 10 THEN md5('phone:' || right({digits(e)}, 10)) END"


def entity_key(name: str, phone: str, web: str) -> str:
    site = rf"rtrim(regexp_replace(lower({strip(f'coalesce({web}, {chr(39) * 2})')}), '^https?://', ''), '/')"
    text = f"'name:' || {norm(name)} || CASE WHEN {site} <> '' THEN '|web:' || {site} ELSE '' END"
    return f"coalesce({phone_key(phone)}, md5({text}))"


def site_key(e: str) -> str:
    web = f"coalesce({e}, '')"
    host = rf"lower(coalesce(nullif(regexp_extract({web}, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)', 1), ''), {web}))"
    return rf"split_part(regexp_replace({host}, '^www\.', ''), '/', 1)"


def source_name(e: str) -> str:
    whens = " ".join(f"WHEN contains({e}, '{d}') THEN '{n}'" for d, n in K.SOURCE_DOMAINS.items())
    return f"CASE {whens} END"


def valid_email(e: str) -> str:
    return f"coalesce(regexp_full_match({strip(e)}, '{EMAIL}'), false)"


def clean_phone(e: str) -> str:
    kept = f"regexp_replace({e}, '[^0-9+]', '', 'g')"
    return f"CASE WHEN length({kept}) >= 10 THEN substr({kept}, 1, 15) END"


def ratio(a: str, b: str) -> str:
    """200 * LCS / (len a + len b): bit-parallel LCS folded over the characters of ``b``."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    mask = (
        f"coalesce(list_sum(list_transform(range(0, length({a})), lambda i: "
        f"CASE WHEN {a}[i + 1] = ch THEN (1::HUGEINT << i::INT) ELSE 0::HUGEINT END)), 0)::HUGEINT"
    )
    step = f"(((s + (s & ({mask}))) | (s - (s & ({mask})))) & {full})"
    chars = f"list_transform(range(1, length({b}) + 1), lambda j: {b}[j])"
    final = f"list_reduce({chars}, lambda s, ch: {step}, {full})"
    lcs = f"(length({a}) - bit_count(coalesce({final}, {full})))"
    return (
        f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 "
        f"ELSE 200.0 * {lcs} / (length({a}) + length({b})) END"
    )


# Leads with their site key, and the cleaned (deduplicated, validated) ones.
KEYED = f"leads AS ({LEADS}), keyed AS (SELECT *, {site_key('website')} AS dedup_key, " \
        "(employee_count IS NOT NULL)::INT + (revenue_band IS NOT NULL)::INT AS fields FROM leads)"
KEPT = KEYED + f""",
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY fields DESC, company_name, seq) AS rn
    FROM keyed WHERE {not_blank('dedup_key')}) WHERE rn = 1
  UNION ALL SELECT * FROM keyed WHERE NOT {not_blank('dedup_key')}
)"""
JUDGED = KEPT + f""",
judged AS (
  SELECT *, CASE WHEN NOT {not_blank('company_name')} THEN 'Empty company_name'
    WHEN NOT {present('email')} AND NOT {not_blank('phone')} THEN 'Missing both email and phone' END AS reason
  FROM kept
)"""

# Identity columns, and companies built from even leads as an existing registry.
IDENTITY = f"""leads AS ({LEADS}), ident AS MATERIALIZED (
  SELECT *, coalesce({blank_to_null('company_name')}, 'Unknown') AS stored_name,
    {norm(f"coalesce({blank_to_null('company_name')}, 'Unknown')")} AS in_norm,
    {fuzzy_form('company_name')} AS in_form,
    {phone_key(blank_to_null('phone'))} AS phone_key,
    {entity_key('company_name', blank_to_null('phone'), 'website')} AS entity_key
  FROM leads
)"""
REGISTRY = IDENTITY + f""",
registry AS MATERIALIZED (
  SELECT entity_key AS dedup_key, arg_min(stored_name, seq) AS company_name,
    arg_min(in_norm, seq) AS normalized_name
  FROM ident WHERE seq % 2 = 0 GROUP BY entity_key
), reg AS MATERIALIZED (
  SELECT *, {fuzzy_form('company_name')} AS cand_form FROM registry
)"""
