"""Entity resolution and graph queries."""

import uuid

from pyspark.sql import functions as F

from leadloom.functions.similarity import indel_ratio
from leadloom.operators import graph as G
from leadloom.operators import resolve as R
from leadloom.operators.legacy import build_legacy_graph
from leadloom.operators.leads import rescore_from_companies
from leadloom.operators.search import find_names, name_postings
from leadloom.plans.lead_run import lead_run
from leadloom.schemas import BREAKDOWN
from leadloom.session import ensure_checkpoint_dir, stored
from leadloom.sources.graph_store import GraphStore
from leadloom.sources.tables import TableStore
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import (
    CRAWL_ERRORS,
    EMAIL,
    IDENTITY,
    JUDGED,
    LEGACY,
    REGISTRY,
    blank_to_null,
    digits,
    not_blank,
    present,
    query,
    ratio,
    source_name,
    strip,
)

def _leads(spark, sf):
    scored = A.leads(spark, sf).withColumn("lead_score", (F.col("seq") % 101).cast("int"))
    return scored.withColumn("lead_score_breakdown", F.struct(F.col("lead_score").alias("total")))


def _registry(spark, sf):
    even = R.with_identity(A.leads(spark, sf).where("seq % 2 = 0"))
    return even.groupBy(F.col("entity_key").alias("dedup_key")).agg(
        F.min_by("stored_name", "seq").alias("company_name"),
        F.min_by("in_norm", "seq").alias("normalized_name"),
    )


def _batch(spark, sf):
    return A.leads(spark, sf).where("seq % 2 = 1")


@query("phone_match", f"""
WITH {REGISTRY}
SELECT seq, dedup_key AS matched_key, r.company_name AS matched_name
FROM ident LEFT JOIN registry r ON phone_key = dedup_key WHERE seq % 2 = 1""")
def _(spark, sf):
    return R.phone_match(_batch(spark, sf), _registry(spark, sf)).select("seq", "matched_key", "matched_name")


@query("prefix_block", f"""
WITH {REGISTRY}, sizes AS (SELECT left(in_norm, 3) AS prefix, count(r.dedup_key) AS candidates
  FROM (SELECT DISTINCT in_norm FROM ident) i LEFT JOIN registry r ON starts_with(r.normalized_name, left(i.in_norm, 3))
  GROUP BY i.in_norm, prefix)
SELECT seq, left(in_norm, 3) AS prefix, (SELECT max(candidates) FROM sizes s WHERE s.prefix = left(i.in_norm, 3)) AS candidates
FROM ident i WHERE seq % 2 = 1""")
def _(spark, sf):
    return R.block_sizes(_batch(spark, sf), _registry(spark, sf)).select("seq", "prefix", "candidates")


@query("token_sort_score", f"""
WITH {IDENTITY} SELECT a.seq, round({ratio('a.in_form', 'b.in_form')}, 6) AS score
FROM ident a JOIN ident b ON b.seq = a.seq + 40""")
def _(spark, sf):
    rows = A.leads(spark, sf).select("seq", R.fuzzy_form("company_name").alias("a"))
    other = rows.select((F.col("seq") - 40).alias("seq"), F.col("a").alias("b"))
    return rows.join(other, "seq").select("seq", F.round(indel_ratio("a", "b"), 6).alias("score"))


_NEAR = f"""near AS MATERIALIZED (
  SELECT in_form, in_norm, cand_form, normalized_name, {ratio('in_form', 'cand_form')} AS score
  FROM (SELECT DISTINCT in_form, in_norm FROM ident WHERE seq % 2 = 1) i
  JOIN (SELECT DISTINCT cand_form, normalized_name FROM reg) r ON starts_with(normalized_name, left(in_norm, 3)))"""


def _best_sql(least):
    return f"""
WITH {REGISTRY}, {_NEAR}, best AS (
  SELECT in_form, in_norm, arg_min(dedup_key, (-score, company_name, dedup_key)) AS matched_key,
    arg_min(company_name, (-score, company_name, dedup_key)) AS matched_name, max(score) AS score
  FROM near JOIN reg USING (cand_form, normalized_name) WHERE score >= {least} GROUP BY in_form, in_norm)
SELECT seq, matched_key, matched_name, round(score, 6) AS fuzzy_score FROM ident JOIN best USING (in_form, in_norm) WHERE seq % 2 = 1"""


def _best_rows(spark, sf, least):
    best = R.best_fuzzy(_batch(spark, sf), _registry(spark, sf), least)
    return best.select("seq", "matched_key", "matched_name", F.round("fuzzy_score", 6).alias("fuzzy_score"))


@query("best_fuzzy", _best_sql(90))
def _(spark, sf):
    return _best_rows(spark, sf, 90)


@query("best_fuzzy_low", _best_sql(60))
def _(spark, sf):
    """Under the threshold at which names share a segment: blocks compared in tiles."""
    return _best_rows(spark, sf, 60)


# One-by-one resolution: the list of created nodes grows record by record. ``source`` picks the
# records among ``ident``, ``order`` says in which order they arrive.
def _resolved_sql(source: str = "SELECT * FROM ident", order: str = "seq", before: str = "") -> str:
    return IDENTITY + f""",{before}
part AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM ({source})),
run AS (
  WITH RECURSIVE step(n, nodes) AS (
    SELECT 0::BIGINT, CAST([] AS STRUCT(k VARCHAR, form VARCHAR, nm VARCHAR, s BIGINT)[])
    UNION ALL
    SELECT n + 1, CASE WHEN len(list_filter(nodes, lambda x: x.k = o.entity_key OR (
        starts_with(x.nm, left(o.in_norm, 3)) AND
        CASE WHEN starts_with(x.nm, left(o.in_norm, 3)) THEN x.form = o.in_form ELSE false END))) > 0 THEN nodes
      WHEN len(list_filter(nodes, lambda x: CASE WHEN starts_with(x.nm, left(o.in_norm, 3))
          AND abs(length(x.form) - length(o.in_form)) * 9 <= 2 * length(o.in_form) + 9
          THEN {ratio('o.in_form', 'x.form')} >= 90 ELSE false END)) > 0 THEN nodes
      ELSE list_append(nodes, {{'k': o.entity_key, 'form': CASE WHEN o.in_form = '' AND o.stored_name = 'Unknown' THEN 'unknown' ELSE o.in_form END,
        'nm': o.in_norm, 's': o.rn}}) END
    FROM step JOIN part o ON o.rn = step.n + 1)
  SELECT nodes FROM step ORDER BY n DESC LIMIT 1
),
leaders AS MATERIALIZED (
  SELECT x.k AS leader_key, x.form AS cand_form, x.nm AS cand_norm, x.s AS leader_seq, i.stored_name AS leader_name
  FROM (SELECT unnest(nodes) AS x FROM run) JOIN part i ON i.rn = x.s),
scores AS MATERIALIZED (
  SELECT in_form, in_norm, cand_form, cand_norm, {ratio('in_form', 'cand_form')} AS score
  FROM (SELECT DISTINCT in_form, in_norm FROM part) JOIN (SELECT DISTINCT cand_form, cand_norm FROM leaders)
    ON starts_with(cand_norm, left(in_norm, 3))),
fuzzy AS (
  SELECT rn, arg_min(leader_key, (-score, leader_name)) AS fuzzy_key, arg_min(leader_name, (-score, leader_name)) AS fuzzy_name,
    max(score) AS fuzzy_score
  FROM part JOIN scores USING (in_form, in_norm) JOIN leaders USING (cand_form, cand_norm)
  WHERE score >= 90 AND leader_seq < rn GROUP BY rn),
resolved AS MATERIALIZED (
  SELECT i.*, CASE WHEN k.leader_key IS NOT NULL AND phone_key IS NOT NULL THEN 'phone'
      WHEN fuzzy_key IS NOT NULL THEN 'fuzzy' WHEN k.leader_key IS NOT NULL THEN 'key' END AS match_type,
    CASE WHEN fuzzy_key IS NOT NULL AND (k.leader_key IS NULL OR phone_key IS NULL) THEN fuzzy_key ELSE entity_key END AS resolved_key,
    CASE WHEN fuzzy_key IS NOT NULL AND (k.leader_key IS NULL OR phone_key IS NULL) THEN fuzzy_score END AS score
  FROM part i LEFT JOIN fuzzy USING (rn) LEFT JOIN leaders k ON k.leader_key = entity_key AND k.leader_seq < i.rn)"""


_RESOLVED = _resolved_sql()


@query("resolve_batch", f"WITH {_RESOLVED} SELECT seq, resolved_key, match_type, round(score, 6) AS fuzzy_score FROM resolved")
def _(spark, sf):
    return R.resolve(_leads(spark, sf)).records.select(
        "seq", "resolved_key", "match_type", F.round("fuzzy_score", 6).alias("fuzzy_score")
    )


@query("review_log", f"""
WITH {_RESOLVED}
SELECT company_name AS incoming_name, in_norm AS incoming_normalized, leader_name AS candidate_name,
  cand_norm AS candidate_normalized, round(s.score, 6) AS score, 90 AS threshold,
  CASE WHEN s.score >= 90 THEN 'matched' ELSE 'not_matched' END AS verdict
FROM resolved JOIN scores s USING (in_form, in_norm) JOIN leaders USING (cand_form, cand_norm)
WHERE s.score >= 80 AND leader_seq < rn AND coalesce(match_type <> 'phone', true)""")
def _(spark, sf):
    log = R.review_log(R.resolve(_leads(spark, sf)), A.AS_OF)
    return log.drop("timestamp", "action").withColumn("score", F.round("score", 6))


@query("review_counts", f"""
WITH {_RESOLVED}
SELECT seq, count(leader_key) AS comparisons, count(*) FILTER (WHERE s.score >= 90) AS matched,
  count(leader_key) - count(*) FILTER (WHERE s.score >= 90) AS not_matched
FROM resolved LEFT JOIN (leaders JOIN scores s USING (cand_form, cand_norm))
  ON s.in_form = resolved.in_form AND s.in_norm = resolved.in_norm AND leader_seq < rn
WHERE coalesce(match_type <> 'phone', true) GROUP BY seq""")
def _(spark, sf):
    return R.review_counts(R.resolve(_leads(spark, sf)))


@query("review_lines", f"""
WITH {REGISTRY}, {_NEAR}
SELECT concat_ws('|', '2026-01-31T12:00:00', 'FUZZY_MATCH', replace(i.company_name, ' ', '\\|'), i.in_norm, r.company_name,
  r.normalized_name, format('{{:.1f}}', n.score), '90', CASE WHEN n.score >= 90 THEN 'matched' ELSE 'not_matched' END) AS line
FROM ident i JOIN near n USING (in_form, in_norm) JOIN reg r ON r.cand_form = n.cand_form AND r.normalized_name = n.normalized_name
WHERE i.seq % 2 = 1 AND n.score >= 80""")
def _(spark, sf):
    batch = _batch(spark, sf)
    known = R.as_leaders(_registry(spark, sf))
    piped = R.with_identity(batch).withColumn("company_name", F.replace("company_name", F.lit(" "), F.lit("|")))
    fixed = R.Resolution(piped.withColumn("match_type", F.lit(None).cast("string")), known)
    lines = R.review_lines(R.review_log(fixed, A.AS_OF))
    return lines.select(F.concat(F.substring("value", 1, 19), F.regexp_replace("value", r"^[^|]*", "")).alias("line"))


@query("write_stats", f"""
WITH {_RESOLVED}
SELECT count(*) FILTER (WHERE match_type IS NULL) AS created, count(*) FILTER (WHERE match_type = 'phone') AS merged_phone,
  count(*) FILTER (WHERE match_type = 'fuzzy') AS merged_fuzzy, count(*) FILTER (WHERE match_type = 'key') AS merged_key FROM resolved""")
def _(spark, sf):
    return G.write_stats(R.resolve(_leads(spark, sf)).records)


# --- graph of the resolved leads -----------------------------------------------------------

_last = lambda c: f"arg_max({blank_to_null(c)}, rn) FILTER (WHERE {not_blank(c)})"
_PRIMARY = (
    f"coalesce(nullif({digits(blank_to_null('phone'))}, ''), {blank_to_null('email')}, {blank_to_null('website')}, '')"
)
_FIRST, _SECOND = "seq % 2 = 0", "seq % 2 = 1"


def _graph_sql(source: str = "SELECT * FROM ident", order: str = "seq", only: str = "true") -> str:
    """Node and edge tables of the resolved leads, or of those under ``only``."""
    return _resolved_sql(source, order) + "," + _tables_sql(only)


def _tables_sql(only: str = "true") -> str:
    return f"""
rows AS MATERIALIZED (SELECT * EXCLUDE (entity_key, score), resolved_key AS entity_key, {source_name('source_url')} AS source,
  seq % 101 AS score FROM resolved WHERE {only}),
companies AS MATERIALIZED (
  SELECT entity_key AS dedup_key, arg_min(stored_name, rn) AS company_name, arg_min(in_norm, rn) AS normalized_name,
    {_last('phone')} AS phone, {_last('email')} AS email, {_last('website')} AS website, {_last('address')} AS address,
    {_last('industry_code')} AS industry_code, CAST(arg_max(score, rn) AS INT) AS lead_score
  FROM rows GROUP BY entity_key),
src AS (SELECT entity_key AS dedup_key, string_agg(source, ',' ORDER BY first) AS sources FROM (
  SELECT entity_key, source, min(rn) AS first FROM rows WHERE source IS NOT NULL GROUP BY ALL) GROUP BY entity_key),
listed_in AS MATERIALIZED (SELECT DISTINCT entity_key AS dedup_key, category_slug AS category FROM rows),
located_in AS MATERIALIZED (SELECT DISTINCT entity_key AS dedup_key, city_slug AS city FROM rows),
sourced_from AS MATERIALIZED (SELECT entity_key AS dedup_key, source,
  arg_max(lower(source || '|' || stored_name || '|' || {_PRIMARY}), rn) AS raw_record_id
  FROM rows WHERE source IS NOT NULL GROUP BY ALL)"""


def _resolved(spark, sf, where="true"):
    return R.resolve(_leads(spark, sf).where(where)).records


def _graph(spark, sf):
    return G.build_graph(_resolved(spark, sf), A.AS_OF)


def _company_rows(companies):
    return companies.select(
        "dedup_key", "company_name", "normalized_name", "phone", "email", "website", "address", "industry_code",
        "lead_score", F.array_join("sources", ",").alias("sources"),
        F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"),
    )


@query("company_upsert", f"""
WITH {_graph_sql()}
SELECT companies.*, coalesce(sources, '') AS sources, '2026-01-31' AS first_seen, '2026-01-31' AS last_seen
FROM companies LEFT JOIN src USING (dedup_key)""")
def _(spark, sf):
    return _company_rows(G.upsert_companies(_resolved(spark, sf), A.AS_OF))


_EXISTING_SQL = f"""
WITH {_graph_sql(order="seq % 2, seq")}, old AS (SELECT DISTINCT entity_key AS dedup_key FROM rows WHERE {_FIRST}),
new AS (SELECT DISTINCT entity_key AS dedup_key FROM rows WHERE {_SECOND}),
late AS MATERIALIZED (SELECT *, rn AS o FROM rows)
SELECT entity_key AS dedup_key, arg_min(stored_name, o) AS company_name, arg_min(in_norm, o) AS normalized_name,
  arg_max({blank_to_null('phone')}, o) FILTER (WHERE {not_blank('phone')}) AS phone,
  arg_max({blank_to_null('email')}, o) FILTER (WHERE {not_blank('email')}) AS email,
  CAST(arg_max(score, o) AS INT) AS lead_score,
  CASE WHEN entity_key IN (SELECT dedup_key FROM old) THEN '2026-01-30' ELSE '2026-01-31' END AS first_seen,
  CASE WHEN entity_key IN (SELECT dedup_key FROM new) THEN '2026-01-31' ELSE '2026-01-30' END AS last_seen
FROM late GROUP BY entity_key"""


@query("company_upsert_existing", _EXISTING_SQL)
def _(spark, sf):
    yesterday = "2026-01-30 12:00:00"
    old = G.upsert_companies(_resolved(spark, sf, _FIRST), yesterday)
    batch = R.resolve(_leads(spark, sf).where(_SECOND), old).records
    return _company_rows(G.upsert_companies(batch, A.AS_OF, old)).select(
        "dedup_key", "company_name", "normalized_name", "phone", "email", "lead_score", "first_seen", "last_seen"
    )


@query("company_upsert_delta", _EXISTING_SQL)
def _(spark, sf):
    """The same two batches through the stored graph, which rewrites touched buckets only."""
    store = GraphStore(spark, f"{ensure_checkpoint_dir(spark)}/graph-{uuid.uuid4().hex}")
    whole = F.from_json(F.to_json("lead_score_breakdown"), BREAKDOWN)
    typed = lambda records: records.withColumn("lead_score_breakdown", whole)
    store.upsert(typed(_resolved(spark, sf, _FIRST)), "2026-01-30 12:00:00")
    store.upsert(typed(R.resolve(_leads(spark, sf).where(_SECOND), store.table("companies")).records), A.AS_OF)
    return _company_rows(store.table("companies")).select(
        "dedup_key", "company_name", "normalized_name", "phone", "email", "lead_score", "first_seen", "last_seen"
    )


@query("resolve_second_batch", f"""
WITH {_resolved_sql(order="seq % 2, seq")}
SELECT seq, resolved_key, match_type, round(score, 6) AS fuzzy_score FROM resolved WHERE {_SECOND}""")
def _(spark, sf):
    """A batch against stored companies, whose names are looked up in the persisted segment index."""
    store = GraphStore(spark, f"{ensure_checkpoint_dir(spark)}/graph-{uuid.uuid4().hex}")
    whole = F.from_json(F.to_json("lead_score_breakdown"), BREAKDOWN)
    store.upsert(_resolved(spark, sf, _FIRST).withColumn("lead_score_breakdown", whole), A.AS_OF)
    batch = R.resolve(_leads(spark, sf).where(_SECOND), store.index()).records
    return batch.select("seq", "resolved_key", "match_type", F.round("fuzzy_score", 6).alias("fuzzy_score"))


@query("edges_listed_in", f"WITH {_graph_sql()} SELECT dedup_key, category FROM listed_in")
def _(spark, sf):
    return G.listed_in(_resolved(spark, sf))


@query("edges_located_in", f"WITH {_graph_sql()} SELECT dedup_key, city FROM located_in")
def _(spark, sf):
    return G.located_in(_resolved(spark, sf))


@query("edges_sourced_from", f"WITH {_graph_sql()} SELECT dedup_key, source, '2026-01-31' AS scraped_at, raw_record_id FROM sourced_from")
def _(spark, sf):
    edges = G.sourced_from(_resolved(spark, sf), A.AS_OF)
    return edges.withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd"))


_STATS = """
SELECT 'Company' AS label, count(*) AS count FROM companies UNION ALL SELECT 'Category', count(DISTINCT category) FROM listed_in
UNION ALL SELECT 'City', count(DISTINCT city) FROM located_in UNION ALL SELECT 'Source', count(DISTINCT source) FROM sourced_from
UNION ALL SELECT 'LISTED_IN', count(*) FROM listed_in UNION ALL SELECT 'LOCATED_IN', count(*) FROM located_in
UNION ALL SELECT 'SOURCED_FROM', count(*) FROM sourced_from"""


@query("graph_stats", f"WITH {_graph_sql()} {_STATS}")
def _(spark, sf):
    return G.graph_stats(_graph(spark, sf))


@query("company_count", f"WITH {_graph_sql()} SELECT count(*) AS count FROM companies")
def _(spark, sf):
    return G.company_count(_graph(spark, sf))


_TWICE = "SELECT *, 0 AS pass FROM ident UNION ALL SELECT *, 1 FROM ident"


@query("idempotency_delta", f"""
WITH once AS (WITH {_graph_sql()} {_STATS}), twice AS (WITH {_graph_sql(_TWICE, "pass, seq")} {_STATS})
SELECT label, once.count AS before, twice.count AS after, twice.count - once.count AS delta FROM once JOIN twice USING (label)""")
def _(spark, sf):
    before = _graph(spark, sf)
    # The graph of the first run is read by the second one and by both counts.
    first = {t: stored(getattr(before, t)) for t in ("companies", "listed_in", "located_in", "sourced_from")}
    before = before._replace(**first, categories=first["listed_in"].select(F.col("category").alias("name")).distinct(),
                             cities=first["located_in"].select(F.col("city").alias("name")).distinct(),
                             source_nodes=first["sourced_from"].select(F.col("source").alias("name")).distinct())
    again = R.resolve(_leads(spark, sf), before.companies).records
    after = G.build_graph(again, A.AS_OF, before)
    return G.stats_delta(G.graph_stats(before), G.graph_stats(after))


@query("unique_keys", f"WITH {_graph_sql()} SELECT count(*) AS companies, count(DISTINCT dedup_key) AS keys FROM companies")
def _(spark, sf):
    graph = _graph(spark, sf)
    G.check_constraints(graph)
    return graph.companies.agg(F.count("*").alias("companies"), F.count_distinct("dedup_key").alias("keys"))


_LINKED = """
links AS (SELECT dedup_key, category AS cat, NULL AS src FROM listed_in UNION ALL SELECT dedup_key, NULL, source FROM sourced_from)"""
_COLLECTED = """array_to_string(list_sort(list(DISTINCT cat) FILTER (WHERE cat IS NOT NULL)), ',') AS categories,
  coalesce(array_to_string(list_sort(list(DISTINCT src) FILTER (WHERE src IS NOT NULL)), ','), '') AS sources"""


@query("by_location", f"""
WITH {_graph_sql()}, {_LINKED}
SELECT company_name, website, address, phone, email, lead_score, {_COLLECTED}
FROM companies JOIN located_in USING (dedup_key) LEFT JOIN links USING (dedup_key) WHERE city = 'nation_3' GROUP BY ALL ORDER BY company_name""")
def _(spark, sf):
    found = G.query_by_location(_graph(spark, sf), "nation_3")
    return found.withColumns({c: F.array_join(c, ",") for c in ("categories", "sources")})


@query("company_detail", f"""
WITH {_graph_sql()}, {_LINKED}
SELECT company_name, website, address, phone, email, city, lead_score, '{{"total":' || lead_score || '}}' AS lead_score_breakdown, {_COLLECTED}
FROM companies LEFT JOIN located_in USING (dedup_key) LEFT JOIN links USING (dedup_key)
WHERE contains(lower(company_name), 'nova') GROUP BY ALL ORDER BY company_name""")
def _(spark, sf):
    found = G.query_company_detail(_graph(spark, sf), "NOVA")
    return found.withColumns({c: F.array_join(c, ",") for c in ("categories", "sources")})


# Pieces of the leads' own names, of one to seven characters, as search terms.
_TERM = "substr(company_name, CAST(1 + seq % 9 AS INT), CAST(1 + seq % 7 AS INT))"


@query("company_detail_indexed", f"""
WITH {REGISTRY}, terms AS (SELECT DISTINCT {_TERM} AS term FROM leads)
SELECT term, dedup_key, company_name FROM terms JOIN registry ON contains(lower(company_name), lower(term))""")
def _(spark, sf):
    companies = stored(_registry(spark, sf))
    terms = A.leads(spark, sf).select(F.expr(_TERM).alias("term")).distinct()
    return find_names(terms, companies, stored(name_postings(companies)))


@query("rescore", f"""
WITH {_graph_sql()}, n AS (SELECT entity_key, count(DISTINCT source) AS n FROM rows GROUP BY entity_key)
SELECT seq, CASE WHEN {present('phone')} THEN 25 ELSE 0 END + CASE WHEN {present('email')} THEN 15 ELSE 0 END
  + CASE WHEN {present('website')} THEN 15 ELSE 0 END + CASE WHEN n >= 3 THEN 35 WHEN n = 2 THEN 25 ELSE 0 END
  + CASE WHEN first_seen IS NULL OR first_seen::DATE = DATE '2026-01-31' THEN 10
     WHEN first_seen >= TIMESTAMP '2026-01-24 12:00:00' THEN 5 ELSE 0 END AS lead_score
FROM rows JOIN n USING (entity_key)""")
def _(spark, sf):
    resolved = _resolved(spark, sf)
    companies = G.upsert_companies(resolved, A.AS_OF)
    linked = resolved.select("seq", F.col("resolved_key").alias("dedup_key"))
    leads = A.leads(spark, sf).withColumn("sources", F.expr("CAST(NULL AS ARRAY<STRING>)"))
    return rescore_from_companies(leads, linked, companies, A.AS_OF).select(
        "seq", F.least("lead_score", F.lit(100)).alias("lead_score")
    )


# --- legacy graph ------------------------------------------------------------------------

_CODE = "upper(replace(replace(trim(industry), ' ', '_'), '/', '_'))"
_LEGACY = f"""
raw AS (SELECT *, md5(lower({strip("coalesce(company_name, 'None') || '|' || coalesce(website, 'None')")})) AS dk FROM ({LEGACY})),
m AS MATERIALIZED (SELECT dk, min(seq) AS seq, {', '.join(
    f"arg_min({c}, seq) FILTER (WHERE {c} <> '') AS {c}"
    for c in ('company_name', 'website', 'phone', 'phone1', 'email', 'raw_email', 'address', 'locality', 'city', 'industry', 'source_url')
)} FROM raw GROUP BY dk),
w AS MATERIALIZED (SELECT dk, seq, coalesce({blank_to_null('company_name')}, 'Unknown') AS company_name, website,
  nullif(trim(concat_ws(' ', address, locality, city)), '') AS address, city, {strip('industry')} AS industry,
  CASE WHEN {strip('industry')} IN ('N/A', 'n/a') THEN NULL WHEN length({_CODE}) > 50 THEN substr(md5({_CODE}), 1, 16) ELSE {_CODE} END AS code,
  source_url, coalesce({source_name('lower(source_url)')}, 'Unknown') AS source,
  list_concat(regexp_extract_all(coalesce(phone, ''), '[0-9]{{6,15}}'), regexp_extract_all(coalesce(phone1, ''), '[0-9]{{6,15}}')) AS phones,
  regexp_extract_all(lower(coalesce(email, '') || '|' || coalesce(raw_email, '')), '{EMAIL}') AS emails FROM m)"""


@query("legacy_edges", f"""
WITH {_LEGACY}
SELECT DISTINCT 'HAS_PHONE' AS rel, dk AS dedup_key, unnest(phones) AS value FROM w
UNION ALL SELECT DISTINCT 'HAS_EMAIL', dk, unnest(emails) FROM w
UNION ALL SELECT 'HAS_WEBSITE', dk, website FROM w WHERE website <> ''
UNION ALL SELECT 'LOCATED_IN', dk, city FROM w WHERE city <> ''
UNION ALL SELECT 'BELONGS_TO', dk, code FROM w WHERE code <> ''
UNION ALL SELECT 'SOURCED_FROM', dk, source FROM w WHERE source <> 'Unknown'""")
def _(spark, sf):
    g = build_legacy_graph(A.legacy_rows(spark, sf))
    parts = {"HAS_PHONE": g.has_phone, "HAS_EMAIL": g.has_email, "HAS_WEBSITE": g.has_website,
             "LOCATED_IN": g.located_in, "BELONGS_TO": g.belongs_to, "SOURCED_FROM": g.sourced_from}
    out = None
    for rel, edges in parts.items():
        part = edges.select(F.lit(rel).alias("rel"), "dedup_key", F.col(edges.columns[1]).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query("legacy_companies", f"""
WITH {_LEGACY} SELECT dk AS dedup_key, company_name, website, address, code AS industry_code, source_url FROM w""")
def _(spark, sf):
    return build_legacy_graph(A.legacy_rows(spark, sf)).companies


@query("legacy_industries", f"WITH {_LEGACY} SELECT code, arg_min(industry, seq) AS name FROM w WHERE code <> '' GROUP BY code")
def _(spark, sf):
    return build_legacy_graph(A.legacy_rows(spark, sf)).industries


# --- whole batch run ---------------------------------------------------------------------

_CLEAN = f"""
keyed AS{JUDGED.split("keyed AS", 1)[1]},
valid AS MATERIALIZED (SELECT seq FROM judged WHERE reason IS NULL),"""


@query("batch_run", f"""
WITH {_resolved_sql("SELECT * FROM ident SEMI JOIN valid USING (seq)", before=_CLEAN)}, {_tables_sql()}
SELECT (SELECT count(*) FROM leads) AS scraped, (SELECT count(*) FROM valid) AS kept_after_validation,
  (SELECT count(*) FROM keyed) - (SELECT count(*) FROM kept) AS rejected_duplicates,
  (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS invalid_records,
  count(*) FILTER (WHERE match_type IS NULL) AS created, count(*) FILTER (WHERE match_type = 'phone') AS merged_phone,
  count(*) FILTER (WHERE match_type = 'fuzzy') AS merged_fuzzy, count(*) FILTER (WHERE match_type = 'key') AS merged_key,
  (SELECT count(*) FROM listed_in) AS listed_in, (SELECT count(*) FROM sourced_from) AS sourced_from,
  (SELECT count(*) FROM valid) AS promoted, (SELECT count(*) FROM ({CRAWL_ERRORS})) AS error_rows,
  (SELECT count(*) FROM resolved r JOIN scores s USING (in_form, in_norm) JOIN leaders USING (cand_form, cand_norm)
   WHERE s.score >= 80 AND leader_seq < rn AND coalesce(match_type <> 'phone', true)) AS review_rows
FROM resolved""")
def _(spark, sf):
    """Clean, stage, resolve into stored graph tables, gate and promote, in a fresh store."""
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark)}/batch-run-{uuid.uuid4().hex}")
    summary = lead_run(
        store, A.leads(spark, sf), A.crawl_errors(spark, sf), A.crawl_targets(spark, sf), A.AS_OF, "run"
    )
    names = ["scraped", "kept_after_validation", "rejected_duplicates", "invalid_records", "created",
             "merged_phone", "merged_fuzzy", "merged_key"]
    counts = {n: summary[n] for n in names} | {n.lower(): summary[n] for n in ("LISTED_IN", "SOURCED_FROM")}
    counts |= {"error_rows": store.read("scrape_errors").count(), "review_rows": store.read("fuzzy_review").count()}
    literal = [F.max(F.lit(v).cast("bigint")).alias(n) for n, v in counts.items()]
    return store.read("leads").agg(*literal, F.count("*").alias("promoted"))
