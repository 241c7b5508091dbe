"""Lead-shaped views over the benchmark tables.

Each view is one SQL text that Spark and an ANSI engine read alike; ``{customer}`` and the
like stand for the table. They are projections for testing and benchmarking, not operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2026-01-31 12:00:00"

_WORDS = (
    "Acme,Acmee,Bharat,Bharath,Nova,Novaa,Pinnacle,Zenith,Orion,Vertex,Summit,Apex,Lotus,Indus,"
    "Ganga,Himal,Malabar,Deccan,Coral,Saffron,Sapphire,Emerald,Quantum,Fusion,Matrix,Vector,"
    "Cobalt,Granite,Harbor,Meridian,Mercury,Jupiter,Saturn,Neptune,Aurora,Polaris,Sirius,Altair,"
    "Rigel,Vega"
)
_PLACES = (
    "Northgate,Southgate,Eastend,Westend,Riverside,Lakeside,Hillside,Midtown,Uptown,Downtown,"
    "Harbour,Seaside,Parkside,Oldtown,Newtown,Central,Garden,Market,Station,Airport,Castle,"
    "Bridge,Fort"
)
_SUFFIXES = "Pvt Ltd,LLP,Solutions,(OPC) Private Limited,Inc.,Services"

LEADS_SQL = f"""
SELECT k AS seq,
  CASE WHEN k % 211 = 5 THEN '   '
       ELSE word || ' ' || place || ' ' || split_part('{_SUFFIXES}', ',', CAST(k % 6 + 1 AS INT))
  END AS company_name,
  CASE WHEN k % 4 = 0 THEN NULL
       ELSE 'https://www.' || lower(word) || CAST(k % 500 AS STRING) || '.example.com/' END AS website,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 0 THEN ' not-an-address ' WHEN k % 11 = 0 THEN ''
       ELSE lower(word) || CAST(k AS STRING) || '@example.com' END AS email,
  CASE WHEN k % 3 = 0 THEN NULL WHEN k % 17 = 0 THEN '  '
       ELSE '+91 ' || CAST(9000000000 + k % 700 AS STRING) END AS phone,
  CAST(k % 97 AS STRING) || ' Main Road' AS address,
  segment AS industry_code,
  CASE WHEN k % 2 = 0 THEN NULL ELSE CAST(k % 500 AS INT) END AS employee_count,
  CASE WHEN k % 3 = 1 THEN NULL ELSE 'band-' || CAST(k % 4 AS STRING) END AS revenue_band,
  CASE k % 4 WHEN 0 THEN 'https://www.justdial.com/list' WHEN 1 THEN 'https://dir.indiamart.com/list'
       WHEN 2 THEN 'https://www.tradeindia.com/list'
       ELSE 'https://www.elsewhere.example.org/list' END AS source_url,
  lower(segment) AS category_slug,
  lower(city) AS city_slug,
  CASE WHEN k % 12 = 11 THEN NULL
       ELSE TIMESTAMP '{AS_OF}' - INTERVAL '1' DAY * (k % 12) END AS first_seen
FROM (
  SELECT c.c_custkey AS k, c.c_mktsegment AS segment, n.n_name AS city,
    split_part('{_WORDS}', ',', CAST(c.c_custkey % 40 + 1 AS INT)) AS word,
    split_part('{_PLACES}', ',', CAST(c.c_custkey % 23 + 1 AS INT)) AS place
  FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
) AS base
"""

# Crawl results with repeating names: later pages run out of unseen ones. Some slugs are absent.
LISTINGS_SQL = """
SELECT o_orderkey AS seq,
  CASE WHEN o_custkey % 5 = 0 THEN 'justdial' WHEN o_custkey % 2 = 0 THEN 'indiamart' ELSE 'tradeindia' END AS site,
  CASE WHEN o_custkey % 13 > 0 THEN lower(o_orderpriority) END AS category_slug,
  CASE WHEN o_custkey % 10 <> 7 THEN 'city-' || CAST(o_custkey % 10 AS STRING) END AS city_slug,
  CAST(1 + o_orderkey % 12 AS INT) AS page,
  CASE WHEN o_orderkey % 97 = 0 THEN ' ' ELSE ' Company ' || CAST(o_custkey % 60 AS STRING) END
    AS company_name
FROM {orders}
"""

FETCH_LOG_SQL = """
SELECT event_id AS seq, CAST(CAST(ts AS DATE) AS STRING) AS date,
  CASE WHEN event_id % 29 > 0 THEN 'site' || CAST(user_id % 25 AS STRING) || '.example.com' END AS domain,
  CASE user_id % 3 WHEN 0 THEN 'justdial' WHEN 1 THEN 'indiamart' ELSE 'tradeindia' END AS site,
  'parse_' || CASE user_id % 3 WHEN 0 THEN 'justdial' WHEN 1 THEN 'indiamart' ELSE 'tradeindia' END
    AS parser,
  CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 403 ELSE 404 END
       WHEN 'signup' THEN 503 ELSE 200 END AS status,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE repeat('é', CAST(event_id % 520 AS INT)) END AS body,
  CASE WHEN event_id % 7 = 0 THEN NULL
       ELSE 'http://user:pw@10.0.0.' || CAST(user_id % 50 AS STRING) || ':8080' END AS endpoint,
  event_type IN ('view', 'click') AS yielded
FROM {events}
"""

TARGETS_SQL = """
SELECT 'Site' || n_name AS name, n_nationkey % 2 = 0 AS enabled, n_nationkey AS pos FROM {nation}
UNION ALL SELECT 'Justdial', FALSE, 100 UNION ALL SELECT 'IndiaMART', TRUE, 101
UNION ALL SELECT 'TradeIndia', TRUE, 102
"""

ERRORS_SQL = """
SELECT ' https://site' || CAST(o_orderkey % 6 AS STRING) || '.example.com ' AS url,
  'RobotsDisallowed' AS error_type, 'run-' || CAST(o_orderkey % 3 AS STRING) AS run_id
FROM {orders}
"""

# One crawl target per order; the urgent ones (about a fifth) failed.
CRAWL_TARGETS_SQL = "SELECT 'target ' || CAST(o_orderkey AS STRING) AS name, TRUE AS enabled FROM {orders}"
CRAWL_ERRORS_SQL = f"""
SELECT 'https://target' || CAST(o_orderkey AS STRING) || '.example.com' AS url, TIMESTAMP '{AS_OF}' AS timestamp,
  'Timeout' AS error_type
FROM {{orders}} WHERE o_orderpriority = '1-URGENT'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LEADS_SQL, "customer", "nation")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LISTINGS_SQL, "orders")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FETCH_LOG_SQL, "events")


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TARGETS_SQL, "nation")


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ERRORS_SQL, "orders")


def crawl_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CRAWL_TARGETS_SQL, "orders")


def crawl_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CRAWL_ERRORS_SQL, "orders")


def caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily request cap per domain: a few, for every fifth domain many."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("site"), F.col("n_nationkey").cast("string"), F.lit(".example.com")).alias("domain"),
        F.when(F.col("n_nationkey") % 5 == 0, 40 + F.col("n_nationkey")).otherwise(6 + F.col("n_nationkey") % 7).cast("int").alias("cap"),
    )


def prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units already consumed on the first day."""
    return caps(spark, sf_dir).select(
        F.lit("2024-01-01").alias("date"), "domain", (F.col("cap") % 4).cast("int").alias("consumed")
    )


# --- captured pages built from leads -----------------------------------------------------

PER_PAGE = 10


def _paged(df: DataFrame, item, *extra) -> DataFrame:
    """Ten consecutive leads per page; ``items`` is their JSON in order."""
    page = F.floor(F.col("seq") / PER_PAGE).cast("bigint")
    return (
        df.groupBy(page.alias("page_id"))
        .agg(
            F.array_sort(F.collect_list(F.struct("seq", item.alias("item"))))["item"].alias("items"),
            *extra,
        )
        .withColumn("url", F.concat(F.lit("https://dir.indiamart.com/list/"), F.col("page_id").cast("string")))
    )


def json_ld_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per lead: a malformed block, then a business node (every fifth in a graph)."""
    rows = leads(spark, sf_dir)
    node = F.to_json(F.struct(
        F.when(F.col("seq") % 6 == 1, "WebSite").when(F.col("seq") % 6 != 2, "LocalBusiness").alias("@type"),
        F.col("company_name").alias("name"),
        F.when(F.col("seq") % 9 == 0, "https://www.facebook.com/x").otherwise(F.col("website")).alias("url"),
        F.col("phone").alias("telephone"),
        F.struct(F.col("address").alias("streetAddress"), F.col("city_slug").alias("addressLocality")).alias("address"),
        F.array(F.struct(F.lit(None).cast("string").alias("email")), F.struct(F.col("email").alias("email"))).alias("contactPoint"),
    ))
    body = F.when(F.col("seq") % 5 == 0, F.concat(F.lit('{"@graph":['), node, F.lit("]}"))).otherwise(node)
    html = F.concat(
        F.lit('<html><script type="application/ld+json">{broken</script>'
              '<script type="application/ld+json" async>'), body, F.lit("</script></html>"),
    )
    return rows.select(F.col("seq").alias("page_id"), F.col("source_url").alias("url"), html.alias("html"))


def _state_html(df: DataFrame) -> DataFrame:
    item = F.to_json(F.struct(
        F.col("company_name").alias("CMP"), F.col("address").alias("ad"),
        F.col("city_slug").alias("city"), F.lit("").alias("g_s"),
        F.col("industry_code").alias("ds"),
        F.when(F.col("seq") % 2 == 0, F.concat(F.lit("https://www.indiamart.com/c"), F.col("seq").cast("string"), F.lit("//?x=1")))
        .otherwise(F.col("website")).alias("s_url"),
    ))
    ads = F.array_sort(F.collect_list(F.struct("seq", F.struct(
        F.col("company_name").alias("COMPANYNAME"), F.col("phone").alias("CONTACT_NUMBER")
    ).alias("ad"))))["ad"].alias("ads")
    paged = _paged(df, item, ads)
    html = F.concat(
        F.lit("<script>window.__INITIAL_STATE__ = {\"data\":["), F.array_join("items", ","),
        F.lit("],\"plaWidgetData\":"), F.to_json("ads"), F.lit("}; window.next = {};</script>"),
    )
    return paged.select("page_id", "url", html.alias("html"))


def state_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_html(leads(spark, sf_dir))


def columnar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a ``columns`` + ``data`` payload; contacts of odd leads sit in nested JSON."""
    odd = F.col("seq") % 2 == 1
    text = lambda c: F.to_json(F.array(c))
    nested = F.to_json(F.struct(F.struct(
        F.col("email").alias("email"), F.regexp_replace("website", "^https://", "").alias("website"),
        F.col("phone").alias("misc"),
    ).alias("cmp_params")))
    cells = [F.col("company_name"), F.when(~odd, F.col("phone")), F.col("address"), F.col("city_slug"),
             F.col("industry_code"), F.when(~odd, F.col("email")), F.when(~odd, F.col("website")),
             F.when(odd, nested)]
    row = F.concat(F.lit("["), F.concat_ws(",", *[
        F.coalesce(F.regexp_replace(text(c), r"^\[|\]$", ""), F.lit("null")) for c in cells
    ]), F.lit("]"))
    paged = _paged(leads(spark, sf_dir), row)
    names = '["name","VNumber","NewAddress","city","type","email","website","bd_params"]'
    html = F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"listData":'
              '{"results":{"columns":' + names + ',"data":['), F.array_join("items", ","),
        F.lit("]}}}}}</script>"),
    )
    return paged.select("page_id", "url", html.alias("html"))


def payload_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with captured requests: an unrelated one first, then the site's own."""
    item = F.to_json(F.struct(
        F.when(F.col("seq") % 2 == 0, F.col("company_name")).alias("name"),
        F.when(F.col("seq") % 2 == 1, F.col("company_name")).alias("title"),
        F.col("phone").alias("contactNumber"), F.col("address"), F.col("city_slug").alias("city"),
        F.col("industry_code").alias("category"), F.col("website"), F.col("email"),
    ))
    paged = _paged(leads(spark, sf_dir), item)
    rows = F.array_join("items", ",")
    own = F.col("page_id") % 3 != 2
    payload = lambda url, body: F.struct(url.alias("url"), body.alias("body"))
    payloads = F.array(
        payload(F.lit("https://track.example.com/t"), F.lit('"just a string"')),
        payload(F.lit(None).cast("string"), F.when(own, F.lit('{"results":[{"name":"Decoy"}]}'))
                .otherwise(F.concat(F.lit('{"listData":['), rows, F.lit("]}")))),
        payload(F.lit("https://www.JustDial.com/api"), F.when(own, F.concat(
            F.lit('{"data":{"searchOutput":{"results":['), rows, F.lit("]}}}"))).otherwise(F.lit("{}"))),
    )
    return paged.select("page_id", "url", F.lit("<html></html>").alias("html"), payloads.alias("payloads"))


def cascade_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one site: with page state, with names in script text only, or with nothing."""
    rows = leads(spark, sf_dir)
    state = _state_html(rows).where("page_id % 3 = 0")
    names = _paged(rows, F.concat(F.lit('"CMP" : "'), F.col("company_name"), F.lit('"')))
    text = names.where("page_id % 3 = 1").select("page_id", "url", F.concat(
        F.lit("<script>"), F.array_join("items", ","), F.lit("</script><p>info@contact.in</p>"
        "<p>Call 9876543210</p><a href='https://site.example.in/home?x=1'>w</a>")).alias("html"))
    none = names.where("page_id % 3 = 2").select("page_id", "url", F.lit("<html>none</html>").alias("html"))
    return state.unionByName(text).unionByName(none)


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail page of every third lead; some come back empty, some show site-wide contacts."""
    k = F.col("seq")
    html = (
        F.when(k % 12 == 0, F.lit("  "))
        .when(k % 12 == 3, F.concat(F.lit("<p>helpdesk@tradeindia.com 01146710423</p>")))
        .otherwise(F.concat(
            F.lit("<p>Mail detail"), k.cast("string"), F.lit("@shop.in or call 98"),
            F.lpad((k % 1000).cast("string"), 8, "0"), F.lit("</p><a href=\"https://shop"),
            k.cast("string"), F.lit(".in/?utm=1\">site</a>"),
        ))
    )
    return leads(spark, sf_dir).where(k % 3 == 0).select(k.alias("record_id"), html.alias("html"))


LEGACY_SQL = """
SELECT seq, company_name, CASE WHEN seq % 3 = 0 THEN NULL ELSE website END AS website,
  phone, 'x ' || CAST(7000000 + seq % 90 AS STRING) || ' / 080' AS phone1,
  CAST(NULL AS STRING) AS alt_phone, email,
  CASE WHEN seq % 4 = 1 THEN 'B' || CAST(seq % 9 AS STRING) || '@Mail.COM; junk' ELSE '' END AS raw_email,
  address, 'Sector ' || CAST(seq % 5 AS STRING) AS locality,
  CASE WHEN seq % 6 = 0 THEN '' ELSE city_slug END AS city,
  CASE WHEN seq % 10 = 0 THEN 'N/A' WHEN seq % 10 = 1 THEN repeat('long industry ', 5)
       ELSE industry_code || ' / retail' END AS industry,
  source_url
FROM ({leads}) AS l
"""


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LEGACY_SQL.replace("({leads})", "{leads}"), leads=leads(spark, sf_dir))
