"""Queries over files that Spark writes from the given tables first: faulty JSON, dimensions, snapshots."""

import uuid

from pyspark.sql import functions as F

from leadloom.operators.legacy import build_legacy_graph
from leadloom.session import ensure_checkpoint_dir
from leadloom.sources.captures import scan_dimension, scan_records, scan_snapshots
from leadloom.sources.tables import TableStore
from leadloom.workloads import adapters as A
from leadloom.workloads.catalog import LEADS, LEGACY, query


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("record_batch_scan", f"""
SELECT seq, company_name, phone, NULL AS record FROM ({LEADS}) WHERE seq % 13 NOT IN (0, 5)
UNION ALL SELECT NULL, NULL, NULL, '{{"seq": ' || seq || ', "company_name": "cut' FROM ({LEADS}) WHERE seq % 13 = 0
UNION ALL SELECT NULL, NULL, NULL, '{{"seq": "no number ' || seq || '"}}' FROM ({LEADS}) WHERE seq % 13 = 5""")
def _(spark, sf):
    """All leads as JSON lines, some cut off and some of the wrong type."""
    path = _folder(spark, "records")
    k = F.col("seq").cast("string")
    line = (F.when(F.col("seq") % 13 == 0, F.concat(F.lit('{"seq": '), k, F.lit(', "company_name": "cut')))
            .when(F.col("seq") % 13 == 5, F.concat(F.lit('{"seq": "no number '), k, F.lit('"}')))
            .otherwise(F.to_json(F.struct("seq", "company_name", "phone"))))
    A.leads(spark, sf).select(line.alias("value")).write.text(path)
    found = scan_records(spark, path, "seq BIGINT, company_name STRING, phone STRING")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("seq", "bigint"), ("company_name", "string"), ("phone", "string"))]
    return found.rows.withColumn("record", F.lit(None).cast("string")).unionByName(found.errors.select(*none, "record"))


@query("dimension_load", """
SELECT lower(n_name) AS slug, site, n_name || ' ' || site AS label, CAST(n_regionkey AS VARCHAR) AS code, NULL AS error_type
FROM nation, (VALUES ('indiamart'), ('tradeindia')) s(site) WHERE n_nationkey % 6 NOT IN (2, 4)
UNION ALL SELECT NULL, NULL, NULL, NULL, CASE n_nationkey % 6 WHEN 2 THEN 'MalformedRecord' ELSE 'MissingSlug' END FROM nation WHERE n_nationkey % 6 IN (2, 4)""")
def _(spark, sf):
    """A city dimension from the nations: labels by site in a map, some entries broken or without a slug."""
    path = _folder(spark, "cities")
    kind, labels = F.col("n_nationkey") % 6, F.create_map(*[x for s in ("indiamart", "tradeindia") for x in (F.lit(s), F.concat("n_name", F.lit(f" {s}")))])
    entry = F.to_json(F.struct(F.when(kind == 4, " ").otherwise(F.lower("n_name")).alias("slug"), labels.alias("labels"), F.col("n_regionkey").cast("string").alias("code")))
    A.table(spark, sf, "nation").select(F.when(kind == 2, F.substring(entry, 1, 20)).otherwise(entry).alias("value")).write.text(path)
    found = scan_dimension(spark, path)
    rows = found.rows.select("slug", F.explode("labels").alias("site", "label"), "code", F.lit(None).cast("string").alias("error_type"))
    none = [F.lit(None).cast("string").alias(c) for c in ("slug", "site", "label", "code")]
    return rows.unionByName(found.errors.select(*none, "error_type"))


_COLUMNS = {"company_name": ["company_name", "name"], "website": ["website"], "phone": ["phone", "mobile"], "phone1": ["phone1"], "email": ["email"],
            "raw_email": ["raw_email"], "address": ["address"], "locality": ["locality"], "city": ["city"], "industry": ["industry"], "source_url": ["source_url"]}


def _snapshots(spark, sf):
    """Three snapshots: an old one with other names and fewer columns, one without second phones, a full one."""
    rows, root = A.legacy_rows(spark, sf), _folder(spark, "legacy")
    old = rows.where("seq % 3 = 0").withColumnsRenamed({"company_name": "name", "phone": "mobile"}).drop("raw_email", "phone1")
    for k, part in enumerate((old, rows.where("seq % 3 = 1").drop("phone1"), rows.where("seq % 3 = 2"))):
        # One ordered file, as an export has it.
        part.coalesce(1).sortWithinPartitions("seq").drop("seq").write.parquet(f"{root}/{k}")
    return scan_snapshots(spark, [f"{root}/{k}" for k in range(3)], _COLUMNS)


_PLACE = "row_number() OVER (ORDER BY seq % 3, seq) - 1"


@query("legacy_snapshots", f"""
SELECT {_PLACE} AS seq, CAST(seq % 3 AS INT) AS snapshot, company_name, phone, CASE WHEN seq % 3 = 2 THEN phone1 END AS phone1,
  CASE WHEN seq % 3 <> 0 THEN raw_email END AS raw_email, city, source_url FROM ({LEGACY})""")
def _(spark, sf):
    return _snapshots(spark, sf).select("seq", "snapshot", "company_name", "phone", "phone1", "raw_email", "city", "source_url")


@query("legacy_snapshot_cities", f"""
WITH raw AS (SELECT {_PLACE} AS place, md5(lower(regexp_replace(coalesce(company_name, 'None') || '|' || coalesce(website, 'None'), '^\\s+|\\s+$', '', 'g'))) AS dk, city FROM ({LEGACY}))
SELECT dk AS dedup_key, arg_min(city, place) FILTER (WHERE city <> '') AS city FROM raw GROUP BY dk HAVING count(*) FILTER (WHERE city <> '') > 0""")
def _(spark, sf):
    """The legacy graph over all snapshots: the first city that arrived for a company."""
    return build_legacy_graph(_snapshots(spark, sf)).located_in


@query("truncated_tables", f"SELECT 'leads' AS name, 0 AS after, count(*) AS before FROM ({LEADS}) UNION ALL SELECT 'staging', count(*), count(*) FROM ({LEADS})")
def _(spark, sf):
    """Two filled tables of which one is emptied; the other and the emptied one's earlier version stay."""
    store = TableStore(spark, _folder(spark, "truncate"))
    for name in ("leads", "staging"):
        store.append(name, A.leads(spark, sf))
    before = {name: store.read(name) for name in ("leads", "staging")}
    store.truncate("leads")
    sized = lambda df, name, kind: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit(kind).alias("kind"), "n")
    parts = [sized(df, n, k) for n in before for df, k in ((before[n], "before"), (store.read(n), "after"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("n"))).alias(kind)
    return rows.groupBy("name").agg(pick("after"), pick("before"))
