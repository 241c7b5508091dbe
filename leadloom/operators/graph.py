"""Company graph as node and edge tables: upsert, statistics, queries, checks."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.names import primary_contact, raw_record_id
from leadloom.functions.text import blank_to_null
from leadloom.functions.urls import source_name
from leadloom.operators.leads import as_of_column

_CONTACT = ["phone", "email", "website", "address", "industry_code"]
NODE_TABLES = {"Company": "companies", "Category": "categories", "City": "cities", "Source": "source_nodes"}
EDGE_TABLES = {"LISTED_IN": "listed_in", "LOCATED_IN": "located_in", "SOURCED_FROM": "sourced_from"}


class Graph(NamedTuple):
    companies: DataFrame
    listed_in: DataFrame
    located_in: DataFrame
    sourced_from: DataFrame
    categories: DataFrame
    cities: DataFrame
    source_nodes: DataFrame


def _cleaned(resolved: DataFrame) -> DataFrame:
    """Resolved records with stripped values and their source."""
    stripped = {c: blank_to_null(c) for c in (*_CONTACT, "city_slug", "category_slug", "source_url")}
    return resolved.withColumns(stripped).withColumn("source", source_name("source_url"))


def upsert_companies(
    resolved: DataFrame, as_of, existing: DataFrame | None = None
) -> DataFrame:
    """Company table after the batch.

    Name, identity form and first_seen come from creation; contact fields are the last
    non-empty values; last_seen, score and breakdown are the last ones (NULL overwrites);
    sources append in order of first appearance.
    """
    now = as_of_column(as_of)
    rows = _cleaned(resolved)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))
    batch = rows.groupBy(F.col("resolved_key").alias("dedup_key")).agg(
        F.min_by(F.struct("stored_name", "in_norm"), "seq").alias("created"),
        *[last(c).alias(f"new_{c}") for c in _CONTACT],
        F.max_by(F.struct("lead_score", "lead_score_breakdown"), "seq").alias("scored"),
    )
    # At most one row per (company, directory) reaches the collection below.
    seen = (
        rows.where(F.col("source").isNotNull())
        .groupBy(F.col("resolved_key").alias("dedup_key"), "source")
        .agg(F.min("seq").alias("first"))
        .groupBy("dedup_key")
        .agg(F.array_sort(F.collect_list(F.struct("first", "source")))["source"].alias("new_sources"))
    )
    batch = batch.join(seen, "dedup_key", "left")
    no_sources = F.expr("CAST(array() AS ARRAY<STRING>)")
    fresh = F.coalesce("new_sources", no_sources)
    if existing is None:
        return batch.select(
            "dedup_key",
            F.col("created.stored_name").alias("company_name"),
            F.col("created.in_norm").alias("normalized_name"),
            *[F.col(f"new_{c}").alias(c) for c in _CONTACT],
            now.alias("first_seen"), now.alias("last_seen"),
            F.col("scored.lead_score"), F.col("scored.lead_score_breakdown"),
            fresh.alias("sources"),
        )
    old = existing.withColumn("is_old", F.lit(True))
    both = old.join(batch.withColumn("touched", F.lit(True)), "dedup_key", "full")
    on_touch = lambda new, kept: F.when(F.col("touched"), new).otherwise(F.col(kept))
    on_create = lambda new, kept: F.when(F.col("is_old"), F.col(kept)).otherwise(new)
    return both.select(
        "dedup_key",
        on_create(F.col("created.stored_name"), "company_name").alias("company_name"),
        on_create(F.col("created.in_norm"), "normalized_name").alias("normalized_name"),
        *[F.coalesce(f"new_{c}", c).alias(c) for c in _CONTACT],
        on_create(now, "first_seen").alias("first_seen"),
        on_touch(now, "last_seen").alias("last_seen"),
        on_touch(F.col("scored.lead_score"), "lead_score").alias("lead_score"),
        on_touch(F.col("scored.lead_score_breakdown"), "lead_score_breakdown").alias("lead_score_breakdown"),
        F.array_union(F.coalesce("sources", no_sources), fresh).alias("sources"),
    )


def _edge(resolved: DataFrame, column: str, name: str, existing: DataFrame | None) -> DataFrame:
    edges = resolved.select(
        F.col("resolved_key").alias("dedup_key"), blank_to_null(column).alias(name)
    ).where(F.col(name).isNotNull())
    if existing is not None:
        edges = edges.unionByName(existing.select("dedup_key", name))
    return edges.distinct()


def listed_in(resolved: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _edge(resolved, "category_slug", "category", existing)


def located_in(resolved: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _edge(resolved, "city_slug", "city", existing)


def sourced_from(resolved: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    """One edge per (company, source) with the last scrape time and raw record id.

    The id uses the incoming name, not the stored company name.
    """
    rows = _cleaned(resolved).where(F.col("source").isNotNull())
    edges = rows.select(
        F.col("resolved_key").alias("dedup_key"), "source", "seq",
        as_of_column(as_of).alias("scraped_at"),
        raw_record_id("source", "stored_name", primary_contact("phone", "email", "website"))
        .alias("raw_record_id"),
    )
    if existing is not None:
        edges = edges.unionByName(existing.withColumn("seq", F.lit(-1).cast("bigint")))
    return (
        edges.groupBy("dedup_key", "source")
        .agg(F.max_by(F.struct("scraped_at", "raw_record_id"), "seq").alias("e"))
        .select("dedup_key", "source", "e.*")
    )


def _nodes(edges: DataFrame, column: str, existing: DataFrame | None) -> DataFrame:
    names = edges.select(F.col(column).alias("name"))
    return (names if existing is None else names.unionByName(existing)).distinct()


def build_graph(resolved: DataFrame, as_of, existing: Graph | None = None) -> Graph:
    """All node and edge tables after the batch."""
    old = existing or Graph(*[None] * 7)
    li = listed_in(resolved, old.listed_in)
    lo = located_in(resolved, old.located_in)
    sf = sourced_from(resolved, as_of, old.sourced_from)
    return Graph(
        upsert_companies(resolved, as_of, old.companies), li, lo, sf,
        _nodes(li, "category", old.categories), _nodes(lo, "city", old.cities),
        _nodes(sf, "source", old.source_nodes),
    )


def write_stats(resolved: DataFrame) -> DataFrame:
    """Records per outcome: created, merged by phone, fuzzy name, or equal identity key."""
    kinds = {"created": F.col("match_type").isNull()}
    kinds |= {f"merged_{t}": F.col("match_type") == t for t in ("phone", "fuzzy", "key")}
    return resolved.agg(*[F.count_if(cond).alias(name) for name, cond in kinds.items()])


def graph_stats(graph: Graph) -> DataFrame:
    """Row per node label and relationship type with its count."""
    tables = NODE_TABLES | EDGE_TABLES
    return reduce(
        DataFrame.unionByName,
        [
            getattr(graph, table).agg(F.count("*").alias("count")).select(F.lit(label).alias("label"), "count")
            for label, table in tables.items()
        ],
    )


def company_count(graph: Graph) -> DataFrame:
    return graph.companies.agg(F.count("*").alias("count"))


def stats_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of every count between two snapshots; all zero after an idempotent re-run."""
    return before.withColumnRenamed("count", "before").join(
        after.withColumnRenamed("count", "after"), "label", "full"
    ).withColumn("delta", F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0)))


def check_unique(table: DataFrame, *keys: str) -> None:
    """Raise when a key occurs more than once (a uniqueness constraint)."""
    clash = table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"duplicate key {clash[0].asDict()}")


def check_constraints(graph: Graph) -> None:
    check_unique(graph.companies, "dedup_key")
    for nodes in (graph.categories, graph.cities, graph.source_nodes):
        check_unique(nodes, "name")


def _with_links(companies: DataFrame, graph: Graph, columns: list[str]) -> DataFrame:
    """Group by the returned columns, collecting distinct category and source names.

    Both edge kinds come through one join, so categories and sources do not multiply.
    """
    link = lambda df, name: df.select(
        "dedup_key", F.lit(name).alias("kind"), F.col(name).alias("value")
    )
    links = link(graph.listed_in, "category").unionByName(link(graph.sourced_from, "source"))
    named = lambda kind: F.array_sort(
        F.collect_set(F.when(F.col("kind") == kind, F.col("value")))
    )
    return (
        companies.join(links, "dedup_key", "left")
        .groupBy(*columns)
        .agg(named("category").alias("categories"), named("source").alias("sources"))
        .orderBy("company_name")
    )


def query_by_location(graph: Graph, city: str) -> DataFrame:
    """Companies of a city with their categories and sources, by name."""
    columns = ["company_name", "website", "address", "phone", "email", "lead_score"]
    there = graph.located_in.where(F.col("city") == city).select("dedup_key")
    found = graph.companies.join(there, "dedup_key", "left_semi").select("dedup_key", *columns)
    return _with_links(found, graph, columns)


def query_company_detail(graph: Graph, name: str) -> DataFrame:
    """Companies whose name contains ``name`` (any case), one row per city."""
    columns = ["company_name", "website", "address", "phone", "email", "city", "lead_score", "breakdown"]
    hit: Column = F.lower("company_name").contains(name.lower())
    found = (
        graph.companies.where(hit)
        .withColumn("breakdown", F.to_json("lead_score_breakdown"))
        .join(graph.located_in, "dedup_key", "left")
        .select("dedup_key", *columns)
    )
    out = _with_links(found, graph, columns)
    return out.withColumnRenamed("breakdown", "lead_score_breakdown")
