"""The batch run: raw records to staged, resolved and promoted leads."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.constants import FUZZY_THRESHOLD
from leadloom.operators.dedup import deduplicate
from leadloom.operators.gates import failure_gate, promote, require_gate, staged_summary
from leadloom.operators.graph import graph_stats, write_stats
from leadloom.operators.leads import filter_valid, raw_to_lead, score_leads
from leadloom.operators.resolve import resolve, review_log
from leadloom.sources.graph_store import ConcurrentWrite
from leadloom.sources.tables import TableStore


log = logging.getLogger(__name__)


class CleanLeads(NamedTuple):
    leads: DataFrame
    scored: DataFrame
    rejected: DataFrame
    invalid: DataFrame


def clean_leads(
    raw: DataFrame, as_of, icp_categories: Iterable[str] = (), icp_cities: Iterable[str] = (),
) -> CleanLeads:
    """Convert, deduplicate, validate and score: one lazy plan.

    Deduplication comes before validation, so an invalid record may win its key and then
    drop out.
    """
    leads = raw_to_lead(raw, as_of)
    dedup = deduplicate(leads, as_of)
    checked = filter_valid(dedup.kept)
    scored = score_leads(checked.valid, as_of, icp_categories, icp_cities)
    return CleanLeads(leads, scored, dedup.rejected, checked.invalid)


def resolve_into_graph(
    store: TableStore, scored: DataFrame, as_of, threshold: float = FUZZY_THRESHOLD,
    log_review: bool = True,
) -> dict[str, int]:
    """Resolve staged leads against the stored graph and commit its next version.

    Constraints are checked before the commit; a failed write leaves the version before in place.
    """
    resolution = resolve(scored, store.graph.index(), threshold)
    resolved = resolution.records
    store.upsert_graph(resolved, as_of)
    stored = store.read_graph()
    if log_review and threshold <= 100:
        store.append("fuzzy_review", review_log(resolution, as_of, threshold))
    stats = write_stats(resolved).first().asDict()
    stats.update({r["label"]: r["count"] for r in graph_stats(stored).collect()})  # seven rows
    return stats


def lead_run(
    store: TableStore, raw: DataFrame, errors: DataFrame, targets: DataFrame, as_of, run_id: str,
    icp_categories: Iterable[str] = (), icp_cities: Iterable[str] = (),
    threshold: float = FUZZY_THRESHOLD, dry_run: bool = False,
) -> dict[str, int]:
    """Full run over captured data. Returns the summary; a failing gate raises.

    ``raw`` needs a unique ``seq``. A dry run stops after staging and the sinks. A failure while
    resolving or writing the graph does not end the run: staging, gate and promotion go on, and
    the summary says ``graph_failed``.
    """
    store.ensure_all()
    result = clean_leads(raw, as_of, icp_categories, icp_cities)
    store.overwrite("staging", result.scored)
    store.append("scrape_errors", errors.withColumn("run_id", F.lit(run_id)))
    store.append("rejected_duplicates", result.rejected)
    staged = store.read("staging")
    summary = staged_summary(result.leads, staged, errors).first().asDict()
    if dry_run:
        return summary
    summary["graph_failed"] = 0
    try:
        summary.update(resolve_into_graph(store, staged, as_of, threshold))
    except (PySparkException, Py4JJavaError, OSError, ValueError, ConcurrentWrite):
        log.exception("graph not written")
        summary["graph_failed"] = 1
    require_gate(failure_gate(errors, targets))
    store.append("leads", promote(staged, store.read("leads")))
    return summary


def promote_standalone(store: TableStore, targets: DataFrame, run_id: str | None = None) -> None:
    """Promote what is staged, gated by the distinct failing URLs of the error table."""
    gate = failure_gate(store.read("scrape_errors"), targets, mode="urls", run_id=run_id)
    require_gate(gate)
    store.append("leads", promote(store.read("staging"), store.read("leads")))
