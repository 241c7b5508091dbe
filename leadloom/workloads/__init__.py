"""Benchmark queries over the given tables. Importing this package fills the catalog."""

from leadloom.workloads import q_crawl, q_extract, q_graph, q_leads, q_sources, q_text  # noqa: F401
from leadloom.workloads.catalog import ORACLES, QUERIES  # noqa: F401
