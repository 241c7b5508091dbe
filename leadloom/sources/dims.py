"""Crawl configuration as small dimension tables.

Configuration is read on the driver: it is written by hand and bounded by its file.
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from leadloom.constants import DEFAULT_MAX_PAGES, FUZZY_THRESHOLD

try:
    import yaml
except ImportError:  # JSON configuration still works
    yaml = None


def load_config(path: str) -> dict[str, Any]:
    """Mapping from a YAML or JSON file; empty if the file is missing or holds something else.

    A malformed file is an error: a run without any target would look like a sound one.
    """
    file = Path(path)
    if not file.exists():
        return {}
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        data = json.loads(text)
    elif yaml is None:
        raise RuntimeError("reading YAML configuration needs PyYAML; use JSON instead")
    else:
        try:
            data = yaml.safe_load(text)
        except yaml.YAMLError as error:
            raise ValueError(f"{path} is no valid YAML") from error
    return data if isinstance(data, dict) else {}


def _entries(config: dict[str, Any], key: str) -> list:
    value = config.get(key, [])
    return value if isinstance(value, list) else []


def icp_list(config: dict[str, Any], key: str) -> set[str]:
    """Slugs of ``icp_categories`` / ``icp_cities`` (plain or ``{slug: ...}`` entries)."""
    return {c["slug"] if isinstance(c, dict) else str(c) for c in _entries(config, key)}


def fuzzy_threshold(config: dict[str, Any]) -> int:
    try:
        return int(config.get("fuzzy_match_threshold", FUZZY_THRESHOLD))
    except (TypeError, ValueError):
        return FUZZY_THRESHOLD


def url_templates(config: dict[str, Any]) -> dict[str, str]:
    value = config.get("url_templates", {})
    return value if isinstance(value, dict) else {}


def _as_int(value: Any) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def targets_df(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """One row per configured target. A non-integer ``max_pages`` is stored as 0 (unusable)."""
    rows = []
    for t in _entries(config, "targets"):
        limit = t.get("max_pages", DEFAULT_MAX_PAGES)
        rows.append((
            t.get("name", ""), bool(t.get("enabled", False)), t.get("parser"),
            _as_int(t.get("pages", 3)), _as_int(limit) if _as_int(limit) is not None else 0,
            _as_int(t.get("max_requests_per_day", 100)),
            _as_int((t.get("fetch_kwargs") or {}).get("max_detail_pages", 20)),
        ))
    return spark.createDataFrame(
        rows,
        "name STRING, enabled BOOLEAN, parser STRING, pages INT, max_pages INT, "
        "max_requests_per_day INT, max_detail_pages INT",
    )


def categories_df(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    rows = [
        (i, c.get("slug", ""), dict(c.get("labels") or {}))
        for i, c in enumerate(_entries(config, "categories"))
    ]
    return spark.createDataFrame(rows, "pos INT, slug STRING, labels MAP<STRING, STRING>")


def cities_df(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    rows = [
        (i, c.get("slug", ""), dict(c.get("labels") or {}), c.get("tradeindia_code"))
        for i, c in enumerate(_entries(config, "cities"))
    ]
    return spark.createDataFrame(rows, "pos INT, slug STRING, labels MAP<STRING, STRING>, code STRING")
