"""Failure gate, promotion and run summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import FAILURE_LIMIT
from leadloom.functions.text import blank_to_null, not_blank, present
from leadloom.operators.dedup import existing_keys, filter_new_rows


class ThresholdExceeded(RuntimeError):
    """Too many failing targets: promotion is refused."""


def _one_row(named: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row with one scalar per name, each from its own aggregate (no cross join)."""
    parts = [df.agg(value.cast("bigint").alias("n")).select(F.lit(name).alias("name"), "n")
             for name, (df, value) in named.items()]
    return reduce(DataFrame.unionByName, parts).groupBy().agg(
        *[F.coalesce(F.max(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(name)
          for name in named]
    )


def failure_gate(
    errors: DataFrame, targets: DataFrame, mode: str = "rows", limit: float = FAILURE_LIMIT,
    run_id: str | None = None,
) -> DataFrame:
    """One row: error and target counts, rate and whether the run passes.

    ``mode='rows'`` counts error rows (inside a run), ``'urls'`` distinct failing URLs
    (standalone promotion). All targets count, disabled ones too; no target passes.
    ``run_id`` restricts a shared error table to one run.
    """
    if run_id is not None:
        errors = errors.where(F.col("run_id") == run_id)
    if mode == "rows":
        numerator = F.count("*")
    elif mode == "urls":
        numerator = F.count_distinct(blank_to_null("url"))
    else:
        raise ValueError(f"unknown gate mode {mode!r}")
    counts = _one_row(
        {"error_count": (errors, numerator), "target_count": (targets, F.count("*"))}
    )
    rate = F.when(F.col("target_count") > 0, F.col("error_count") / F.col("target_count"))
    return counts.withColumn("failure_rate", F.coalesce(rate, F.lit(0.0))).withColumn(
        "passed", F.col("failure_rate") <= F.lit(limit)
    )


def require_gate(gate: DataFrame) -> None:
    """Raise unless the single gate row passed."""
    row = gate.first()
    if not row["passed"]:
        raise ThresholdExceeded(
            f"failure rate {row['failure_rate']:.0%} "
            f"({row['error_count']}/{row['target_count']} targets) is over the limit"
        )


def promotable(staging: DataFrame) -> DataFrame:
    """Staged rows with at least one non-blank cell (``seq`` is ours, not a cell)."""
    def filled(name: str, dtype: str) -> Column:
        if dtype == "string":
            return not_blank(name)
        return F.col(name).isNotNull()

    cells = [filled(n, t) for n, t in staging.dtypes if n != "seq"]
    return staging.where(reduce(Column.__or__, cells))


def promote(staging: DataFrame, leads: DataFrame) -> DataFrame:
    """Rows to append to ``leads``: non-blank staged rows whose key is new."""
    return filter_new_rows(promotable(staging), existing_keys(leads))


def run_summary(
    raw: DataFrame, valid: DataFrame, rejected: DataFrame, errors: DataFrame, invalid: DataFrame,
) -> DataFrame:
    """One row of run counts; a raw record with any enrichment field counts as enriched."""
    enriched = F.count_if(F.col("employee_count").isNotNull() | F.col("revenue_band").isNotNull())
    return _one_row(
        {
            "scraped": (raw, F.count("*")),
            "enriched_count": (raw, enriched),
            "kept_after_validation": (valid, F.count("*")),
            "rejected_duplicates": (rejected, F.count("*")),
            "errors": (errors, F.count("*")),
            "invalid_records": (invalid, F.count("*")),
        }
    )


def staged_summary(leads: DataFrame, staged: DataFrame, errors: DataFrame) -> DataFrame:
    """The counts of :func:`run_summary` once the valid leads are stored.

    Rejected and invalid rows follow from key counts, so this reads three columns of the
    leads instead of running deduplication again.
    """
    keyed = not_blank("dedup_key")
    enriched = F.count_if(F.col("employee_count").isNotNull() | F.col("revenue_band").isNotNull())
    duplicates = F.count_if(keyed) - F.count_distinct(F.when(keyed, F.col("dedup_key")))
    counts = leads.agg(
        F.count("*").alias("scraped"), enriched.alias("enriched_count"),
        duplicates.alias("rejected_duplicates"),
    )
    stored = _one_row(
        {"kept_after_validation": (staged, F.count("*")), "errors": (errors, F.count("*"))}
    )
    # Two single-row inputs.
    both = counts.withColumn("one", F.lit(1)).join(stored.withColumn("one", F.lit(1)), "one")
    invalid = F.col("scraped") - F.col("rejected_duplicates") - F.col("kept_after_validation")
    return both.select(
        "scraped", "enriched_count", "kept_after_validation", "rejected_duplicates", "errors",
        invalid.alias("invalid_records"),
    )


__all__ = [
    "ThresholdExceeded", "failure_gate", "require_gate", "promotable", "promote",
    "run_summary", "staged_summary", "present",
]
