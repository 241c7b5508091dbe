"""Daily request quotas whose consumption carries over from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.operators.frontier import daily_quota
from leadloom.session import stored
from leadloom.sources.tables import TableStore

GROUP = "quota"


def advanced(counts: DataFrame, decisions: DataFrame, keep_days: int) -> DataFrame:
    """Consumption per date and domain after a run: what was there plus the requests allowed.

    A denied request consumes nothing. Entries whose domain starts with two underscores are markers of
    the day and stay as they are. Days more than ``keep_days`` before the newest one requested go: a new
    day starts from nothing.
    """
    used = decisions.where("allowed").groupBy("date", "domain").agg(F.count("*").alias("consumed"))
    total = counts.unionByName(used).groupBy("date", "domain").agg(F.sum("consumed").alias("consumed"))
    newest = decisions.agg(F.max("date")).first()[0]
    if newest is None:
        return total
    return total.where(F.datediff(F.lit(newest).cast("date"), F.col("date").cast("date")) <= keep_days)


def quota_run(store: TableStore, requests: DataFrame, caps: DataFrame, keep_days: int = 0) -> DataFrame:
    """Decide a run's requests against the stored consumption; returns ``seq, date, domain, allowed``.

    Decisions and new consumption are one version: a run that fails before its end has consumed nothing
    and is simply run again. ``requests``: ``seq, date, domain``; caps: ``domain, cap``.
    """
    before = store.read_together(GROUP, "request_counts")
    markers = F.col("domain").startswith("__")
    flagged = daily_quota(requests.select("seq", "date", "domain"), caps, before.where(~markers))
    flagged = stored(flagged.select("seq", "date", "domain", "allowed"))
    store.overwrite_together(GROUP, {"request_decisions": flagged, "request_counts": advanced(before, flagged, keep_days)})
    return store.read_together(GROUP, "request_decisions")
