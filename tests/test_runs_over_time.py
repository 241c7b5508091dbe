"""What carries over between runs: quota consumption and the position of the promotion stream."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leadloom.plans.quota_run import quota_run
from leadloom.schemas import LEADS
from leadloom.sources.tables import TableStore
from leadloom.streaming.ingest import start_promotion_stream

CAPS = [("a.in", 3), ("b.in", 1)]


def counts(store):
    return {(r.date, r.domain): r.consumed for r in store.read_together("quota", "request_counts").collect()}


def run(spark, store, rows, **more):
    requests = spark.createDataFrame(rows, "seq BIGINT, date STRING, domain STRING")
    caps = spark.createDataFrame(CAPS, "domain STRING, cap INT")
    return {r.seq: r.allowed for r in quota_run(store, requests, caps, **more).collect()}


def test_consumption_carries_over_and_a_new_day_starts_from_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    day = "2026-01-30"
    assert run(spark, store, [(0, day, "a.in"), (1, day, "a.in"), (2, day, "b.in"), (3, day, "b.in"), (4, day, "c.in"), (5, day, None)]) == {
        0: True, 1: True, 2: True, 3: False, 4: False, 5: False}
    assert counts(store) == {(day, "a.in"): 2, (day, "b.in"): 1}
    marked = store.read_together("quota", "request_counts").unionByName(
        spark.createDataFrame([(day, "__tested", 1)], "date STRING, domain STRING, consumed BIGINT"))
    store.overwrite_together("quota", {"request_counts": marked})
    assert run(spark, store, [(6, day, "a.in"), (7, day, "a.in"), (8, day, "b.in"), (9, day, "__tested")]) == {6: True, 7: False, 8: False, 9: False}
    assert counts(store) == {(day, "a.in"): 3, (day, "b.in"): 1, (day, "__tested"): 1}
    assert run(spark, store, [(10, "2026-01-31", "b.in")]) == {10: True}
    assert counts(store) == {("2026-01-31", "b.in"): 1}
    assert run(spark, store, []) == {} and counts(store) == {("2026-01-31", "b.in"): 1}
    assert run(spark, store, [(11, "2026-02-01", "b.in")], keep_days=1) == {11: True}
    assert counts(store) == {("2026-01-31", "b.in"): 1, ("2026-02-01", "b.in"): 1}


def test_a_failed_run_has_consumed_nothing(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "db"))
    run(spark, store, [(0, "2026-01-30", "a.in")])
    typed = TableStore._typed

    def broken(self, name, df):
        if name == "request_counts":
            raise OSError("no space left")
        return typed(self, name, df)

    monkeypatch.setattr(TableStore, "_typed", broken)
    with pytest.raises(OSError):
        run(spark, store, [(1, "2026-01-30", "a.in"), (2, "2026-01-30", "a.in")])
    monkeypatch.undo()
    assert counts(store) == {("2026-01-30", "a.in"): 1}
    assert run(spark, store, [(1, "2026-01-30", "a.in"), (2, "2026-01-30", "a.in"), (3, "2026-01-30", "a.in")]) == {1: True, 2: True, 3: False}


def staged(spark, path, rows):
    base = spark.createDataFrame(rows, "seq BIGINT, company_name STRING, dedup_key STRING")
    fields = spark.createDataFrame([], LEADS).schema.fields
    df = base.select(*[(F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])
    df.coalesce(1).write.mode("append").parquet(path)


def test_replayed_batch_adds_nothing_twice(spark, tmp_path):
    store, files, position = TableStore(spark, str(tmp_path / "db")), str(tmp_path / "in"), str(tmp_path / "pos")
    go = lambda: start_promotion_stream(spark, files, store, position, files_per_batch=1).awaitTermination()
    names = lambda: sorted(r.company_name for r in store.read("leads").collect())
    staged(spark, files, [(0, "One", "k1"), (1, "Keyless", ""), (2, "Two", "k2"), (3, "Two again", "k2")])
    go()
    assert names() == ["Keyless", "One", "Two"]
    staged(spark, files, [(4, "One again", "k1"), (5, "Three", "k3"), (6, "Keyless too", None)])
    go()
    want = ["Keyless", "Keyless too", "One", "Three", "Two"]
    assert names() == want
    # The last batch was written, but the stream died before noting it: it comes again.
    last = max(Path(position, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    shutil.move(last, tmp_path / "lost")
    for p in Path(position, "commits").glob(".*.crc"):
        shutil.move(p, tmp_path / p.name)
    go()
    assert names() == want
    # A full replacement of the table leaves earlier batches behind.
    store.overwrite("leads", store.read("leads").where("company_name = 'One'"))
    assert names() == ["One"]
    staged(spark, files, [(7, "Three", "k3")])
    go()
    assert names() == ["One", "Three"]
